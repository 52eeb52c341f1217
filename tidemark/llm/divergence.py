"""Source divergence audit: how far the term distributions of a language's sources lie apart, exactly, in whole numbers.

A divergence is a sum over all terms of a language, but most terms are missing from most sources. Inclusion-exclusion over
the supports prices it without a dense table: what every term would cost if both sources lacked it is one product; the
terms of one source are priced through a histogram of its counts, as if the other lacked them all; only terms that both
hold meet in a join of postings, which corrects what the two histograms said of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_bytes, text_slices, word_bounds

#: A probability is a whole number of this many parts; a term counts from so many documents on; term ranks
#: are listed so far.
PARTS, MIN_DOCS, TERM_RANKS = 1_000_000_000, 3, 200
#: Bytes of text counted at once.
COUNT_BYTES = 8 << 20

_BYTES = np.arange(256)
#: Terms are made of ASCII letters and of all that is not ASCII.
GAP = (_BYTES < 128) & ~(((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122))
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)

_POSTINGS = "lang string, source string, term string, n long, docs long"


def _terms(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, code, distinct terms): the terms of all rows as codes into the distinct ones."""
    first, last, row = word_bounds(raw, off, GAP)
    ends = np.concatenate([[0], np.cumsum(last - first)])
    said = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(LOWER[raw[~GAP[raw]]]))])
    coded = said.dictionary_encode()
    return row, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, how often each occurs, and the sum of its values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.diff(np.append(at, len(keys))), np.add.reduceat(values[order], at) if len(at) else at


def _pieces(raw: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """raw cut between terms, into pieces of about limit bytes; a longer term stays whole."""
    at = 0
    while at < len(raw):
        to = min(len(raw), at + limit)
        while to < len(raw) and not GAP[raw[to]]:
            to += 1
        yield raw[at:to]
        at = to


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) in pieces to be added up: occurrences and documents, counted over some MB of text each."""

    def counted(part: pa.RecordBatch) -> pa.RecordBatch:
        langs, sources = (pc.fill_null(part.column(c), "").dictionary_encode() for c in ("lang", "source"))
        group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        raw, off = text_bytes(part.column("text"))
        if len(raw) > 2 * COUNT_BYTES:  # one long text
            found = [pa.table({"term": terms, "n": np.bincount(code, minlength=len(terms))}) for _, code, terms in (_terms(x, np.array([0, len(x)])) for x in _pieces(raw, COUNT_BYTES))]
            added = pa.concat_tables(found).group_by("term", use_threads=False).aggregate([("n", "sum")])
            group, terms, n = np.repeat(group[:1], len(added)), added["term"].combine_chunks(), added["n_sum"].to_numpy()
            seen, code = np.ones(len(added), np.int64), np.arange(len(added))
        else:
            row, code, terms = _terms(raw, off)
            pairs, _, n = _added(row * len(terms) + code, np.ones(len(code), np.int64))  # a row's terms
            keys, seen, n = _added(group[pairs // max(1, len(terms))] * len(terms) + pairs % max(1, len(terms)), n)
            group, code = np.divmod(keys, max(1, len(terms)))
        named = [langs.dictionary.take(pa.array(group // len(sources.dictionary))), sources.dictionary.take(pa.array(group % len(sources.dictionary)))]
        return pa.RecordBatch.from_arrays([*named, terms.take(pa.array(code)).cast(pa.string()), pa.array(n, pa.int64()), pa.array(seen, pa.int64())], ["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=COUNT_BYTES):
                yield counted(part)

    return docs.select("lang", "source", "text").where("text IS NOT NULL").mapInArrow(count, _POSTINGS)


def postings(docs: DataFrame, least: int = MIN_DOCS) -> DataFrame:
    """(lang, term, source, n, lang_n, head): occurrences of the terms that at least so many documents of the lang hold.

    lang_n is the term's count in the lang; head is 1 in one row of each term. One shuffle, by lang and term, of counts
    that tasks have added up before; a term's rows are then at most one for each source of its lang.
    """
    dealt = count_terms(docs).repartition("lang", "term")
    added = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    known = added.withColumns({"held": F.sum("docs").over(term), "lang_n": F.sum("n").over(term), "head": F.row_number().over(term.orderBy("source"))})
    return known.where(F.col("held") >= least).select("lang", "term", "source", "n", "lang_n", (F.col("head") == 1).cast("int").alias("head"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def probability(n: str | Column, size: str | Column) -> Column:
    """1 + floor(PARTS * (n + 1) / size) in longs: long division by three digits at a time, exact up to 9 * 10^15 tokens."""
    n, size = (F.col(c) if isinstance(c, str) else c for c in (n, size))
    out, rest = F.lit(1).cast("long"), n + 1
    for digits in (1_000_000, 1000, 1):
        out, rest = out + digits * _div(rest * 1000, size), (rest * 1000) % size
    return out


def gap(p: str, q: str) -> Column:
    """floor((p - q)^2 / q)"""
    d = F.col(p) - F.col(q)
    return _div(d * d, F.col(q))


def groups(docs: DataFrame, posted: DataFrame) -> DataFrame:
    """(lang, source, size, none, v, lang_size) of every group of docs: N + V, p of a missing term, V, and the lang's N + V.

    size is null where the lang has no terms.
    """
    said = posted.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum("head").alias("heads"))
    every = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct().join(said, ["lang", "source"], "left").fillna(0, ["n", "heads"])
    lang = Window.partitionBy("lang")
    sized = every.withColumns({"v": F.sum("heads").over(lang), "total": F.sum("n").over(lang)})
    size = lambda c: F.when(F.col("v") > 0, F.col(c) + F.col("v"))
    return sized.select("lang", "source", "v", size("n").alias("size"), size("total").alias("lang_size")).withColumn("none", probability(F.lit(0), "size"))


def pair_divergences(posted: DataFrame, grouped: DataFrame) -> DataFrame:
    """(lang, source, item, value): for each source of a lang against each other one, the sum of gap(p, q) over all V terms."""
    priced = posted.join(grouped.select("lang", "source", "size", "none"), ["lang", "source"]).select("lang", "term", "source", probability("n", "size").alias("p"), "none")
    side = lambda df, k: df.select("lang", *[F.col(c).alias(f"{c}_{k}") for c in df.columns if c not in ("lang", "term")], *[c for c in df.columns if c == "term"])
    other = F.col("source_a") != F.col("source_b")
    # terms that both lack: all of them, for a start
    both = grouped.select("lang", "source", "none", "v")
    start = side(both, "a").join(side(both, "b"), "lang").where(other).select("lang", "source_a", "source_b", F.coalesce(F.col("v_a") * gap("none_a", "none_b"), F.lit(0)).alias("value"))
    # terms of a, as if b lacked them: a histogram of a's counts prices them for (a, b) and for (b, a)
    counts = posted.groupBy("lang", "source", "n").agg(F.count("*").alias("terms")).join(grouped.select("lang", "source", "size", "none"), ["lang", "source"])
    bars = side(counts.select("lang", "source", probability("n", "size").alias("p"), "none", "terms"), "a").join(side(grouped.select("lang", "source", "none"), "b"), "lang").where(other)
    one = bars.select("lang", F.inline(F.array(
        F.struct("source_a", "source_b", (F.col("terms_a") * (gap("p_a", "none_b") - gap("none_a", "none_b"))).alias("value")),
        F.struct(F.col("source_b").alias("source_a"), F.col("source_a").alias("source_b"), (F.col("terms_a") * (gap("none_b", "p_a") - gap("none_b", "none_a"))).alias("value")),
    )))
    # terms of both: what they cost, less what the two histograms said, plus the start that both took off
    dealt = priced.repartition("lang", "term")
    met = side(dealt, "a").join(side(dealt, "b"), ["lang", "term"]).where(other)
    two = met.select("lang", "source_a", "source_b", (gap("p_a", "p_b") - gap("p_a", "none_b") - gap("none_a", "p_b") + gap("none_a", "none_b")).alias("value"))
    parts = [x.groupBy("lang", "source_a", "source_b").agg(F.sum("value").alias("value")) for x in (start, one, two)]
    added = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "source_a", "source_b").agg(F.sum("value").alias("value"))
    return added.select("lang", F.col("source_a").alias("source"), F.col("source_b").alias("item"), "value")


def term_divergences(posted: DataFrame, grouped: DataFrame) -> DataFrame:
    """(lang, source, item, value): gap(p, q) of the terms that a source has more of than its lang."""
    sized = posted.join(grouped.select("lang", "source", "size", "lang_size"), ["lang", "source"])
    priced = sized.select("lang", "source", F.col("term").alias("item"), probability("n", "size").alias("p"), probability("lang_n", "lang_size").alias("q"))
    return priced.where("p > q").select("lang", "source", "item", gap("p", "q").alias("value"))


def divergence_audit(docs: DataFrame, least: int = MIN_DOCS, ranks: int = TERM_RANKS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) over docs (lang, source, text); see the module.

    Part `pair`: the other sources of the lang, all of them, by the divergence of the source from each. Part `term`: the
    first `ranks` of the source's terms by their share in its divergence from the whole lang. Ranks go by value, highest
    first, then by item in code point order.

    Null text, lang and source are ''. Rows are documents, repeated ones too. A group without terms takes part in pairs; a
    lang without kept terms has pairs of value 0 and no terms. Other columns are not read. An empty docs gives no rows.

    Work grows with the postings, and with the pairs of sources that hold a term: a result of its own size in any case.
    """
    posted = stage(postings(docs, least), "postings")
    grouped = stage(groups(docs, posted), "groups")
    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pair_divergences(posted, grouped).withColumn("rank", F.row_number().over(by))
    terms = term_divergences(posted, grouped).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= ranks)
    return pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term"))).select("lang", "source", "part", "item", "value", "rank")
