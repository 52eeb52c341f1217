"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices

#: Lengths of the character n-grams.
ORDERS = (2, 3)
#: Hash buckets, alike for any number of languages. The broadcast model has 4 bytes for each bucket and language; beyond
#: MODEL_CELLS (256 MB, 1024 languages at this many buckets) fit() raises and asks for fewer buckets.
BUCKETS = 1 << 16
MODEL_CELLS = 1 << 26
#: The classifier is fitted on at most about this many labelled rows. Each language has an equal share of them: all its
#: rows if it has no more, else about that many, picked by a hash of doc_id.
FIT_ROWS = 40_000
#: The share of a language is never below this, so that it is learned however many languages there are.
LEAST_ROWS = 100
HASHES = 1 << 40
SMOOTHING = 0.1
UNKNOWN = "und"


def fold_of(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def _points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, each text between two blanks, and the places where the texts begin."""
    strings = [f" {(t or '').lower()} " for t in texts.to_pylist()]
    off = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
    return np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32), off


def _grams(points: np.ndarray, off: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket of each n-gram, place where it begins) for each order; no n-gram crosses two texts."""
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    for n in ORDERS:
        if len(points) < n:
            continue
        h = points[: len(points) - n + 1] * np.uint32(0x9E3779B1)
        for i in range(1, n):
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) + points[i : len(points) - n + 1 + i] * np.uint32(0xC2B2AE3D)
        h = ((h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F)) >> np.uint32(8)
        whole = row[: len(points) - n + 1] == row[n - 1 :]
        yield (h % np.uint32(buckets))[whole], row[: len(points) - n + 1][whole]


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """(languages, log-probability matrix buckets x languages) from rows (doc_id, text, lang).

    Tasks return bucket counts per language, summed by Spark; the driver only sees the languages x buckets sums. Rows
    with null text or null lang are left out, and languages of which no row has an n-gram. No labelled rows: no languages.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((buckets, 0), np.float32)
    if buckets * len(langs) > MODEL_CELLS:
        raise ValueError(f"{buckets} buckets for {len(langs)} languages pass {MODEL_CELLS} cells; give fewer buckets")
    quota = max(LEAST_ROWS, fit_rows / len(langs))
    large = [(lang, int(HASHES * quota / n)) for lang, n in sizes.items() if n > quota]
    if large:
        shares = rows.sparkSession.createDataFrame(large, "lang string, below long")
        drawn = F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(HASHES)) < F.coalesce("below", F.lit(HASHES))
        rows = rows.join(F.broadcast(shares), "lang", "left").where(drawn).select("doc_id", "text", "lang")
    number = {lang: i for i, lang in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(langs) * buckets, np.int64)
        for batch in batches:
            for part in text_slices(batch):
                lang = np.array([number[x] for x in part.column("lang").to_pylist()], np.int64)
                for h, row in _grams(*_points(part.column("text")), buckets):
                    sums += np.bincount(lang[row] * buckets + h, minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["cell", "n"])

    cells = rows.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(langs) * buckets)
    counts[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(float)
    counts = counts.reshape(len(langs), buckets).T
    seen = counts.any(axis=0)
    langs, counts = [lang for lang, ok in zip(langs, seen, strict=True) if ok], counts[:, seen] + SMOOTHING
    return langs, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def predict(docs: DataFrame, langs: list[str], matrix: np.ndarray) -> DataFrame:
    """docs with lang_pred and score (posterior of lang_pred under equal priors); columns of these names are replaced.

    Of languages that score alike the first by code point is named. A text that is null, empty or without a letter gets UNKNOWN and score 0, as do all texts if no language was learned.
    Only the text is looked at. Map-only; the matrix is broadcast, at most 256 MB.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    model = docs.sparkSession.sparkContext.broadcast((langs, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, logp = model.value
        for batch in batches:
            for part in text_slices(batch):
                texts = part.column("text")
                points, off = _points(texts)
                score = np.zeros((len(texts), max(1, len(known))))
                if known:
                    for h, row in _grams(points, off, len(logp)):
                        for i in range(len(known)):
                            score[:, i] += np.bincount(row, weights=logp[h, i], minlength=len(texts))
                best = score.argmax(axis=1)
                top = 1 / np.exp(score - score.max(axis=1, keepdims=True)).sum(axis=1)
                named = [bool(known) and t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()]
                pred = [known[b] if ok else UNKNOWN for b, ok in zip(best, named, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(pred, pa.string()), pa.array(np.where(named, top, 0.0))], [*names, "lang_pred", "score"]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    return docs.select(*names).mapInArrow(run, f"{fields}, lang_pred string, score double")


def identify(docs: DataFrame, held_out: int = 0, folds: int = 5, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Fit on the labelled rows outside one fold and predict every row: doc_id, held_out, lang_pred, score.

    A null doc_id belongs to no fold: it is neither learned from nor held out.
    """
    fold = fold_of(F.col("doc_id"), folds)
    langs, matrix = fit(docs.where(fold != held_out), fit_rows)
    return predict(docs.select("doc_id", "text"), langs, matrix).select("doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
