"""Line dedup: lines that many documents hold stay in one of them.

Texts are exploded to normalised lines, which are hashed; documents are counted distinctly by hash, in two steps, so that
no hash gathers its documents in one task. Lines of hashes over the threshold go from all documents but the largest, and
what is left of a document is put together again by the lines' places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_slices

#: Lines of so many code points, found in so many documents, are repeats.
MIN_CHARS, MIN_DOCS = 20, 3
BLANK = b" \t\n\v\f\r"

NEW = ("n_lines", "n_dropped", "kept_sha256", "kept_text")


def line_key(line: bytes, least: int) -> bytes | None:
    """128-bit hash of the line without blanks at its ends and with A-Z in lower case; None for fewer than least code points."""
    key = line.strip(BLANK).lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def exploded(docs: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row, key, places) for each distinct key of each row of docs (doc_id, row, text): where its lines are, from 0."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                owner, keys, places = [], [], []
                for i, text in enumerate(part.column("text").cast(pa.binary())):
                    found: dict[bytes, list[int]] = {}
                    for at, line in enumerate((text.as_py() or b"").split(b"\n")):
                        if key := line_key(line, least):
                            found.setdefault(key, []).append(at)
                    owner += [i] * len(found)
                    keys += found.keys()
                    places += found.values()
                at = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(at), part.column("row").take(at), pa.array(keys, pa.binary()), pa.array(places, pa.list_(pa.int32()))], ["doc_id", "row", "key", "places"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "row", "text").mapInArrow(explode, f"doc_id {kind}, row binary, key binary, places array<int>")


def repeated_keys(lines: DataFrame, least: int = MIN_DOCS) -> DataFrame:
    """(key, last): keys that at least so many distinct doc_ids hold, with the largest of them."""
    pairs = lines.select("key", "doc_id").distinct()
    return pairs.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("last")).where(F.col("n") >= least).select("key", "last")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with n_lines (before dropping), n_dropped, kept_sha256 and kept_text.

    Lines lie between \\n; a null or empty text is one empty line. A line goes if its key - the line without ASCII white
    space at its ends, A-Z in lower case - has at least min_chars code points, is found in at least min_docs documents,
    and the document isn't the largest doc_id that holds it. Others stay as they are, joined by \\n; kept_text of a null
    text is null, its digest that of the empty text.

    Documents are doc_ids: rows that share one are one document and keep or lose a line together. Rows without doc_id are
    one document, smaller than all. Columns of docs with the names of the new ones are replaced; others pass through.
    An empty docs gives an empty result.

    Shuffles: keys with their ids twice and thrice (they are written in between, once), and the texts once, to meet
    the places of their dropped lines. Of a line that a third of all documents hold, counts are added up in each task
    before they meet, and the join that marks its documents is one that Spark can split.
    """
    names = [c for c in docs.columns if c not in NEW]
    other = {c: f"c{i}" for i, c in enumerate(names) if c not in ("doc_id", "text")}  # clashes with no name used here
    # a row is known by its id and its text, so that the dropped places of one group are those of one text
    digest = F.unhex(F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 32)).alias("row")
    rows = docs.select("doc_id", "text", digest, *(F.col(f"`{c}`").alias(k) for c, k in other.items()))
    lines = stage(exploded(rows, min_chars).distinct(), "line-keys")
    # written, so that both sides of the join are exchanges of their own, of which Spark can split a hot key's
    repeated = stage(repeated_keys(lines, min_docs), "repeated-keys")
    gone = lines.join(repeated, "key").where(~F.col("doc_id").eqNullSafe(F.col("last")))
    dropped = gone.groupBy(F.col("doc_id").alias("_of"), F.col("row").alias("_row")).agg(F.flatten(F.collect_list("places")).alias("places"))
    marked = rows.join(dropped, F.col("doc_id").eqNullSafe(F.col("_of")) & (F.col("row") == F.col("_row")), "left").drop("_of", "_row", "row")

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                n_lines, n_dropped, sha, kept = [], [], [], []
                for text, places in zip(part.column("text").cast(pa.binary()), part.column("places"), strict=True):
                    said, drop = (text.as_py() or b"").split(b"\n"), set(places.as_py() or ())
                    left = b"\n".join(x for at, x in enumerate(said) if at not in drop)
                    n_lines.append(len(said))
                    n_dropped.append(len(drop))
                    sha.append(hashlib.sha256(left).hexdigest())
                    kept.append(left.decode() if text.is_valid else None)
                made = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays([*(part.column(other.get(c, c)) for c in names), *made], [*names, *NEW])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*(f"`{c}`" for c in names)).schema)
    return marked.mapInArrow(reassemble, f"{fields}, n_lines long, n_dropped long, kept_sha256 string, kept_text string")
