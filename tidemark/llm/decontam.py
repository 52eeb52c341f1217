"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items, each text scanned once."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

WINDOW = 10
#: Windows in one broadcast automaton (about 0.5 kB each). A larger benchmark is scanned for in blocks of this many.
BLOCK_WINDOWS = 200_000
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_GAP = re.compile(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def normalise(text: str) -> str:
    """Lower-case A-Z; words joined by one blank, with a blank before the first and after the last."""
    words = _GAP.sub(" ", text.translate(_LOWER)).strip(" ")
    return f" {words} " if words else " "


def windows(text: str, size: int = WINDOW) -> list[str]:
    """All windows of an item: size consecutive words, or the whole of a shorter item that has words."""
    words = normalise(text).split()
    return [f" {' '.join(words[i : i + size])} " for i in range(max(1, len(words) - size + 1))] if words else []


def automaton(patterns: dict[str, list]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for window, items in patterns.items():
        found.add_word(window, (window.count(" ") - 1, items))
    found.make_automaton()
    return found


_HITS = "hits array<struct<first:int,last:int>>"
_HIT_TYPE = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """docs with n_words, hits (maximal runs [first, last] of hit word numbers) and items (ids whose windows occur).

    Columns of docs with these names are replaced.

    benchmark has item_id, of any type that sorts, and text; an item without words (null, empty) and one with a null id have no windows. The
    benchmark is streamed to the driver in order of nothing in particular and cut in blocks of at most block_windows
    windows; each block is an automaton of its own and one map-only pass, so a benchmark of any size works and what is
    broadcast stays bounded. A document with null text has no words. No shuffle of documents.
    """
    names = [c for c in docs.columns if c not in ("n_words", "hits", "items")]
    listed = pa.list_(to_arrow_type(benchmark.schema["item_id"].dataType))
    kind = dict(benchmark.dtypes)["item_id"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    out, none_yet = docs.select(*names), True
    block: dict[str, list] = defaultdict(list)

    def one_pass(df: DataFrame, patterns: dict[str, list], fresh: bool) -> DataFrame:
        return df.mapInArrow(_scanner(df.sparkSession.sparkContext.broadcast(dict(patterns)), names, fresh, listed), f"{fields}, n_words long, {_HITS}, items array<{kind}>")

    for item in benchmark.select("item_id", "text").toLocalIterator():
        if item["text"] is None or item["item_id"] is None:
            continue
        for w in dict.fromkeys(windows(item["text"], size)):
            block[w].append(item["item_id"])
        if len(block) >= block_windows:
            out, none_yet = one_pass(out, block, none_yet), False
            block.clear()
    return one_pass(out, block, none_yet) if block or none_yet else out


#: The last patterns that this process has met and their automaton, so that its tasks share one.
_CACHE: dict = {}


def _machine(patterns: dict[str, list]):
    if _CACHE.get("of") is not patterns:
        _CACHE.update(of=patterns, machine=automaton(patterns) if patterns else None)
    return _CACHE["machine"]


def _scanner(patterns, names: list[str], fresh: bool, listed: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(patterns.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts, hits, items = [], [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    norm = normalise(text or "")
                    n = norm.count(" ") - 1
                    counts.append(max(0, n))
                    spans, ids = [], set()
                    if not fresh:
                        spans = [(h["first"], h["last"]) for h in part.column("hits")[i].as_py()]
                        ids = set(part.column("items")[i].as_py())
                    if machine is not None and n > 0:
                        ends = list(machine.iter(norm))
                        if ends:
                            blanks = np.flatnonzero(np.frombuffer(norm.encode("utf-32-le"), np.uint32) == 32)
                            for end, (length, found) in ends:
                                last = int(np.searchsorted(blanks, end)) - 1
                                spans.append((last - length + 1, last))
                                ids.update(found)
                    hits.append([{"first": a, "last": b} for a, b in _union(spans)])
                    items.append(sorted(ids))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(counts, pa.int64()), pa.array(hits, _HIT_TYPE), pa.array(items, listed)],
                    [*names, "n_words", "hits", "items"],
                )

    return run


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def original_spans(text: str | None, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where runs of hit words lie in the original text, as character ranges [start, end)."""
    if not text or not hits:
        return []
    words = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    return [(words[a][0], words[b][1]) for a, b in hits]


def with_spans(scanned: DataFrame) -> DataFrame:
    """scanned with spans: the hits mapped to character ranges [start, end) of the original text."""
    names = [c for c in scanned.columns if c != "spans"]
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = zip(part.column("text").to_pylist(), part.column("hits").to_pylist(), strict=True)
                found = [[{"start": a, "end": b} for a, b in original_spans(t, [(h["first"], h["last"]) for h in hs or []])] for t, hs in rows]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(found, spans)], [*names, "spans"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scanned.select(*names).schema)
    return scanned.mapInArrow(run, f"{fields}, spans array<struct<start:bigint,end:bigint>>")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    scanned = scan(docs.select("doc_id", "text"), benchmark)
    kind = dict(docs.dtypes)["doc_id"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, items = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            n_hit = [sum(h["last"] - h["first"] + 1 for h in hs) for hs in hits]
            sha = [hashlib.sha256(",".join(sorted(map(str, x))).encode()).hexdigest() for x in items]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit, pa.int64()), pa.array(list(map(len, items)), pa.int64()), pa.array(sha, pa.string()), pa.array([n > 0 for n in n_hit], pa.bool_())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    schema = f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return scanned.drop("text").mapInArrow(digest, schema)
