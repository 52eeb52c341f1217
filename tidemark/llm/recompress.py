"""Substring dedup by recompression.

Rounds name what repeats: first maximal runs of a word, then, round after round, adjacent pairs whose left symbol fell on
the left side of the alphabet and whose right symbol on the right side. A symbol's side and the name of a run or pair
are hashes, so all tasks name alike and no round needs a shuffle. Which symbols cover a stretch of text depends on that
stretch and little around it; each symbol carries the span of words that decides it. A symbol whose deciding span lies
inside a window stands in every copy of the window, at the same place. Hence:

* reveal: each window has a key, the first symbols that it decides and that cover REACH words, on the highest level that
  has such - at worst words. A window can only repeat in another document if its key does. Only keys are shuffled, and
  neighbouring windows share them.
* verify: windows with a key that several documents share are compared by 96-bit fingerprints of their words, the only
  step that shuffles windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_runs, hash_spans, hash_windows, mix, text_bytes, text_slices, word_bounds

WINDOW = 13
ROUNDS = 4
#: A window's key covers at least so many words.
REACH = 4
_U = np.uint64
_ODD = (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD1B54A32D192ED03)
_NO_ID = (1 << 63) - 1
_LOW = _U((1 << 48) - 1)
#: Bytes of keys that a task gathers before it deals them out.
_GATHER = 24 << 20


def _runs(name: np.ndarray, at: np.ndarray, ds: np.ndarray, de: np.ndarray, row: np.ndarray, edge: tuple[np.ndarray, np.ndarray]):
    """Name maximal runs of equal symbols. A run is decided by itself and its two neighbours."""
    n = len(name)
    fresh = np.empty(n, bool)
    fresh[0] = True
    fresh[1:] = (name[1:] != name[:-1]) | (row[1:] != row[:-1])
    i = np.flatnonzero(fresh)
    length = np.diff(np.append(i, n))
    new_row = row[i]
    new = np.where(length > 1, mix(name[i] * _U(_ODD[0]) + length.astype(_U)), name[i])
    first = np.append(True, new_row[1:] != new_row[:-1])
    last = np.append(first[1:], True)
    new_ds = np.where(first, edge[0][new_row] - 1, ds[i - 1])
    new_de = np.where(last, edge[1][new_row] + 1, de[np.minimum(i + length, n - 1)])
    return new, at[i], new_ds, new_de, new_row


def _pairs(name: np.ndarray, at: np.ndarray, ds: np.ndarray, de: np.ndarray, row: np.ndarray, edge: tuple[np.ndarray, np.ndarray], turn: int):
    """Name pairs (left, right). A pair decides itself; a lone symbol is decided together with the neighbour it missed."""
    n = len(name)
    left = (mix(name + _U(turn)) >> _U(63)).astype(bool)
    same = row[1:] == row[:-1]
    head = np.zeros(n, bool)
    head[:-1] = left[:-1] & ~left[1:] & same
    keep = np.ones(n, bool)
    keep[1:] = ~head[:-1]
    prev, nxt = np.arange(n) - 1, np.minimum(np.arange(n) + 1, n - 1)
    before = np.where(np.append(True, ~same), edge[0][row] - 1, ds[prev])
    after = np.where(np.append(~same, True), edge[1][row] + 1, de[nxt])
    new_ds = np.where(left, ds, before)
    new_de = np.where(left, after, de)
    new = np.where(head, mix(name * _U(_ODD[1]) + name[nxt] * _U(_ODD[2]) + _U(turn)), name)
    return new[keep], at[keep], new_ds[keep], new_de[keep], row[keep]


def window_keys(words: np.ndarray, row: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS, reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """(start, key) of every window of words that lies in one row; equal windows have equal keys, whatever surrounds them."""
    n = len(words)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    edge_row, begin = np.unique(row, return_index=True)
    edge = (np.zeros(int(edge_row[-1]) + 1, np.int64), np.zeros(int(edge_row[-1]) + 1, np.int64))
    edge[0][edge_row], edge[1][edge_row] = begin, np.append(begin[1:], n)
    place = np.arange(n, dtype=np.int64)
    levels = [(words, place, place, place + 1, row)]
    levels.append(_runs(*levels[-1], edge))
    for turn in range(rounds):
        levels.append(_pairs(*levels[-1], edge, turn + 1))
    start = np.flatnonzero(row[: n - window + 1] == row[window - 1 :])
    key = np.zeros(len(start), _U)
    todo = np.arange(len(start))
    for level in range(len(levels) - 1, -1, -1):
        name, at, ds, de, _ = levels[level]
        i = start[todo]
        # ds and de never fall, so the symbols that a window decides are those from t0 to t1; the first that reach will do
        t0 = np.cumsum(np.bincount(ds + 1, minlength=n + 2))[i]
        t1 = np.cumsum(np.bincount(de, minlength=n + 2))[i + window]
        last = np.append(np.searchsorted(np.append(at[1:], n), at + (reach if level else 1)) + 1, n + 2)[np.minimum(t0, len(at))]
        ok = last <= t1
        key[todo[ok]] = mix(hash_runs(name, t0[ok], last[ok]) + _U(level))
        todo = todo[~ok]
        if not len(todo):
            break
    return start, key


def _split_rows(batch: pa.RecordBatch):
    raw, off = text_bytes(batch.column("text"))
    first, last, row = word_bounds(raw, off)
    return raw, off, hash_spans(raw, first, last), row


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("_id").to_numpy(zero_copy_only=False).astype(np.int64)


def _pack(values: np.ndarray) -> bytes:
    """Integers as byte planes, so that the shuffle's compression drops the planes of zeros."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unpack(data: bytes, kind, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(kind).ravel()


#: Packets of marks. to is -1 for marks that still have to meet their like in part, else the part of documents to go on to.
_PART = "part int, to int, n int, low binary, high binary, ids binary"
_PART_NAMES = [x.split()[0] for x in _PART.split(", ")]
_PART_TYPES = [pa.int32()] * 3 + [pa.binary()] * 3


def _deal(low: np.ndarray, high: np.ndarray, ids: np.ndarray, parts: int, part: np.ndarray, met: bool, cut_bits: bool = False) -> Iterator[pa.RecordBatch]:
    """A packet for each part: its marks in order of document id, ids as differences.

    With cut_bits the marks only serve to select, and 48 bits of them beside their part are enough.
    """
    order = np.lexsort((ids, part))
    low, high, ids = low[order], high[order] if len(high) else high, ids[order]
    if cut_bits:
        low = low & _LOW
    cut = np.searchsorted(part[order], np.arange(parts + 1))
    for p in range(parts):
        a, b = int(cut[p]), int(cut[p + 1])
        if a < b:
            step = ids[a:b].copy()
            step[1:] = np.diff(ids[a:b])
            row = (p, p if met else -1, b - a, _pack(low[a:b]), high[a:b].tobytes(), _pack(step))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _PART_TYPES, strict=True)], _PART_NAMES)


def _by_document(low: np.ndarray, ids: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Met marks, each once per document, dealt out by document."""
    order = np.lexsort((low, ids))
    low, ids = low[order], ids[order]
    fresh = np.append(True, (low[1:] != low[:-1]) | (ids[1:] != ids[:-1]))[: len(ids)]
    low, ids = low[fresh], ids[fresh]
    yield from _deal(low, np.zeros(0, np.uint32), ids, parts, (mix(ids.view(_U)) >> _U(40)).astype(np.int64) % parts, True)


def _grouped(low: np.ndarray, high: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The marks in order of mark and then id, the place of each mark's first, and how many it has."""
    order = np.lexsort((ids, high, low)) if len(high) and high.any() else np.lexsort((ids, low))
    low, high, ids = low[order], high[order] if len(high) else high, ids[order]
    other = low[1:] != low[:-1]
    if len(high):
        other |= high[1:] != high[:-1]
    at = np.flatnonzero(np.append(True, other)[: len(low)])
    return low, high, ids, at, np.diff(np.append(at, len(ids)))


def _gathered(made: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], parts: int, beyond_first: bool, cut_bits: bool = False) -> Iterator[pa.RecordBatch]:
    """Packets of what a task makes, in bounded gatherings; within each, marks are combined.

    A mark that several documents of the gathering have is decided here for all of them but the smallest (or, if any
    sharing counts, for all): those go to their documents' part. Of the mark itself only its smallest document, and the
    largest if any sharing counts, goes on to meet those of other tasks. So a mark that every document has meets as many
    rows as there are gatherings, and not documents.
    """

    def out(low: np.ndarray, high: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        part = lambda x: (x >> _U(48)).astype(np.int64) % parts
        low, high, ids, at, size = _grouped(low, high, ids)
        least, most = ids[at], ids[at + size - 1]
        hit = ids > np.repeat(least, size) if beyond_first else np.repeat(most > least, size)
        send = at if beyond_first else np.unique(np.concatenate([at, (at + size - 1)[most > least]]))
        some = high[send] if len(high) else high
        yield from _deal(low[send], some, ids[send], parts, part(low[send]), False, cut_bits)
        if hit.any():
            yield from _by_document(low[hit] & _LOW if cut_bits else low[hit], ids[hit], parts)

    held, size = [], 0
    for x in made:
        held.append(x)
        size += sum(a.nbytes for a in x)
        if size >= _GATHER:
            yield from out(*map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if size:
        yield from out(*map(np.concatenate, zip(*held, strict=True)))


def _unpacked(packets: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low, high, ids = [], [], []
    for n, a, b, c in packets:
        low.append(_unpack(a, _U, n))
        high.append(np.frombuffer(b, np.uint32) if b else np.zeros(n, np.uint32))
        ids.append(np.cumsum(_unpack(c, np.int64, n)))
    return tuple(map(np.concatenate, (low, high, ids)))


def _meeting(beyond_first: bool, parts: int):
    """Stream packets sorted by part; of a part's marks those that several documents have, or a smaller document has, are
    dealt out by document, gathered over a task's parts. What is met already passes through."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held, found, size = None, [], [], 0

        def close() -> None:
            low, high, ids, at, n = _grouped(*_unpacked(held))
            hit = ids > np.repeat(ids[at], n) if beyond_first else np.repeat(ids[at + n - 1] > ids[at], n)
            if hit.any():
                found.append((low[hit], ids[hit]))

        for batch in batches:
            for part, to, *packet in zip(*(batch.column(c).to_pylist() for c in _PART_NAMES), strict=True):
                if to >= 0:
                    row = (part, to, *packet)
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _PART_TYPES, strict=True)], _PART_NAMES)
                    continue
                if held and part != of:
                    close()
                    held = []
                    if (size := sum(x.nbytes for pair in found for x in pair)) >= _GATHER:
                        yield from _by_document(*map(np.concatenate, zip(*found, strict=True)), parts)
                        found = []
                of = part
                held.append(tuple(packet))
        if held:
            close()
        if found:
            yield from _by_document(*map(np.concatenate, zip(*found, strict=True)), parts)

    return meet


def _lists(group: pa.Table) -> pa.Table:
    """A part's marks as rows (document id, its marks)."""
    low, _, ids = _unpacked(list(zip(*(group.column(x).to_pylist() for x in ("n", "low", "high", "ids")), strict=True)))
    order = np.lexsort((low, ids))
    low, ids = low[order], ids[order]
    fresh = np.append(True, (low[1:] != low[:-1]) | (ids[1:] != ids[:-1]))
    low, ids = low[fresh], ids[fresh]
    at = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    off = pa.array(np.append(at, len(ids)).astype(np.int32))
    return pa.Table.from_arrays([pa.array(ids[at]), pa.ListArray.from_arrays(off, pa.array(low.view(np.int64)))], ["_id", "marks"])


def _pooled(marks: DataFrame, beyond_first: bool, parts: int) -> DataFrame:
    """Rows (document id, its marks) of the marks that meet."""
    met = marks.repartition("part").sortWithinPartitions("part").mapInArrow(_meeting(beyond_first, parts), _PART)
    return met.groupBy("to").applyInArrow(_lists, "_id long, marks array<long>")


def _member(row: np.ndarray, value: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Whether value[i] is in the list of row[i]."""
    off = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)[off[0] : off[-1]].astype(np.int64).view(_U)
    if not len(flat):
        return np.zeros(len(value), bool)
    owner = np.repeat(np.arange(len(lists)), np.diff(off))
    salt = mix(np.arange(len(lists), dtype=_U) + _U(1))
    return np.isin(value ^ salt[row], flat ^ salt[owner])


def remove_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, parts: int | None = None) -> DataFrame:
    """docs with n_words, n_removed, kept_sha256 and kept_text.

    Words are what lies between ASCII white space. A word goes if it is covered by a window of `window` words that also
    starts in a document with a smaller doc_id; all windows are judged on the input. kept_text is the kept words joined by
    one blank, or the text unchanged where nothing goes; kept_sha256 is the digest of the joined words in UTF-8.

    Null text has no words and stays null. A null doc_id counts as the largest id. Rows that share an id don't take from
    each other, and all lose to smaller ids. Columns of docs with the names of the new ones are replaced.

    doc_id must be a whole number or a string of one; others raise.

    Shuffles: keys (7 bytes or so for a third of the words), windows under shared keys, and the documents once by id, both
    joins with the documents using that one exchange. parts (default: twice the shuffle partitions) splits keys and
    windows by hash. A task combines what it has gathered before that, so of a passage that all documents hold a part
    gets two rows from each gathering of a task, some 24 MB of keys.
    """
    spark = docs.sparkSession
    parts = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    new = ("n_words", "n_removed", "kept_sha256", "kept_text")
    names = [c for c in docs.columns if c not in new]
    other = {c: f"c{i}" for i, c in enumerate(names) if c != "text"}  # whatever a column is called, it clashes with none
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("_id"), "text", *(F.col(f"`{c}`").alias(k) for c, k in other.items()))

    def reveal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for batch in batches:
                for part in text_slices(batch):
                    _, _, words, row = _split_rows(part)
                    start, key = window_keys(words, row, window, rounds)
                    if len(start):
                        owner = row[start]
                        fresh = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))
                        yield key[fresh], np.zeros(0, np.uint32), _ids(part)[owner[fresh]]

        yield from _gathered(made(), parts, False, cut_bits=True)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for batch in batches:
                for part in text_slices(batch):
                    _, _, words, row = _split_rows(part)
                    start, key = window_keys(words, row, window, rounds)
                    if not len(start):
                        continue
                    hit = start[_member(row[start], key & _LOW, part.column("marks"))]
                    low, high = hash_windows(words, window, _ODD[0])[hit], hash_windows(words, window, _ODD[1])[hit]
                    yield low, (high >> _U(32)).astype(np.uint32), _ids(part)[row[hit]]

        yield from _gathered(made(), parts, True)

    shared = _pooled(rows.select("_id", "text").mapInArrow(reveal, _PART), False, parts)
    candidates = rows.join(shared.hint("shuffle_hash"), "_id")
    repeats = _pooled(candidates.mapInArrow(verify, _PART), True, parts)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                raw, off, words, row = _split_rows(part)
                n_words = np.bincount(row, minlength=part.num_rows)
                lists = part.column("marks")
                gone = np.zeros(len(words) + 1, np.int64)
                if lists.null_count < len(lists) and len(words) >= window:
                    start = np.flatnonzero(row[: len(words) - window + 1] == row[window - 1 :])
                    low = hash_windows(words, window, _ODD[0])[start]
                    hit = start[_member(row[start], low, lists)]
                    gone += np.bincount(hit, minlength=len(gone)) - np.bincount(hit + window, minlength=len(gone))
                gone = np.cumsum(gone)[:-1] > 0
                n_removed = np.bincount(row[gone], minlength=part.num_rows)
                ends = np.concatenate([[0], np.cumsum(n_words)])
                sha, kept = [], []
                texts, data = part.column("text"), raw.tobytes()
                for i in range(part.num_rows):
                    said = data[off[i] : off[i + 1]].split()
                    if n_removed[i]:
                        said = list(compress(said, ~gone[ends[i] : ends[i + 1]]))
                    joined = b" ".join(said)
                    sha.append(hashlib.sha256(joined).hexdigest())
                    kept.append(joined.decode() if n_removed[i] else texts[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(other.get(c, c)) for c in names), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())],
                    [*names, *new],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    return rows.join(repeats.hint("shuffle_hash"), "_id", "left").mapInArrow(remove, f"{fields}, n_words long, n_removed long, kept_sha256 string, kept_text string")
