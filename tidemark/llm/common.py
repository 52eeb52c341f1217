"""Helpers that several operators share: word splitting and hashing in numpy, batch slicing, staged tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.shared import drop, drop_staged, drop_table, shared_dir, stage, staged_dir

__all__ = ["drop", "drop_staged", "drop_table", "shared_dir", "stage", "staged_dir"]

#: Bytes of text that one numpy step works on; temporary arrays take about 50 times as much.
CHUNK_BYTES = 1 << 20

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def offsets(arr: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    if len(arr) == 0:
        return np.zeros(1, np.int64)
    return np.frombuffer(arr.buffers()[1], kind)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of batch with at most limit bytes of text each, or one row."""
    off = offsets(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings of arr, and the len + 1 places where they begin."""
    off = offsets(arr)
    data = arr.buffers()[2] if len(arr) else None
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_bounds(raw: np.ndarray, off: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after the last, row) of each word; a word never crosses two rows."""
    if not len(raw):
        return (np.zeros(0, np.int64),) * 3
    gap = space[raw]
    begin = np.empty(len(raw), bool)
    begin[0] = True
    begin[1:] = gap[:-1]
    inner = off[(off > 0) & (off < len(raw))]
    begin[inner] = True
    begin &= ~gap
    final = np.empty(len(raw), bool)
    final[-1] = True
    final[:-1] = gap[1:]
    final[inner - 1] = True
    final &= ~gap
    first, last = np.flatnonzero(begin), np.flatnonzero(final) + 1
    return first, last, np.searchsorted(off, first, "right") - 1


@lru_cache(4)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, base, _U), np.full(n + 1, pow(base, -1, 1 << 64), _U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def hash_spans(raw: np.ndarray, first: np.ndarray, last: np.ndarray, base: int = _BASE) -> np.ndarray:
    """A 64-bit hash of each byte span, from prefix sums of a polynomial."""
    size = 1 << max(16, int(len(raw)).bit_length())
    up, down = _powers(size, base)
    total = np.zeros(len(raw) + 1, _U)
    np.cumsum((raw.astype(_U) + _U(1)) * up[: len(raw)], out=total[1:])
    return mix((total[last] - total[first]) * down[first] + (last - first).astype(_U) * _U(0xD6E8FEB86659FD93))


def hash_windows(words: np.ndarray, n: int, base: int) -> np.ndarray:
    """Hash of words[i:i+n] for every i, over plain 64-bit word hashes."""
    if len(words) < n:
        return np.zeros(0, _U)
    out = np.zeros(len(words) - n + 1, _U)
    for i in range(n):
        out = out * _U(base) + words[i : len(words) - n + 1 + i]
    return mix(out)


def hash_runs(values: np.ndarray, first: np.ndarray, last: np.ndarray, base: int = 0x94D049BB133111EB) -> np.ndarray:
    """Hash of values[first:last] for many ranges of 64-bit values, from prefix sums of a polynomial."""
    up, down = _powers(1 << max(16, int(len(values)).bit_length()), base)
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(mix(values) * up[: len(values)], out=total[1:])
    return mix((total[last] - total[first]) * down[first] + (last - first).astype(_U))
