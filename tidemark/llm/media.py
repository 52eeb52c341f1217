"""Media columns: find what a blob really is, carve what it embeds, and store bytes as lossless media.

An Aho-Corasick automaton over the magic bytes scans each blob once. A hit counts only if the format's validator
confirms the structure and the length that the header states, so text that happens to hold a magic string is no media.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Payloads are padded with zero bytes to a positive multiple of this; it is also the pixel width of stored images.
UNIT = 64


class Found(NamedTuple):
    kind: str
    start: int
    size: int
    samples: tuple[int, int] | None  # where the sample bytes lie, if they lie there uncompressed
    shape: str


def _wav(b: bytes, at: int) -> Found | None:
    if len(b) < at + 12 or b[at + 8 : at + 12] != b"WAVE":
        return None
    size = struct.unpack_from("<I", b, at + 4)[0] + 8
    pos, form, data = at + 12, None, None
    if at + size > len(b):
        return None
    while pos + 8 <= at + size:
        tag, n = b[pos : pos + 4], struct.unpack_from("<I", b, pos + 4)[0]
        if pos + 8 + n > at + size:
            return None
        if tag == b"fmt " and n >= 16:
            form = struct.unpack_from("<HHIIHH", b, pos + 8)
        elif tag == b"data":
            data = (pos + 8, n)
        pos += 8 + n + (n & 1)
    if form is None or data is None:
        return None
    return Found("audio/wav", at, size, data, f"{form[1]}ch{form[5]}bit{form[2]}hz")


def _bmp(b: bytes, at: int) -> Found | None:
    if len(b) < at + 54:
        return None
    size, zero, start, head, w, h, planes, depth, packed = struct.unpack_from("<IIIIiiHHI", b, at + 2)
    if zero or head != 40 or planes != 1 or depth not in (1, 4, 8, 24, 32) or w <= 0 or h == 0 or packed or start < 54:
        return None
    row = (w * depth + 31) // 32 * 4
    if size != start + row * abs(h) or at + size > len(b):
        return None
    return Found("image/bmp", at, size, (at + start, row * abs(h)), f"{w}x{abs(h)}x{depth}")


def _au(b: bytes, at: int) -> Found | None:
    if len(b) < at + 24:
        return None
    start, n, code, rate, channels = struct.unpack_from(">IIIII", b, at + 4)
    if start < 24 or not 1 <= code <= 27 or not 0 < rate <= 1 << 20 or not 0 < channels <= 64 or at + start + n > len(b):
        return None
    return Found("audio/basic", at, start + n, (at + start, n), f"{channels}ch{rate}hz")


def _png(b: bytes, at: int) -> Found | None:
    pos, shape, data = at + 8, "", False
    while pos + 12 <= len(b):
        n, tag = struct.unpack_from(">I4s", b, pos)
        if pos + 12 + n > len(b) or struct.unpack_from(">I", b, pos + 8 + n)[0] != zlib.crc32(b[pos + 4 : pos + 8 + n]):
            return None
        if not shape:
            if tag != b"IHDR" or n != 13:
                return None
            w, h, depth, colour = struct.unpack_from(">IIBB", b, pos + 8)
            shape = f"{w}x{h}x{depth}c{colour}"
        data |= tag == b"IDAT"
        pos += 12 + n
        if tag == b"IEND":
            return Found("image/png", at, pos - at, None, shape) if data else None
    return None


def _gif(b: bytes, at: int) -> Found | None:
    if len(b) < at + 14:
        return None
    w, h, flags = struct.unpack_from("<HHB", b, at + 6)
    pos = at + 13 + (3 << ((flags & 7) + 1) if flags & 0x80 else 0)

    def blocks(pos: int) -> int:
        while pos < len(b) and b[pos]:
            pos += 1 + b[pos]
        return pos + 1

    while pos < len(b):
        if b[pos] == 0x3B:
            return Found("image/gif", at, pos + 1 - at, None, f"{w}x{h}") if w and h else None
        if b[pos] == 0x21:
            pos = blocks(pos + 2)
        elif b[pos] == 0x2C and pos + 10 < len(b):
            local = b[pos + 9]
            pos = blocks(pos + 11 + (3 << ((local & 7) + 1) if local & 0x80 else 0))
        else:
            return None
    return None


def _zip(b: bytes, at: int) -> Found | None:
    if len(b) < at + 30 or struct.unpack_from("<H", b, at + 4)[0] > 63:
        return None
    end = b.find(b"PK\x05\x06", at)
    if end < 0 or end + 22 > len(b):
        return None
    size, start, note = struct.unpack_from("<IIH", b, end + 12)
    if at + start + size != end or end + 22 + note > len(b):
        return None
    return Found("application/zip", at, end + 22 + note - at, None, "")


def _pdf(b: bytes, at: int) -> Found | None:
    end = b.find(b"%%EOF", at)
    if end < 0 or b.find(b"startxref", at, end) < 0:
        return None
    return Found("application/pdf", at, end + 5 - at, None, "")


def _jpeg(b: bytes, at: int) -> Found | None:
    pos, shape = at + 2, ""
    while pos + 4 <= len(b) and b[pos] == 0xFF:
        mark, n = b[pos + 1], struct.unpack_from(">H", b, pos + 2)[0]
        if mark in (0xC0, 0xC1, 0xC2) and pos + 9 <= len(b):
            h, w = struct.unpack_from(">HH", b, pos + 5)
            shape = f"{w}x{h}"
        pos += 2 + n
        if mark == 0xDA:
            while (pos := b.find(b"\xff", pos)) >= 0 and pos + 1 < len(b):
                if b[pos + 1] == 0xD9:
                    return Found("image/jpeg", at, pos + 2 - at, None, shape) if shape else None
                pos += 2
            return None
        if n < 2:
            return None
    return None


#: Magic bytes of each format and its validator.
FORMATS: dict[bytes, Callable[[bytes, int], Found | None]] = {
    b"RIFF": _wav,
    b"BM": _bmp,
    b".snd": _au,
    b"\x89PNG\r\n\x1a\n": _png,
    b"GIF87a": _gif,
    b"GIF89a": _gif,
    b"PK\x03\x04": _zip,
    b"%PDF-": _pdf,
    b"\xff\xd8\xff": _jpeg,
}


@lru_cache(1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for magic in FORMATS:
        found.add_word(magic.decode("latin-1"), magic)
    found.make_automaton()
    return found


#: Kinds that hold other files as they are. What lies in the samples of any other kind is data and not a file.
CONTAINERS = ("application/zip", "application/pdf")


def sniff(blob: bytes) -> list[Found]:
    """All confirmed media in blob in order of their start, those inside containers too."""
    out: list[Found] = []
    covered = 0
    for end, magic in _automaton().iter(blob.decode("latin-1")):
        at = end + 1 - len(magic)
        if at >= covered and (found := FORMATS[magic](blob, at)):
            out.append(found)
            covered = end + 1 if found.kind in CONTAINERS else found.start + found.size
    return out


def decode_samples(blob: bytes, found: Found) -> bytes:
    """The stored samples of a confirmed file, for the kinds that encode() writes."""
    if found.samples:
        return blob[found.samples[0] : found.samples[0] + found.samples[1]]
    if found.kind != "image/png":
        raise ValueError(f"no sample decoder for {found.kind}")
    pos, parts = found.start + 8, []
    while pos < found.start + found.size:
        n, tag = struct.unpack_from(">I4s", blob, pos)
        if tag == b"IDAT":
            parts.append(blob[pos + 8 : pos + 8 + n])
        pos += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(-1, UNIT + 1)
    if rows[:, 0].any():
        raise ValueError("only unfiltered PNG rows are decoded")
    return rows[:, 1:].tobytes()


def encode(payload: bytes) -> bytes:
    """Store payload (a multiple of UNIT bytes) as 8-bit samples; its checksum alone picks the format."""
    pick, n = zlib.crc32(payload) % 4, len(payload)
    if pick == 0:
        head = struct.pack("<HHIIHH", 1, 1, 8000, 8000, 1, 8)
        return b"RIFF" + struct.pack("<I", 36 + n) + b"WAVEfmt " + struct.pack("<I", 16) + head + b"data" + struct.pack("<I", n) + payload
    if pick == 1:
        return b".snd" + struct.pack(">IIIII", 24, n, 2, 8000, 1) + payload
    if pick == 2:
        grey = b"".join(bytes((i, i, i, 0)) for i in range(256))
        start = 54 + len(grey)
        return b"BM" + struct.pack("<IIIIiiHHIIiiII", start + n, 0, start, 40, UNIT, -(n // UNIT), 1, 8, 0, n, 0, 0, 256, 0) + grey + payload
    rows = np.zeros((n // UNIT, UNIT + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)

    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    head = struct.pack(">IIBBBBB", UNIT, n // UNIT, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 1)) + chunk(b"IEND", b"")


#: Extensions of the kinds that encode() writes, and the types that they declare.
EXTENSIONS = {"wav": "audio/wav", "au": "audio/basic", "bmp": "image/bmp", "png": "image/png"}


def declared_type(payload: bytes) -> str:
    """The type that a file's name declares. Names are given without a look at the format, so most are wrong."""
    return EXTENSIONS[list(EXTENSIONS)[payload[0] % 4]]


#: Rows that one step turns into media at a time.
ROWS = 64


def to_media(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Columns key, n_bytes, declared (by the file's name, often wrongly) and media (the stored file).

    Null text is empty; an empty text is one unit of zero bytes. Map-only; rows are independent.
    """
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                keys, sizes, media, declared = batch.column(0).slice(at, ROWS), [], [], []
                for t in batch.column(1).slice(at, ROWS).to_pylist():
                    data = (t or "").encode()
                    sizes.append(len(data))
                    payload = data + bytes(-len(data) % UNIT if data else UNIT)
                    media.append(encode(payload))
                    declared.append(declared_type(payload))
                yield pa.RecordBatch.from_arrays([keys, pa.array(sizes, pa.int64()), pa.array(declared, pa.string()), pa.array(media, pa.binary())], [key, "n_bytes", "declared", "media"])

    schema = f"`{key}` {kind.simpleString()}, n_bytes long, declared string, media binary"
    return df.select(df[key], df[text]).mapInArrow(run, schema)


def inspect_media(df: DataFrame, key: str = "doc_id", carry: tuple[str, ...] = ("n_bytes",)) -> DataFrame:
    """Sniff the media column: the corrected type, sizes and digests of file and samples, and what the file embeds.

    Columns: key, carry, kind (null if nothing is confirmed at the first byte), shape, mislabelled, embedded (array of
    kind, start, size for media confirmed beyond the outer file's start, inside it if it is a container), payload_bytes, payload_sha256, tail_crc32 (of the last
    UNIT sample bytes), media_bytes, media_sha256, feature. Null media: nulls.
    """
    types = dict(df.dtypes)
    columns = [key, *carry, "declared", "media"]
    n = len(columns)
    out_types = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("size", pa.int64())])

    def one(declared: str | None, blob: bytes | None) -> tuple:
        if blob is None:
            return (None,) * 10
        found = sniff(blob)
        outer = found[0] if found and found[0].start == 0 else None
        inner = [{"kind": f.kind, "start": f.start, "size": f.size} for f in found if f is not outer]
        samples = decode_samples(blob, outer) if outer and (outer.samples or outer.kind == "image/png") else b""
        feature = "unknown"
        if outer:
            values = np.frombuffer(samples, np.uint8)
            counts = np.bincount(values, minlength=256)
            total = max(1, len(values))
            p = counts[counts > 0] / total
            mean, entropy = float((counts * np.arange(256)).sum()) / total, float(-(p * np.log2(p)).sum())
            feature = f"{outer.kind} {outer.shape} mean={mean:.3f} entropy={entropy:.3f} zeros={int(counts[0])}"
        return (
            outer and outer.kind, outer and outer.shape, bool(outer and outer.kind != declared), inner, len(samples), hashlib.sha256(samples).hexdigest(),
            zlib.crc32(samples[-UNIT:]), len(blob), hashlib.sha256(blob).hexdigest(), feature,
        )

    names = ["kind", "shape", "mislabelled", "embedded", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    arrow = [pa.string(), pa.string(), pa.bool_(), pa.list_(out_types), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    ddl = ["string", "string", "boolean", "array<struct<kind:string,start:bigint,size:bigint>>", "bigint", "string", "bigint", "bigint", "string", "string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = [one(d.as_py(), m.as_py()) for d, m in zip(part.column(n - 2), part.column(n - 1), strict=True)]
                made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n - 2)), *made], [*columns[:-2], *names])

    schema = ", ".join([*(f"`{c}` {types[c]}" for c in columns[:-2]), *(f"{a} {b}" for a, b in zip(names, ddl, strict=True))])
    return df.select(*columns).mapInArrow(run, schema)


def media_digests(docs: DataFrame) -> DataFrame:
    """Every text of docs through to_media and back through inspect_media: its digests, and the type as corrected."""
    return inspect_media(to_media(docs)).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "kind", "mislabelled", F.size("embedded").alias("n_embedded"))
