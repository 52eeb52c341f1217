"""WARC archives: write page captures, read the archives back, assemble transactions.

A capture is three records - request, response (or revisit) and metadata - tied by WARC-Concurrent-To. Each record is
a gzip member of its own, so any WARC reader can open the files. Spark's own writer commits the files, hence a lost
task leaves no half file, and any file system that Spark knows will do.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage, staged_dir

#: Equal payloads shorter than this are stored again rather than referred to.
MIN_REVISIT_BYTES = 1000
#: A file holds about so many units of UNIT_BYTES; a capture counts as one for each unit of its stored bytes, so a file
#: has at most 512 MB and one capture more.
UNITS_PER_FILE = 2000
UNIT_BYTES = 1 << 18
_DATE = "2024-01-01T00:00:00Z"


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


#: Spark's text writer ends each row with a separator that can't be empty; an empty gzip member adds no data.
_EMPTY_MEMBER = _member(b"").decode("latin-1")

_PAGE_COLUMNS = "page_id string, url string, html string, capture long, refers_to long, refers_uri string"
RECORD_SCHEMA = (
    "record_id string, warc_type string, concurrent_to string, refers_to string, target_uri string, warc_date string,"
    " declared_digest string, page_id string, payload binary, payload_bytes long, payload_digest string"
)
#: A record as read, with what is wrong with it.
READ_SCHEMA = f"{RECORD_SCHEMA}, error string"


def _urn(kind: str, capture: int) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{kind}:{capture}'.encode()).hexdigest())}>"


def _record(kind: str, record_id: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", _DATE), *fields, ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return _member(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n")


def _capture(page_id: str | None, url: str | None, payload: bytes, capture: int, refers_to: int | None, refers_uri: str | None) -> bytes:
    uri = url and "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    main = _urn("response", capture)
    digest = f"sha1:{hashlib.sha1(payload).hexdigest()}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    host, _, path = (uri or "").partition("//")[2].partition("/")
    request = f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    common = [("WARC-Target-URI", uri or None)]
    if refers_to is None:
        body = _record("response", main, [*common, ("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response")], http + payload)
    else:
        refers = [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _urn("response", refers_to)),
            ("WARC-Refers-To-Target-URI", refers_uri and "".join(c if c > " " else f"%{ord(c):02X}" for c in refers_uri)),
        ]
        body = _record("revisit", main, [*common, *refers, ("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response")], http)
    fields = b"" if page_id is None else f"page-id: {page_id}\r\n".encode()
    tie = [*common, ("WARC-Concurrent-To", main)]
    return (
        _record("request", _urn("request", capture), [*tie, ("Content-Type", "application/http; msgtype=request")], request)
        + body
        + _record("metadata", _urn("metadata", capture), [*tie, ("Content-Type", "application/warc-fields")], fields)
    )


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        cols = [batch.column(c) for c in ("page_id", "url", "html", "capture", "refers_to", "refers_uri")]
        for at in range(0, batch.num_rows, 256):
            rows = zip(*(c.slice(at, 256).to_pylist() for c in cols), strict=True)
            for p, u, h, c, r, ru in rows:
                made = _capture(p, u, (h or "").encode(), c, r, ru)
                # an empty row is an empty gzip member in the file, and counts there as a unit
                held += [made, *[b""] * (len(made) // UNIT_BYTES)]
                size += len(made)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["record"])
                    held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["record"])


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Number the captures; point each at the capture that holds its payload, null where it holds its own.

    Of equal payloads of at least min_bytes bytes the one with the largest page_id keeps it (null ids come last; rows
    that share that largest id keep it each). The numbers come from the rows' places in the input as read, so give a
    written table. Only the payload's digest is grouped, with map-side combining, and only digests that occur twice
    are joined back; a frequent payload is split by Spark's skew handling, as the join's other side is unique.
    """
    own = pages.select(
        F.col("page_id").cast("string").alias("page_id"),
        F.col("page_id").alias("_order"),
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
        F.monotonically_increasing_id().alias("capture"),
    ).withColumn("_digest", F.when(F.octet_length("html") >= min_bytes, F.sha1(F.encode("html", "utf-8"))))
    first = F.struct(F.col("_order").isNotNull().alias("known"), F.col("_order").alias("order"), (-F.col("capture")).alias("minus"))
    kept = (
        own.where(F.col("_digest").isNotNull())
        .groupBy("_digest")
        .agg(F.max(first).alias("best"), F.max_by("url", first).alias("refers_uri"), F.count("*").alias("n"))
        .where("n > 1")
        .select("_digest", "refers_uri", F.col("best.order").alias("_best"), (-F.col("best.minus")).alias("refers_to"))
    )
    revisit = F.col("refers_to").isNotNull() & ~F.col("_order").eqNullSafe(F.col("_best"))
    # short pages have no digest: under a key of its own each, or they would all meet in one task
    key = F.coalesce("_digest", F.concat(F.lit("-"), F.col("capture").cast("string")))
    return own.withColumn("_key", key).drop("_digest").join(kept, F.col("_key") == F.col("_digest"), "left").select(
        "page_id",
        "url",
        "html",
        "capture",
        F.when(revisit, F.col("refers_to")).alias("refers_to"),
        F.when(revisit, F.col("refers_uri")).alias("refers_uri"),
    )


def write_warc(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES, units_per_file: int = UNITS_PER_FILE) -> None:
    """Write a capture for each row of pages (page_id, url, html; other columns are ignored) to .gz files under path.

    Files are bounded in bytes and not in records, since a page may be of any length. Null html is an empty payload; null url leaves the target out; null page_id leaves the field out. An empty table
    writes an archive without records. Repeated rows are captures of their own.
    """
    rows = with_revisits(pages, min_bytes).mapInArrow(_write, "record binary")
    rows.select(F.col("record").cast("string").alias("value")).write.option("lineSep", _EMPTY_MEMBER).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", units_per_file).text(path)


def _headers(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}


def _split(data: bytes) -> Iterator[tuple[bytes, str | None]]:
    """gzip members, or the plain file as it is; what is left where a member is broken, with an error."""
    if data[:2] != b"\x1f\x8b":
        yield data, None
        return
    # unused_data copies the rest at each member; in windows the copies stay small
    view, at = memoryview(data), 0
    while at < len(view):
        z, parts, step = zlib.decompressobj(31), [], 1 << 16
        while not z.eof:
            piece = view[at : at + step]
            if not piece:
                yield b"".join(parts), "the file ends inside a gzip member"
                return
            try:
                parts.append(z.decompress(piece))
            except zlib.error as e:
                yield b"".join(parts), f"broken gzip member: {e}"
                return
            at += len(piece) - len(z.unused_data)
        if any(parts):
            yield b"".join(parts), None


def _parse(data: bytes, keep: bool) -> Iterator[tuple]:
    for chunk, error in _split(data):
        at = 0
        while at < len(chunk):
            end = chunk.find(b"\r\n\r\n", at)
            head = _headers(chunk[at : end if end >= 0 else len(chunk)])
            size = head.get("content-length", "")
            wrong = "no end of the record's head" if end < 0 else None if size.isascii() and size.isdigit() else "no Content-Length"
            block = b"" if wrong else chunk[end + 4 : end + 4 + int(size)]
            if not wrong and len(block) < int(size):
                wrong = "the record is shorter than its Content-Length"
            # nothing says where the record after a broken one begins
            at = len(chunk) if wrong else end + 4 + len(block) + 4
            wrong = error if wrong and error else wrong or (None if "warc-record-id" in head else "no WARC-Record-ID")
            kind = head.get("warc-type")
            page_id = payload = length = digest = None
            if kind == "response":
                payload = block
                if head.get("content-type", "application/http").lower().startswith("application/http"):
                    _, ended, payload = block.partition(b"\r\n\r\n")
                    wrong = wrong or (None if ended else "no end of the HTTP head")
                length, digest = len(payload), hashlib.sha1(payload).hexdigest()
            elif kind == "metadata":
                page_id = _headers(b"\r\n" + block).get("page-id")
            yield (
                head.get("warc-record-id"), kind, head.get("warc-concurrent-to"), head.get("warc-refers-to"), head.get("warc-target-uri"),
                head.get("warc-date"), head.get("warc-payload-digest"), page_id, payload if keep else None, length, digest, wrong,
            )
        if error and not chunk:
            yield (*[None] * 11, error)


_NAMES = [x.split()[0] for x in READ_SCHEMA.split(",")]
_TYPES = [{"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}[x.split()[1]] for x in READ_SCHEMA.split(",")]


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per WARC record under path (plain or gzip, any writer's).

    payload_digest and payload_bytes are computed from the bytes that are stored; declared_digest is the header's. The
    payload of a response is what follows its HTTP head, or its whole block where the block isn't HTTP. error says what is
    wrong with a record: one without an id is kept as it is, one that is cut short with what is there, and what follows a
    broken record in its gzip member (or plain file) can't be found.
    Files are read whole, one at a time, so an archive's size bounds the memory.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                rows, size = [], 0
                for r in _parse(data.as_buffer().to_pybytes(), payload):
                    rows.append(r)
                    size += len(r[8] or b"") + 300
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, READ_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """Tie the records of each transaction by their concurrent-to ids: one nested row per capture.

    Columns: capture_id (the response's or revisit's record id), responses, requests and metadata, arrays of structs in
    order of record id and of their columns. An archive may hold several records of a kind under one id, or none: all are kept, an
    absent kind is an empty array. Records without an id to tie them by are in no capture. One shuffle on the id.
    """
    kind = F.col("warc_type")
    main = F.struct("record_id", "warc_type", "refers_to", "target_uri", "warc_date", "declared_digest", "payload_bytes", "payload_digest", "payload")
    tie = F.when(kind.isin("response", "revisit"), F.col("record_id")).otherwise(F.coalesce("concurrent_to", "record_id"))

    def every(of: Column, when: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(when, of)))

    return (
        records.where(kind.isin("request", "response", "revisit", "metadata") & tie.isNotNull())
        .groupBy(tie.alias("capture_id"))
        .agg(
            every(main, kind.isin("response", "revisit")).alias("responses"),
            every(F.struct("record_id", "target_uri", "warc_date"), kind == "request").alias("requests"),
            every(F.struct("record_id", "page_id"), kind == "metadata").alias("metadata"),
        )
    )


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """One row per response or revisit of captures, a revisit with the payload and page id of the response that it refers to.

    Columns: capture_id, page_id and refers_to_page (of the first metadata record that has one), response, requests,
    metadata, payload, payload_bytes, payload_digest. Of several responses under the id that is referred to, the first
    counts. Captures without a response or revisit have no row here.
    """
    page = F.element_at(F.concat(F.filter("metadata", lambda m: m["page_id"].isNotNull())["page_id"], F.array(F.lit(None).cast("string"))), 1)
    rows = captures.withColumn("page_id", page)
    first = F.get(F.filter("responses", lambda r: r["warc_type"] == "response"), F.lit(0))
    columns = ("payload", "payload_bytes", "payload_digest")
    held = rows.select(F.col("capture_id").alias("_target"), F.col("page_id").alias("_page"), first.alias("_first")).where("_first is not null")
    each = rows.select("capture_id", "page_id", "requests", "metadata", F.explode("responses").alias("response"))
    return each.join(held, F.col("response.refers_to") == F.col("_target"), "left").select(
        "capture_id", "page_id", F.col("_page").alias("refers_to_page"), "response", "requests", "metadata", *(F.coalesce(F.col(f"response.{c}"), F.col(f"_first.{c}")).alias(c) for c in columns)
    )


def warc_roundtrip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write pages as WARC, read the archives back, and describe each capture."""
    spark = pages.sparkSession
    path = path or f"{staged_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, path)
    captures = stage(assemble(read_warc(spark, path, payload=False)), "captures")
    kind = dict(pages.dtypes)["page_id"]
    return resolve_revisits(captures).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("response.warc_type").alias("record_type"),
        F.col("refers_to_page").cast(kind).alias("refers_to"),
    )
