"""Raw filing artifacts: files named by their content, their digests, a digest tree over folders, and what disagrees.

A file table has a row per file: path (relative to a root, with /), length, modified, sha256. It is kept from one look at
the folder to the next: only files whose length or time changed are opened again. Folders have digests of their own, so
that two file tables are compared by the folders that differ, and no file of an equal folder is looked at.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import uuid
from collections.abc import Iterable, Iterator
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Element names, in lower case, that tell operating cash flow and capital expenditure.
OCF = ("cashflowsfromusedinoperatingactivities", "cashflowsfromusedinoperations")
CAPEX = ("purchaseofpropertyplantandequipmentclassifiedasinvestingactivities",)
#: What may disagree between a catalogue row, its file and its sidecar.
ISSUES = (
    "missing_xml", "missing_json", "invalid_json", "symbol_mismatch", "period_mismatch", "invalid_period", "scope_mismatch", "reference_mismatch", "sha256_mismatch",
    "file_size_mismatch", "invalid_file_size", "missing_json_xml_path", "xml_path_mismatch", "invalid_broadcast_datetime", "invalid_revised_datetime",
)

#: Bytes that a task holds of a file at a time.
PIECE = 1 << 20


# Names


def safe_name(c: Column) -> Column:
    """Runs of other characters than letters, digits, ._- become one underscore; `unknown` if nothing is left."""
    made = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"[^A-Za-z0-9._-]+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(made, r"^[._-]+|[._-]+$", ""), F.lit("")), F.lit("unknown"))


def scope_name(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low.startswith("consol"), "Consolidated").when(low.startswith("stand"), "Standalone").when(F.coalesce(low, F.lit("")) == "", "Unknown").otherwise(safe_name(c))


def raw_path(symbol: Column, period_end: Column, scope: Column, url: Column, content: Column) -> Column:
    """SYMBOL/period/scope/stem__digest.xml: the stem is the URL's file name, the digest 16 digits of the content's sha256."""
    base = F.regexp_extract(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*|[?#].*$", ""), r"([^/]*)/*$", 1)
    stem = F.regexp_replace(safe_name(F.when(base == "", "financial_filing.xml").otherwise(base)), r"(?i)(?<=.)\.xml$", "")
    return F.concat_ws("/", safe_name(F.upper(symbol)), period_end.cast("string"), scope_name(scope), F.concat(stem, F.lit("__"), F.substring(F.sha2(content, 256), 1, 16), F.lit(".xml")))


def artifacts(filings: DataFrame) -> DataFrame:
    """filings (symbol, period_end, statement_scope, url, content, further columns) with raw_relative_path, sha256, file_size
    and sidecar, the JSON of all columns but content. A null content is an empty file."""
    bytes_ = F.coalesce(F.col("content").cast("binary"), F.lit(b""))
    named = filings.withColumn("content", bytes_).withColumn("raw_relative_path", raw_path(F.col("symbol"), F.col("period_end"), F.col("statement_scope"), F.col("url"), F.col("content")))
    full = named.withColumns({"sha256": F.sha2("content", 256), "file_size": F.octet_length("content").cast("long")})
    said = [F.col(c) for c in full.columns if c not in ("content", "raw_relative_path")]
    return full.withColumn("sidecar", F.to_json(F.struct(*said, F.col("raw_relative_path").alias("raw_xml_path"))))


def _file_system(path: str):
    """The file system of a path or URI and the path on it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (fs.LocalFileSystem(), path)


def write_artifacts(made: DataFrame, root: str) -> DataFrame:
    """Write the files and sidecars of artifacts() under root, a shared folder or URI; per row raw_relative_path and already.

    A file is immutable: where it is there with its length it stays, and `already` is true. The sidecar is written anew. Both
    appear under their names only when whole, so a task that is run again after a loss does no harm. Lazy: nothing is
    written until the result is.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = _file_system(root)

        def put(path: str, data: bytes) -> None:
            part = f"{path}.{uuid.uuid4().hex}.part"
            with system.open_output_stream(part) as out:
                out.write(data)
            system.move(part, path)

        for batch in batches:
            already = []
            for name, content, side in zip(batch["raw_relative_path"], batch["content"], batch["sidecar"], strict=True):
                path = posixpath.join(base, name)
                system.create_dir(posixpath.dirname(path), recursive=True)
                found = system.get_file_info(path)
                already.append(found.type == fs.FileType.File and found.size == len(content))
                if not already[-1]:
                    put(path, content)
                put(f"{path.removesuffix('.xml')}.json", side.encode())
            yield pd.DataFrame({"raw_relative_path": batch["raw_relative_path"], "already": already})

    return made.select("raw_relative_path", "content", "sidecar").mapInPandas(run, "raw_relative_path string, already boolean")


# Digests


def listing(spark: SparkSession, root: str, pattern: str = "*.xml") -> DataFrame:
    """path below root, length and modified of the files; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    below = root.partition("://")[2] or root.removeprefix("file:")
    return files.select(F.element_at(F.split("path", F.lit(f"\\Q{below.rstrip('/')}/\\E"), 2), -1).alias("path"), "length", "modified")


def pieces(path: str) -> Iterator[bytes]:
    system, name = _file_system(path)
    with system.open_input_stream(name) as stream:
        while data := stream.read(PIECE):
            yield data


def inspect(data: Iterable[bytes]) -> dict:
    """sha256, size and the distinct element names (local, lower case) of a document that comes in pieces, in one pass.

    xml_status is OK or INVALID_XML, with error; names are those before the error. Memory holds a piece and the names.
    """
    digest, size, names, error, last = hashlib.sha256(), 0, set(), None, b""
    parser = expat.ParserCreate()
    parser.StartElementHandler = lambda tag, _: names.add(tag.rpartition(":")[2].lower())
    for last in data:
        digest.update(last)
        size += len(last)
        if error is None:
            try:
                parser.Parse(last, False)
            except expat.ExpatError as e:
                error = str(e)
    if error is None:
        try:
            parser.Parse(b"", True)
        except expat.ExpatError as e:
            error = str(e)
    return {"sha256": digest.hexdigest(), "length": size, "names": sorted(names), "xml_status": "INVALID_XML" if error else "OK", "error": error}


_INSPECTED = "sha256 string, length long, names array<string>, xml_status string, error string"


def inspected_files(files: DataFrame, root: str) -> DataFrame:
    """inspect() of each file of a listing, opened in the task; READ_ERROR where that fails. path and modified stay."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                try:
                    rows.append(inspect(pieces(posixpath.join(root, path))))
                except OSError as e:
                    rows.append({"sha256": None, "length": None, "names": [], "xml_status": "READ_ERROR", "error": str(e)})
            made = pd.DataFrame(rows, columns=["sha256", "length", "names", "xml_status", "error"])
            made["length"] = made["length"].astype("Int64")
            yield pd.concat([batch[["path", "modified"]].reset_index(drop=True), made], axis=1)

    return files.select("path", "modified").mapInPandas(run, f"path string, modified timestamp, {_INSPECTED}")


def inspected_documents(documents: DataFrame) -> DataFrame:
    """inspect() of documents (path, content); a null content is empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [inspect([content] if content else []) for content in batch["content"]]
            yield pd.concat([batch[["path"]].reset_index(drop=True), pd.DataFrame(rows, columns=["sha256", "length", "names", "xml_status", "error"])], axis=1)

    return documents.select("path", F.col("content").cast("binary").alias("content")).mapInPandas(run, f"path string, {_INSPECTED}")


def refreshed(known: DataFrame, found: DataFrame, root: str) -> DataFrame:
    """The file table after another look: rows of known (a file table) for files of found (a listing) whose length and time are
    as they were, and inspected rows of all others. Files that are gone leave."""
    same = ["path", "length", "modified"]
    fresh = inspected_files(found.join(known.where("sha256 IS NOT NULL"), same, "left_anti"), root)
    columns = ["path", "modified", "length", "sha256", "names", "xml_status", "error"]
    return known.where("sha256 IS NOT NULL").join(found, same, "left_semi").select(*columns).unionByName(fresh.select(*columns))


_MARKS = 4


def digest_tree(files: DataFrame) -> DataFrame:
    """folder, files and digest of every folder of a file table, at all depths; the root is ''.

    A folder's digest is the sum of what its files contribute, 60 bits of sha256(path, digest) four times over, so that
    one aggregate with partial sums gives all depths, whatever a folder holds, and the order of files plays no part.
    """
    whole = F.sha2(F.concat_ws("\0", "path", F.coalesce("sha256", F.lit("?"))), 256)
    marks = [F.conv(F.substring(whole, 1 + 15 * k, 15), 16, 10).cast("decimal(19,0)").alias(f"m{k}") for k in range(_MARKS)]
    parts = F.split("path", "/")
    folders = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.concat_ws("/", F.slice(parts, 1, n)))
    summed = files.select(F.explode(folders).alias("folder"), *marks).groupBy("folder").agg(F.count("*").alias("files"), *[F.sum(f"m{k}").alias(f"m{k}") for k in range(_MARKS)])
    return summed.select("folder", "files", F.sha2(F.concat_ws(",", "files", *[F.col(f"m{k}").cast("string") for k in range(_MARKS)]), 256).alias("digest"))


def changed_files(old: DataFrame, new: DataFrame, old_tree: DataFrame | None = None, new_tree: DataFrame | None = None) -> DataFrame:
    """path and change (added, removed, changed) between two file tables that hold each path once.

    Trees may be given where they are stored. Folders whose digests agree leave by an anti-join; only files that lie in one
    of the others meet.
    """
    old_tree, new_tree = (digest_tree(old) if old_tree is None else old_tree), (digest_tree(new) if new_tree is None else new_tree)
    key = ["folder", "digest"]
    differ = old_tree.join(new_tree, key, "left_anti").select("folder").union(new_tree.join(old_tree, key, "left_anti").select("folder")).distinct()
    folder = F.regexp_extract("path", r"^(?:(.*)/)?[^/]*$", 1)
    sides = [t.select("path", F.coalesce("sha256", F.lit("?")).alias(name), folder.alias("folder")).join(differ, "folder", "left_semi").drop("folder") for t, name in ((old, "_old"), (new, "_new"))]
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.col("_old") != F.col("_new"), "changed")
    return sides[0].join(sides[1], "path", "full_outer").select("path", change.alias("change")).where("change IS NOT NULL")


# What disagrees


def integrity(catalogue: DataFrame, files: DataFrame) -> DataFrame:
    """Catalogue rows (id, raw_relative_path, file_size, sha256) against a file table: file_exists, size_matches, sha256_matches,
    actual_file_size and actual_sha256. What can't be compared doesn't match; digests compare whatever their case."""
    seen = files.select(F.col("path").alias("raw_relative_path"), F.col("length").alias("actual_file_size"), F.col("sha256").alias("actual_sha256"), F.lit(True).alias("_here"))
    agrees = lambda a, b: F.coalesce(a == b, F.lit(False))
    return catalogue.select("id", "raw_relative_path", "file_size", "sha256").join(seen, "raw_relative_path", "left").select(
        "id", "raw_relative_path", F.coalesce("_here", F.lit(False)).alias("file_exists"), "actual_file_size", "actual_sha256",
        agrees(F.col("actual_file_size"), F.col("file_size")).alias("size_matches"), agrees(F.col("actual_sha256"), F.lower("sha256")).alias("sha256_matches"),
    )


def diagnosis(inspected: DataFrame) -> DataFrame:
    """path, classification, cash_concepts (their number), ocf_concepts and capex_concepts of inspected files or documents."""
    of = lambda names: F.array_intersect("names", F.array(*map(F.lit, names)))
    ocf, capex, cash = F.size(of(OCF)) > 0, F.size(of(CAPEX)) > 0, F.size(F.filter("names", lambda n: n.contains("cash")))
    ok = F.col("xml_status") == "OK"
    named = F.when(~ok, F.col("xml_status")).when(ocf & capex, "BOTH_FOUND").when(ocf, "OCF_ONLY").when(capex, "CAPEX_ONLY").when(cash > 0, "OTHER_CASH_CONCEPTS").otherwise("NO_CASH_CONCEPTS")
    listed = lambda names: F.when(ok, F.array_join(F.array_sort(of(names)), ";")).otherwise("")
    return inspected.select("path", named.alias("classification"), F.when(ok, cash).otherwise(0).alias("cash_concepts"), listed(OCF).alias("ocf_concepts"), listed(CAPEX).alias("capex_concepts"))


def _cells(text: str | None) -> dict | None:
    """The top-level cells of a JSON object as text; null if the text is no JSON object."""
    try:
        found = json.loads(text or "")
    except ValueError:
        return None
    return {k: v if isinstance(v, str) or v is None else json.dumps(v) for k, v in found.items()} if isinstance(found, dict) else None


def sidecar_issues(catalogue: DataFrame, files: DataFrame, sidecars: DataFrame, root: str = "") -> DataFrame:
    """id and issues, an array of ISSUES in their order, of the catalogue rows that have any.

    catalogue: id, symbol, period_end, statement_scope, source_reference, sha256, file_size, raw_relative_path; files: a
    file table; sidecars: path (of the file that it goes with) and content, its JSON. Of a row without a file, a sidecar or
    a readable sidecar nothing else is said. Names, scopes and digests compare whatever their case, with blanks
    at their ends taken off; a period is yyyy-mm-dd or yyyymmdd; a size is a whole number; a path may be absolute under
    root; times are 01-Jan-2020 10:00:00 or ISO 8601. Several sidecars of one file: the smallest text counts.
    """
    present = files.select(F.col("path").alias("raw_relative_path"), F.lit(True).alias("_xml")).distinct()
    parse = F.pandas_udf(lambda texts: texts.map(_cells), "map<string,string>")
    told = sidecars.groupBy(F.col("path").alias("raw_relative_path")).agg(F.min(F.coalesce("content", F.lit(""))).alias("_said"))
    both = catalogue.join(present, "raw_relative_path", "left").join(told.withColumn("_m", parse("_said")), "raw_relative_path", "left")
    said = lambda name: F.trim(F.coalesce(F.try_element_at("_m", F.lit(name)), F.lit("")))
    own = lambda name: F.trim(F.coalesce(F.col(name), F.lit("")))
    period = F.when(said("period_end").rlike(r"^(\d{8}|\d{4}-\d\d-\d\d)$"), F.coalesce(F.try_to_date(said("period_end"), "yyyy-MM-dd"), F.try_to_date(said("period_end"), "yyyyMMdd")))
    size = F.when(said("file_size").rlike(r"^[+-]?\d+$"), F.regexp_replace(said("file_size"), r"^\+?(-?)0*(?=\d)", "$1"))  # text: any length
    path = F.regexp_replace(F.regexp_replace(said("raw_xml_path"), r"\\", "/"), r"(^|/)(\./)+", "$1")
    path = F.when(F.lit(bool(root)) & path.startswith(f"{root.rstrip('/')}/"), F.substr(path, F.lit(len(root.rstrip("/")) + 2))).otherwise(path)

    def bad_time(name: str) -> Column:
        day = F.split(said(name), "-")
        named = F.concat_ws("-", day[0], F.initcap(F.try_element_at(day, F.lit(2))), F.try_element_at(day, F.lit(3)))
        iso = F.when(said(name).rlike(r"^\d{4}-\d\d-\d\d([T ].+)?$"), said(name).try_cast("timestamp"))
        return (said(name) != "") & F.try_to_timestamp(named, F.lit("d-MMM-yyyy H:m:s")).isNull() & iso.isNull()

    differs = {
        "symbol_mismatch": F.upper(said("symbol")) != F.upper(own("symbol")), "period_mismatch": ~period.eqNullSafe(F.col("period_end")) & period.isNotNull(), "invalid_period": period.isNull(),
        "scope_mismatch": F.lower(said("statement_scope")) != F.lower(own("statement_scope")), "reference_mismatch": said("source_reference") != own("source_reference"),
        "sha256_mismatch": F.lower(said("sha256")) != F.lower(own("sha256")), "file_size_mismatch": ~size.eqNullSafe(F.col("file_size").cast("string")) & size.isNotNull(), "invalid_file_size": size.isNull(),
        "missing_json_xml_path": path == "", "xml_path_mismatch": (path != "") & (path != F.col("raw_relative_path")),
        "invalid_broadcast_datetime": bad_time("broadcast_datetime"), "invalid_revised_datetime": bad_time("revised_datetime"),
    }
    rest = F.array_compact(F.array(*[F.when(differs[k], F.lit(k)) for k in ISSUES[3:]]))
    found = F.when(F.col("_xml").isNull(), F.array(F.lit(ISSUES[0]))).when(F.col("_said").isNull(), F.array(F.lit(ISSUES[1]))).when(F.col("_m").isNull(), F.array(F.lit(ISSUES[2]))).otherwise(rest)
    return both.select("id", found.alias("issues")).where(F.size("issues") > 0)
