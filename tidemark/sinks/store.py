"""Versioned tables that change together.

Data files are written under names of their own and never touched again. A version is a manifest: for each table its
schema, how it is partitioned, and the folder of each partition. Putting the next manifest in its place is one step that
only one writer can take, so readers see all of a change or nothing, a crash leaves the last version as it was, and of two
writers that start from one version the second fails with Conflict and can try again.

A merge rewrites only the partitions in which a row really changes; the others keep their folders from version to version.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import TypeVar
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.core import upsert

PART = "_part"
#: A null partition value's name.
NULL_PART = "__null__"
#: So many rows of a partition go to one file where a change deals them itself.
ROWS = 500_000
T = TypeVar("T")


class Conflict(RuntimeError):
    """Another writer has put the next version in place."""


@dataclass(frozen=True)
class Snapshot:
    """One version: tables maps a name to {schema, by, parts: partition to folder}; info is what its writer said of it."""

    version: int = 0
    tables: dict[str, dict] = field(default_factory=dict)
    info: dict = field(default_factory=dict)


class Store:
    """Tables under a folder of any file system that Spark knows. The driver holds manifests: a line for each partition."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list(self, path: str) -> list[str]:
        at, fs = self._at(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []

    def versions(self) -> list[int]:
        return [int(n[1:-5]) for n in self._list(f"{self.path}/manifests") if n.startswith("v") and n.endswith(".json")]

    def snapshot(self, version: int | None = None) -> Snapshot:
        """A version, by default the last; version 0 is the empty store."""
        version = max(self.versions(), default=0) if version is None else version
        if version == 0:
            return Snapshot()
        at, fs = self._at(f"{self.path}/manifests/v{version:012d}.json")
        stream = fs.open(at)
        try:
            return Snapshot(**json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def read(self, table: str, version: int | None = None) -> DataFrame:
        return self._read(self.snapshot(version), table)

    def _read(self, snapshot: Snapshot, table: str, parts: Sequence[str] | None = None) -> DataFrame:
        """The table's rows, or those of some partitions; partitions that aren't there have none."""
        if table not in snapshot.tables:
            raise KeyError(f"no table {table} in version {snapshot.version}")
        entry = snapshot.tables[table]
        schema = StructType.fromJson(entry["schema"])
        folders = [p for k, p in entry["parts"].items() if parts is None or k in parts]
        if folders:
            return self.spark.read.schema(schema).parquet(*folders)
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

    def _put(self, name: str, text: str) -> bool:
        """Put a file in place, complete and only if there is none of that name: one link or rename, which can't half happen."""
        target, temporary = f"{self.path}/manifests/{name}", f"{self.path}/manifests/.{uuid.uuid4().hex}"
        at, fs = self._at(temporary)
        out = fs.create(at, False)
        out.write(bytearray(text.encode()))
        out.close()
        uri = fs.makeQualified(at).toUri()
        try:
            if uri.getScheme() == "file":  # where a rename would replace what is there
                os.link(urlparse(uri.toString()).path, urlparse(fs.makeQualified(self._at(target)[0]).toUri().toString()).path)
                return True
            jvm = self.spark._jvm
            none = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, self.spark._jsc.hadoopConfiguration()).rename(at, self._at(target)[0], none)
            return True
        except FileExistsError:
            return False
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        finally:
            fs.delete(at, False)

    def change(self) -> Change:
        return Change(self, self.snapshot())

    def update(self, step: Callable[[Change], T], attempts: int = 20) -> T:
        """Run step on the last version and commit; start again from the newer version if another writer was first."""
        for _ in range(attempts):
            change = self.change()
            result = step(change)
            if not change.pending:
                return result
            try:
                change.commit()
            except Conflict:
                continue
            return result
        raise Conflict(f"no commit in {attempts} attempts")

    def vacuum(self, keep: int = 10) -> int:
        """Delete folders that none of the last `keep` versions names, and older manifests; returns how many folders went.

        For when nothing is being written: a change that is not committed yet looks like one that failed.
        """
        kept = self.versions()[-keep:] if keep else []
        named = {p for v in kept for t in self.snapshot(v).tables.values() for p in t["parts"].values()}
        gone = 0
        for table in self._list(f"{self.path}/data"):
            for write in self._list(f"{self.path}/data/{table}"):
                at, fs = self._at(f"{self.path}/data/{table}/{write}")
                parts = [f"{self.path}/data/{table}/{write}/{n}" for n in self._list(f"{self.path}/data/{table}/{write}") if n.startswith(f"{PART}=")]
                unused = [p for p in parts if p not in named]
                if len(unused) == len(parts):
                    fs.delete(at, True)
                else:
                    for p in unused:
                        fs.delete(self._at(p)[0], True)
                gone += len(unused)
        for v in self.versions()[: -keep or None]:
            at, fs = self._at(f"{self.path}/manifests/v{v:012d}.json")
            fs.delete(at, False)
        return gone


def row_digest(columns: Sequence[str]) -> Column:
    """Two 64-bit hashes of all columns in order; nulls count by their place."""
    named = [F.struct(F.col(f"`{c}`").alias("v"), F.col(f"`{c}`").isNull().alias("n")) for c in columns]
    return F.struct(F.xxhash64(*named).alias("a"), F.xxhash64(F.lit(1), *named).alias("b"))


class Change:
    """What is to become the version after `base`. Nothing of it can be read by others before commit()."""

    def __init__(self, store: Store, base: Snapshot):
        self.store, self.base, self.tables = store, base, dict(base.tables)
        self.rewritten: dict[str, list[str]] = {}

    @property
    def pending(self) -> bool:
        return self.tables != self.base.tables

    def read(self, table: str) -> DataFrame:
        """The table as this change has it so far."""
        return self.store._read(Snapshot(self.base.version, self.tables), table)

    def has(self, table: str) -> bool:
        return table in self.tables

    def _write(self, table: str, rows: DataFrame, dealt: bool = False) -> dict[str, str]:
        return self._deal(table, rows, dealt)

    def _deal(self, table: str, rows: DataFrame, dealt: bool = False) -> dict[str, str]:
        """Write rows (with PART) to a folder of their own: partition to folder. Large partitions go to several files; dealt
        rows lie in their tasks by PART already."""
        path = f"{self.store.path}/data/{table}/{uuid.uuid4().hex}"
        (rows if dealt else rows.hint("rebalance", PART)).write.partitionBy(PART).parquet(path)
        unescape = self.store.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return {unescape(n.partition("=")[2]): f"{path}/{n}" for n in self.store._list(path) if n.startswith(f"{PART}=")}

    def _entry(self, table: str, rows: DataFrame, by: str | int, keys: Sequence[str]) -> tuple[dict, DataFrame]:
        entry = self.tables.get(table) or {"schema": json.loads(rows.schema.json()), "by": by, "keys": list(keys), "parts": {}}
        wanted = StructType.fromJson(entry["schema"])
        if {f.name for f in rows.schema} != {f.name for f in wanted}:
            raise ValueError(f"{table} has columns {wanted.names}, not {rows.columns}")
        return entry, rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])

    @staticmethod
    def _part(by: str | int, keys: Sequence[str]) -> Column:
        if isinstance(by, int):
            value = F.pmod(F.xxhash64(*keys), F.lit(by))
        else:
            column, _, unit = by.partition("/")
            value = F.date_format(column, {"month": "yyyy-MM", "year": "yyyy"}[unit]) if unit else F.col(column)
        return F.coalesce(value.cast("string"), F.lit(NULL_PART))

    def _apply(self, table: str, entry: dict, parts: list[str], make: Callable[[DataFrame], DataFrame]) -> None:
        """Put make(old rows) in place of the rows of some partitions."""
        self.tables[table] = entry
        if not parts:
            return
        old = self.store._read(Snapshot(self.base.version, {table: entry}), table, parts)
        made = make(old).withColumn(PART, self._part(entry["by"], entry["keys"]))
        written = self._write(table, made)
        strays = set(written) - set(parts)
        assert not strays, f"rows of other partitions: {strays}"
        left = {k: p for k, p in entry["parts"].items() if k not in parts}
        self.tables[table] = {**entry, "parts": {**left, **written}}
        self.rewritten.setdefault(table, []).extend(parts)

    def merge(self, table: str, incoming: DataFrame, keys: Sequence[str], by: str | int = 16, keep: dict[str, Column] | None = None, dealt: bool = False) -> None:
        """Upsert incoming (each key once) by keys. A table's first merge fixes its columns and its partitions: by the
        column `by`, which must be one of the keys ("date/month" and "date/year" take its month or year), or by so many
        buckets of the keys. keep: as in functions.core.upsert,
        expressions over the old row o.* and the new one n.*.

        dealt: incoming's tasks are few and large, so that each may write its own files.

        incoming is computed once. Of a partition in which no row differs from what is there, nothing is written.
        """
        if isinstance(by, str) and by.partition("/")[0] not in keys:
            raise ValueError("a key must lie in one partition: `by` must be one of the keys")
        entry, rows = self._entry(table, incoming, by, keys)
        if not entry["parts"]:  # nothing to compare with or to keep
            fresh = upsert(self.store._read(Snapshot(self.base.version, {table: entry}), table), rows, list(keys), keep) if keep else rows
            fresh = fresh.withColumn(PART, self._part(entry["by"], entry["keys"]))
            written = self._write(table, fresh, dealt=True) if dealt else self._write(table, fresh)
            self.tables[table] = {**entry, "parts": written}
            self.rewritten.setdefault(table, []).extend(written)
            return
        if keep:
            new = self._staged(rows.withColumn(PART, self._part(entry["by"], entry["keys"])))
        else:
            # dealt as they are stored: partitions that aren't there yet take their folders as they are
            written = self._deal(table, rows.withColumn(PART, self._part(entry["by"], entry["keys"])), dealt)
            fresh = {p: folder for p, folder in written.items() if p not in entry["parts"]}
            entry = {**entry, "parts": {**entry["parts"], **fresh}}
            if fresh:
                self.tables[table] = entry
                self.rewritten.setdefault(table, []).extend(sorted(fresh))
            met = {p: folder for p, folder in written.items() if p not in fresh}
            if not met:
                return
            new = self.store._read(Snapshot(self.base.version, {table: {**entry, "parts": met}}), table).withColumn(PART, self._part(entry["by"], entry["keys"]))
        held = self.store._read(Snapshot(self.base.version, {table: entry}), table, self._parts(new))
        merged = self._merged(held, new, keys, keep)
        # the digest is of the keys too
        same = held.select(row_digest(held.columns).alias("_old"))
        moved = merged.withColumn("_new", row_digest(held.columns)).join(same, F.col("_new") == F.col("_old"), "left_anti")
        changed = self._parts(moved)
        own = new.where(F.col(PART).isin(changed))
        self._apply(table, entry, changed, lambda old: upsert(old, own.drop(PART), list(keys), keep))
        for folder in () if keep else met.values():
            at, fs = self.store._at(folder)
            fs.delete(at, True)

    def _merged(self, held: DataFrame, new: DataFrame, keys: Sequence[str], keep: dict[str, Column] | None) -> DataFrame:
        """The incoming rows as they will be stored."""
        if not keep:
            return new
        on = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
        both = new.alias("n").join(held.alias("o"), on, "left")
        return both.select(*[(keep[c] if c in keep else F.col(f"n.{c}")).alias(c) for c in new.columns])

    def amend(self, table: str, incoming: DataFrame, columns: Sequence[str]) -> None:
        """New values of some columns for rows that are stored: incoming has the table's keys, each once, and those columns.
        Keys that aren't stored are ignored.

        Old and new rows meet in one shuffle, which deals them as they are written. Of a partition in which no row differs
        the old folder stays.
        """
        entry = self.tables[table]
        keys, part, types = entry["keys"], self._part(entry["by"], entry["keys"]), {f.name: f.dataType for f in StructType.fromJson(entry["schema"])}
        new = self._staged(incoming.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in (*keys, *columns)]).withColumn(PART, part))
        parts = [p for p in self._parts(new) if p in entry["parts"]]
        if not parts:
            return
        held = self.store._read(Snapshot(self.base.version, {table: entry}), table, parts)
        files = -(-held.count() // (len(parts) * ROWS)) or 1
        rows = new.where(F.col(PART).isin(parts)).select(*[F.col(f"`{k}`") for k in keys], PART, F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_new"), F.lit(False).alias("_old"))
        both = held.withColumns({PART: part, "_old": F.lit(True)}).unionByName(rows, allowMissingColumns=True).withColumn("_file", F.pmod(F.xxhash64(*keys), F.lit(files)))
        line = Window.partitionBy(PART, "_file", *keys)
        met = both.repartition(len(parts) * files, PART, "_file").withColumn("_set", F.max("_new").over(line)).where("_old")
        value = {c: F.when(F.col("_set").isNotNull(), F.col("_set")[c]).otherwise(F.col(f"`{c}`")).alias(c) for c in columns}
        written = self._write(table, met.select(*[value.get(c, F.col(f"`{c}`")) for c in types], PART), dealt=True)
        sums = lambda df: {r[0]: tuple(r[1:]) for r in df.groupBy(part).agg(F.count("*"), *[F.sum(row_digest(list(types))[x].cast("decimal(38,0)")) for x in "ab"]).collect()}
        before, after = sums(held), sums(self.store._read(Snapshot(0, {table: {**entry, "parts": written}}), table))
        changed = {p: folder for p, folder in written.items() if before[p] != after[p]}
        for p in written.keys() - changed.keys():
            at, fs = self.store._at(written[p])
            fs.delete(at, True)
        if changed:
            self.tables[table] = {**entry, "parts": {**entry["parts"], **changed}}
            self.rewritten.setdefault(table, []).extend(sorted(changed))

    def replace(self, table: str, incoming: DataFrame, keys: Sequence[str], by: int = 16, gone: DataFrame | None = None) -> None:
        """Delete and replace: for each key value in incoming or in gone (the key columns alone) all its rows make way for
        those of incoming, which may be any number. Keys whose rows are the same as before are not rewritten."""
        entry, rows = self._entry(table, incoming, by, keys)
        part = self._part(entry["by"], entry["keys"])
        new = self._staged(rows.withColumn(PART, part))
        touched = new.select(*keys, PART)
        if gone is not None:
            touched = touched.unionByName(gone.select(*keys).withColumn(PART, part))
        touched = touched.distinct()
        held = self.store._read(Snapshot(self.base.version, {table: entry}), table, self._parts(touched)).withColumn(PART, part)
        sums = lambda df, n: df.groupBy(*keys, PART).agg(F.count("*").alias(f"{n}c"), *[F.sum(row_digest(rows.columns)[x].cast("decimal(38,0)")).alias(f"{n}{x}") for x in "ab"])
        match = lambda x, y: reduce(lambda a, b: a & b, [F.col(f"{x}.{k}").eqNullSafe(F.col(f"{y}.{k}")) for k in keys])
        both = touched.alias("t").join(sums(new, "n").alias("n"), match("t", "n"), "left").join(sums(held, "o").alias("o"), match("t", "o"), "left")
        differ = both.where(~reduce(lambda a, b: a & b, [F.col(f"n.n{x}").eqNullSafe(F.col(f"o.o{x}")) for x in "cab"])).select("t.*")
        moved = self._staged(differ)
        changed = self._parts(moved)

        def make(old: DataFrame) -> DataFrame:
            stays = old.alias("o").join(moved.alias("t"), match("o", "t"), "left_anti")
            comes = new.alias("n").join(moved.alias("t"), match("n", "t"), "left_semi").drop(PART)
            return stays.unionByName(comes)

        self._apply(table, entry, changed, make)

    def _staged(self, rows: DataFrame) -> DataFrame:
        """rows, written once so that they are not computed for each use."""
        path = f"{self.store.path}/data/_staged/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return self.store.spark.read.schema(rows.schema).parquet(path)

    @staticmethod
    def _parts(rows: DataFrame) -> list[str]:
        """The partitions of rows: as many as the manifest has lines at most."""
        return sorted(r[0] for r in rows.select(PART).distinct().collect())

    def commit(self, **info) -> int:
        """Put this change in place as the next version, or raise Conflict if there is one already."""
        version = self.base.version + 1
        text = json.dumps({"version": version, "tables": self.tables, "info": {**info, "rewritten": self.rewritten}})
        if not self.store._put(f"v{version:012d}.json", text):
            raise Conflict(f"version {version} is there already")
        return version
