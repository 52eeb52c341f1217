"""The folder that driver and executors share, and tables staged in it."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; a session on one machine may go without."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not (spark.conf.get("spark.master", "") == "local" or spark.conf.get("spark.master", "").startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        found = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in this application's folder."""
    return f"{staged_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged_dir(spark: SparkSession) -> str:
    """This application's folder of staged tables. Results read from it, so it stays until drop_staged() or the session's end."""
    app = spark.sparkContext.applicationId
    if app not in _STAGED:
        _STAGED.add(app)
        atexit.register(_drop_at_exit, spark)
    return f"{shared_dir(spark)}/staged-{app}"


_STAGED: set[str] = set()


def drop(spark: SparkSession, path: str) -> None:
    """Delete a staged table or a folder of them, on whatever file system it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_table(df: DataFrame | None) -> None:
    """Delete a table that stage() has written and that nothing reads any more."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()} if df is not None else ():
        drop(df.sparkSession, folder)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application has staged; results that were not written elsewhere are lost."""
    drop(spark, staged_dir(spark))


def _drop_at_exit(spark: SparkSession) -> None:
    # a stopped session's folder is left to whoever clears the shared one
    with contextlib.suppress(Exception):
        drop_staged(spark)
