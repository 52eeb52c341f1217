"""Tables laid out by company, so that windows and as-of joins over them need no shuffle, and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Tables that are walked together have the same number of buckets: about 100 000 companies' prices at 1 GB a bucket.
BUCKETS = 512


def write_by_company(df: DataFrame, name: str, path: str, buckets: int = BUCKETS, order: tuple[str, ...] = ("trade_date",), key: str = "company_id") -> DataFrame:
    """df as table `name` at path, bucketed by company and sorted by company and order within a bucket; returns the table.

    One shuffle here, by the buckets' own hash, gives one file a bucket; every later window by company, and every as-of
    join of two such tables, takes the buckets as they lie. An existing table of that name makes way. Null keys are kept.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    placed = df.withColumnRenamed(key, f"_{key}").repartition(buckets, f"_{key}")
    placed.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, f"_{key}").sortBy(f"_{key}", *order).saveAsTable(f"`{name}`")
    return read_by_company(spark, name, key)


def read_by_company(spark: SparkSession, name: str, key: str = "company_id") -> DataFrame:
    """The table with its key's own name. It is stored with an underscore before it: a union of two tables keeps their
    layout only where the key of the first is a renamed column."""
    return spark.table(f"`{name}`").withColumnRenamed(f"_{key}", key)


def write_csv(df: DataFrame, path: str, order: tuple[str, ...], one_file: bool = False) -> None:
    """df as CSV with a header under path, sorted by order across the files; nulls are empty, arrays are joined by ;.

    one_file is for summaries: it moves all rows to one task.
    """
    from pyspark.sql import functions as F

    flat = df.select(*[F.array_join(c, ";").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])
    rows = flat.coalesce(1).sortWithinPartitions(*order) if one_file else flat.orderBy(*order)
    rows.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)
