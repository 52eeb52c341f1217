"""Trading calendar of the exchange as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Exchange holidays by year.
HOLIDAYS = """
2021-01-26 2021-03-11 2021-03-29 2021-04-02 2021-04-14 2021-04-21 2021-05-13 2021-07-21 2021-08-19 2021-09-10 2021-10-15 2021-11-05 2021-11-19
2022-01-26 2022-03-01 2022-03-18 2022-04-14 2022-04-15 2022-05-03 2022-08-09 2022-08-15 2022-08-31 2022-10-05 2022-10-26 2022-11-08
2023-01-26 2023-03-07 2023-03-30 2023-04-04 2023-04-07 2023-04-14 2023-05-01 2023-06-29 2023-08-15 2023-09-19 2023-10-02 2023-10-24 2023-11-14 2023-11-27 2023-12-25
2024-01-22 2024-01-26 2024-03-08 2024-03-25 2024-03-29 2024-04-11 2024-04-17 2024-05-01 2024-05-20 2024-06-17 2024-07-17 2024-08-15 2024-10-02 2024-11-15 2024-11-20 2024-12-25
2025-02-26 2025-03-14 2025-03-31 2025-04-10 2025-04-14 2025-04-18 2025-05-01 2025-08-15 2025-08-27 2025-10-02 2025-10-22 2025-11-05 2025-12-25
2026-01-15 2026-01-26 2026-03-03 2026-03-26 2026-03-31 2026-04-03 2026-04-14 2026-05-01 2026-05-28 2026-06-26 2026-09-14
""".split()
#: Sessions held on a day that would be closed.
SPECIAL_SESSIONS = ["2021-11-04", "2022-10-24", "2023-11-12", "2024-11-01", "2025-10-21", "2026-11-08"]


def _among(day: Column, days: list[str]) -> Column:
    return day.isin([F.lit(d).cast("date") for d in days])


def classify(day: Column) -> Column:
    """SPECIAL_TRADING_DAY before WEEKEND before HOLIDAY, else TRADING_DAY; null for a null day."""
    return (
        F.when(day.isNull(), F.lit(None).cast("string"))
        .when(_among(day, SPECIAL_SESSIONS), "SPECIAL_TRADING_DAY")
        .when(F.weekday(day) >= 5, "WEEKEND")
        .when(_among(day, HOLIDAYS), "HOLIDAY")
        .otherwise("TRADING_DAY")
    )


def is_trading_day(day: Column) -> Column:
    return classify(day).isin("TRADING_DAY", "SPECIAL_TRADING_DAY")


def trading_days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """trade_date for each trading day from start to end, both included; none if start is after end."""
    span = F.when(F.lit(start).cast("date") <= F.lit(end).cast("date"), F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return spark.range(1).select(F.explode(span).alias("trade_date")).where(is_trading_day(F.col("trade_date")))
