"""Coverage checks of the output tables, their history and comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "check_name string, status string, expected long, actual long, missing long, details string"


def status(expected: str, missing: str) -> Column:
    """INFO if nothing is expected, PASS if nothing is missing, else FAIL."""
    return F.when(F.col(expected) == 0, "INFO").when(F.col(missing) == 0, "PASS").otherwise("FAIL")


def completeness(expected: str, missing: str) -> Column:
    return F.when((F.col(expected) > 0) & (F.col(missing) == 0), "PASS").otherwise("INFO")


def active_prices(prices: DataFrame, companies: DataFrame) -> DataFrame:
    return prices.join(companies.where("is_active").select(F.col("id").alias("company_id")), "company_id", "left_semi").select("company_id", "trade_date")


def missing_rows(wanted: DataFrame, table: DataFrame, keys: tuple[str, ...] = ("company_id", "trade_date")) -> DataFrame:
    """Rows of wanted without a partner in table."""
    return wanted.join(table.select(*keys), list(keys), "left_anti")


def coverage(wanted: DataFrame, table: DataFrame, name: str, keys: tuple[str, ...] = ("company_id", "trade_date")) -> DataFrame:
    """Per date: how many of wanted have a row in table, as a check."""
    marked = wanted.join(table.select(*keys).distinct().withColumn("_has", F.lit(True)), list(keys), "left")
    out = marked.groupBy("trade_date").agg(F.count("*").alias("expected"), F.count_if(F.col("_has").isNull()).alias("missing"))
    return out.select("trade_date", F.lit(name).alias("check_name"), status("expected", "missing").alias("status"), "expected", (F.col("expected") - F.col("missing")).alias("actual"), "missing")


def price_input(prices: DataFrame) -> DataFrame:
    """Per date: PASS where there are prices."""
    return prices.groupBy("trade_date").agg(F.count("*").alias("actual")).select("trade_date", F.lit("Daily price input").alias("check_name"), F.lit("PASS").alias("status"), F.col("actual").alias("expected"), "actual", F.lit(0).cast("long").alias("missing"))


def universe_coverage(prices: DataFrame, companies: DataFrame) -> DataFrame:
    """Per date: active companies without a price as a WARN, with how many and the first and last symbol of them.

    Companies are counted per date, so no list of (date, company) pairs is formed.
    """
    active = companies.where("is_active")
    total = active.agg(F.count("*").alias("n")).first()["n"]
    seen = active_prices(prices, companies).distinct().groupBy("trade_date").agg(F.count("*").alias("actual"))
    missing = F.lit(total) - F.col("actual")
    return seen.select("trade_date", F.lit("Active-universe price coverage").alias("check_name"), F.when(missing == 0, "PASS").otherwise("WARN").alias("status"), F.lit(total).cast("long").alias("expected"), "actual", missing.alias("missing"))


def missing_symbols(prices: DataFrame, companies: DataFrame, day: str) -> DataFrame:
    """The symbols of active companies without a price on one day, in order."""
    of_day = prices.where(F.col("trade_date") == F.lit(day).cast("date")).select(F.col("company_id").alias("id"))
    return companies.where("is_active").join(of_day, "id", "left_anti").select("symbol").orderBy("symbol")


def eligible_ratios(features: DataFrame, ratios: DataFrame) -> DataFrame:
    """Per date: rows with a TTM row known by then, and whether ratios exist for its period."""
    eligible = features.where("ttm_period_end IS NOT NULL")
    has = ratios.select("company_id", F.col("period_end").alias("ttm_period_end")).distinct().withColumn("_has", F.lit(True))
    out = eligible.join(has, ["company_id", "ttm_period_end"], "left").groupBy("trade_date").agg(F.count("*").alias("expected"), F.count_if(F.col("_has").isNull()).alias("missing"))
    return out.select("trade_date", F.lit("Eligible financial-ratio coverage").alias("check_name"), status("expected", "missing").alias("status"), "expected", (F.col("expected") - F.col("missing")).alias("actual"), "missing")


FIELDS = {"pe": "P/E availability", "ev_to_ebitda": "EV/EBITDA availability", "price_to_fcf": "Price-to-FCF availability", "fcf_yield": "FCF yield availability"}


def field_availability(valuations: DataFrame) -> DataFrame:
    """Per date and field: PASS if no valuation lacks it, else INFO."""
    counts = valuations.groupBy("valuation_date").agg(F.count("*").alias("expected"), *[F.count(c).alias(f"_{c}") for c in FIELDS])
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(f"_{c}").alias("actual")) for c, name in FIELDS.items()])).alias("r")
    flat = counts.select(F.col("valuation_date").alias("trade_date"), "expected", rows).select("trade_date", "r.check_name", "expected", "r.actual").withColumn("missing", F.col("expected") - F.col("actual"))
    return flat.select("trade_date", "check_name", completeness("expected", "missing").alias("status"), "expected", "actual", "missing")


def cash_flow_coverage(canon: DataFrame) -> DataFrame:
    """Per quarter: consolidated statements that lack operating cash flow, capital expenditure or free cash flow, as a WARN."""
    lacks = F.col("operating_cash_flow").isNull() | F.col("capital_expenditure").isNull() | F.col("free_cash_flow").isNull()
    out = canon.where("period_type = 'quarterly' AND statement_scope = 'Consolidated'").groupBy("period_end").agg(F.count("*").alias("expected"), F.count_if(lacks).alias("missing"), F.count_distinct(F.when(lacks, F.col("company_id"))).alias("companies"))
    return out.select("period_end", F.when(F.col("missing") > 0, "WARN").otherwise("PASS").alias("status"), "expected", "missing", "companies")


def report(prices: DataFrame, companies: DataFrame, outputs: dict[str, DataFrame], features: DataFrame, ratios: DataFrame, valuations: DataFrame) -> DataFrame:
    """All checks by date, one row each; a date without prices has none and should be treated as failed."""
    wanted = active_prices(prices, companies)
    parts = [price_input(prices), universe_coverage(prices, companies), *[coverage(wanted, t, f"{n} coverage") for n, t in outputs.items()], eligible_ratios(features, ratios)]
    value_side = valuations.select("company_id", F.col("valuation_date").alias("trade_date"))
    eligible = features.where("ttm_period_end IS NOT NULL").select("company_id", "trade_date")
    parts += [coverage(eligible, value_side, "Eligible valuation coverage"), field_availability(valuations)]
    return reduce(lambda a, b: a.unionByName(b), parts)


def compare_runs(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Checks of two runs by name: added, removed, changed or unchanged, with both sides' values."""
    names = ("status", "expected", "actual")
    o = older.select("check_name", *[F.col(c).alias(f"old_{c}") for c in names], F.lit(True).alias("_o"))
    n = newer.select("check_name", *[F.col(c).alias(f"new_{c}") for c in names], F.lit(True).alias("_n"))
    same = reduce(lambda a, b: a & b, [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in names])
    change = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(same, "unchanged").otherwise("changed")
    return o.join(n, "check_name", "full_outer").select("check_name", change.alias("change"), *[f"{side}_{c}" for side in ("old", "new") for c in names])


def history(runs: DataFrame, day: str | None = None, limit: int = 20) -> DataFrame:
    """The latest runs, of one date if given."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    rows = runs if day is None else runs.where(F.col("trade_date") == F.lit(day).cast("date"))
    return rows.orderBy(F.col("started_at").desc(), F.col("id").desc()).limit(limit)


def run_summary(checks: DataFrame) -> DataFrame:
    """Counts by status, and whether the run failed."""
    each = [F.count_if(F.col("status") == s).alias(s.lower()) for s in ("PASS", "FAIL", "WARN", "INFO")]
    return checks.groupBy("trade_date").agg(F.count("*").alias("checks"), *each).withColumn("failed", F.col("fail") > 0)


def complete_ingests(runs: DataFrame, prices: DataFrame) -> DataFrame:
    """Dates whose latest successful run wrote as many rows as there are prices, and some."""
    last = runs.where("status = 'SUCCESS'").groupBy("trade_date").agg(F.max_by("records_written", F.struct("started_at", "id")).alias("records_written"))
    stored = prices.groupBy("trade_date").agg(F.count("*").alias("stored"))
    return last.join(stored, "trade_date", "left").select("trade_date", "records_written", F.coalesce("stored", F.lit(0)).alias("stored"), ((F.col("stored") > 0) & (F.col("records_written") == F.col("stored"))).alias("is_complete"))
