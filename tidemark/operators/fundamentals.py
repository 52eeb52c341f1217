"""Statements to trailing-twelve-month figures, ratios and growth, for all companies and periods at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.core import growth, latest, month_gap, ratio, strict_sum

FLOWS = ("revenue", "ebitda", "ebit", "profit_before_tax", "net_income", "eps")
CASH_FLOWS = ("operating_cash_flow", "capital_expenditure", "free_cash_flow")
BALANCES = ("total_debt", "total_equity", "total_assets", "cash_and_equivalents")


def canonical(statements: DataFrame) -> DataFrame:
    """One statement per company, period type, period end and scope: the largest numeric source_reference, a missing one first."""
    order = [F.expr("try_cast(source_reference AS BIGINT)").desc_nulls_first(), F.col("submission_type")]
    return latest(statements, ["company_id", "period_type", "period_end", "statement_scope"], order)


def best_quarters(statements: DataFrame) -> DataFrame:
    """One quarter per period end: a filing date before none, the latest, a revision before an original, the largest reference."""
    order = [F.col("filing_date").desc_nulls_last(), (F.col("submission_type") == "Revision").desc(), F.expr("try_cast(source_reference AS BIGINT)").desc_nulls_last()]
    return latest(statements, ["company_id", "statement_scope", "period_end"], order)


def ttm(canon: DataFrame) -> DataFrame:
    """Trailing-twelve-month rows from canonical statements: company_id, period_end, statement_scope, latest_filing_date, flows
    (<name>_ttm), balances, calculation_method, source_periods.

    A row stands at each quarter that ends four quarters without a gap. Flows need all four values. At a 31 March with an
    annual statement the cash flows are the annual's, even if null. Balances are the last known of the four quarters.
    latest_filing_date is the latest of the quarters' and the annual's.
    """
    line = Window.partitionBy("company_id", "statement_scope").orderBy("period_end")
    four = line.rowsBetween(-3, 0)
    quarters = canon.where("period_type = 'quarterly'")
    before = F.lag("period_end").over(line)
    steady = (month_gap(F.col("period_end"), before) == 3) & F.datediff("period_end", before).between(80, 100)
    rows = quarters.withColumn("_steady", F.coalesce(steady.cast("int"), F.lit(0)))
    summed = rows.select(
        "company_id", "statement_scope", "period_end",
        *[strict_sum(c, four, 4).alias(f"{c}_ttm") for c in FLOWS],
        *[strict_sum(c, four, 4).alias(f"_{c}") for c in CASH_FLOWS],
        *[F.last(c, ignorenulls=True).over(four).alias(c) for c in BALANCES],
        F.max("filing_date").over(four).alias("_filed"),
        F.sum("_steady").over(line.rowsBetween(-2, 0)).alias("_steps"),
        F.row_number().over(line).alias("_n"),
        F.array_join(F.collect_list(F.col("period_end").cast("string")).over(four), ",").alias("source_periods"),
    ).where("_n >= 4 AND _steps = 3")
    annual = canon.where("period_type = 'annual'").select("company_id", "statement_scope", "period_end", F.lit(True).alias("_has"), F.col("filing_date").alias("_annual_filed"), *[F.col(c).alias(f"_annual_{c}") for c in CASH_FLOWS])
    joined = summed.join(annual, ["company_id", "statement_scope", "period_end"], "left")
    march = (F.month("period_end") == 3) & (F.dayofmonth("period_end") == 31) & F.col("_has")
    return joined.select(
        "company_id", "period_end", "statement_scope",
        F.greatest("_filed", "_annual_filed").alias("latest_filing_date"),
        *[f"{c}_ttm" for c in FLOWS],
        *[F.when(march, F.col(f"_annual_{c}")).otherwise(F.col(f"_{c}")).alias(f"{c}_ttm") for c in CASH_FLOWS],
        *BALANCES,
        F.when(F.col("eps_ttm").isNull(), "FOUR_QUARTERS_EPS_PARTIAL").otherwise("FOUR_QUARTERS").alias("calculation_method"),
        "source_periods",
    )


MARGINS = {"ebitda": "ebitda_margin", "ebit": "ebit_margin", "net_income": "net_profit_margin", "operating_cash_flow": "ocf_margin", "free_cash_flow": "fcf_margin"}
GROWTH = {"revenue": "revenue_growth_yoy", "ebitda": "ebitda_growth_yoy", "ebit": "ebit_growth_yoy", "net_income": "net_income_growth_yoy", "eps": "eps_growth_yoy"}


def ratios(ttm_rows: DataFrame, yoy: str = "previous") -> DataFrame:
    """19 ratios per TTM row.

    Growth compares with the row just before, if that ends exactly a year earlier (yoy="previous"), or with whatever row
    ends a year earlier (yoy="calendar"). A missing value or a zero denominator gives null.
    """
    year_ago = F.add_months("period_end", -12)
    grown = [f"{c}_ttm" for c in GROWTH]
    if yoy == "previous":
        line = Window.partitionBy("company_id", "statement_scope").orderBy("period_end")
        prior = F.lag(F.struct("period_end", *grown)).over(line)
        rows = ttm_rows.withColumn("_prior", prior).withColumn("_prior", F.when(F.col("_prior.period_end") == year_ago, F.col("_prior")))
    else:
        old = ttm_rows.select("company_id", "statement_scope", F.struct("period_end", *grown).alias("_prior"), F.add_months("period_end", 12).alias("_at"))
        rows = ttm_rows.withColumn("_at", F.col("period_end")).join(old, ["company_id", "statement_scope", "_at"], "left").where(F.col("_prior").isNull() | (F.col("_prior.period_end") == year_ago)).drop("_at")
    t = lambda c: F.col(f"{c}_ttm")
    return rows.select(
        "company_id", "period_end", "statement_scope",
        *[ratio(t(c), t("revenue")).alias(name) for c, name in MARGINS.items()],
        ratio(t("net_income"), "total_equity").alias("roe"),
        ratio(t("net_income"), "total_assets").alias("roa"),
        *[growth(t(c), F.col(f"_prior.{c}_ttm")).alias(name) for c, name in GROWTH.items()],
        ratio("total_debt", "total_equity").alias("debt_to_equity"),
        ratio("total_debt", t("ebitda")).alias("debt_to_ebitda"),
        ratio(F.col("total_debt") - F.col("cash_and_equivalents"), t("ebitda")).alias("net_debt_to_ebitda"),
        ratio(t("revenue"), "total_assets").alias("asset_turnover"),
        t("eps"),
        ratio(t("free_cash_flow"), t("net_income")).alias("fcf_to_net_income"),
        ratio(t("operating_cash_flow"), t("net_income")).alias("ocf_to_net_income"),
        F.col("period_end").alias("source_period"),
        F.col("_prior.period_end").alias("prior_period"),
        F.lit("TTM_RATIOS").alias("calculation_method"),
    )


def previous_quarter_end(day: Column) -> Column:
    """The quarter end before a standard quarter end; null for any other day."""
    standard = (F.month(day) % 3 == 0) & (day == F.last_day(day))
    return F.when(standard, F.last_day(F.add_months(day, -3)))


def statement_metrics(now: dict[str, Column], before: dict[str, Column]) -> dict[str, Column]:
    """Nine metrics of a statement and, for growth, an earlier one."""
    return {
        "revenue_growth": growth(now["revenue"], before["revenue"]),
        "eps_growth": growth(now["eps"], before["eps"]),
        "fcf_growth": growth(now["free_cash_flow"], before["free_cash_flow"]),
        "ebitda_margin": ratio(now["ebitda"], now["revenue"]),
        "ebit_margin": ratio(now["ebit"], now["revenue"]),
        "net_profit_margin": ratio(now["net_income"], now["revenue"]),
        "fcf_margin": ratio(now["free_cash_flow"], now["revenue"]),
        "debt_to_equity": ratio(now["total_debt"], now["total_equity"]),
        "roe": ratio(now["net_income"], now["total_equity"]),
    }


_MEASURES = ("revenue", "ebitda", "ebit", "net_income", "eps", "total_debt", "total_equity", "free_cash_flow")


def yoy_qoq(canon: DataFrame) -> DataFrame:
    """Per statement: its metrics, and growth of revenue, eps and free cash flow on a year (yoy_) and a quarter (qoq_) before.

    The earlier statement has the same company, scope and period type and ends on exactly that day; an annual statement
    and a quarter that ends on no standard day have no quarter before.
    """
    key = ["company_id", "statement_scope", "period_type"]
    old = canon.select(*key, F.col("period_end").alias("_end"), F.struct(*_MEASURES).alias("_old"))
    rows = canon.withColumn("_year", F.add_months("period_end", -12)).withColumn("_quarter", F.when(F.col("period_type") == "quarterly", previous_quarter_end(F.col("period_end"))))
    for span in ("year", "quarter"):
        rows = rows.join(old.withColumnRenamed("_end", f"_{span}").withColumnRenamed("_old", f"_old_{span}"), [*key, f"_{span}"], "left")
    now = {c: F.col(c) for c in _MEASURES}
    year, quarter = ({c: F.col(f"_old_{span}.{c}") for c in _MEASURES} for span in ("year", "quarter"))
    by_year, by_quarter = statement_metrics(now, year), statement_metrics(now, quarter)
    grown = ("revenue_growth", "eps_growth", "fcf_growth")
    return rows.select(
        "company_id", "period_type", "period_end", "statement_scope",
        *[by_year[c].alias(c) for c in by_year if c not in grown],
        *[by_year[c].alias(f"yoy_{c}") for c in grown],
        *[by_quarter[c].alias(f"qoq_{c}") for c in grown],
    )


def fundamental_history(canon: DataFrame, companies: DataFrame, symbol: str, period_type: str = "quarterly", scope: str = "Consolidated") -> DataFrame:
    """All periods of one company, latest first, with their metrics; the symbol is matched without regard to case."""
    one = companies.where(F.upper("symbol") == symbol.upper()).select(F.col("id").alias("company_id"), "symbol")
    rows = canon.where((F.col("period_type") == period_type) & (F.col("statement_scope") == scope)).join(one, "company_id", "left_semi")
    return yoy_qoq(rows).orderBy(F.col("period_end").desc())


def fundamental_analysis(canon: DataFrame, ttm_rows: DataFrame, companies: DataFrame, symbol: str, period_end: str, period_type: str = "quarterly", scope: str = "Consolidated", as_of_date: str | None = None) -> DataFrame:
    """One row: the statement's metrics, its year- and quarter-growth, and the TTM row known at as_of_date as a struct."""
    chosen = fundamental_history(canon, companies, symbol, period_type, scope).where(F.col("period_end") == F.lit(period_end).cast("date"))
    if as_of_date is None:
        return chosen
    known = ttm_rows.where((F.col("latest_filing_date") <= F.lit(as_of_date).cast("date")) & (F.col("statement_scope") == scope))
    best = known.groupBy("company_id").agg(F.max(F.struct("period_end", "latest_filing_date", *[c for c in known.columns if c.endswith("_ttm")], *BALANCES)).alias("ttm"))
    return chosen.join(best, "company_id", "left")
