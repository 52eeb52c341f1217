"""Point-in-time market capitalisation, valuation, shareholding percentages and forward returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.core import Known, asof_joins, ratio
from tidemark.operators.fundamentals import BALANCES, CASH_FLOWS, FLOWS


def known_shares(share_capital: DataFrame) -> Known:
    """The equity shares last filed by a date, for asof_joins."""
    shares = share_capital.where("share_type = 'EQUITY' AND shares_outstanding IS NOT NULL")
    return Known(shares, "filing_date", ["filing_date", "effective_date"], ["shares_outstanding", "effective_date"])


def market_metrics(prices: DataFrame, share_capital: DataFrame) -> DataFrame:
    """Close x the equity shares last filed by the trade date; a price without known shares keeps null shares and capitalisation.

    Of shares filed on one day those with the latest effective date count.
    """
    rows = prices.select("company_id", "trade_date", "close", "volume")
    known = asof_joins(rows, ["company_id"], "trade_date", [known_shares(share_capital)])
    return known.select(
        "company_id", "trade_date", "close", "volume", "shares_outstanding",
        F.col("effective_date").alias("share_data_date"),
        (F.col("close") * F.col("shares_outstanding")).alias("market_cap"),
        F.when(F.col("shares_outstanding").isNull(), "PRICE_ONLY").otherwise("CLOSE_X_HISTORICAL_SHARES").alias("calculation_method"),
    )


TTM_PAYLOAD = ["period_end", "latest_filing_date", *[f"{c}_ttm" for c in (*FLOWS, *CASH_FLOWS)], *BALANCES]


#: What multiples() reads of a TTM row.
MULTIPLES_OF = ["period_end", "latest_filing_date", *[f"{c}_ttm" for c in ("net_income", "revenue", "free_cash_flow", "ebitda")], "total_debt", "cash_and_equivalents"]


def ttm_known(ttm_rows: DataFrame, scope: str = "Consolidated", prefix: str = "ttm_", more: tuple[str, ...] = (), columns: list[str] = TTM_PAYLOAD) -> Known:
    """The TTM row of the latest period that was filed by a date, for asof_joins: columns of it, and more."""
    scoped = ttm_rows.where((F.col("statement_scope") == scope) & F.col("latest_filing_date").isNotNull())
    return Known(scoped, "latest_filing_date", ["period_end", "latest_filing_date"], [*columns, *more], prefix)


def known_ttm(rows: DataFrame, ttm_rows: DataFrame, scope: str = "Consolidated", prefix: str = "ttm_") -> DataFrame:
    """rows (company_id, trade_date, ...) with the TTM row of the latest period that was filed by the trade date."""
    return asof_joins(rows, ["company_id"], "trade_date", [ttm_known(ttm_rows, scope, prefix)])


def multiples(t: Callable[[str], Column] = lambda c: F.col(f"ttm_{c}")) -> dict[str, Column]:
    """Multiples and yields of market_cap and enterprise_value over a TTM row, whose columns t gives by name."""
    of = lambda c: t(f"{c}_ttm")
    value = F.col("market_cap") + t("total_debt") - t("cash_and_equivalents")
    return {
        "enterprise_value": value,
        "pe": ratio("market_cap", of("net_income")),
        "price_to_sales": ratio("market_cap", of("revenue")),
        "price_to_fcf": ratio("market_cap", of("free_cash_flow")),
        "ev_to_ebitda": ratio(value, of("ebitda")),
        "ev_to_sales": ratio(value, of("revenue")),
        "earnings_yield": ratio(of("net_income"), "market_cap"),
        "fcf_yield": ratio(of("free_cash_flow"), "market_cap"),
    }


def valuations(metrics: DataFrame, ttm_rows: DataFrame, scope: str = "Consolidated") -> DataFrame:
    """Multiples and yields per market row that has a TTM row known by its date; rows without one are left out.

    Zero denominators and missing values give null, negative values stay.
    """
    r = known_ttm(metrics.select("company_id", "trade_date", "market_cap"), ttm_rows, scope).where("ttm_period_end IS NOT NULL")
    return r.select(
        "company_id", F.col("trade_date").alias("valuation_date"), F.lit(scope).alias("statement_scope"), "market_cap",
        F.col("ttm_period_end").alias("ttm_period_end"), F.col("ttm_latest_filing_date").alias("ttm_filing_date"),
        *[e.alias(c) for c, e in multiples().items()],
        F.lit("EXACT_MARKET_DATE_PIT_TTM").alias("calculation_method"),
    )


def shareholding_percentages(snapshots: DataFrame) -> DataFrame:
    """Each <category>_shares as <category>_pct of the total, six decimals half up; snapshots without a positive total leave."""
    names = [c.removesuffix("_shares") for c in snapshots.columns if c.endswith("_shares") and c != "total_shares"]
    pct = [F.round(F.col(f"{c}_shares").cast("decimal(28,0)") * 100 / F.col("total_shares").cast("decimal(20,0)"), 6).cast("decimal(12,6)").alias(f"{c}_pct") for c in names]
    return snapshots.where("total_shares > 0").select("company_id", "effective_date", "total_shares", *pct)


HORIZONS = (5, 20, 60)


def closes_ahead(horizons: tuple[int, ...] = HORIZONS) -> list[Column]:
    line = Window.partitionBy("company_id").orderBy("trade_date")
    return [F.lead("close", n).over(line).alias(f"close_{n}d") for n in horizons]


def gain_ahead(n: int) -> Column:
    """The return to the close n rows ahead, of rows that have it beside them."""
    return F.when((F.col("close") > 0) & (F.col(f"close_{n}d") > 0), F.col(f"close_{n}d") / F.col("close") - 1).alias(f"forward_{n}d_return")


def forward_returns(prices: DataFrame, start: str | None = None, end: str | None = None, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """Close n trading rows ahead and the return to it; null unless both closes are positive.

    The dates are cut before looking ahead, so the last rows of the range have no returns.
    """
    rows = prices
    if start is not None:
        rows = rows.where(F.col("trade_date") >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.where(F.col("trade_date") <= F.lit(end).cast("date"))
    ahead = rows.select("company_id", "trade_date", "close", *closes_ahead(horizons))
    gain = [gain_ahead(n) for n in horizons]
    return ahead.select("company_id", "trade_date", "close", *[f"close_{n}d" for n in horizons], *gain)
