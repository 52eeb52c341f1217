"""Cumulative filings to single quarters, with the lineage of what was subtracted from what.

Each step is one self join on the fiscal year: a cumulative row's base is the latest earlier row of the same company,
scope, submission type and fiscal start. Bases are read from the input, so no step depends on another row's result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.core import asof_join

KEY = ("company_id", "statement_scope", "submission_type", "fiscal_start")
PROFITS = ("revenue", "profit_before_tax", "net_income")
_CARRIED = ("ytd_revenue", "ytd_profit_before_tax", "ytd_net_income", "ytd_finance_costs", "ytd_depreciation", "ytd_operating_cash_flow", "ytd_capital_expenditure", "raw_filing_id", "period_end")


def with_base(rows: DataFrame, adjacent_only: bool = False) -> DataFrame:
    """rows with base, the cumulative figures of the row before in the fiscal year; null for the first.

    With adjacent_only the base must end one quarter earlier, so a missing filing gives no base in place of a longer one.
    A null company has no base.
    """
    line = Window.partitionBy(*KEY).orderBy("period_end", "raw_filing_id")
    base = F.lag(F.struct(*_CARRIED)).over(line)
    ok = F.col("company_id").isNotNull() & (base["period_end"] < F.col("period_end"))
    if adjacent_only:
        ok = ok & (base["period_end"] == F.last_day(F.add_months("period_end", -3)))
    return rows.withColumn("base", F.when(ok, base))


def _minus(c: str) -> Column:
    return F.col(f"ytd_{c}") - F.col(f"base.ytd_{c}")


def quarterly_pnl(rows: DataFrame, adjacent_only: bool = False) -> DataFrame:
    """Profit and loss of the quarter alone.

    A row that reports the quarter keeps its figures. A cumulative row is the difference to its base: revenue, profit
    before tax and net income where both are known, EBIT = profit before tax + finance costs and EBITDA = EBIT +
    depreciation where those are known on both sides, no EPS. Without a base all of them are null.
    """
    r = with_base(rows, adjacent_only)
    derive = F.col("pnl_context") == "ytd"
    pbt = _minus("profit_before_tax")
    ebit = pbt + _minus("finance_costs")
    made = {"revenue": _minus("revenue"), "profit_before_tax": pbt, "net_income": _minus("net_income"), "eps": F.lit(None).cast("double"), "ebit": ebit, "ebitda": ebit + _minus("depreciation")}
    return r.select("raw_filing_id", *KEY, "period_end", *[F.when(derive, e).otherwise(F.col(c)).alias(c) for c, e in made.items()], F.when(derive & F.col("base").isNotNull(), F.col("base.raw_filing_id")).alias("base_filing_id"))


def free_cash_flow(ocf: Column, capex: Column) -> Column:
    return ocf - F.abs(capex)


def quarterly_cash_flow(rows: DataFrame, adjacent_only: bool = False) -> DataFrame:
    """Operating cash flow, capital expenditure and free cash flow of the quarter alone, per field where both sides are known.

    The fiscal year's first row is its own quarter; rows without cumulative cash flows give nulls.
    """
    r = with_base(rows, adjacent_only)
    first = F.months_between("period_end", "fiscal_start") < 4
    made = {c: F.when(first, F.col(f"ytd_{c}")).otherwise(_minus(c)) for c in ("operating_cash_flow", "capital_expenditure")}
    flat = r.select("raw_filing_id", *KEY, "period_end", *[e.alias(c) for c, e in made.items()], F.when(~first, F.col("base.raw_filing_id")).alias("base_filing_id"))
    return flat.withColumn("free_cash_flow", free_cash_flow(F.col("operating_cash_flow"), F.col("capital_expenditure")))


def fourth_quarter(rows: DataFrame, annual: DataFrame) -> DataFrame:
    """Fourth quarters as the annual statement minus the cumulative row before: profits and cash flows.

    Profits take the latest cumulative row of the fiscal year that ends before the annual; cash flows only one that ends
    exactly a quarter before it. Years without such a row give nulls for those figures.
    """
    keys = [k for k in KEY]
    old = rows.select(*keys, F.struct(F.col("period_end").alias("end"), *_CARRIED).alias("base"), F.col("period_end").alias("_end"))
    a = annual.alias("a").join(old.alias("o"), [F.col(f"a.{k}") == F.col(f"o.{k}") for k in keys] + [F.col("o._end") < F.col("a.period_end")], "left")
    names = [c for c in annual.columns if c not in keys]
    best = a.groupBy(*[F.col(f"a.{k}").alias(k) for k in keys], *[F.col(f"a.{c}").alias(c) for c in names]).agg(F.max("o.base").alias("base"))
    near = F.col("base.end") == F.last_day(F.add_months("period_end", -3))
    out = best.select(
        "raw_filing_id", *keys, "period_end",
        *[(F.col(c) - F.col(f"base.ytd_{c}")).alias(c) for c in PROFITS],
        *[F.when(near, F.col(c) - F.col(f"base.ytd_{c}")).alias(c) for c in ("operating_cash_flow", "capital_expenditure")],
        F.col("base.raw_filing_id").alias("base_filing_id"),
    )
    return out.withColumn("free_cash_flow", free_cash_flow(F.col("operating_cash_flow"), F.col("capital_expenditure")))


def lineage(rows: DataFrame, annual: DataFrame) -> DataFrame:
    """What each derived quarter came from: raw_filing_id, source_filing_id, component, source_role, derivation_method.

    Only where both filings are known and at least one of the component's figures can be subtracted; each row once.
    """
    r = with_base(rows)
    known = F.col("base").isNotNull() & F.col("raw_filing_id").isNotNull()
    derive = {"PNL": known & (F.col("pnl_context") == "ytd"), "CASH_FLOW": known & (F.months_between("period_end", "fiscal_start") >= 4)}
    some = lambda cs: F.coalesce(*[_minus(c).cast("double") for c in cs]).isNotNull()
    parts = []
    for component, cs in (("PNL", PROFITS), ("CASH_FLOW", ("operating_cash_flow", "capital_expenditure"))):
        found = r.where(derive[component] & some(cs))
        for role, source in (("CURRENT_CUMULATIVE", F.col("raw_filing_id")), ("PREVIOUS_CUMULATIVE", F.col("base.raw_filing_id"))):
            parts.append(found.select("raw_filing_id", source.alias("source_filing_id"), F.lit(component).alias("component"), F.lit(role).alias("source_role"), F.lit("YTD_DIFFERENCE").alias("derivation_method")))
    q4 = fourth_quarter(rows, annual).where("base_filing_id IS NOT NULL")
    for component, cs in (("PNL", PROFITS), ("CASH_FLOW", ("operating_cash_flow", "capital_expenditure"))):
        found = q4.where(F.coalesce(*[F.col(c) for c in cs]).isNotNull())
        for role, source in (("ANNUAL_TOTAL", F.col("raw_filing_id")), ("PREVIOUS_CUMULATIVE", F.col("base_filing_id"))):
            parts.append(found.select("raw_filing_id", source.alias("source_filing_id"), F.lit(component).alias("component"), F.lit(role).alias("source_role"), F.lit("ANNUAL_MINUS_YTD").alias("derivation_method")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("source_filing_id IS NOT NULL").distinct()


def reported_values(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The figures as filed, as JSON, taken before anything is derived from them."""
    return rows.select("raw_filing_id", "period_end", F.to_json(F.struct(*columns)).alias("reported_values"))


LINE = ("company_id", "statement_scope", "submission_type")
CASH = ("operating_cash_flow", "capital_expenditure")


def direct_cash_flow() -> Column:
    """Whether a row's cash flows are those of a quarter: 75 to 105 days that end with the period, both figures there."""
    ends = (F.col("cash_flow_end") == F.col("period_end")) & F.datediff("cash_flow_end", "cash_flow_start").between(75, 105)
    return F.coalesce(ends & F.col("operating_cash_flow").isNotNull() & F.col("capital_expenditure").isNotNull(), F.lit(False))


def cumulative(c: str) -> Column:
    """The year-to-date figure, else a direct quarter's own, which is what the year has come to by its first quarter."""
    return F.coalesce(f"ytd_{c}", F.when(F.col("pnl_context") == "quarter", F.col(c)))


def _profits_less(base: str) -> dict[str, Column]:
    """What the profit figures become by subtraction of the base; figures that either side lacks stay as they are."""
    less = {c: cumulative(c) - F.col(base + c) for c in PROFITS}
    ebit = less["profit_before_tax"] + F.col("ytd_finance_costs") - F.col(base + "finance_costs")
    made = {**less, "ebit": ebit, "ebitda": ebit + F.col("ytd_depreciation") - F.col(base + "depreciation")}
    return {**{c: F.coalesce(e, F.col(c)) for c, e in made.items()}, "eps": F.lit(None).cast("double")}


def derive_quarterly_financials(rows: DataFrame) -> DataFrame:
    """Quarterly and annual filings in one table, with every quarterly row turned into figures of its quarter alone.

    Four steps in this order, each over what the one before left: profits of cumulative rows less their base; cash flows
    less theirs; profits of a fourth quarter from the base of its annual filing's year; cash flows of a fourth quarter as
    annual less nine months. A base is the latest earlier row of the same company, scope, submission type and start;
    among rows of one end the one with the largest raw_filing_id. Rules:

    * A direct quarter keeps its profits. A cumulative row without a base has no profits; with one, figures that either
      side lacks stay as filed and EPS becomes null.
    * Cash flows of a direct quarter stay. Such a quarter is a base too, by its own start, where it has no cumulative data.
    * Fourth quarters need their quarterly row (the one with the smallest raw_filing_id); its profits change only if it is
      cumulative. Nine months must end exactly a quarter before the annual filing. Of several annual filings of one end
      that with the largest raw_filing_id counts.
    * Free cash flow is made anew wherever both of its parts are known and were looked at.
    * A null company has no base and no fourth quarter; null scopes and submission types equal each other.

    Adds derivation_sources: array of source_filing_id, component, source_role, derivation_method, each once.
    """
    quarterly, annual = F.coalesce(F.col("period_type") == "quarterly", F.lit(False)), F.coalesce(F.col("period_type") == "annual", F.lit(False))
    known = rows.where(quarterly & F.col("company_id").isNotNull()).withColumn("found", F.lit(True))
    order = ["period_end", "raw_filing_id"]
    of_profits = ["found", "raw_filing_id", *PROFITS, "finance_costs", "depreciation"]
    profits = known.select(
        *LINE, "period_end", "raw_filing_id", "found", F.coalesce("ytd_start", "pnl_start").alias("_start"),
        *[cumulative(c).alias(c) for c in PROFITS], F.col("ytd_finance_costs").alias("finance_costs"), F.col("ytd_depreciation").alias("depreciation"),
    ).where("_start IS NOT NULL")

    # everything that is asked of the rows as filed
    day = Window.partitionBy(*LINE, "period_end")
    filed = F.when(annual & F.col("company_id").isNotNull(), F.coalesce("pnl_start", "period_start"))
    paid = annual & F.col("company_id").isNotNull() & (F.col("cash_flow_end") == F.col("period_end")) & F.col("cash_flow_start").isNotNull()
    r = rows.withColumn("_direct", direct_cash_flow()).withColumn("_cash", quarterly & (F.col("_direct") | F.coalesce(*[f"ytd_{c}" for c in CASH]).isNotNull()))
    r = r.withColumn("_year", F.max(F.when(filed.isNotNull(), F.struct("raw_filing_id", filed.alias("start")))).over(day))
    r = r.withColumn("_paid", F.max(F.when(paid, F.struct("raw_filing_id", F.col("cash_flow_start").alias("start"), *CASH))).over(day))
    r = r.withColumn("_fourth", quarterly & (F.row_number().over(Window.partitionBy(*LINE, "period_end", "period_type").orderBy("raw_filing_id")) == 1))

    def with_base_of(left: DataFrame, start: Column, right: DataFrame, payload: list[str], prefix: str) -> DataFrame:
        return asof_join(left.withColumn("_start", start), right, [*LINE, "_start"], "period_end", "period_end", order, payload, prefix, strict=True).drop("_start")

    ytd = quarterly & (F.col("pnl_context") == "ytd")
    r = with_base_of(r, F.when(ytd, F.col("pnl_start")), profits, of_profits, "_p_")
    r = with_base_of(r, F.when(ytd & F.col("_fourth"), F.col("_year.start")), profits, of_profits, "_y_")
    own = F.col("ytd_start").isNull() & F.col("_direct")
    flows = known.withColumn("_direct", direct_cash_flow()).withColumn("_start", F.coalesce("ytd_start", F.when(own, F.col("cash_flow_start"))))
    flows = flows.where(F.col("_start").isNotNull() & (F.when(own, F.col("cash_flow_end")).otherwise(F.col("ytd_end")) == F.col("period_end")))
    flows = flows.select(*LINE, "period_end", "raw_filing_id", "_start", *[F.coalesce(f"ytd_{c}", c).alias(c) for c in CASH])
    r = with_base_of(r, F.when(F.col("_cash") & ~F.col("_direct"), F.col("ytd_start")), flows, ["raw_filing_id", *CASH], "_c_")
    months = known.where("ytd_start IS NOT NULL AND ytd_end = period_end").groupBy(*[F.col(c).alias(f"_m_{c}") for c in LINE], F.col("ytd_start").alias("_m_start"), F.col("ytd_end").alias("_m_end"))
    months = months.agg(F.max(F.struct("raw_filing_id", *[F.col(f"ytd_{c}").alias(c) for c in CASH])).alias("_m"))
    before = F.when(F.month("period_end") % 3 == 0, F.last_day(F.add_months("period_end", -3)))
    on = F.col("_fourth") & (F.col("company_id") == F.col("_m_company_id")) & (F.col("_paid.start") == F.col("_m_start")) & (before == F.col("_m_end"))
    for c in LINE[1:]:
        on = on & F.col(c).eqNullSafe(F.col(f"_m_{c}"))
    r = r.join(months, on, "left")

    def some(of: list[Column]) -> Column:
        return F.coalesce(*of).isNotNull()

    has = {
        "_p_": some([cumulative(c) - F.col(f"_p_{c}") for c in PROFITS]), "_y_": some([cumulative(c) - F.col(f"_y_{c}") for c in PROFITS]),
        "_c_": some([F.col(f"ytd_{c}") - F.col(f"_c_{c}") for c in CASH]), "_m_": some([F.col(f"_paid.{c}") - F.col(f"_m.{c}") for c in CASH]),
    }
    tell = [
        ("_p_", "raw_filing_id", "PNL", "CURRENT_CUMULATIVE", "YTD_DIFFERENCE"), ("_p_", "_p_raw_filing_id", "PNL", "PREVIOUS_CUMULATIVE", "YTD_DIFFERENCE"),
        ("_c_", "raw_filing_id", "CASH_FLOW", "CURRENT_CUMULATIVE", "YTD_DIFFERENCE"), ("_c_", "_c_raw_filing_id", "CASH_FLOW", "PREVIOUS_CUMULATIVE", "YTD_DIFFERENCE"),
        ("_y_", "raw_filing_id", "PNL", "CURRENT_CUMULATIVE", "YTD_DIFFERENCE"), ("_y_", "_y_raw_filing_id", "PNL", "PREVIOUS_CUMULATIVE", "YTD_DIFFERENCE"),
        ("_m_", "_paid.raw_filing_id", "CASH_FLOW", "ANNUAL_TOTAL", "ANNUAL_MINUS_YTD"), ("_m_", "_m.raw_filing_id", "CASH_FLOW", "PREVIOUS_CUMULATIVE", "ANNUAL_MINUS_YTD"),
    ]
    entries = [F.when(has[step] & F.col(source).isNotNull(), F.struct(F.col(source).alias("source_filing_id"), *[F.lit(x).alias(n) for n, x in zip(("component", "source_role", "derivation_method"), rest, strict=True)])) for step, source, *rest in tell]
    r = r.withColumn("derivation_sources", F.array_distinct(F.array_compact(F.array(*entries))))

    r = r.withColumns({c: F.when(ytd, F.when(F.col("_p_found"), e)).otherwise(F.col(c)) for c, e in _profits_less("_p_").items()})
    r = r.withColumns({c: F.when(F.col("_cash") & ~F.col("_direct"), F.coalesce(F.col(f"ytd_{c}") - F.col(f"_c_{c}"), F.col(c))).otherwise(F.col(c)) for c in CASH})
    fcf = free_cash_flow(F.col("operating_cash_flow"), F.col("capital_expenditure"))
    r = r.withColumn("free_cash_flow", F.coalesce(F.when(F.col("_cash"), fcf), F.col("free_cash_flow")))
    r = r.withColumns({c: F.when(F.col("_y_found"), e).otherwise(F.col(c)) for c, e in _profits_less("_y_").items()})
    r = r.withColumns({c: F.coalesce(F.col(f"_paid.{c}") - F.col(f"_m.{c}"), F.col(c)) for c in CASH})
    r = r.withColumn("free_cash_flow", F.coalesce(F.when(F.col("_m").isNotNull(), fcf), F.col("free_cash_flow")))
    return r.select(*rows.columns, "derivation_sources")
