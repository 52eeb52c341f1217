"""Domain tables as views over the star-schema test tables, in SQL that Spark and DuckDB both read.

A supplier stands for a company, its line items by ship date for its trades. The same text feeds the Spark queries and
the SQL that they are compared with, so both see the same rows; {name} stands for a table. Values are rounded as
floor(x * 10^d + 0.5) / 10^d, which both engines compute alike to the last bit.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.shared import stage

QUARTER_BASE = """
SELECT company_id, period_end, qidx, revenue, (company_id + qidx) AS k FROM (
  SELECT l_suppkey AS company_id,
         last_day(CAST(CAST(date_trunc('quarter', l_shipdate) AS DATE) + INTERVAL 2 MONTH AS DATE)) AS period_end,
         CAST((extract(YEAR FROM l_shipdate) - 1995) * 4 + extract(QUARTER FROM l_shipdate) AS BIGINT) AS qidx,
         CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS revenue
  FROM {lineitem} GROUP BY 1, 2, 3) b
"""

FIXTURES = {
    "companies": """
SELECT s_suppkey AS id, s_name AS symbol, concat('IN', CAST(s_suppkey AS STRING)) AS isin, s_name AS company_name,
       CASE WHEN s_nationkey % 2 = 0 THEN 'EQ' ELSE 'BE' END AS series, s_acctbal >= 0 AS is_active
FROM {supplier}""",
    "daily_prices": """
SELECT l_suppkey AS company_id, CAST(l_shipdate AS DATE) AS trade_date,
       floor((CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE)) * 1e2 + 0.5) / 1e2 AS close,
       floor((max(l_extendedprice / l_quantity)) * 1e2 + 0.5) / 1e2 AS high,
       floor((min(l_extendedprice / l_quantity)) * 1e2 + 0.5) / 1e2 AS low,
       CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS volume,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS traded_value,
       count(*) AS trades_count
FROM {lineitem} GROUP BY 1, 2""",
    "benchmark_prices": """
SELECT CAST(l_shipdate AS DATE) AS trade_date,
       floor((CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE)) * 1e2 + 0.5) / 1e2 AS close_price
FROM {lineitem} WHERE extract(DAY FROM l_shipdate) <> 13 GROUP BY 1""",
    "share_capital": f"""
SELECT company_id, period_end AS effective_date, CAST(period_end + INTERVAL 21 DAY AS DATE) AS filing_date,
       CASE WHEN k % 31 = 0 THEN 'PREFERENCE' ELSE 'EQUITY' END AS share_type,
       CASE WHEN k % 37 = 0 THEN NULL ELSE CAST(1000000 + company_id * 1000 + qidx * 500 AS DOUBLE) END AS shares_outstanding
FROM ({QUARTER_BASE}) q WHERE company_id % 11 <> 0""",
    "shareholding_snapshots": f"""
SELECT company_id, period_end AS effective_date, CASE WHEN k % 23 = 0 THEN 0 ELSE 1000000 + company_id * 1000 + qidx * 500 END AS total_shares,
       CASE WHEN k % 7 = 0 THEN NULL ELSE 400000 + company_id * 11 + qidx * 7 END AS promoter_shares,
       CASE WHEN k % 5 = 0 THEN NULL ELSE 150000 + company_id * 3 END AS domestic_institutions_shares,
       120000 + qidx * 13 AS foreign_institutions_shares,
       CASE WHEN k % 3 = 0 THEN NULL ELSE 90000 + k END AS mutual_funds_shares,
       CASE WHEN k % 13 = 0 THEN NULL ELSE 33333 END AS insurance_companies_shares,
       CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS governments_shares,
       CASE WHEN k % 17 = 0 THEN NULL ELSE 77777 + company_id END AS non_institutions_shares
FROM ({QUARTER_BASE}) q""",
    "statements": f"""
SELECT company_id, period_type, period_end, statement_scope, submission_type, source_reference,
       CASE WHEN k % 29 = 0 THEN NULL ELSE CAST(period_end + CASE WHEN k % 23 = 0 THEN INTERVAL 200 DAY ELSE INTERVAL 45 DAY END AS DATE) END AS filing_date,
       floor((f * revenue) * 1e4 + 0.5) / 1e4 AS revenue,
       CASE WHEN k % 13 = 0 THEN NULL ELSE floor((f * revenue * 0.3) * 1e4 + 0.5) / 1e4 END AS ebitda,
       floor((f * revenue * 0.22) * 1e4 + 0.5) / 1e4 AS ebit,
       floor((f * revenue * 0.2) * 1e4 + 0.5) / 1e4 AS profit_before_tax,
       floor((f * revenue * CASE WHEN k % 9 = 0 THEN -0.1 ELSE 0.15 END) * 1e4 + 0.5) / 1e4 AS net_income,
       CASE WHEN k % 10 = 0 THEN NULL ELSE floor((f * revenue * 0.00000015) * 1e6 + 0.5) / 1e6 END AS eps,
       floor((revenue * (1 + company_id % 4)) * 1e4 + 0.5) / 1e4 AS total_debt,
       CASE WHEN k % 19 = 0 THEN 0.0 ELSE floor((revenue * 3) * 1e4 + 0.5) / 1e4 END AS total_equity,
       CASE WHEN k % 15 = 0 THEN NULL ELSE floor((revenue * 6) * 1e4 + 0.5) / 1e4 END AS total_assets,
       floor((revenue * 0.5) * 1e4 + 0.5) / 1e4 AS cash_and_equivalents,
       CASE WHEN k % 17 = 0 THEN NULL ELSE floor((f * revenue * 0.18) * 1e4 + 0.5) / 1e4 END AS operating_cash_flow,
       floor((f * revenue * 0.05) * 1e4 + 0.5) / 1e4 AS capital_expenditure,
       CASE WHEN k % 17 = 0 THEN NULL ELSE floor((f * revenue * 0.18) * 1e4 + 0.5) / 1e4 - floor((f * revenue * 0.05) * 1e4 + 0.5) / 1e4 END AS free_cash_flow
FROM (
  SELECT company_id, period_end, qidx, k, revenue, 'quarterly' AS period_type, 'Consolidated' AS statement_scope, 'Original' AS submission_type, CAST(company_id * 1000 + qidx AS STRING) AS source_reference, CAST(1.0 AS DOUBLE) AS f FROM ({QUARTER_BASE}) q1
  UNION ALL
  SELECT company_id, period_end, qidx, k, revenue, 'quarterly', 'Consolidated', 'Revision', CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(company_id * 1000 + qidx + 500 AS STRING) END, CAST(1.01 AS DOUBLE) FROM ({QUARTER_BASE}) q2 WHERE k % 5 = 0
  UNION ALL
  SELECT company_id, period_end, qidx, k, revenue, 'quarterly', 'Standalone', 'Original', CAST(company_id * 1000 + qidx AS STRING), CAST(0.8 AS DOUBLE) FROM ({QUARTER_BASE}) q3 WHERE company_id % 4 = 0
  UNION ALL
  SELECT company_id, period_end, qidx, k, revenue, 'annual', 'Consolidated', 'Original', CAST(company_id * 1000 + qidx + 900 AS STRING), CAST(4.1 AS DOUBLE) FROM ({QUARTER_BASE}) q4 WHERE extract(MONTH FROM period_end) = 3 AND company_id % 3 <> 0
) s WHERE NOT (company_id % 8 = 1 AND qidx % 9 = 4)""",
    "cumulative_statements": f"""
SELECT company_id * 100 + qidx AS raw_filing_id, company_id, CAST('Consolidated' AS STRING) AS statement_scope, CAST('Original' AS STRING) AS submission_type,
       CAST('quarterly' AS STRING) AS period_type, period_end, fiscal_start, CASE WHEN fq = 1 OR k % 6 = 0 THEN 'quarter' ELSE 'ytd' END AS pnl_context,
       floor((revenue) * 1e4 + 0.5) / 1e4 AS revenue, floor((revenue * 0.2) * 1e4 + 0.5) / 1e4 AS profit_before_tax, floor((revenue * 0.15) * 1e4 + 0.5) / 1e4 AS net_income, floor((revenue * 0.00000015) * 1e6 + 0.5) / 1e6 AS eps,
       floor((revenue * 0.22) * 1e4 + 0.5) / 1e4 AS ebit, floor((revenue * 0.3) * 1e4 + 0.5) / 1e4 AS ebitda,
       floor((ytd) * 1e4 + 0.5) / 1e4 AS ytd_revenue, floor((ytd * 0.2) * 1e4 + 0.5) / 1e4 AS ytd_profit_before_tax, CASE WHEN k % 14 = 0 THEN NULL ELSE floor((ytd * 0.15) * 1e4 + 0.5) / 1e4 END AS ytd_net_income,
       CASE WHEN k % 8 = 0 THEN NULL ELSE floor((ytd * 0.02) * 1e4 + 0.5) / 1e4 END AS ytd_finance_costs, CASE WHEN k % 9 = 0 THEN NULL ELSE floor((ytd * 0.08) * 1e4 + 0.5) / 1e4 END AS ytd_depreciation,
       CASE WHEN fq IN (1, 2, 3) AND k % 12 <> 0 THEN floor((ytd * 0.18) * 1e4 + 0.5) / 1e4 END AS ytd_operating_cash_flow,
       CASE WHEN fq IN (1, 2, 3) THEN floor((ytd * 0.05) * 1e4 + 0.5) / 1e4 END AS ytd_capital_expenditure, fq
FROM (
  SELECT b.*, CAST(CASE WHEN extract(MONTH FROM period_end) >= 4 THEN extract(YEAR FROM period_end) ELSE extract(YEAR FROM period_end) - 1 END AS INT) AS fy,
         CAST(make_date(CAST(CASE WHEN extract(MONTH FROM period_end) >= 4 THEN extract(YEAR FROM period_end) ELSE extract(YEAR FROM period_end) - 1 END AS INT), 4, 1) AS DATE) AS fiscal_start,
         CAST(CASE extract(MONTH FROM period_end) WHEN 6 THEN 1 WHEN 9 THEN 2 WHEN 12 THEN 3 ELSE 4 END AS INT) AS fq,
         CAST(sum(CAST(revenue AS DECIMAL(18, 4))) OVER (PARTITION BY company_id, CASE WHEN extract(MONTH FROM period_end) >= 4 THEN extract(YEAR FROM period_end) ELSE extract(YEAR FROM period_end) - 1 END ORDER BY period_end) AS DOUBLE) AS ytd
  FROM ({QUARTER_BASE}) b
) c WHERE (company_id * 3 + qidx) % 11 <> 0""",
    "annual_statements": f"""
SELECT company_id * 100 + 90 + max(qidx) AS raw_filing_id, company_id, CAST('Consolidated' AS STRING) AS statement_scope, CAST('Original' AS STRING) AS submission_type,
       CAST(make_date(fy + 1, 3, 31) AS DATE) AS period_end, CAST(make_date(fy, 4, 1) AS DATE) AS fiscal_start,
       CAST(sum(CAST(revenue AS DECIMAL(18, 4))) AS DOUBLE) AS revenue,
       floor((CAST(sum(CAST(revenue AS DECIMAL(18, 4))) AS DOUBLE) * 0.2) * 1e4 + 0.5) / 1e4 AS profit_before_tax,
       floor((CAST(sum(CAST(revenue AS DECIMAL(18, 4))) AS DOUBLE) * 0.15) * 1e4 + 0.5) / 1e4 AS net_income,
       CASE WHEN company_id % 6 = 0 THEN NULL ELSE floor((CAST(sum(CAST(revenue AS DECIMAL(18, 4))) AS DOUBLE) * 0.18) * 1e4 + 0.5) / 1e4 END AS operating_cash_flow,
       floor((CAST(sum(CAST(revenue AS DECIMAL(18, 4))) AS DOUBLE) * 0.05) * 1e4 + 0.5) / 1e4 AS capital_expenditure
FROM (SELECT b.*, CAST(CASE WHEN extract(MONTH FROM period_end) >= 4 THEN extract(YEAR FROM period_end) ELSE extract(YEAR FROM period_end) - 1 END AS INT) AS fy FROM ({QUARTER_BASE}) b) c
GROUP BY company_id, fy HAVING count(*) = 4""",
    "news_signals": """
SELECT DISTINCT CAST(o_custkey % (SELECT count(*) FROM {supplier}) + 1 AS BIGINT) AS company_id, CAST(o_orderdate AS DATE) AS trade_date,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'positive' WHEN '5-LOW' THEN 'negative' ELSE 'neutral' END AS sentiment,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE floor(((o_totalprice - 150000) / 10000000) * 1e6 + 0.5) / 1e6 END AS score_adjustment,
       concat('feed', CAST(o_orderkey % 3 AS STRING)) AS source, o_orderkey AS signal_id
FROM {orders}""",
    "runs": """
SELECT event_id AS id, CAST(ts AS DATE) AS trade_date, user_id AS company_id,
       CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' ELSE upper(event_type) END AS status, ts AS started_at, CAST(floor(value) AS BIGINT) AS records_written
FROM {events}""",
}

_YTD = ("revenue", "profit_before_tax", "net_income", "finance_costs", "depreciation", "operating_cash_flow", "capital_expenditure")
#: Quarterly and annual filings in one table, with the periods that their figures are of.
FIXTURES["filed_statements"] = f"""
SELECT raw_filing_id, company_id, statement_scope, submission_type, period_type, period_end, pnl_context,
       CASE WHEN pnl_context = 'quarter' THEN CAST(date_trunc('quarter', period_end) AS DATE) WHEN raw_filing_id % 23 = 0 THEN NULL ELSE fiscal_start END AS pnl_start,
       CASE WHEN fq > 1 AND raw_filing_id % 13 <> 0 THEN fiscal_start END AS ytd_start,
       CASE WHEN fq > 1 AND raw_filing_id % 13 <> 0 THEN CASE WHEN raw_filing_id % 17 = 0 THEN CAST(period_end - INTERVAL 1 DAY AS DATE) ELSE period_end END END AS ytd_end,
       CASE WHEN fq = 1 OR raw_filing_id % 19 = 0 THEN CAST(date_trunc('quarter', period_end) AS DATE) ELSE fiscal_start END AS cash_flow_start, period_end AS cash_flow_end, fiscal_start AS period_start,
       revenue, profit_before_tax, net_income, eps, ebit, ebitda,
       CASE WHEN fq = 1 OR raw_filing_id % 19 = 0 THEN floor((revenue * 0.18) * 1e4 + 0.5) / 1e4 END AS operating_cash_flow,
       CASE WHEN (fq = 1 OR raw_filing_id % 19 = 0) AND raw_filing_id % 7 <> 0 THEN floor((revenue * 0.05) * 1e4 + 0.5) / 1e4 END AS capital_expenditure,
       CAST(NULL AS DOUBLE) AS free_cash_flow, {", ".join(f"ytd_{c}" for c in _YTD[:5])},
       CASE WHEN fq > 1 THEN ytd_operating_cash_flow END AS ytd_operating_cash_flow, CASE WHEN fq > 1 THEN ytd_capital_expenditure END AS ytd_capital_expenditure
FROM ({FIXTURES["cumulative_statements"]}) s
UNION ALL
SELECT raw_filing_id, company_id, statement_scope, submission_type, 'annual', period_end, 'ytd', CASE WHEN company_id % 5 = 0 THEN NULL ELSE fiscal_start END, NULL, NULL, fiscal_start, period_end, fiscal_start,
       revenue, profit_before_tax, net_income, NULL, NULL, NULL, operating_cash_flow, capital_expenditure, NULL, {", ".join(["NULL"] * len(_YTD))}
FROM ({FIXTURES["annual_statements"]}) y"""

_NAME = re.compile(r"\{(\w+)\}")
_SUM = re.compile(r"CAST\(sum\(CAST\(((?:[^()]|\([^()]*\))+) AS DECIMAL\(18, (\d)\)\)\) AS DOUBLE\)")


def in_units(text: str) -> str:
    """The text with its sums of decimals, taken as doubles, written as sums of whole units for Spark: the same doubles.

    Spark casts a double to a decimal by way of its digits. Away from a tie the rounded whole number is the same, so only
    values near one, and large ones, still go that way; sums beyond 2^53 are divided as decimals.
    """

    def units(found: re.Match) -> str:
        x, scale = f"({found[1]})", f"1e{found[2]}"
        clear = f"abs({x}) < 1e8 AND abs({x} * {scale} - floor({x} * {scale}) - 0.5D) > 1e-3"
        total = f"sum(CASE WHEN {clear} THEN floor({x} * {scale} + 0.5D) ELSE CAST(CAST({x} AS DECIMAL(18, {found[2]})) * {10 ** int(found[2])} AS BIGINT) END)"
        return f"(CASE WHEN abs({total}) < 9007199254740992 THEN CAST({total} AS DOUBLE) / {scale} ELSE CAST(CAST({total} AS DECIMAL(20, 0)) / {10 ** int(found[2])} AS DOUBLE) END)"

    return _SUM.sub(units, text)


def duck(name: str) -> str:
    """The view's text with bare table names."""
    return _NAME.sub(r"\1", FIXTURES[name])


def _view(spark: SparkSession, sf_dir: str, text: str, **made: DataFrame) -> DataFrame:
    tables = {t: made[t] if t in made else spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(_NAME.findall(text))}
    return spark.sql(in_units(text), **tables)


def quarter_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of QUARTER_BASE, written once: a row a company and quarter, for all the views and branches of views that read them."""
    return stage(_view(spark, sf_dir, QUARTER_BASE), "quarters")


def load(spark: SparkSession, sf_dir: str, name: str, quarters: DataFrame | None = None) -> DataFrame:
    """The view over the Parquet tables of sf_dir. quarters: what quarter_base() gave, to be read where the view groups line items by quarter."""
    if quarters is None:
        return _view(spark, sf_dir, FIXTURES[name])
    return _view(spark, sf_dir, FIXTURES[name].replace(f"({QUARTER_BASE})", "{quarters}"), quarters=quarters)
