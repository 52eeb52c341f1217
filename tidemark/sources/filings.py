"""XBRL filings: Python only turns XML into facts, everything after is DataFrame logic over facts.

A fact row carries its context: start, end or instant date, whether it has dimensions, and its members. A document that
does not parse is one row with error set.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.shared import stage

FACT_SCHEMA = (
    "filing_id long, company_id long, period_end date, concept string, context string, start_date date, end_date date, instant date,"
    " dimensioned boolean, members array<string>, value string, unit string, decimals string, pos int, error string"
)
_NAMES = [x.split()[0] for x in FACT_SCHEMA.split(",")]

#: Concepts in order of preference.
CONCEPTS = {
    "revenue": ("RevenueFromOperations", "Income"),
    "profit_before_tax": ("ProfitBeforeTax", "ProfitLossFromOrdinaryActivitiesBeforeTax"),
    "net_income": ("ProfitLossForPeriod", "ProfitLossAfterTaxesMinorityInterestAndShareOfProfitLossOfAssociates"),
    "depreciation": ("DepreciationDepletionAndAmortisationExpense",),
    "finance_costs": ("FinanceCosts",),
    "eps": ("BasicEarningsLossPerShareFromContinuingAndDiscontinuedOperations", "BasicEarningsPerShareAfterExtraordinaryItems", "BasicEarningsPerShareBeforeExtraordinaryItems"),
    "operating_cash_flow": ("CashFlowsFromUsedInOperatingActivities",),
    "capital_expenditure": ("PurchaseOfPropertyPlantAndEquipmentClassifiedAsInvestingActivities",),
}
BALANCE = {"total_assets": "Assets", "total_equity": "Equity", "debt_current": "BorrowingsCurrent", "debt_noncurrent": "BorrowingsNoncurrent", "cash_and_equivalents": "CashAndCashEquivalents"}


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _facts(root: ET.Element) -> Iterator[tuple]:
    """(concept, context, start, end, instant, dimensioned, members, value, unit, decimals, pos) in document order."""
    contexts: dict[str, tuple] = {}
    for c in root:
        if _local(c.tag) != "context":
            continue
        period = {_local(x.tag): (x.text or "").strip() for p in c if _local(p.tag) == "period" for x in p}
        deep = [x for x in c.iter() if _local(x.tag) in ("segment", "scenario")]
        members = sorted({v.rpartition(":")[2].strip() for x in c.iter() if _local(x.tag) in ("explicitMember", "typedMember") for v in (x.get("dimension"), x.text) if v and v.strip()})
        contexts[c.get("id", "")] = (period.get("startDate"), period.get("endDate"), period.get("instant"), bool(deep), members)
    for pos, e in enumerate(root.iter()):
        ref, value = e.get("contextRef"), (e.text or "").strip()
        if ref and value:
            yield (_local(e.tag), ref, *contexts.get(ref, (None, None, None, False, [])), value, e.get("unitRef"), e.get("decimals"), pos)


def parse_facts(documents: DataFrame) -> DataFrame:
    """Facts of documents (filing_id, company_id, period_end, content). Map-only; one document is in memory at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for fid, cid, end, content in zip(batch["filing_id"], batch["company_id"], batch["period_end"], batch["content"], strict=True):
                try:
                    rows += [(fid, cid, end, *f, None) for f in _facts(ET.fromstring(content or ""))]
                except ET.ParseError as e:
                    rows.append((fid, cid, end, *[None] * 11, f"ParseError: {e}"))
            out = pd.DataFrame(rows, columns=_NAMES)
            for c in ("start_date", "end_date", "instant"):
                out[c] = pd.to_datetime(out[c], errors="coerce").dt.date.astype(object).where(lambda s: s.notna(), None)
            out["pos"] = out["pos"].astype("Int32")
            yield out

    return documents.select("filing_id", "company_id", "period_end", "content").mapInPandas(run, FACT_SCHEMA)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """XML files under path beside their .json sidecars: path, content, metadata (a map), sha256; files without one stay out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.regexp_replace("path", r"\.(xml|json)$", "").alias("stem"), F.regexp_extract("path", r"\.(xml|json)$", 1).alias("kind"), "content")
    xml = files.where("kind = 'xml'").select("stem", F.col("content").cast("string").alias("content"), F.sha2("content", 256).alias("sha256"))
    side = files.where("kind = 'json'").select("stem", F.from_json(F.col("content").cast("string"), "map<string,string>").alias("metadata")).where("metadata IS NOT NULL")
    return xml.join(side, "stem")


def artifact_name(stem: Column, content: Column) -> Column:
    """A content-addressed file name: unsafe characters become underscores, 16 digits of the digest follow."""
    return F.concat(F.regexp_replace(stem, r"[^A-Za-z0-9._-]+", "_"), F.lit("__"), F.substring(F.sha2(content, 256), 1, 16))


def statements(facts: DataFrame) -> DataFrame:
    """Up to two statements per filing, quarterly and annual, or a row with an error.

    A context's days are its end less its start. pnl_context is quarter for 75-105 days, and in March for 160-200 days that
    start on or after October 1; else ytd. Only contexts without dimensions that end (or stand) at the period end count. By their days: quarter 75-105, the
    shortest; year to date 160-200 or 250-300, the longest; annual 330-370, the shortest. In March a context of 160-300
    days that starts after last April 1 stands in for a missing quarter, and the year-to-date context for any other. Of a
    concept's facts in a context the first that is a number counts. The balance date's context is the one with most
    balance concepts. Free cash flow is operating cash flow less the absolute capital expenditure.
    """
    # three branches read the facts, whose documents are parsed once, and two the statements
    facts = stage(facts.select("filing_id", "company_id", "period_end", "concept", "context", "start_date", "end_date", "instant", "dimensioned", "value", "pos", "error"), "facts")
    good = facts.where("error IS NULL AND NOT dimensioned AND (end_date = period_end OR instant = period_end)")
    numbers = good.withColumn("number", F.col("value").try_cast("double")).where("number IS NOT NULL")
    per = numbers.groupBy("filing_id", "company_id", "period_end", "context", "concept").agg(F.min_by("number", "pos").alias("number"), F.min("pos").alias("pos"), F.first("start_date").alias("start_date"), F.first("instant").alias("instant"))
    days = F.datediff("period_end", "start_date")
    balance = F.col("instant").isNotNull() & F.col("concept").isin(*BALANCE.values())
    ctx = (
        per.groupBy("filing_id", "company_id", "period_end", "context")
        .agg(F.first("start_date").alias("start_date"), F.max(days).alias("days"), F.count_if(balance).alias("n"), F.min("pos").alias("pos"), F.map_from_entries(F.collect_list(F.struct("concept", "number"))).alias("v"))
        .withColumn("c", F.struct("context", "start_date", "days", "v"))
    )
    april = F.add_months(F.trunc("period_end", "year"), -9)
    is_q, is_y, is_a = F.col("days").between(75, 105), F.col("days").between(160, 200) | F.col("days").between(250, 300), F.col("days").between(330, 370)
    late = (F.month("period_end") == 3) & F.col("days").between(160, 300) & (F.col("start_date") > april)
    per_filing = ctx.groupBy("filing_id", "company_id", "period_end").agg(
        F.min_by(F.when(is_q, F.col("c")), F.when(is_q, F.struct("days", "pos"))).alias("q"),
        F.max_by(F.when(is_y, F.col("c")), F.when(is_y, F.struct("days", -F.col("pos")))).alias("y"),
        F.min_by(F.when(is_a, F.col("c")), F.when(is_a, F.struct("days", "pos"))).alias("a"),
        F.min_by(F.when(late, F.col("c")), F.when(late, F.struct("days", "pos"))).alias("m"),
        F.max_by(F.when(F.col("n") > 0, F.col("c")), F.when(F.col("n") > 0, F.struct("n", -F.col("pos")))).alias("b"),
    )
    quarter = F.coalesce("q", "m", "y")
    rows = per_filing.select("filing_id", "company_id", "period_end", "b", "y", F.explode(F.array(F.struct(F.lit("quarterly").alias("period_type"), quarter.alias("c")), F.struct(F.lit("annual").alias("period_type"), F.col("a").alias("c")))).alias("s")).where("s.c IS NOT NULL")
    pick = lambda of, names: F.coalesce(*[F.try_element_at(F.col(of), F.lit(n)) for n in names])
    value = {k: pick("s.c.v", names) for k, names in CONCEPTS.items()}
    flows = (F.col("s.period_type") == "annual") | F.col("s.c.days").between(75, 105)
    october = F.make_date(F.year("period_end") - 1, F.lit(10), F.lit(1))
    half = (F.month("period_end") == 3) & F.col("s.c.days").between(160, 200) & (F.col("s.c.start_date") >= october)
    out = rows.select(
        "filing_id", "company_id", "period_end", F.col("s.period_type").alias("period_type"),
        *[value[k].alias(k) for k in ("revenue", "profit_before_tax", "net_income", "depreciation", "finance_costs", "eps")],
        F.when(flows, value["operating_cash_flow"]).alias("operating_cash_flow"),
        F.when(flows, F.abs(value["capital_expenditure"])).alias("capital_expenditure"),
        *[pick("b.v", (n,)).alias(k) for k, n in BALANCE.items()],
        *[pick("y.v", CONCEPTS[k]).alias(f"ytd_{k}") for k in ("revenue", "profit_before_tax", "net_income", "finance_costs", "depreciation", "operating_cash_flow", "capital_expenditure")],
        F.when(F.col("s.c.days").between(75, 105) | half, "quarter").otherwise("ytd").alias("pnl_context"),
        F.col("s.c.start_date").alias("fiscal_start"), F.lit(None).cast("string").alias("error"),
    )
    both = F.col("debt_current").isNull() & F.col("debt_noncurrent").isNull()
    out = (
        out.withColumn("total_debt", F.when(~both, F.coalesce("debt_current", F.lit(0.0)) + F.coalesce("debt_noncurrent", F.lit(0.0))))
        .withColumn("ebit", F.col("profit_before_tax") + F.col("finance_costs"))
        .withColumn("ebitda", F.col("ebit") + F.col("depreciation"))
        .withColumn("free_cash_flow", F.col("operating_cash_flow") - F.abs("capital_expenditure"))
        .drop("debt_current", "debt_noncurrent")
    )
    out = stage(out, "statements")
    seen = out.select("filing_id").distinct()
    failed = facts.groupBy("filing_id", "company_id", "period_end").agg(F.first("error", ignorenulls=True).alias("error")).join(seen, "filing_id", "left_anti")
    return out.unionByName(failed.withColumn("error", F.coalesce("error", F.lit("NO_TARGET_PERIOD_CONTEXT"))), allowMissingColumns=True)


def standard_of(url: Column) -> Column:
    return F.when(F.upper(url).contains("INDAS"), "Ind AS")


def filing_date(broadcast: Column, cached: Column) -> Column:
    """The broadcast's day if it can be read, else the cached date."""
    return F.coalesce(F.try_to_timestamp(broadcast, F.lit("dd-MMM-yyyy HH:mm:ss")).cast("date"), cached)


def dated(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Statements with filing_date and reporting_standard out of the catalogue (filing_id, broadcast, effective_date, url).

    Both are null for filings that the catalogue lacks; of several entries of a filing the latest effective date counts.
    """
    last = F.max_by(F.struct("broadcast", "effective_date", "url"), F.struct("effective_date", "broadcast", "url"))
    known = catalogue.groupBy("filing_id").agg(last.alias("_f"))
    return rows.join(known, "filing_id", "left").select(*rows.columns, filing_date(F.col("_f.broadcast"), F.col("_f.effective_date")).alias("filing_date"), standard_of(F.col("_f.url")).alias("reporting_standard"))


def sample_documents(cumulative: DataFrame) -> DataFrame:
    """XBRL documents that state the rows of cumulative.

    Contexts: the quarter, the year to date (the whole year in March), the same quarter of one segment, whose figures do
    not count, and the balance date. Facts that can't be read as numbers stand before those that can.
    """
    scenario = "<scenario><explicitMember dimension='x:SegmentAxis'>x:OneMember</explicitMember></scenario>"
    ctx = lambda i, a, more="": F.concat(F.lit(f'<context id="{i}"><period><startDate>'), a.cast("string"), F.lit("</startDate><endDate>"), F.col("period_end").cast("string"), F.lit(f"</endDate></period>{more}</context>"))
    cents = lambda v: (F.floor(v * 100 + 0.5) / 100).cast("decimal(24,2)").cast("string")
    fact = lambda n, c, v: F.coalesce(F.concat(F.lit(f'<{n} contextRef="{c}" decimals="2">'), cents(v), F.lit(f"</{n}>")), F.lit(""))
    facts = lambda c, of: F.concat(*[fact(n, c, v) for n, v in of.items()])
    start = F.add_months(F.trunc("period_end", "month"), -2)
    r, quarter, later = F.col("revenue"), F.col("pnl_context") == "quarter", F.col("fq") > 1
    of_quarter = {
        "RevenueFromOperations": r, "ProfitBeforeTax": F.col("profit_before_tax"), "ProfitLossForPeriod": F.col("net_income"), "FinanceCosts": r * 0.02, "DepreciationDepletionAndAmortisationExpense": F.when(F.col("raw_filing_id") % 5 > 0, r * 0.08),
        "BasicEarningsPerShareAfterExtraordinaryItems": r * 0.001, "CashFlowsFromUsedInOperatingActivities": r * 0.18, "PurchaseOfPropertyPlantAndEquipmentClassifiedAsInvestingActivities": r * -0.05,
    }
    of_year = {
        "Income": F.col("ytd_revenue"), "ProfitBeforeTax": F.col("ytd_profit_before_tax"), "FinanceCosts": F.col("ytd_finance_costs"), "CashFlowsFromUsedInOperatingActivities": F.col("ytd_operating_cash_flow"),
        "PurchaseOfPropertyPlantAndEquipmentClassifiedAsInvestingActivities": F.col("ytd_capital_expenditure"),
    }
    of_balance = {"Assets": r * 6, "Equity": r * 3, "BorrowingsCurrent": F.when(F.col("raw_filing_id") % 3 > 0, r), "BorrowingsNoncurrent": F.when(F.col("raw_filing_id") % 2 > 0, r * 2), "CashAndCashEquivalents": r * 0.5}
    parts = [
        F.lit("<xbrl>"), ctx("D", start, scenario), F.when(quarter, ctx("Q", start)).otherwise(""), F.when(later, ctx("Y", F.col("fiscal_start"))).otherwise(""),
        F.concat(F.lit('<context id="B"><period><instant>'), F.col("period_end").cast("string"), F.lit("</instant></period></context>")),
        fact("RevenueFromOperations", "D", r * 9), F.when(quarter, F.concat(F.lit('<ProfitBeforeTax contextRef="Q">n/a</ProfitBeforeTax>'), facts("Q", of_quarter))).otherwise(""),
        F.when(later, facts("Y", of_year)).otherwise(""), facts("B", of_balance), F.lit("</xbrl>"),
    ]
    broken = F.col("raw_filing_id") % 97 == 0
    return cumulative.select(F.col("raw_filing_id").alias("filing_id"), "company_id", "period_end", F.when(broken, "<xbrl><open>").otherwise(F.concat(*parts)).alias("content"))
