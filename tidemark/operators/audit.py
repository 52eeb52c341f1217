"""Audits of filings: what cash-flow facts they hold, whether the catalogue agrees, and which version counted when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Concept names and name parts that tell a cash-flow fact.
OPERATING = ("CashFlowsFromUsedInOperatingActivities",)
CAPITAL = ("PurchaseOfPropertyPlantAndEquipmentClassifiedAsInvestingActivities",)
METADATA = ("WhetherCashFlowStatementIsApplicableOnCompany", "TypeOfCashFlowStatement")
TERMS = (
    "cashflowsfrom", "cashflowfrom", "netcashprovidedby", "netcashusedin", "netcashfrom", "cashgeneratedfrom", "cashusedin", "cashprovidedby",
    "purchaseofpropertyplantandequipment", "paymentforpropertyplantandequipment", "paymentstoacquirepropertyplantandequipment",
    "capitalexpenditure", "proceedsfromsaleofpropertyplantandequipment", "acquisitionofpropertyplantandequipment",
)


def concept_class(concept: Column) -> Column:
    """METADATA, OCF, CAPEX or OTHER_CASH_FLOW; null for a concept that says nothing of cash flows."""
    return F.when(concept.isin(*METADATA), "METADATA").when(concept.isin(*OPERATING), "OCF").when(concept.isin(*CAPITAL), "CAPEX").when(F.lower(concept).rlike("|".join(TERMS)), "OTHER_CASH_FLOW")


def cash_flow_audit(facts: DataFrame, months: int = 3) -> DataFrame:
    """Per filing: a status, and counts of its cash-flow facts in the quarter that ends at the period end and elsewhere."""
    kind = concept_class(F.col("concept"))
    start = F.add_months(F.date_add("period_end", 1), -months)
    target = F.coalesce((F.col("start_date") == start) & (F.col("end_date") == F.col("period_end")), F.lit(False))
    rows = facts.withColumn("_kind", kind).withColumn("_target", target).withColumn("_amount", F.coalesce(F.col("_kind") != "METADATA", F.lit(False)))
    counts = rows.groupBy("filing_id", "company_id", "period_end").agg(
        *[F.count_if(F.col("_target") & (F.col("_kind") == k)).alias(n) for n, k in (("ocf_target", "OCF"), ("capex_target", "CAPEX"), ("other_target", "OTHER_CASH_FLOW"), ("metadata_target", "METADATA"))],
        F.count_if("_amount").alias("amounts"), F.count_if(F.col("_amount") & F.col("_target")).alias("amounts_target"), F.count_if(F.col("_kind") == "METADATA").alias("metadata"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("_amount") & F.col("_target"), F.col("concept")))), ",").alias("concepts_target"),
        F.max(F.col("error")).alias("error"),
    )
    status = (
        F.when(F.col("error").isNotNull(), "AUDIT_ERROR").when(F.col("amounts_target") > 0, "QUARTER_CASH_FLOW_FACTS_FOUND").when(F.col("amounts") > 0, "OTHER_PERIOD_CASH_FLOW_FACTS_ONLY").when(F.col("metadata") > 0, "METADATA_ONLY").otherwise("NO_RECOGNIZED_CASH_FLOW_FACTS")
    )
    return counts.withColumn("status", status).drop("error")


def audit_summary(audited: DataFrame) -> DataFrame:
    return audited.groupBy("status").agg(F.count("*").alias("filings"), F.count_distinct("company_id").alias("companies"))


def version_intervals(filings: DataFrame) -> DataFrame:
    """For each period of a company, which filing counts from when to when: a row each time that this changes.

    filings: company_id, period_end, effective_at, filing_id, content_hash. Columns: company_id, period_end, effective_at,
    until (the time from which another counts, null for the last), slot and next_slot (the same as places in the company's
    distinct times, from 1; next_slot of the last is one after them all), smallest and ids (of the filings of that time),
    and ambiguous, where these differ in content. Filings without a time never count. One sweep over each period's and
    one over each company's times, so the work grows with the filings; what a target changes is the rows of its slot.
    """
    known = filings.where("effective_at IS NOT NULL AND company_id IS NOT NULL")
    per = known.groupBy("company_id", "period_end", "effective_at").agg(F.min("filing_id").alias("smallest"), F.collect_set("filing_id").alias("ids"), F.count_distinct("content_hash").alias("_contents"))
    line = Window.partitionBy("company_id").orderBy("effective_at")
    placed = per.withColumn("slot", F.dense_rank().over(line)).withColumn("_last", F.max("slot").over(Window.partitionBy("company_id")))
    period = Window.partitionBy("company_id", "period_end").orderBy("effective_at")
    return placed.select(
        "company_id", "period_end", "effective_at", F.lead("effective_at").over(period).alias("until"), "slot",
        F.coalesce(F.lead("slot").over(period), F.col("_last") + 1).alias("next_slot"), "smallest", "ids", (F.col("_contents") != 1).alias("ambiguous"),
    )


def point_in_time_versions(filings: DataFrame) -> DataFrame:
    """For each filing as target and each period of its company: the version of the period known when the target came.

    Of the filings not after the target's time the latest counts; if several share that time and differ in content the
    period is ambiguous and left out; if they agree the target itself is taken, or else the smallest id. Each interval is
    laid out over the times that it spans and meets the targets of those times, so no pair is formed that isn't a row of
    the result. Where only changes matter, version_intervals has them without that.
    """
    intervals = version_intervals(filings)
    times = intervals.select("company_id", F.col("effective_at").alias("as_of"), F.col("slot").alias("at")).distinct()
    targets = filings.where("effective_at IS NOT NULL").select("company_id", F.col("filing_id").alias("target_id"), F.col("effective_at").alias("as_of"), F.col("period_end").alias("target_period")).distinct()
    placed = targets.join(times, ["company_id", "as_of"])
    spread = intervals.where("NOT ambiguous").withColumn("at", F.explode(F.sequence("slot", F.col("next_slot") - 1)))
    chosen = F.when(F.array_contains("ids", F.col("target_id")), F.col("target_id")).otherwise(F.col("smallest"))
    return spread.join(placed, ["company_id", "at"]).select("company_id", "target_id", "target_period", "period_end", chosen.alias("version_id"), "effective_at")


def new_catalogue_rows(catalogue: DataFrame, incoming: DataFrame, companies: DataFrame, renamed: dict[str, str] | None = None) -> DataFrame:
    """Incoming filings of known companies that the catalogue lacks by company, reference and digest; renamed maps old symbols."""
    symbol = F.col("symbol")
    for old, new in (renamed or {}).items():
        symbol = F.when(F.upper("symbol") == old.upper(), new).otherwise(symbol)
    known = incoming.withColumn("symbol", symbol).join(companies.select("symbol", F.col("id").alias("company_id")), "symbol")
    return known.join(catalogue.select("company_id", "source_reference", "sha256"), ["company_id", "source_reference", "sha256"], "left_anti")


def claim(catalogue: DataFrame, size: int = 250) -> DataFrame:
    """The next pending filings in order of period and id, as a batch to process."""
    return catalogue.where("processing_status = 'PENDING'").orderBy("period_end", "id").limit(size)


def advance(catalogue: DataFrame, results: DataFrame) -> DataFrame:
    """Statuses after a batch: results (id, ok, error) become PROCESSED or FAILED, filings left in PROCESSING are pending again."""
    done = catalogue.alias("c").join(results.alias("r"), "id", "left")
    status = F.when(F.col("r.ok"), "PROCESSED").when(~F.col("r.ok"), "FAILED").when(F.col("c.processing_status") == "PROCESSING", "PENDING").otherwise(F.col("c.processing_status"))
    keep = [F.col(f"c.{c}") for c in catalogue.columns if c not in ("id", "processing_status", "processing_error")]
    return done.select("id", *keep, status.alias("processing_status"), F.when(~F.col("r.ok"), F.col("r.error")).alias("processing_error"))


def fill_missing(rows: DataFrame, found: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """rows with null columns filled from found; values that are there stay."""
    return rows.alias("o").join(found.alias("n"), key, "left").select(*[F.col(key) if c == key else F.coalesce(f"o.{c}", f"n.{c}").alias(c) if c in columns else F.col(f"o.{c}") for c in rows.columns])
