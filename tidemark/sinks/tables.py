"""The stored tables: what each is keyed by, what survives an update, and the records of runs, versions and batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sinks.store import Change, Conflict, Store

#: A pending filing is claimed in batches of so many.
BATCH = 250
TRIGGERS = ("analyze", "verify")


@dataclass(frozen=True)
class Sink:
    """keys: the identity of a row; by: the key column that partitions the table, or a number of buckets of the keys; keep:
    columns for which an update must not simply win, as expressions over the old row o.* and the new one n.*."""

    keys: tuple[str, ...]
    by: str | int = 16
    keep: dict[str, Callable[[], Column]] = field(default_factory=dict)


def _old_first(c: str) -> Callable[[], Column]:
    """The stored value of a row that is there already, null or not."""
    return lambda: F.when(F.col("o.company_id").isNotNull(), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))


STATEMENT = ("company_id", "period_type", "period_end", "statement_scope", "submission_type", "source")
DAY = ("company_id", "trade_date")
SCOPED = (*DAY, "statement_scope")
#: Daily tables are partitioned by month, so that a day's update rewrites one partition; others by buckets of their keys.
SINKS = {
    "daily_prices": Sink(DAY, "trade_date/month"),
    "benchmark_prices": Sink(("benchmark", "trade_date"), "trade_date/month"),
    "financial_statements": Sink(STATEMENT, 16, {"filing_date": lambda: F.coalesce("n.filing_date", "o.filing_date"), "source_reference": _old_first("source_reference")}),
    "share_capital": Sink(("company_id", "effective_date", "share_type")),
    "shareholding_snapshots": Sink(("company_id", "effective_date")),
    "shareholding_metrics": Sink(("company_id", "effective_date")),
    "market_metrics": Sink(DAY, "trade_date/month"),
    "ttm_financials": Sink(("company_id", "period_end", "statement_scope")),
    "financial_ratios": Sink(("company_id", "period_end", "statement_scope")),
    "valuations": Sink(("company_id", "valuation_date", "statement_scope"), "valuation_date/month"),
    "technical_indicators": Sink(DAY, "trade_date/month"),
    "historical_features": Sink(SCOPED, "trade_date/month"),
    "feature_scores": Sink(SCOPED, "trade_date/month"),
    "stock_rankings": Sink(SCOPED, "trade_date/month"),
    "future_returns": Sink(DAY, "trade_date/month"),
    "hold_decisions": Sink(DAY, "trade_date/month"),
    "refinements": Sink(DAY, "trade_date/month"),
    "outcomes": Sink(DAY, "trade_date/month"),
    "overrides": Sink((*DAY, "source"), "trade_date/month"),
    "ingestion_runs": Sink(("id",)),
    "raw_filings": Sink(("id",)),
    "verification_runs": Sink(("id",)),
}


def save(change: Change, table: str, rows: DataFrame) -> None:
    """Upsert rows by the table's keys and rules. Rows hold each key once and all columns of the table."""
    sink = SINKS[table]
    change.merge(table, rows, sink.keys, sink.by, {c: e() for c, e in sink.keep.items()})


def publish(store: Store, tables: dict[str, DataFrame], **info) -> int:
    """Upsert several tables as one version: all of them or, if anything fails, none."""

    def step(change: Change) -> int:
        for name, rows in tables.items():
            save(change, name, rows)
        return change.base.version + change.pending

    return store.update(step)


def save_share_capital(change: Change, snapshots: DataFrame, share_type: str = "EQUITY") -> None:
    """Shareholding snapshots, and the share capital that their totals are, in one version."""
    save(change, "shareholding_snapshots", snapshots)
    capital = snapshots.where("total_shares IS NOT NULL").select("company_id", "effective_date", "filing_date", F.lit(share_type).alias("share_type"), F.col("total_shares").cast("double").alias("shares_outstanding"))
    save(change, "share_capital", capital)


VERSION = ("raw_filing_id", "period_type", "period_end", "statement_scope")
SOURCE = ("source_filing_id", "component", "source_role", "derivation_method")


def save_versions(change: Change, rows: DataFrame, sources: DataFrame) -> None:
    """Statement versions, one for each filing and period, and where their figures were derived from.

    rows without a filing or without reported_values make no version. All stored sources of a version that is saved make
    way for its new ones, each once, which may be none: reprocessing a filing leaves nothing of what it derived before.
    Sources without a filing of their own are left out. Both tables change in one version of the store.
    """
    # written once: the versions, the sources to keep and those to go are all found by them
    known = change._staged(rows.where("raw_filing_id IS NOT NULL AND reported_values IS NOT NULL"))
    kept = sources.where("source_filing_id IS NOT NULL").join(known.select(*VERSION), list(VERSION), "left_semi").select(*VERSION, *SOURCE).distinct()
    change.merge("statement_versions", known, VERSION)
    change.replace("version_sources", kept, VERSION, gone=known.select(*VERSION))


def update_rankings(change: Change, scores: DataFrame) -> None:
    """New category and overall scores for rankings that are stored; rank and percentile stay, unknown rankings are ignored."""
    names = ("momentum_score", "profitability_score", "leverage_score", "valuation_score", "overall_score")
    change.amend("stock_rankings", scores, names)


# Runs


RUN = "id string, run_type string, trade_date date, source string, status string, started_at timestamp, finished_at timestamp, records_seen long, records_written long, error_message string"


def _run(store: Store, **values) -> DataFrame:
    names = [x.split()[0] for x in RUN.split(", ")]
    return store.spark.createDataFrame([tuple(values.get(n) for n in names)], RUN)


def logged_run(store: Store, run_type: str, trade_date, source: str, step: Callable[[Change], tuple[int, int]]) -> str:
    """Run step (which changes tables and returns records seen and written) under an entry of ingestion_runs; returns its id.

    The entry is RUNNING while step runs. SUCCESS is committed together with what step changed, so that a run that says so
    has its rows; where step or the commit fails, nothing of it is stored, the entry is FAILED, and the error is raised.
    """
    run = {"id": uuid.uuid4().hex, "run_type": run_type, "trade_date": trade_date, "source": source, "started_at": datetime.now(UTC).replace(tzinfo=None)}
    store.update(lambda c: save(c, "ingestion_runs", _run(store, **run, status="RUNNING")))

    def whole(change: Change) -> None:
        seen, written = step(change)
        save(change, "ingestion_runs", _run(store, **run, status="SUCCESS", records_seen=seen, records_written=written, finished_at=datetime.now(UTC).replace(tzinfo=None)))

    try:
        store.update(whole)
    except Exception as e:
        store.update(lambda c: save(c, "ingestion_runs", _run(store, **run, status="FAILED", error_message=repr(e), finished_at=datetime.now(UTC).replace(tzinfo=None))))
        raise
    return run["id"]


# Filings


def claim_batch(store: Store, worker: str, size: int = BATCH, attempts: int = 20) -> DataFrame:
    """Mark the next pending filings, in order of period end and id, as PROCESSING by worker, and return them.

    The mark is a commit on the version that was looked at; if another worker was first, it is looked at again. So no
    filing is in two batches. An empty result: nothing is pending.
    """

    def step(change: Change) -> DataFrame:
        stored = change.read("raw_filings")
        batch = stored.where("processing_status = 'PENDING'").orderBy("period_end", "id").limit(size)
        claimed = batch.withColumns({"processing_status": F.lit("PROCESSING"), "claimed_by": F.lit(worker)}).select(*stored.columns)
        rows = change._staged(claimed)
        save(change, "raw_filings", rows)
        return rows

    return store.update(step, attempts)


def finish_batch(store: Store, worker: str, results: DataFrame) -> None:
    """Results (id, ok, error) of worker's filings: PROCESSED, or FAILED with the error. Filings of other workers stay."""

    def step(change: Change) -> None:
        stored = change.read("raw_filings").alias("s")
        mine = (F.col("s.processing_status") == "PROCESSING") & (F.col("s.claimed_by") == worker)
        done = stored.join(results.alias("r"), "id").where(mine)
        new = {"processing_status": F.when(F.col("r.ok"), "PROCESSED").otherwise("FAILED"), "processing_error": F.when(~F.col("r.ok"), F.col("r.error"))}
        save(change, "raw_filings", done.select(*[new[c].alias(c) if c in new else F.col("id") if c == "id" else F.col(f"s.{c}") for c in stored.columns]))

    store.update(step)


def release(store: Store, worker: str | None = None) -> None:
    """Filings left in PROCESSING (by a worker that is gone, or by any) are pending again."""

    def step(change: Change) -> None:
        stored = change.read("raw_filings").where("processing_status = 'PROCESSING'")
        rows = stored if worker is None else stored.where(F.col("claimed_by") == worker)
        save(change, "raw_filings", rows.withColumns({"processing_status": F.lit("PENDING"), "claimed_by": F.lit(None).cast("string")}))

    store.update(step)


# Verification runs


def save_verification(change: Change, checks: DataFrame, run_id: str, trigger: str, at: str | Column) -> None:
    """A verification run of each date of checks (trade_date, check_name, status, expected, actual, missing), with its results.

    The runs' ids are run_id and the date; a run and its results are in one version. Saved again, they replace themselves.
    """
    if trigger not in TRIGGERS:
        raise ValueError(f"a run is triggered by {' or '.join(TRIGGERS)}, not {trigger}")
    when = F.lit(at).cast("timestamp") if isinstance(at, str) else at
    # written once: runs and results both come of the checks
    named = change._staged(checks.withColumn("run_id", F.concat_ws("/", F.lit(run_id), F.col("trade_date").cast("string"))))
    count = lambda s: F.count_if(F.col("status") == s).alias(s.lower())
    runs = named.groupBy(F.col("run_id").alias("id"), "trade_date").agg(F.count("*").alias("checks"), *map(count, ("PASS", "FAIL", "WARN", "INFO"))).withColumns(
        {"trigger": F.lit(trigger), "started_at": when, "status": F.when(F.col("fail") > 0, "FAIL").otherwise("PASS")}
    )
    save(change, "verification_runs", runs)
    change.replace("verification_results", named.select("run_id", "trade_date", "check_name", "status", "expected", "actual", "missing"), ["run_id"])


def verification_history(store: Store, day: str | None = None, limit: int = 20, version: int | None = None) -> DataFrame:
    """The latest runs, of one date if given, newest first."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    runs = store.read("verification_runs", version)
    rows = runs if day is None else runs.where(F.col("trade_date") == F.lit(day).cast("date"))
    return rows.orderBy(F.col("started_at").desc(), F.col("id").desc()).limit(limit)


def verification_details(store: Store, run_ids: Sequence[str] | str, version: int | None = None) -> DataFrame:
    """The results of runs, in order of name."""
    ids = [run_ids] if isinstance(run_ids, str) else list(run_ids)
    return store.read("verification_results", version).where(F.col("run_id").isin(ids)).orderBy("run_id", "check_name")


__all__ = ["SINKS", "Conflict", "Sink", "claim_batch", "finish_batch", "logged_run", "publish", "release", "save", "save_share_capital", "save_verification", "save_versions", "update_rankings", "verification_details", "verification_history"]
