"""Rows out of what listing services gave, landed as files: filing lists, index histories, benchmark histories."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _filled(*names: str) -> Column:
    """The first of the row's cells that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.col("row")[n], F.lit("")) for n in names])


def filing_list(bodies: DataFrame) -> DataFrame:
    """One row per filing of bodies (symbol, body): a body is {"data": [{cell: text}]}.

    Filings without a quarter's end are skipped, a missing symbol is the one that was asked for. raw keeps all cells. Null
    or unreadable bodies and empty lists give no rows.
    """
    rows = bodies.select(F.upper("symbol").alias("asked"), F.explode(F.from_json("body", "data array<map<string,string>>")["data"]).alias("row"))
    cell = lambda name: F.col("row")[name]
    return rows.where(_filled("qe_Date").isNotNull()).select(
        F.coalesce(_filled("symbol"), "asked").alias("symbol"), F.coalesce(_filled("cmName", "smName"), F.lit("")).alias("company_name"), F.to_date(cell("qe_Date"), "dd-MMM-yyyy").alias("period_end"),
        F.coalesce(_filled("type_Sub"), F.lit("Unknown")).alias("submission_type"), cell("audited").alias("audit_status"), F.coalesce(_filled("consolidated"), F.lit("Unknown")).alias("statement_scope"),
        cell("pdf_attach").alias("details_url"), cell("xbrl").alias("xbrl_url"), cell("ixbrl").alias("ixbrl_url"), cell("broadcast_Date").alias("broadcast_datetime"), cell("revised_Date").alias("revised_datetime"),
        cell("revision_Remark").alias("revision_remarks"), cell("seq_Id").alias("source_reference"), F.col("row").alias("raw"),
    )


def index_history(bodies: DataFrame) -> DataFrame:
    """row: the cells of each day of bodies (body), where {"d": ...} holds a list of objects or that list as text once more.

    Null or unreadable bodies and empty lists give no rows.
    """
    return bodies.select(F.from_json(F.from_json("body", "d string")["d"], "array<map<string,string>>").alias("days")).select(F.explode("days").alias("row"))


def benchmark_history(landed: DataFrame, benchmark: str = "NIFTY50", reference: str = "^NSEI", source: str = "YAHOO_FINANCE") -> DataFrame:
    """Rows of benchmark_prices from a landed download, as text or typed: a date and open, high, low and close.

    A column goes by the first word of its name in any case, so that two-level names such as ('Close', '^NSEI') count as
    well; adjusted closes and others are left alone. NaN, empty and unreadable cells are null; rows without a readable date
    leave. Of several rows of a date the one with the largest close, then open, high and low counts. A missing column
    raises.
    """
    words = {c: re.search(r"[A-Za-z]+", c) for c in landed.columns}
    of = {m.group().lower(): c for c, m in reversed(words.items()) if m}
    if absent := {"date", "open", "high", "low", "close"} - of.keys():
        raise ValueError(f"the landed file lacks {', '.join(sorted(absent))}")
    cell = lambda name: F.col(f"`{of[name]}`")
    number = lambda name: F.nanvl(F.trim(cell(name).cast("string")).try_cast("double"), F.lit(None))
    day = F.substring(F.trim(cell("date").cast("string")), 1, 10).try_cast("date")
    rows = landed.select(day.alias("trade_date"), *[number(c).alias(f"{c}_price") for c in ("open", "high", "low", "close")]).where("trade_date IS NOT NULL")
    names = ("close_price", "open_price", "high_price", "low_price")
    one = rows.groupBy("trade_date").agg(F.max(F.struct(*names)).alias("_p"))
    return one.select(F.lit(benchmark).alias("benchmark"), "trade_date", *[F.col(f"_p.{c}").alias(c) for c in ("open_price", "high_price", "low_price", "close_price")], F.lit(source).alias("source"), F.lit(reference).alias("source_reference"))
