"""End-of-day price archives: names, zip members, column aliases, cleaning, and storing a day."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.core import upsert

#: The names that archives of different years give to a column.
ALIASES = {
    "symbol": ("TckrSymb", "SYMBOL", "Symbol"),
    "series": ("SctySrs", "SERIES", "Series"),
    "open": ("OpnPric", "OPEN", "Open Price"),
    "high": ("HghPric", "HIGH", "High Price"),
    "low": ("LwPric", "LOW", "Low Price"),
    "close": ("ClsPric", "CLOSE", "Close Price"),
    "prev_close": ("PrvsClsgPric", "PREV_CLOSE", "Prev Close"),
    "volume": ("TtlTradgVol", "TOTTRDQTY", "Total Traded Quantity"),
    "value": ("TtlTrfVal", "TOTTRDVAL", "Turnover"),
    "trades": ("TtlNbOfTxsExctd", "TOTALTRADES", "No. of Trades"),
    "delivery_qty": ("DlvryQty", "DELIV_QTY", "Deliverable Qty"),
    "delivery_pct": ("DlvryPct", "DELIV_PER", "% Dly Qt to Traded Qty"),
    "vwap": ("VWAP", "WghtdAvrgPric", "Average Price"),
    "date": ("TradDt", "TIMESTAMP", "Date"),
}
TEXT = ("symbol", "series", "date")
#: The series that are traded as equity, and the day on which the archive's format changed.
EQUITY_SERIES = ("EQ", "BE", "BZ", "SM", "ST")
FORMAT_CHANGE = "2024-07-08"


def archive_name(day: Column) -> Column:
    """The archive's file name for a day: the old layout before the change, else the new one."""
    old = F.concat(F.lit("cm"), F.upper(F.date_format(day, "ddMMMyyyy")), F.lit("bhav.csv.zip"))
    return F.when(day < F.lit(FORMAT_CHANGE).cast("date"), old).otherwise(F.concat(F.lit("BhavCopy_CM_0_0_0_"), F.date_format(day, "yyyyMMdd"), F.lit("_F_0000.csv.zip")))


def find_column(columns: list[str], names: tuple[str, ...]) -> str | None:
    """The first of names among columns, without regard to case and outer blanks."""
    by_name = {c.strip().lower(): c for c in reversed(columns)}
    return next((by_name[n.lower()] for n in names if n.lower() in by_name), None)


def number(c: Column) -> Column:
    """A number written with thousands commas; a dash, an empty text and anything else give null."""
    flat = F.trim(F.regexp_replace(c.cast("string"), ",", ""))
    return F.when(~flat.isin("", "-"), flat.try_cast("double"))


def normalize(raw: DataFrame) -> DataFrame:
    """Any archive's rows with the target columns; a column that the archive lacks is null, outer blanks go."""
    out = []
    for target, names in ALIASES.items():
        found = find_column(raw.columns, names)
        if found is None:
            out.append(F.lit(None).cast("string" if target in TEXT else "double").alias(target))
        else:
            value = F.col(f"`{found}`")
            out.append((F.trim(value.cast("string")) if target in TEXT else number(value)).alias(target))
    return raw.select(*out)


def normalize_universe(raw: DataFrame) -> DataFrame:
    """Companies of a universe file: trimmed, listing date or null, the first row of a symbol, no empty symbols."""
    pick = lambda *names: F.trim(F.col(f"`{c}`").cast("string")) if (c := find_column(raw.columns, names)) else F.lit(None).cast("string")
    listed = pick("DATE OF LISTING", "listing_date")
    day = F.coalesce(*[F.try_to_timestamp(listed, F.lit(form)).cast("date") for form in ("dd-MMM-yyyy", "yyyy-MM-dd")])
    rows = raw.select(pick("SYMBOL").alias("symbol"), pick("NAME OF COMPANY", "company_name").alias("company_name"), pick("SERIES").alias("series"), pick("ISIN NUMBER", "isin").alias("isin"), day.alias("listing_date"), F.monotonically_increasing_id().alias("_at"))
    first = rows.where("symbol IS NOT NULL AND symbol <> ''").groupBy("symbol").agg(F.min_by(F.struct("company_name", "series", "isin", "listing_date"), "_at").alias("r"))
    return first.select("symbol", "r.*")


def merge_universe(companies: DataFrame, incoming: DataFrame) -> DataFrame:
    """Companies by symbol: a known isin, series or listing date is only replaced by another, the name always; none is removed."""
    old = companies.alias("o")
    both = old.join(incoming.alias("n"), F.col("o.symbol") == F.col("n.symbol"), "full_outer")
    keep = [F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in ("symbol", "isin", "series", "listing_date", "company_name")]
    return both.select("o.id", *keep, F.when(F.col("n.symbol").isNotNull(), True).otherwise(F.col("o.is_active")).alias("is_active"))


def store_day(stored: DataFrame, incoming: DataFrame, companies: DataFrame, day: str, series: tuple[str, ...] = EQUITY_SERIES) -> DataFrame:
    """Prices with one day's replaced: only the given series, symbols that no company has are dropped."""
    known = incoming.where(F.col("series").isin(*series)).join(companies.select("symbol", F.col("id").alias("company_id")), "symbol")
    names = [c for c in incoming.columns if c in stored.columns and c not in ("company_id", "trade_date")]
    new = known.select("company_id", F.lit(day).cast("date").alias("trade_date"), *names)
    return upsert(stored, new, ["company_id", "trade_date"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """file, ok and the rows as text columns of every zip under path: its first .csv member.

    A broken, empty or csv-less archive gives one row with ok = false. Archives are a day's file, read whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        member = next(n for n in z.namelist() if n.lower().endswith(".csv"))
                        table = pd.read_csv(z.open(member), dtype=str, keep_default_na=False)
                except (zipfile.BadZipFile, StopIteration, pd.errors.EmptyDataError):
                    yield pd.DataFrame({"file": [name], "ok": [False], "cells": [None]})
                    continue
                yield pd.DataFrame({"file": name, "ok": True, "cells": [dict(r) for r in table.to_dict("records")]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, ok boolean, cells map<string,string>")


def archive_rows(archives: DataFrame) -> DataFrame:
    """The cells of valid archives under the target names."""
    value = lambda names: F.coalesce(*[F.col("cells")[n] for n in names])
    return archives.where("ok").select("file", *[(F.trim(value(names)) if t in TEXT else number(value(names))).alias(t) for t, names in ALIASES.items()])
