"""Column and frame helpers: null-safe arithmetic, as-of joins, keyed upserts, weighted means, labels."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b; null where either is missing or b is zero."""
    return col(a) / F.nullif(col(b), F.lit(0))


def growth(now: str | Column, before: str | Column) -> Column:
    """(now - before) / |before|; null where either is missing or before is zero."""
    return (col(now) - col(before)) / F.nullif(F.abs(col(before)), F.lit(0))


def half_up(c: str | Column, digits: int) -> Column:
    """Rounded by floor(x * 10^d + 0.5) / 10^d, which gives the same double in every engine."""
    scale = F.lit(10.0**digits)
    return F.floor(col(c) * scale + F.lit(0.5)).cast("double") / scale


def valid(c: str | Column) -> Column:
    """Neither null nor NaN."""
    return col(c).isNotNull() & ~F.isnan(col(c).cast("double"))


def clamp(c: str | Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.when(col(c).isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), col(c))))


def strict_sum(c: str | Column, over, n: int) -> Column:
    """Sum over a frame, null unless all n values are there."""
    return F.when(F.count(col(c)).over(over) == n, F.sum(col(c)).over(over))


def weighted_mean(weights: dict[str, float], least: int) -> Column:
    """Mean over the columns that are present, weights renormalised; null if fewer than `least` are present."""
    total = lambda xs: reduce(lambda a, b: a + b, xs)
    present = total([F.col(c).isNotNull().cast("int") for c in weights])
    above = total([F.coalesce(F.col(c) * w, F.lit(0.0)) for c, w in weights.items()])
    below = total([F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for c, w in weights.items()])
    return F.when(present >= least, above / F.nullif(below, F.lit(0.0)))


def month_gap(later: Column, earlier: Column) -> Column:
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def red_green(score: str | Column) -> Column:
    """needs_data without a score, red under 50, else green."""
    s = col(score)
    return F.when(s.isNull(), F.lit("needs_data")).when(s < 50, F.lit("red")).otherwise(F.lit("green"))


@dataclass(frozen=True)
class Known:
    """One side of asof_joins: of the rows with time <= the left's (< if strict) that which is largest by order gives its
    payload, each column named prefix and its own name."""

    rows: DataFrame
    time: str
    order: list[str]
    payload: list[str]
    prefix: str = ""
    strict: bool = False


def asof_joins(left: DataFrame, by: list[str], left_time: str, sides: list[Known]) -> DataFrame:
    """left with the payload of one row of each side, nulls where there is none.

    One shuffle by the keys for any number of sides: all rows are tagged and united, and running maxima of
    struct(order, payload) walk the time line, so no pair of rows is ever formed. With order = [time] a side is the plain
    as-of join; any other order gives the best row known by then, which a later but worse row must not displace. Rows of a
    side without a time are never known.
    """
    keep = left.columns
    # at one time: what is known, then the left rows, then what is known only from the next time on
    both = left.withColumns({"_turn": F.lit(1), "_left": F.lit(True)})
    for i, s in enumerate(sides):
        pick = F.struct(*[F.col(c) for c in s.order], *[F.col(c).alias(f"_{c}") for c in s.payload])
        rows = s.rows.where(F.col(s.time).isNotNull()).select(*by, F.col(s.time).alias(left_time), F.lit(2 if s.strict else 0).alias("_turn"), pick.alias(f"_pick{i}"))
        both = both.unionByName(rows, allowMissingColumns=True)
    # sorted by the left's own time, so that windows over the rows found need no sort of their own
    line = Window.partitionBy(*by).orderBy(F.col(left_time).asc_nulls_first(), "_turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.withColumns({f"_best{i}": F.max(f"_pick{i}").over(line) for i in range(len(sides))}).where("_left")
    return out.select(*keep, *[F.col(f"_best{i}._{c}").alias(f"{s.prefix}{c}") for i, s in enumerate(sides) for c in s.payload])


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, order: list[str], payload: list[str], prefix: str = "", strict: bool = False) -> DataFrame:
    """left with the payload of one row of right, as in asof_joins."""
    return asof_joins(left, by, left_time, [Known(right, right_time, order, payload, prefix, strict)])


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], keep: dict[str, Column] | None = None) -> DataFrame:
    """Last writer wins by key: existing rows without a successor, and all incoming rows.

    keep maps columns to expressions over old (o.*) and new (n.*) rows, for values that must survive, as in
    F.coalesce("n.filing_date", "o.filing_date"). Keys compare null-safe. incoming must hold each key once.
    """
    on = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    untouched = existing.alias("o").join(incoming.select(*keys).alias("n"), on, "left_anti")
    if keep:
        merged = incoming.alias("n").join(existing.alias("o"), on, "left")
        incoming = merged.select(*[(keep[c] if c in keep else F.col(f"n.{c}")).alias(c) for c in incoming.columns])
    return untouched.select(*existing.columns).unionByName(incoming, allowMissingColumns=True)


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by order."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")
