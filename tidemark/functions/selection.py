"""Exact order statistics of large groups, without a task that holds a group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.shared import stage

#: A range of values is cut into so many bins; a range of at most LAST values is sorted in one task.
BINS, LAST = 4096, 100_000


def _share(v: Column, low: Column, high: Column) -> Column:
    """Where v lies between low and high, from 0 to 1 and never falling as v grows.

    By size if all of the range is of one order of magnitude, else by the logarithm of the size on both sides of zero, so
    that few rounds are enough for values of any orders.
    """
    log = lambda x: F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.log(F.abs(x)) + 745))
    alike = (F.signum(low) == F.signum(high)) & (F.greatest(F.abs(low), F.abs(high)) / 16 <= F.least(F.abs(low), F.abs(high)))
    return F.when(alike, (v - low) / (high - low)).otherwise((log(v) - log(low)) / (log(high) - log(low)))


def exact_quantile(rows: DataFrame, keys: list[str], value: str, q: float = 0.5, bins: int = BINS, last: int = LAST) -> DataFrame:
    """keys and quantile, for each group of keys with a value: the q-quantile, interpolated between its two neighbours.

    Nulls and NaN are left out. The two ranks on both sides of q are looked for in a range of values that starts as the
    group's own. Counts by bins of that range, added up in each task first, say in which bin the rank lies; that bin's
    least and largest value are the next range, until it holds so few values that they can be sorted, or only one. So the
    groups may be of any size: what meets in a task is a row for each bin. Each round is a pass over rows, which should be
    a written table; a round cuts a range to about one in `bins`, two or three do for most data.
    """
    on = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])
    v = F.col(value).cast("double")
    known = rows.where(v.isNotNull() & ~F.isnan(v)).select(*keys, v.alias("_v"))
    sizes = known.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    place = F.lit(q) * (F.col("n") - 1)
    # rank: the rank wanted among the range's n values, from 0
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.floor(place).alias("rank")), F.struct(F.lit(1).alias("side"), F.ceil(place).alias("rank")))).alias("s")
    targets = stage(sizes.select(*keys, "n", "low", "high", (place - F.floor(place)).alias("share"), sides).select(*keys, "n", "low", "high", "share", "s.*"), "ranks")
    wide = (F.col("n") > last) & (F.col("low") < F.col("high"))
    while not targets.where(wide).isEmpty():
        t = targets.where(wide)
        inside = known.alias("r").join(t.alias("t"), on("r", "t") & (F.col("_v") >= F.col("t.low")) & (F.col("_v") <= F.col("t.high")))
        at = _share(F.col("_v"), F.col("low"), F.col("high"))
        cut = F.least(F.floor(at * bins), F.lit(bins - 1)).alias("bin")
        names = ["side", "rank", "share"]
        counted = inside.select(*[F.col(f"t.{k}").alias(k) for k in keys], *names, cut, "_v").groupBy(*keys, *names, "bin").agg(F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
        before = F.sum("n").over(Window.partitionBy(*keys, "side").orderBy("bin")) - F.col("n")
        hit = counted.withColumn("_before", before).where((F.col("_before") <= F.col("rank")) & (F.col("rank") < F.col("_before") + F.col("n")))
        targets = stage(targets.where(~wide).unionByName(hit.select(*keys, "n", "low", "high", "share", "side", (F.col("rank") - F.col("_before")).alias("rank"))), "ranks")
    few = known.alias("r").join(targets.where("low < high").alias("t"), on("r", "t") & (F.col("_v") >= F.col("t.low")) & (F.col("_v") <= F.col("t.high")))
    sorted_ = few.groupBy(*[F.col(f"t.{k}").alias(k) for k in keys], "side", "share", "rank").agg(F.sort_array(F.collect_list("_v")).alias("all"))
    found = sorted_.select(*keys, "side", "share", F.get("all", F.col("rank").cast("int")).alias("_v"))
    found = found.unionByName(targets.where("low = high").select(*keys, "side", "share", F.col("low").alias("_v")))
    pick = lambda side: F.max(F.when(F.col("side") == side, F.col("_v")))
    return found.groupBy(*keys).agg(((1 - F.max("share")) * pick(0) + F.max("share") * pick(1)).alias("quantile"))
