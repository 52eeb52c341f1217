"""Mixing sources to target weights, on DataFrame functions only.

Each source's documents fall into blocks by a hash of doc_id. The blocks of a source are put in a hashed order and
drawn in that order, pass after pass, until the source's target is met; only in the part of the block where the target
falls does the order of single documents matter, and only one document per source is cut. A splitting tree deals the
draws to the output shards: a node halves its quota vector by a multivariate-hypergeometric draw - a uniformly random half
of all its tickets, one for each draw, goes left - so that each shard gets an exact number of draws from each source.
Draws are numbered, hence the shards get disjoint runs of the permuted blocks, and each is shuffled locally by a hash.
All random numbers are hashes, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Weights by a source's place in code point order, repeating, and the share of all sizes to mix.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
#: A source is repeated at most so often.
REPEATS = 2
#: A source has so many blocks, and a block so many parts: one task sorts the documents of a single part at most.
BLOCKS, PARTS = 256, 256
#: The tree has this many levels, so the mix has 2 ** LEVELS shards.
LEVELS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _rank_hash(*parts: Column, digits: int = 1) -> Column:
    """A hash that SQL engines share: 8 hex digits of md5 over the parts, from the given one on."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)).cast("binary")), digits, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Per source: source, source_size, target, from rows (source, source_size), one per source.

    Targets split share x the sum of all sizes by weight; where one passes repeats x its source's size it stops there and
    the excess goes to the others by weight. In order of size per weight the sources that stop are a prefix, and the
    common level is the largest one that any prefix gives, so no iteration is needed. The windows run over one row per
    source, which is the number of sources and not of documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    everything = Window.partitionBy()
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * repeats)
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    return rows.withColumn("level", level).select(
        "source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.max("level").over(everything)).alias("target")
    )


def split_quotas(quotas: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Deal (source, quota) to 2 ** levels shards: source, shard, first, last, the numbers [first, last) of the draws.

    Each level halves every node. A node has a ticket for each of its draws; the half of the tickets with the smallest
    hashes goes left, which is a multivariate-hypergeometric draw of the sources' quotas. Where a node's tickets part is
    found in a histogram of their hashes - at most 4096 buckets for a level's few nodes, 16 for each of many - and only tickets of that one bucket
    are ranked, so no task sees all sources. Levels are written tables, one row per node and source.
    """
    nodes = quotas.select(F.lit(1).cast("long").alias("node"), "source", F.col("quota").cast("long").alias("quota"))
    for depth in range(levels):
        nodes = stage(nodes.where("quota > 0"), "quotas")
        ticket = F.explode(F.sequence(F.lit(1).cast("long"), F.col("quota"))).alias("i")
        tickets = nodes.select("node", "source", ticket).withColumn("h", _rank_hash(F.col("node"), F.col("source"), F.col("i")))
        tickets = tickets.withColumn("bucket", F.shiftright("h", 32 - max(4, 12 - depth)))
        line = Window.partitionBy("node").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        left = F.floor((F.sum("n").over(Window.partitionBy("node")) + F.col("node") % 2) / 2)
        need = F.greatest(F.lit(0), F.least(F.col("n"), left - F.coalesce(F.sum("n").over(line), F.lit(0))))
        cuts = tickets.groupBy("node", "bucket").agg(F.count("*").alias("n")).select("node", "bucket", "n", need.alias("need"))
        placed = tickets.join(F.broadcast(cuts), ["node", "bucket"])
        rank = F.row_number().over(Window.partitionBy("node", "bucket").orderBy("h", F.col("source").asc_nulls_last(), "i"))
        whole = placed.where("need = 0 OR need = n").withColumn("goes_left", F.col("need") > 0)
        parted = placed.where("need > 0 AND need < n").withColumn("goes_left", rank <= F.col("need"))
        sides = whole.unionByName(parted).groupBy("node", "source").agg(F.count_if("goes_left").alias("l"), F.count_if(~F.col("goes_left")).alias("r"))
        below = F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("l").alias("quota")), F.struct((F.col("node") * 2 + 1).alias("node"), F.col("r").alias("quota"))))
        nodes = sides.select("source", below.alias("x")).select("x.node", "source", "x.quota")
    leaves = nodes.where("quota > 0").select((F.col("node") - (1 << levels)).alias("shard"), "source", "quota")
    upto = F.sum("quota").over(Window.partitionBy("source").orderBy("shard"))
    return leaves.select("source", "shard", (upto - F.col("quota")).alias("first"), upto.alias("last"))


def mix(
    docs: DataFrame, blocks: int = BLOCKS, parts: int = PARTS, levels: int = LEVELS, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, draws.

    draws holds a struct (pass, shard, place, words) for each time the mix takes the document. words is all of it, but
    for the one document of a source in which the target falls; place orders a shard by a hash. Null text has size 0,
    null source is a source of its own, the last; repeated ids are documents of their own, and a null id is hashed by
    its text instead. An empty table gives no rows.

    Texts are read once, for their sizes; the light columns and the sums by (source, block, part), at most blocks x parts
    rows per source, are written tables. Shuffles: those sums, combined before the shuffle; then the light columns meet
    the block table by (source, block), the block being the salt of a hot source. The order of single documents is only
    needed in the part where a source's target falls, one in blocks x parts.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit(""))
    light = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), name.alias("name"))
    light = light.withColumn("block", F.pmod(_rank_hash(F.col("name")), F.lit(blocks)).cast("int")).withColumn("part", F.pmod(_rank_hash(F.col("name"), digits=9), F.lit(parts)).cast("int"))
    light = stage(light, "light")
    per_part = stage(light.groupBy("source", "block", "part").agg(F.sum("size").alias("words")), "parts")
    per_block = per_part.groupBy("source", "block").agg(F.sum("words").alias("words"))
    whole = targets(per_block.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, repeats)
    inside = Window.partitionBy("source").orderBy(_rank_hash(F.col("source"), F.col("block")), "block")
    goals = whole.select(F.col("source").alias("name"), "source_size", "target")
    # In pass p a block lies at p * source_size + before of its source's stream of words, and is draw p * n_blocks + rank.
    ranked = (
        per_block.join(goals, F.col("source").eqNullSafe(F.col("name")))
        .drop("name")
        .withColumn("rank", F.row_number().over(inside) - 1)
        .withColumn("before", F.coalesce(F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("n_blocks", F.count("*").over(Window.partitionBy("source")))
    )
    ranked = stage(ranked, "blocks")
    taken = (
        ranked.withColumn("pass", F.explode(F.array(*(F.lit(i) for i in range(repeats)))))
        .withColumn("room", F.round("target").cast("long") - F.col("pass") * F.col("source_size") - F.col("before"))
        .withColumn("draw", F.col("pass") * F.col("n_blocks") + F.col("rank"))
        .where("room > 0 and words > 0")
    )
    ranges = split_quotas(taken.groupBy("source").agg((F.max("draw") + 1).alias("quota")), levels).withColumnRenamed("source", "name")
    dealt = (
        taken.join(ranges, F.col("source").eqNullSafe(F.col("name")) & (F.col("draw") >= F.col("first")) & (F.col("draw") < F.col("last")))
        .groupBy(F.col("source").alias("name"), F.col("block").alias("number"))
        .agg(F.sort_array(F.collect_list(F.struct("pass", "shard", "room", "words"))).alias("dealt"))
    )
    plan = ranked.join(dealt, F.col("source").eqNullSafe(F.col("name")) & (F.col("block") == F.col("number")), "left").select(
        F.col("source").alias("_source"), F.col("block").alias("_block"), "source_size", "target", F.coalesce("dealt", F.array().cast("array<struct<pass:int,shard:bigint,room:bigint,words:bigint>>")).alias("dealt")
    )
    plan = stage(plan, "plan")
    in_block = F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    falls = F.exists("dealt", lambda d: d["words"] > d["room"])
    rows = light.join(plan, in_block).drop("_source", "_block")
    # where the target falls in the block: in some part of it
    upto = Window.partitionBy("source", "block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cut_parts = per_part.join(plan.where(falls), in_block).withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    inner = F.exists("dealt", lambda d: (d["room"] > F.col("before")) & (d["room"] < F.col("before") + F.col("words")))
    cut_parts = cut_parts.select(F.col("_source").alias("_s"), F.col("_block").alias("_b"), F.col("part").alias("_p"), "before", inner.alias("inner"))
    within = rows.where(falls).join(cut_parts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")) & (F.col("part") == F.col("_p"))).drop("_s", "_b", "_p")
    order = Window.partitionBy("source", "block", "part").orderBy(_rank_hash(F.lit("doc"), F.col("name")), "name", "size").rowsBetween(Window.unboundedPreceding, -1)
    sorted_part = within.where("inner").withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))).withColumn("most", F.lit(None).cast("long"))
    # a part on either side of the target is taken whole or not at all: its documents all lie where it begins
    whole_part = within.where("NOT inner").withColumn("ahead", F.col("before")).withColumn("most", F.col("before"))
    columns = ("doc_id", "source", "size", "name", "source_size", "target", "dealt", "ahead", "most")
    uncut = rows.where(~falls).withColumn("ahead", F.lit(0).cast("long")).withColumn("most", F.lit(None).cast("long"))
    every = uncut.select(*columns).unionByName(sorted_part.select(*columns)).unionByName(whole_part.select(*columns))

    def draw(d: Column) -> Column:
        some = F.when(F.col("most").isNotNull(), F.when(d["room"] > F.col("most"), F.col("size")).otherwise(0)).otherwise(F.greatest(F.lit(0), F.least(F.col("size"), d["room"] - F.col("ahead"))))
        words = F.when(d["words"] <= d["room"], F.col("size")).otherwise(some)
        return F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"), _rank_hash(F.lit("place"), F.col("name"), d["pass"]).alias("place"), words.cast("long").alias("words"))

    draws = F.filter(F.transform("dealt", draw), lambda d: d["words"] > 0)
    return every.select("doc_id", "source", "size", "source_size", "target", draws.alias("draws"))


def taken_words() -> Column:
    return F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])


def shard_words() -> Column:
    """The shards that a document's draws go to, in order of pass: shard:words,shard:words; empty if it isn't taken."""
    return F.array_join(F.transform("draws", lambda d: F.concat_ws(":", d["shard"].cast("string"), d["words"].cast("string"))), ",")


def write_mix(mixed: DataFrame, docs: DataFrame, path: str) -> None:
    """Write the drawn documents by shard, each shard in its hashed order; words says how much of a document to take.

    mixed and docs meet by doc_id, so the ids of docs must be unique and not null here.
    """
    rows = mixed.select("doc_id", F.explode("draws").alias("d")).select("doc_id", "d.*").join(docs.drop("pass", "shard", "place", "words"), "doc_id")
    rows.repartition("shard", F.pmod("place", F.lit(64))).sortWithinPartitions("shard", "place").write.partitionBy("shard").parquet(path)
