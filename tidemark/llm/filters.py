"""Filter interaction audit: what each filter of a chain removes, in every order of the chain.

A document becomes a mask with a bit for each filter that it fails, and the documents of a part become at most 2 ** k
cells of counts, all of that in Spark. A walk over the permutations of the k filters then swaps two neighbours at a time,
so that only the two steps that change places are counted again, out of the cells; what a filter removes is added up
along the walk, which is its Shapley value times k!.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Limits of the five filters. The last filter has no column: it fails texts that a smaller doc_id has too.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 3
SYMBOLS = r"[#$%&*|]"
REPEATED = "E"

_RESULT = "part string, filter_order string, step int, filter string, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """The conditions under which a text fails A (few words), B (few distinct ones), C (capitals) and D (symbols)."""
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MAX_CAPITALS * F.char_length(text),
        "D": text.rlike(SYMBOLS),
    }


def failing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(digest, doc_id, part, mask, good, toxic) of each row of docs; mask has a bit for each of text_filters, A's the lowest.

    Null texts are empty, null langs are ''. A document is good (toxic) if any row of labels says so; a row without doc_id
    has no labels and takes no part in the join, however many such rows there are.
    """
    read = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    split = read.withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    bits = [F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(text_filters(F.col("text"), F.col("words")).values())]
    rows = split.select(F.unhex(F.sha2("text", 256)).alias("digest"), "doc_id", "part", sum(bits[1:], bits[0]).alias("mask"))
    marks = labels.groupBy(F.col("doc_id").alias("marked")).agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(k) for c, k in (("quality", "good"), ("toxic", "toxic"))])
    known = rows.where("doc_id IS NOT NULL").join(marks, F.col("doc_id") == F.col("marked"), "left").drop("marked")
    unknown = rows.where("doc_id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    return known.unionByName(unknown).fillna(False, ["good", "toxic"])


def failure_cells(rows: DataFrame, bit: int) -> DataFrame:
    """(part, mask, n, good, toxic) counts of rows of failing(), with `bit` set where a smaller doc_id has the same digest.

    Copies of a text are added up by part, mask and labels, in each task first, before they meet: of a text that a third
    of all rows hold one row a task and part is shuffled. A row without doc_id is behind all that have one.
    """
    held = ["digest", "part", "mask", "good", "toxic"]
    by_id = rows.groupBy(*held, "doc_id").agg(F.count("*").alias("n"))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    copies = by_id.groupBy(*held).agg(F.sum("n").alias("n"), least.alias("least"))
    joined = copies.withColumn("first", F.min("least.doc_id").over(Window.partitionBy("digest")))
    ahead = F.when(F.col("first").isNull(), F.col("n")).when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = joined.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), ahead.alias("n")),
        F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - ahead).alias("n")),
    )))
    return split.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")])


def neighbour_swaps(k: int) -> Iterator[int]:
    """Places i, k! - 1 of them: swapping entries i and i + 1 in turn visits every order of k entries once."""
    if k < 2:
        return
    # the last entry runs through the orders of the others, to and fro; they change by one swap at each turn
    down = True
    inner = neighbour_swaps(k - 1)
    while True:
        yield from range(k - 2, -1, -1) if down else range(k - 1)
        turn = next(inner, None)
        if turn is None:
            return
        yield turn + 1 if down else turn
        down = not down


def walk(cells: np.ndarray, names: str) -> pd.DataFrame:
    """Rows for each order of the filters and step in it, from cells[mask] = (n, good, toxic)."""
    k = len(names)
    masks = np.arange(1 << k)
    fails = [int(cells[masks >> f & 1 == 1, 0].sum()) for f in range(k)]
    alone = [int(cells[1 << f, 0]) for f in range(k)]

    def step(before: int, f: int) -> tuple[int, int, int, int]:
        """kept, removed, good_lost and toxic_lost of filter f behind the set of filters before."""
        here = masks & before == 0
        lost = cells[here & (masks >> f & 1 == 1)].sum(axis=0)
        return int(cells[here, 0].sum() - lost[0]), *map(int, lost)

    order = list(range(k))
    steps = [step((1 << i) - 1, f) for i, f in enumerate(order)]
    total, out = [0] * k, []

    def visit() -> None:
        label = "".join(names[f] for f in order)
        for i, (f, (kept, removed, good, toxic)) in enumerate(zip(order, steps, strict=True)):
            total[f] += removed
            out.append((label, i + 1, f, kept, removed, fails[f] - removed, alone[f], good, toxic))

    visit()
    for i in neighbour_swaps(k):
        order[i], order[i + 1] = order[i + 1], order[i]
        before = sum(1 << f for f in order[:i])
        steps[i : i + 2] = step(before, order[i]), step(before | 1 << order[i], order[i + 1])
        visit()
    made = pd.DataFrame(out, columns=["filter_order", "step", "f", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"])
    return made.assign(filter=[names[f] for f in made["f"]], shapley=[total[f] for f in made["f"]]).drop(columns="f")


def audit(cells: DataFrame, names: str) -> DataFrame:
    """A row for each part, order of the filters named by single letters and step, from cells (part, mask, n, good, toxic).

    A part's cells, 2 ** k at most, are walked in one task; parts are walked side by side. No cells give no rows.
    """

    def part(rows: pd.DataFrame) -> pd.DataFrame:
        found = np.zeros((1 << len(names), 3), np.int64)
        found[rows["mask"]] = rows[["n", "good", "toxic"]]
        return walk(found, names).assign(part=rows["part"].iloc[0])[[c.split()[0] for c in _RESULT.split(", ")]]

    return cells.groupBy("part").applyInPandas(part, _RESULT)


def interaction_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the filters A to E over docs (doc_id, text, lang) by lang, with labels (doc_id, quality, toxic).

    Columns: part, filter_order, step (from 1), filter, and over the part's documents kept after the step, removed by it,
    redundant (failing the filter, removed before), unique_fails (failing no other), good_lost and toxic_lost (removed
    here), shapley (removed by the filter, added up over all orders). Rows of docs are documents, repeated ones too; rows
    that share a doc_id don't repeat each other. Other columns are not read. An empty docs gives an empty result.
    """
    names = "".join(text_filters(F.lit(""), F.array()).keys()) + REPEATED
    return audit(failure_cells(failing(docs, labels), 1 << len(names) - 1), names)
