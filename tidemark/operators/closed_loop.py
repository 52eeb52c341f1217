"""The closed loop over dates: what a cycle decides, resolves, refines and overrides is there for the cycles after it.

A cycle runs on every date of the rankings. Each company is a small state machine over time: its last hold decision, the
sum of its applied overrides, and its outcomes that wait for returns. Spark puts everything that a company's machine reads
on one time line - rankings with what becomes known of them and when, signals, and the state that earlier cycles left in
the store. Whether an override applies does not depend on the score, so sums of overrides are running sums, and a target
is kept along a run of green rows: windows over the sorted line say all that the machine would. It goes to the store in
one version (sinks.tables), from which the next run starts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.core import clamp
from tidemark.functions.shared import stage
from tidemark.operators.loop import HOLD_DAYS, LEAST_OBSERVATIONS, WEIGHTS, decide_holds, decile_of, horizon_of, outcome, refined_rows
from tidemark.operators.market import HORIZONS
from tidemark.operators.ranking import deciles

#: A deviation within this of the one that was refined before is not refined again.
SAME = 1e-12

_DAY = "company_id long, trade_date date"
HOLDS = f"{_DAY}, action string, score double, red_green string, reason string, hold_until date, sell_target_price double, sell_target_date date"
OUTCOMES = f"{_DAY}, horizon int, expected_return double, expected_on date, actual_return double, deviation double, status string, resolved_on date"
REFINED = f"{_DAY}, {', '.join(f'{c} double' for c in WEIGHTS)}, overall_score double, refined_on date, deviation double"
OVERRIDES = f"{_DAY}, source string, sentiment string, original_score double, adjusted_score double, score_adjustment double, significance_status string, applied boolean"
_KINDS = {"hold_decisions": HOLDS, "outcomes": OUTCOMES, "refinements": REFINED, "overrides": OVERRIDES}
_NAMES = {k: [x.split()[0] for x in s.split(", ")] for k, s in _KINDS.items()}


def known_returns(prices: DataFrame) -> DataFrame:
    """(company_id, trade_date, horizon, value, known_on): forward returns and the day of the price that makes them known."""
    line = Window.partitionBy("company_id").orderBy("trade_date")
    ahead = [F.struct(F.lit(n).alias("horizon"), F.lead("close", n).over(line).alias("later"), F.lead("trade_date", n).over(line).alias("known_on")) for n in HORIZONS]
    rows = prices.select("company_id", "trade_date", "close", F.array(*ahead).alias("a")).select("company_id", "trade_date", "close", F.inline("a"))
    return rows.where("close > 0 AND later > 0").select("company_id", "trade_date", "horizon", (F.col("later") / F.col("close") - 1).alias("value"), "known_on")


def expectations(ranked: DataFrame, known: DataFrame) -> DataFrame:
    """(trade_date, decile, horizon, expected, expected_on): the mean of a decile's returns on the first day that any is known.

    An expectation, once there, stays: an outcome keeps the first one that it gets.
    """
    members = deciles(ranked).select("company_id", "trade_date", "decile").join(known, ["company_id", "trade_date"])
    by_day = members.groupBy("trade_date", "decile", "horizon", "known_on").agg(F.avg("value").alias("expected"))
    return by_day.groupBy("trade_date", "decile", "horizon").agg(F.min_by("expected", "known_on").alias("expected"), F.min("known_on").alias("expected_on"))


@dataclass(frozen=True)
class Stored:
    """What earlier cycles left: hold_decisions, outcomes, refinements and overrides, as closed_loop gives them."""

    hold_decisions: DataFrame
    outcomes: DataFrame
    refinements: DataFrame
    overrides: DataFrame


def nothing_stored(spark) -> Stored:
    return Stored(*[spark.createDataFrame([], s) for s in _KINDS.values()])


def closed_loop(
    ranked: DataFrame, prices: DataFrame, signals: DataFrame, stored: Stored | None = None, start: str | None = None, end: str | None = None, hold_days: int = HOLD_DAYS, score_scale: float = 1.0
) -> Stored:
    """The cycles of all dates of ranked from start to end, after those before start that `stored` tells of: rows to upsert.

    Of each cycle, in order of the stages:

    * score: the ranking, plus the company's overrides applied on earlier dates, clamped;
    * hold: as in loop.decide_holds, from the company's decision before;
    * verify: a green hold opens an outcome. It gets the first mean return of its decile that a cycle finds known, and its
      own return once a cycle finds that known; with both it is verified. An outcome that neither is known of stays;
    * refine: a deviation that isn't zero moves the categories of the ranking as it was scored, unless the stored
      refinement of that date came from the same deviation (within SAME);
    * override: as in loop.override_stage; of several signals of a source and date the last by signal_id counts. It works
      from the next cycle on. Signals of dates without a cycle are not read.

    Decisions, overrides and outcomes of dates from start on are not read from `stored`, and resolutions that were made
    from start on are made again: a run may be repeated, with the same rows, and refinements only where returns changed.
    Rankings, prices and signals are unique by company and date (and source), and companies are not null.
"""
    known = stage(known_returns(prices), "known-returns")
    own = ranked.select("company_id", "trade_date", *WEIGHTS, "overall_score", decile_of("overall_rank", "overall_percentile").alias("decile"))
    expected = expectations(ranked, known)
    sizes = deciles(ranked).join(prices.select("company_id", "trade_date"), ["company_id", "trade_date"], "left_semi").groupBy("trade_date", "decile").agg(F.count("*").alias("observations"))

    def with_returns(rows: DataFrame) -> DataFrame:
        """rows (company_id, trade_date, decile, horizon) with expected, expected_on, actual and known_on."""
        found = rows.join(expected, ["trade_date", "decile", "horizon"], "left")
        mine = known.select("company_id", "trade_date", "horizon", F.col("value").alias("actual"), "known_on")
        return found.join(mine, ["company_id", "trade_date", "horizon"], "left")

    rankings = with_returns(own.withColumn("horizon", F.lit(horizon_of(hold_days)))).join(sizes, ["trade_date", "decile"], "left")
    rankings = rankings.join(prices.select("company_id", "trade_date", "close"), ["company_id", "trade_date"], "left")
    # its dates are asked for before its rows
    rankings = stage(rankings, "rankings")
    return _cycles(rankings, lambda waiting: with_returns(waiting.join(own, ["company_id", "trade_date"], "left")), signals, stored, start, end, hold_days, score_scale)


def closed_loop_judged(
    judged: DataFrame, signals: DataFrame, stored: Stored | None = None, start: str | None = None, end: str | None = None, hold_days: int = HOLD_DAYS, score_scale: float = 1.0
) -> Stored:
    """closed_loop over ranking.judged_cycles, whose rows hold what the loop asks for: nothing is joined to the rankings but
    the few outcomes that wait. These must be of the horizon of hold_days, as judged is; judged should be a written table.
    """
    found = [F.when(F.col("horizon") == horizon_of(hold_days), F.col(c)).alias(c) for c in ("expected", "expected_on", "actual", "known_on")]
    evidence = lambda waiting: waiting.join(judged, ["company_id", "trade_date"], "left").select(*waiting.columns, *WEIGHTS, "overall_score", *found)
    return _cycles(judged, evidence, signals, stored, start, end, hold_days, score_scale)


def lightened(judged: DataFrame, signals: DataFrame, score_scale: float = 1.0) -> DataFrame:
    """judged for closed_loop_judged, where rows that no sum of overrides can turn green hold what their decision and their
    signals need, and no more: a company is moved by the sizes of all its adjustments at most.

    signals: all that any run over judged reads, or has read.
    """
    most = signals.groupBy("company_id").agg(F.sum(F.abs("score_adjustment")).alias("most")).agg(F.max("most")).first()[0] or 0.0
    # sums of doubles are exact to far less
    low = F.col("overall_score") * score_scale < 50 - most * (1 + 1e-6) - 1e-6
    return judged.withColumns({c: F.when(F.col("overall_score").isNotNull() & ~low, F.col(c)) for c in (*WEIGHTS, "close", *_EVIDENCE)})


def _cycles(rankings: DataFrame, evidence: Callable[[DataFrame], DataFrame], signals: DataFrame, stored: Stored | None, start: str | None, end: str | None, hold_days: int, score_scale: float) -> Stored:
    """The cycles over rankings that hold close, observations, expected, expected_on, actual and known_on.

    evidence gives waiting outcomes (company_id, trade_date, horizon) the latter four, and their rankings' scores.
    """
    spark = rankings.sparkSession
    stored = stored or nothing_stored(spark)
    in_run = lambda c: (F.lit(True) if start is None else F.col(c) >= F.lit(start).cast("date")) & (F.lit(True) if end is None else F.col(c) <= F.lit(end).cast("date"))
    before = lambda c: F.lit(False) if start is None else F.col(c) < F.lit(start).cast("date")
    # the calendar of cycles: one date for each day of the run
    cycles = [r[0] for r in rankings.where(in_run("trade_date")).select("trade_date").distinct().orderBy("trade_date").collect()]
    if not cycles:
        return nothing_stored(spark)

    key = ["company_id", "trade_date"]
    # a row of the line is one of these, in this order on a day; what is known before the run has no day
    decided = stored.hold_decisions.where(before("trade_date")).groupBy("company_id").agg(F.max_by(F.struct("sell_target_price", "sell_target_date", "hold_until"), "trade_date").alias("p"))
    moved = stored.overrides.where(before("trade_date") & F.col("applied")).groupBy("company_id").agg(F.sum("score_adjustment").alias("due"))
    refined = stored.refinements.where(in_run("trade_date")).select(*key, F.col("deviation").alias("refined_deviation"))
    scored = lambda c: F.when(F.col("overall_score").isNotNull(), F.col(c)).alias(c)
    ranked = rankings.where(in_run("trade_date")).select(*key, *map(scored, WEIGHTS), "overall_score", *map(scored, ("close", "observations", *_EVIDENCE)))
    calendar = spark.createDataFrame([(c,) for c in cycles], "trade_date date")
    news = signals.where(in_run("trade_date")).join(F.broadcast(calendar), "trade_date", "left_semi").select(*key, "source", "sentiment", "score_adjustment", "signal_id")
    line = decided.select("company_id", "p.*", F.lit(_DECIDED).alias("kind"))
    for rows, kind in ((moved, _MOVED), (refined, _REFINED), (ranked, _RANKING), (news, _SIGNAL)):
        line = line.unionByName(rows.withColumn("kind", F.lit(kind)), allowMissingColumns=True)
    rows = stage(_walked(line.where("company_id IS NOT NULL").repartition("company_id"), hold_days, score_scale), "closed-loop")

    holds = rows.where(F.col("kind") == _RANKING)
    opened = holds.where("action = 'hold' AND red_green = 'green'").select(*key, F.lit(horizon_of(hold_days)).alias("horizon"), F.col("trade_date").alias("first"), *WEIGHTS, "overall_score", *_EVIDENCE, "refined_deviation")
    none = {"expected_return": F.lit(None).cast("double"), "was_expected_on": F.lit(None).cast("date")}
    found = opened.withColumns(none)
    if start is not None:
        waiting = stored.outcomes.where(before("trade_date") & (F.col("resolved_on").isNull() | ~before("resolved_on")))
        fixed = lambda c: F.when(before("expected_on"), F.col(c))
        waiting = waiting.select(*key, "horizon", fixed("expected_return").alias("expected_return"), fixed("expected_on").alias("was_expected_on"))
        old = stored.refinements.select(*key, F.col("deviation").alias("refined_deviation"))
        # outcomes and refinements both come of them
        pending = stage(evidence(waiting).join(old, key, "left").withColumn("first", F.lit(cycles[0])).select(found.columns), "pending")
        found = found.unionByName(pending)
    outs = _resolved(found, cycles)
    again = F.col("refined_deviation").isNotNull() & (F.abs(F.col("refined_deviation") - F.col("deviation")) < SAME)
    again = refined_rows(outs.where((F.col("deviation") != 0) & ~again), (F.col("resolved_on").alias("refined_on"),))
    overs = rows.where(F.col("kind") == _SIGNAL).withColumns(
        {"original_score": F.col("score"), "adjusted_score": F.when(F.col("applied"), clamp(F.col("score") + F.col("adjustment"))).otherwise(F.col("score")), "score_adjustment": F.col("adjustment")}
    ).withColumn("significance_status", F.when(F.col("sound"), "confirmed").otherwise("rejected"))
    return Stored(*[df.select(*names) for df, names in zip((holds, outs, again, overs), _NAMES.values(), strict=True)])


_DECIDED, _MOVED, _REFINED, _RANKING, _SIGNAL = range(5)
_EVIDENCE = ("expected", "expected_on", "actual", "known_on")


def _walked(line: DataFrame, hold_days: int, score_scale: float) -> DataFrame:
    """Rankings with their decisions and signals with their judgement, from a walk along each company's line.

    All windows go along one sorted line, which lies by company.
    """
    same_source = Window.partitionBy("company_id", "trade_date", "kind", "source").orderBy(F.col("signal_id").desc())
    day = Window.partitionBy("company_id", "trade_date")
    days = Window.partitionBy("company_id").orderBy("trade_date", "kind", "source")
    so_far = days.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_ranking, is_signal = F.col("kind") == _RANKING, F.col("kind") == _SIGNAL
    rows = line.withColumn("_n", F.row_number().over(same_source)).where("_n = 1").drop("_n", "signal_id")
    # a day's ranking is there for its signals; at most one row of a day has it
    of_day = {c: F.max(c).over(day) for c in ("overall_score", "observations", "refined_deviation")}
    rows = rows.withColumns(of_day).withColumns({"adjustment": F.when(is_signal, F.coalesce("score_adjustment", F.lit(0.0))), "_goes_on": F.lead("trade_date").over(days).eqNullSafe(F.col("trade_date"))})
    sound = F.coalesce(F.col("sentiment").isin("positive", "negative"), F.lit(False)) & (F.abs("adjustment") > 0) & (F.coalesce("observations", F.lit(0)) >= LEAST_OBSERVATIONS)
    rows = rows.withColumn("sound", is_signal & sound).withColumn("applied", F.col("sound") & F.col("overall_score").isNotNull())
    # a day's sum, in order of sources, stands at its last row, so that it counts once and from the next day on
    rows = rows.withColumn("_due", F.sum(F.when(F.col("applied"), F.col("adjustment"))).over(day.orderBy("kind", "source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    rows = rows.withColumn("_due", F.coalesce("due", F.when(~F.col("_goes_on"), F.col("_due"))))
    rows = rows.withColumn("_delta", F.sum("_due").over(days.rowsBetween(Window.unboundedPreceding, -1)))
    raw = F.col("overall_score") * score_scale
    rows = rows.withColumn("score", F.when(F.col("_delta").isNull(), raw).otherwise(clamp(raw + F.col("_delta"))))
    # a run of green rows keeps one target: that of the decision before the run of cycles, or what its own first row held until
    rows = rows.withColumn("_green", F.when(is_ranking, F.coalesce(F.col("score") >= 50, F.lit(False))))
    held = F.when(F.col("kind") == _DECIDED, F.coalesce("sell_target_date", "hold_until"))
    rows = rows.withColumns(
        {
            "_was": F.last("_green", ignorenulls=True).over(days.rowsBetween(Window.unboundedPreceding, -1)), "_held": F.last(held, ignorenulls=True).over(so_far),
            "_price": F.last("sell_target_price", ignorenulls=True).over(so_far), "_breaks": F.count(F.when(~F.col("_green"), 1)).over(so_far),
        }
    )
    green, kept = F.coalesce("_green", F.lit(False)), (F.col("_breaks") == 0) & F.col("_held").isNotNull()
    rows = rows.withColumn("_begins", green & ~kept & ~F.coalesce("_was", F.lit(False)))
    rows = rows.withColumn("_first", F.last(F.when(F.col("_begins"), F.date_add("trade_date", hold_days)), ignorenulls=True).over(so_far))
    target = F.when(green, F.when(kept, F.col("_held")).when(~F.col("_begins"), F.col("_first")))
    rows = rows.where(is_ranking | is_signal).withColumns({"sell_target_price": F.when(green & (F.col("_breaks") == 0), F.col("_price")), "sell_target_date": target})
    beside = ("kind", *WEIGHTS, "overall_score", *_EVIDENCE, "refined_deviation", "source", "sentiment", "adjustment", "sound", "applied")
    out = decide_holds(rows, hold_days, beside)
    opens = is_ranking & (F.col("action") == "hold") & (F.col("red_green") == "green")
    said = {c: F.when(opens, F.col(c)) for c in (*WEIGHTS, "overall_score", *_EVIDENCE, "refined_deviation")}
    return out.withColumns({**said, **{c: F.when(is_ranking, F.col(c)) for c in ("action", "reason", "red_green", "hold_until")}})


def _resolved(found: DataFrame, cycles: list) -> DataFrame:
    """How outcomes stand after the cycles: found has what was stored of them, their evidence, and `first`, from when on
    cycles look at them."""
    spark, day = found.sparkSession, dt.timedelta(days=1)
    # the first cycle on or after each day
    spans = [(cycles[0], cycles[0])] + [(b - day * i, b) for a, b in zip(cycles, cycles[1:], strict=False) for i in range((b - a).days)]
    calendar = spark.createDataFrame(spans, "day date, cycle date")
    after = lambda c: F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.col("first")))
    rows = found.withColumns({"_e": after("expected_on"), "_k": after("known_on")})
    for at in ("_e", "_k"):
        rows = rows.join(F.broadcast(calendar.select(F.col("day").alias(at), F.col("cycle").alias(f"{at}_cycle"))), at, "left")
    stays = F.col("expected_return").isNotNull()
    seen = F.col("expected").isNotNull() & F.col("_e_cycle").isNotNull()
    rows = rows.withColumns(
        {
            "expected_on": F.when(stays, F.col("was_expected_on")).when(seen, F.col("_e_cycle")),
            "expected_return": F.when(stays, F.col("expected_return")).when(seen, F.col("expected")), "actual_return": F.when(F.col("_k_cycle").isNotNull(), F.col("actual")),
        }
    )
    rows = rows.withColumns(outcome("expected_return", "actual_return"))
    return rows.withColumn("resolved_on", F.when(F.col("deviation").isNotNull(), F.greatest("_k_cycle", "expected_on")))
