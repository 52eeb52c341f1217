"""The recommendation loop: score, hold, verify, refine, override - each stage a projection or join over all companies.

Scores are on the scale of the rankings; labels and clamps use 0 to 100, so pass score_scale=100 to lift rankings in [0, 1].
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.core import asof_join, clamp, col, red_green, weighted_mean
from tidemark.operators.market import HORIZONS
from tidemark.operators.ranking import CATEGORIES

WEIGHTS = {f"{c}_score": w for c, (w, _) in CATEGORIES.items()}
HOLD_DAYS = 2
#: A decile confirms an override only with so many observations.
LEAST_OBSERVATIONS = 10


def decile_of(rank: str | Column, percentile: str | Column) -> Column:
    """Decile 1..10 from a percentile (1 the best), else from a rank in tens; null without either."""
    p = 10 - F.floor(col(percentile) * 10)
    by_rank = F.least(F.lit(10), F.greatest(F.lit(1), F.ceil(col(rank) / 10)))
    return F.when(col(percentile).isNotNull(), F.greatest(F.lit(1), p)).when(col(rank).isNotNull(), by_rank).cast("int")


def horizon_bucket(days: str | Column) -> Column:
    """The smallest horizon that is not below days, else the largest."""
    out = F.lit(HORIZONS[-1])
    for h in reversed(HORIZONS):
        out = F.when(col(days) <= h, F.lit(h)).otherwise(out)
    return F.when(col(days).isNotNull(), out)


def horizon_of(hold_days: int) -> int:
    """horizon_bucket of a number of days that is known beforehand."""
    return next((h for h in HORIZONS if hold_days <= h), HORIZONS[-1])


def apply_overlay(ranked: DataFrame, overrides: DataFrame, as_of: str | None = None, score_scale: float = 1.0) -> DataFrame:
    """Stage 1: rankings with the sum of a company's applied overrides up to the date added to the score, clamped, and a label.

    Adjusted from the raw rankings each time, so a rerun gives the same scores.
    """
    done = overrides.where("applied")
    if as_of is not None:
        done = done.where(F.col("trade_date") <= F.lit(as_of).cast("date"))
    return overlaid(ranked.join(adjustments(done), "company_id", "left"), score_scale)


def adjustments(applied: DataFrame) -> DataFrame:
    """(company_id, _delta): the sums of companies' applied overrides."""
    return applied.groupBy("company_id").agg(F.sum(F.coalesce("score_adjustment", F.lit(0.0))).alias("_delta"))


def overlaid(rows: DataFrame, score_scale: float = 1.0) -> DataFrame:
    """Rankings that hold their company's _delta, with the score that it gives and a label instead."""
    raw = F.col("overall_score") * score_scale
    moved = rows.withColumn("score", F.when(F.col("_delta").isNull(), raw).otherwise(clamp(raw + F.col("_delta"))))
    return moved.drop("_delta").withColumn("red_green", red_green("score"))


def decide_holds(rows: DataFrame, hold_days: int = HOLD_DAYS, beside: tuple[str, ...] = ()) -> DataFrame:
    """Stage 2 for rows (company_id, trade_date, score, close, sell_target_price, sell_target_date): action and reason.
    beside: further columns of the rows to keep.

    The first that holds: no score - pending; red - hold; a target price without a close - pending; target price reached
    - sell; hold end at or past the target date - sell; else hold.
    """
    if hold_days < 1:
        raise ValueError("hold_days must be at least 1")
    until = F.date_add("trade_date", hold_days)
    score, close, price, day = (F.col(c) for c in ("score", "close", "sell_target_price", "sell_target_date"))
    decision = lambda action, reason: F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"))
    case = (
        F.when(score.isNull(), decision("pending", "missing_score"))
        .when(score < 50, decision("hold", "red_score"))
        .when(price.isNotNull() & close.isNull(), decision("pending", "missing_close_price"))
        .when(close >= price, decision("sell", "target_achieved"))
        .when(day.isNotNull() & (until >= day), decision("sell", "time_to_target_reached"))
        .otherwise(decision("hold", "initial_hold"))
    )
    green = score.isNotNull() & (score >= 50)
    return rows.withColumn("_c", case).select(
        "company_id", "trade_date", F.col("_c.action").alias("action"), "score", red_green("score").alias("red_green"), F.col("_c.reason").alias("reason"),
        F.when(green, until).alias("hold_until"), F.when(green, price).alias("sell_target_price"), F.when(green, day).alias("sell_target_date"), *beside,
    )


def hold_stage(scored: DataFrame, prices: DataFrame, prior_holds: DataFrame, hold_days: int = HOLD_DAYS) -> DataFrame:
    """Stage 2: decisions for scored rows from the day's close and, for green ones, the latest decision before the day.

    The target date is the earlier decision's, or else the day it held until.
    """
    rows = scored.select("company_id", "trade_date", "score").join(prices.select("company_id", "trade_date", "close"), ["company_id", "trade_date"], "left")
    return decide_holds(_targets(_after(rows, prior_holds)), hold_days)


def _after(rows: DataFrame, prior_holds: DataFrame) -> DataFrame:
    """rows with the latest decision before their day."""
    return asof_join(rows, prior_holds, ["company_id"], "trade_date", "trade_date", ["trade_date"], ["sell_target_price", "sell_target_date", "hold_until"], prefix="_", strict=True)


def _targets(known: DataFrame) -> DataFrame:
    green = F.col("score") >= 50
    return known.withColumn("sell_target_price", F.when(green, F.col("_sell_target_price"))).withColumn("sell_target_date", F.when(green, F.coalesce("_sell_target_date", "_hold_until")))


def _after_all(scored: DataFrame, hold_days: int = HOLD_DAYS) -> DataFrame:
    """scored with the decision of the row before, as decision_history(scored) has it: _after of all, along one sorted line of a company's days."""
    days = Window.partitionBy("company_id").orderBy("trade_date")
    green, until = F.coalesce(F.col("score") >= 50, F.lit(False)), F.date_add("trade_date", hold_days)
    rows = scored.withColumns({"_green": green, "_until": F.when(green, until)}).withColumn("_begins", F.col("_green") & ~F.coalesce(F.lag("_green").over(days), F.lit(False)))
    # of a run of green rows, what the first held until
    rows = rows.withColumn("_first", F.when(F.col("_green"), F.last(F.when(F.col("_begins"), F.col("_until")), ignorenulls=True).over(days)))
    rows = rows.withColumn("_target", F.when(F.col("_until") > F.col("_first"), F.col("_first")))
    held = {"_sell_target_price": F.lit(None).cast("double"), "_sell_target_date": F.lag("_target").over(days), "_hold_until": F.lag("_until").over(days)}
    return rows.withColumns(held).drop("_green", "_until", "_begins", "_first", "_target")


def decision_history(scored: DataFrame, hold_days: int = HOLD_DAYS) -> DataFrame:
    """The decisions that hold_stage has stored once it ran date by date from an empty store: prior_holds of scored's dates.

    A green row takes its target date over from the decision before, so it is where the first of its run of green rows
    held until; that first one has none. Other decisions hold nothing and end the run. No decision has a target price.
    """
    days = Window.partitionBy("company_id").orderBy("trade_date")
    green, until = F.coalesce(F.col("score") >= 50, F.lit(False)), F.date_add("trade_date", hold_days)
    runs = scored.select("company_id", "trade_date", green.alias("_g"), F.when(green, until).alias("hold_until"), F.sum(F.when(green, 0).otherwise(1)).over(days).alias("_run"))
    first = F.min("hold_until").over(Window.partitionBy("company_id", "_run"))
    return runs.withColumn("_first", first).select(
        "company_id", "trade_date", F.lit(None).cast("double").alias("sell_target_price"), F.when(F.col("hold_until") > F.col("_first"), F.col("_first")).alias("sell_target_date"), "hold_until"
    )


def outcome(expected: str | Column, actual: str | Column) -> dict[str, Column]:
    """deviation = expected - actual; verified only with both."""
    both = col(expected).isNotNull() & col(actual).isNotNull()
    return {"deviation": col(expected) - col(actual), "status": F.when(both, "verified").otherwise("pending")}


def _returns_of(rows: DataFrame, ranked: DataFrame, returns: DataFrame, stats: DataFrame) -> DataFrame:
    """rows (company_id, trade_date, horizon, more) with the expected return of their decile and the actual forward return."""
    own = ranked.select("company_id", "trade_date", decile_of("overall_rank", "overall_percentile").alias("decile"))
    return (
        rows.join(own, ["company_id", "trade_date"], "left")
        .join(stats.select("trade_date", "decile", *[f"avg_{h}d" for h in HORIZONS]), ["trade_date", "decile"], "left")
        .join(returns.select("company_id", "trade_date", *[f"forward_{h}d_return" for h in HORIZONS]), ["company_id", "trade_date"], "left")
        .select(*rows.columns, *_of_horizon())
    )


def _of_horizon() -> list[Column]:
    pick = lambda form: F.coalesce(*[F.when(F.col("horizon") == h, F.col(form.format(h))) for h in HORIZONS])
    return [pick("avg_{}d").alias("expected_return"), pick("forward_{}d_return").alias("actual_return")]


def _horizon() -> Column:
    return horizon_bucket(F.greatest(F.lit(1), F.coalesce(F.datediff("hold_until", "trade_date"), F.lit(HOLD_DAYS)))).alias("horizon")


def verify_stage(holds: DataFrame, ranked: DataFrame, returns: DataFrame, stats: DataFrame) -> DataFrame:
    """Stage 3: for green holds, the expected return of their decile on their date against the actual forward return.

    stats is the backtest by date and decile. The bucket is that of the days held. Where neither is known nothing is
    said of a hold yet.
    """
    green = holds.where("action = 'hold' AND red_green = 'green'").select("company_id", "trade_date", _horizon())
    return _said(_returns_of(green, ranked, returns, stats))


def _said(found: DataFrame) -> DataFrame:
    return found.where("expected_return IS NOT NULL OR actual_return IS NOT NULL").select("*", *[c.alias(n) for n, c in outcome("expected_return", "actual_return").items()])


def resolve_pending(outcomes: DataFrame, holds: DataFrame, ranked: DataFrame, returns: DataFrame, stats: DataFrame) -> DataFrame:
    """All outcomes, the pending ones with what is known by now of their own date: the decision's days, decile and returns.

    An expected return that is there stays; a decision that is gone or holds nothing counts as the usual days. A pending
    outcome of which the actual return is still unknown stays pending.
    """
    columns = outcomes.columns
    open_ = outcomes.where("status = 'pending'").select("company_id", "trade_date", F.col("expected_return").alias("_expected"))
    dated = open_.join(holds.select("company_id", "trade_date", "hold_until"), ["company_id", "trade_date"], "left").select("company_id", "trade_date", "_expected", _horizon())
    found = _returns_of(dated, ranked, returns, stats).withColumn("expected_return", F.coalesce("_expected", "expected_return")).drop("_expected")
    done = found.select("*", *[c.alias(n) for n, c in outcome("expected_return", "actual_return").items()])
    return outcomes.where("status <> 'pending'").unionByName(done.select(*columns))


def refine_stage(outcomes: DataFrame, ranked: DataFrame) -> DataFrame:
    """Stage 4: the deviation dealt to the valid categories by weight, added and clamped; the overall score made anew.

    Outcomes without a deviation, or with none, change nothing; a row without a valid category keeps its score. Rank and
    percentile are not touched.
    """
    moved = outcomes.where("deviation IS NOT NULL AND deviation <> 0").select("company_id", "trade_date", "deviation")
    return refined_rows(moved.join(ranked, ["company_id", "trade_date"]))


def refined_rows(rows: DataFrame, beside: tuple[Column, ...] = ()) -> DataFrame:
    """Rankings beside the deviation that moves them, moved. beside: further columns of the rows."""
    total = sum((F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for c, w in WEIGHTS.items()), F.lit(0.0))
    new = {c: F.when(F.col(c).isNotNull(), clamp(F.col(c) + F.col("deviation") * w / F.nullif(total, F.lit(0.0)))) for c, w in WEIGHTS.items()}
    out = rows.select("company_id", "trade_date", "deviation", F.col("overall_score").alias("_old"), *[e.alias(c) for c, e in new.items()], *beside)
    return out.withColumn("overall_score", F.coalesce(weighted_mean(WEIGHTS, 1), "_old")).drop("_old")


def override_stage(signals: DataFrame, scored: DataFrame, stats: DataFrame) -> DataFrame:
    """Stage 5: news signals against the evidence of the company's own decile on the date.

    Confirmed if the sentiment is positive or negative, the adjustment is not zero and the decile has enough observations;
    rejected otherwise, as are signals of companies without a ranking that day. Applied if confirmed and the company has a
    score; then the score moves, clamped.
    """
    own = scored.select("company_id", "trade_date", "score", decile_of("overall_rank", "overall_percentile").alias("decile"))
    seen = stats.select("trade_date", "decile", "observations")
    return _weighed(signals.join(own, ["company_id", "trade_date"], "left").join(seen, ["trade_date", "decile"], "left"))


def _weighed(rows: DataFrame) -> DataFrame:
    """Signals beside the score of their company and the observations of its decile."""
    sound = F.coalesce(F.col("sentiment").isin("positive", "negative"), F.lit(False)) & (F.abs(F.coalesce("score_adjustment", F.lit(0.0))) > 0) & (F.coalesce("observations", F.lit(0)) >= LEAST_OBSERVATIONS)
    applied = sound & F.col("score").isNotNull()
    moved = F.when(applied, clamp(F.col("score") + F.coalesce("score_adjustment", F.lit(0.0)))).otherwise(F.col("score"))
    return rows.select(
        "company_id", "trade_date", "source", F.col("score").alias("original_score"), moved.alias("adjusted_score"), F.coalesce("score_adjustment", F.lit(0.0)).alias("score_adjustment"),
        F.when(sound, "confirmed").otherwise("rejected").alias("significance_status"), applied.alias("applied"),
    )


@dataclass(frozen=True)
class LoopResult:
    scored: DataFrame
    holds: DataFrame
    outcomes: DataFrame
    refined: DataFrame
    overrides: DataFrame


def run_loop(ranked: DataFrame, prices: DataFrame, returns: DataFrame, signals: DataFrame, stats: DataFrame, prior_holds: DataFrame, overrides: DataFrame, hold_days: int = HOLD_DAYS, score_scale: float = 1.0) -> LoopResult:
    """All five stages over the dates of ranked; nothing runs until a result is asked for."""
    scored = apply_overlay(ranked, overrides, score_scale=score_scale)
    holds = hold_stage(scored, prices, prior_holds, hold_days)
    outcomes = verify_stage(holds, ranked, returns, stats)
    return LoopResult(scored, holds, outcomes, refine_stage(outcomes, ranked), override_stage(signals, scored, stats))


def run_loop_judged(judged: DataFrame, signals: DataFrame, prior_holds: DataFrame | None, overrides: DataFrame, hold_days: int = HOLD_DAYS, score_scale: float = 1.0) -> LoopResult:
    """run_loop over ranking.judged_features, whose rows hold their close, returns and expectations (of the horizon of
    hold_days at least): one walk along each company's days decides, verifies and refines them where they lie.

    prior_holds None stands for decision_history, what a run day by day from an empty store has decided before each date.
    """
    scored = apply_overlay(judged, overrides, score_scale=score_scale)
    # a green hold lasts hold_days, so the horizon is known before any row is moved
    n = horizon_of(hold_days)
    evidence = (f"avg_{n}d", f"forward_{n}d_return")
    beside = (*WEIGHTS, "overall_score", *evidence)
    rows = scored.select("company_id", "trade_date", "score", "close", *beside)
    if prior_holds is None:
        holds = green = decide_holds(_targets(_after_all(rows, hold_days)), hold_days, beside)
    else:
        # a decision before counts for green rows alone: the others stay where they lie
        is_green = F.coalesce(F.col("score") >= 50, F.lit(False))
        green = decide_holds(_targets(_after(rows.where(is_green), prior_holds)), hold_days, beside)
        free = {"sell_target_price": F.lit(None).cast("double"), "sell_target_date": F.lit(None).cast("date")}
        holds = decide_holds(rows.where(~is_green).withColumns(free), hold_days, beside).unionByName(green)
    found = green.where("action = 'hold' AND red_green = 'green'").select("company_id", "trade_date", F.lit(n).alias("horizon"), *WEIGHTS, "overall_score", *evidence)
    said = _said(found.withColumnsRenamed(dict(zip(evidence, ("expected_return", "actual_return"), strict=True))))
    refined = refined_rows(said.where("deviation IS NOT NULL AND deviation <> 0"))
    own = scored.select("company_id", "trade_date", "score", "observations")
    return LoopResult(scored, holds.drop(*beside), said.drop(*WEIGHTS, "overall_score"), refined, _weighed(signals.join(own, ["company_id", "trade_date"], "left")))


def recommendations(scored: DataFrame, day: str) -> DataFrame:
    """The labels of one day, best first."""
    rows = scored.where(F.col("trade_date") == F.lit(day).cast("date"))
    return rows.select("company_id", "trade_date", "score", "red_green", "overall_rank").orderBy(F.col("score").desc_nulls_last(), "company_id")


def label_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("trade_date", "red_green").agg(F.count("*").alias("companies"))
