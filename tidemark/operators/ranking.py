"""Point-in-time feature rows, cross-sectional scores, weighted rankings and the decile backtest."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.core import asof_joins, valid, weighted_mean
from tidemark.functions.selection import exact_quantile
from tidemark.functions.shared import stage
from tidemark.operators.indicators import return_columns, with_technical
from tidemark.operators.market import HORIZONS, MULTIPLES_OF, closes_ahead, gain_ahead, known_shares, known_ttm, multiples, ttm_known

TECHNICAL = (
    "sma20", "sma50", "sma100", "sma200", "ema20", "ema50", "rsi14", "macd", "macd_signal", "macd_histogram", "atr14",
    "adx14", "bb_upper", "bb_lower", "volatility20", "relative_volume20",
)
RETURNS = ("return_5d", "return_20d", "return_60d", "return_120d", "return_252d")
RATIOS = ("ebitda_margin", "ebit_margin", "net_profit_margin", "roe", "roa", "debt_to_equity", "debt_to_ebitda", "net_debt_to_ebitda", "asset_turnover", "fcf_to_net_income")
MULTIPLES = ("enterprise_value", "pe", "price_to_sales", "ev_to_ebitda", "price_to_fcf", "earnings_yield", "fcf_yield")

#: Weights of the features in their category, whether high is good, and the least allowed value (exclusive
#: unless inclusive) of those that need one.
CATEGORIES = {
    "momentum": (0.30, {"return_5d": 0.15, "return_20d": 0.30, "return_60d": 0.30, "return_120d": 0.25}),
    "profitability": (0.30, {"roe": 0.25, "roa": 0.15, "ebitda_margin": 0.25, "ebit_margin": 0.15, "net_profit_margin": 0.20}),
    "leverage": (0.15, {"debt_to_equity": 0.35, "debt_to_ebitda": 0.35, "net_debt_to_ebitda": 0.30}),
    "valuation": (0.25, {"pe": 0.30, "price_to_sales": 0.20, "ev_to_ebitda": 0.25, "earnings_yield": 0.25}),
}
LOW_IS_GOOD = ("debt_to_equity", "debt_to_ebitda", "net_debt_to_ebitda", "pe", "price_to_sales", "ev_to_ebitda")
POSITIVE = ("debt_to_ebitda", "pe", "price_to_sales", "ev_to_ebitda")
NOT_NEGATIVE = ("debt_to_equity",)
FEATURES = tuple(f for _, fs in CATEGORIES.values() for f in fs)


def features(metrics: DataFrame, indicators: DataFrame, ttm_rows: DataFrame, ratio_rows: DataFrame, valuation_rows: DataFrame, scope: str = "Consolidated") -> DataFrame:
    """One row per market row: indicators of the day, the TTM row known by then, its ratios, and the day's valuation."""
    base = known_ttm(metrics.select("company_id", "trade_date", "close", "market_cap", "volume"), ttm_rows, scope)
    rows = base.select("company_id", "trade_date", F.lit(scope).alias("statement_scope"), "close", "market_cap", "volume", F.col("ttm_period_end").alias("ttm_period_end"), F.col("ttm_latest_filing_date").alias("ttm_filing_date"))
    tech = indicators.select("company_id", "trade_date", *RETURNS, *[c for c in TECHNICAL if c in indicators.columns])
    ratio_side = ratio_rows.where(F.col("statement_scope") == scope).select("company_id", F.col("period_end").alias("ttm_period_end"), *RATIOS)
    value_side = valuation_rows.where(F.col("statement_scope") == scope).select("company_id", F.col("valuation_date").alias("trade_date"), *MULTIPLES)
    return rows.join(tech, ["company_id", "trade_date"], "left").join(ratio_side, ["company_id", "ttm_period_end"], "left").join(value_side, ["company_id", "trade_date"], "left")


def pit_features(
    prices: DataFrame, share_capital: DataFrame, ttm_rows: DataFrame, ratio_rows: DataFrame, scope: str = "Consolidated", technical: DataFrame | None = None, ahead: tuple[int, ...] = (), dated: bool = False
) -> DataFrame:
    """The rows of features() straight from prices, shares and TTM rows, with nothing stored in between.

    One walk over a company's time line finds the shares and the TTM row known by each date; the ratios, which belong to a
    TTM row, are joined to it before and come along. Returns are windows over the rows found, which lie by company
    already, so prices are shuffled by company once, as narrow rows. technical: more indicators by company and date to join.
    ahead: horizons of forward returns to add, which are not features: they tell what came after; dated: with the days that
    they are of.
    """
    scoped = ttm_rows.where(F.col("statement_scope") == scope)
    with_ratios = scoped.join(ratio_rows.where(F.col("statement_scope") == scope).select("company_id", "period_end", *RATIOS), ["company_id", "period_end"], "left")
    line = prices.select("company_id", "trade_date", "close", "volume")
    known = asof_joins(line, ["company_id"], "trade_date", [known_shares(share_capital), ttm_known(with_ratios, scope, "ttm_", RATIOS, MULTIPLES_OF)])
    rows = known.withColumn("market_cap", F.col("close") * F.col("shares_outstanding"))
    value = multiples()
    base = rows.select(*line.columns, "market_cap", "ttm_period_end", F.col("ttm_latest_filing_date").alias("ttm_filing_date"), *[F.col(f"ttm_{c}").alias(c) for c in RATIOS], *[value[c].alias(c) for c in MULTIPLES])
    later = [F.lead("trade_date", n).over(Window.partitionBy("company_id").orderBy("trade_date")).alias(f"known_{n}d") for n in ahead if dated]
    out = base.select("*", *return_columns(), *closes_ahead(ahead), *later).select(
        "company_id", "trade_date", F.lit(scope).alias("statement_scope"), "close", "market_cap", "volume", "ttm_period_end", "ttm_filing_date", *RETURNS, *RATIOS, *MULTIPLES, *map(gain_ahead, ahead), *[f"known_{n}d" for n in ahead if dated]
    )
    return out if technical is None else out.join(technical.select("company_id", "trade_date", *TECHNICAL), ["company_id", "trade_date"], "left")


def all_features(prices: DataFrame, share_capital: DataFrame, ttm_rows: DataFrame, ratio_rows: DataFrame, scope: str = "Consolidated") -> DataFrame:
    """The rows of features() with every column, straight from prices: what is known by a date is found first, over narrow
    rows, and the indicators are computed beside it, so that wide rows are neither shuffled nor joined."""
    scoped = ttm_rows.where(F.col("statement_scope") == scope)
    with_ratios = scoped.join(ratio_rows.where(F.col("statement_scope") == scope).select("company_id", "period_end", *RATIOS), ["company_id", "period_end"], "left")
    line = prices.select("company_id", "trade_date", "high", "low", "close", "volume")
    known = asof_joins(line, ["company_id"], "trade_date", [known_shares(share_capital), ttm_known(with_ratios, scope, "ttm_", RATIOS, MULTIPLES_OF)])
    value = multiples()
    base = known.withColumn("market_cap", F.col("close") * F.col("shares_outstanding")).select(
        *line.columns, "market_cap", "ttm_period_end", F.col("ttm_latest_filing_date").alias("ttm_filing_date"), *[F.col(f"ttm_{c}").alias(c) for c in RATIOS], *[value[c].alias(c) for c in MULTIPLES]
    )
    keys = ["company_id", "trade_date", F.lit(scope).alias("statement_scope"), "close", "market_cap", "volume", "ttm_period_end", "ttm_filing_date"]
    return with_technical(base).select(*keys, *RETURNS, *TECHNICAL, *RATIOS, *MULTIPLES)


def leaks(feature_rows: DataFrame) -> DataFrame:
    """Feature rows that use a filing from after their date: there must be none."""
    return feature_rows.where("ttm_filing_date > trade_date")


def check_no_leaks(feature_rows: DataFrame) -> DataFrame:
    """feature_rows, after a job that raises ValueError if any of them looks ahead."""
    if not leaks(feature_rows).isEmpty():
        raise ValueError("a feature row uses a filing from after its trade date")
    return feature_rows


def _scores_of(day: pa.Table) -> dict[str, np.ndarray]:
    """The scores of a date's rows by feature, NaN where there is none."""
    out = {}
    for f in FEATURES:
        value = day.column(f).to_numpy()
        held = np.flatnonzero(~np.isnan(value))
        score = np.full(len(value), np.nan)
        known = value[held]
        # how many are smaller: where a value's run of equals begins, dealt back to its rows
        order = np.argsort(known)
        line = known[order]
        starts = np.arange(len(line))
        starts[1:][line[1:] == line[:-1]] = 0
        below = np.empty(len(line), np.int64)
        below[order] = np.maximum.accumulate(starts)
        p = below / max(len(held) - 1, 1)
        score[held] = 1 - p if f in LOW_IS_GOOD else p
        out[f"{f}_score"] = score
    return out


def _mean_of(columns: dict[str, np.ndarray], weights: dict[str, float], least: int) -> np.ndarray:
    """functions.core.weighted_mean, term by term in the same order."""
    there = {c: ~np.isnan(columns[c]) for c in weights}
    above = reduce(np.add, [np.where(there[c], columns[c] * w, 0.0) for c, w in weights.items()])
    below = reduce(np.add, [np.where(there[c], w, 0.0) for c, w in weights.items()])
    enough = reduce(np.add, [h.astype(np.int32) for h in there.values()]) >= least
    return np.divide(above, below, out=np.full(len(above), np.nan), where=enough & (below != 0))


def _ranked_day(day: pa.Table) -> dict[str, np.ndarray | pa.Array]:
    scores = _scores_of(day)
    rows = {f"{c}_score": _mean_of(scores, {f"{f}_score": w for f, w in fs.items()}, 2) for c, (_, fs) in CATEGORIES.items()}
    count = lambda of: reduce(np.add, [(~np.isnan(x)).astype(np.int32) for x in of])
    overall = _mean_of(rows, {f"{c}_score": w for c, (w, _) in CATEGORIES.items()}, 3)
    unscored = np.isnan(overall)
    line = np.sort(overall[~unscored])
    above = len(line) - np.searchsorted(line, overall, side="right")
    counts = {"valid_feature_count": count(scores.values()), "valid_category_count": count(rows.values())}
    return {**rows, **counts, "overall_score": overall, "overall_rank": pa.array((above + 1).astype(np.int32), mask=unscored), "overall_percentile": np.where(unscored, np.nan, 1 - above / max(len(line) - 1, 1))}


_KEYS = ("company_id", "trade_date", "statement_scope")


def _by_date(feature_rows: DataFrame, make: Callable[[pa.Table], dict], columns: str, beside: tuple[str, ...] = ()) -> DataFrame:
    """make(a date's rows) beside their keys and the columns named. Features that don't count are null."""
    floor = {**{f: F.col(f) > 0 for f in POSITIVE}, **{f: F.col(f) >= 0 for f in NOT_NEGATIVE}}
    usable = [F.when(valid(f) & floor.get(f, F.lit(True)), F.col(f).cast("double")).alias(f) for f in FEATURES]

    def run(day: pa.Table) -> pa.Table:
        made = {c: x if isinstance(x, pa.Array) else pa.array(x, from_pandas=True) for c, x in make(day).items()}
        return pa.table({**{k: day.column(k) for k in keep}, **made})

    keep = (*_KEYS, *beside)
    kinds = dict(feature_rows.select(*keep).dtypes)
    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keep], columns])
    return feature_rows.select(*keep, *usable).groupBy("trade_date").applyInArrow(run, schema)


def feature_scores(feature_rows: DataFrame) -> DataFrame:
    """Percentile rank in [0, 1] of each feature among the valid values of its date, turned round where low is good.

    One shuffle, of the feature rows by date; a task sorts each feature of a date on its own. Rows are unique by company,
    date and scope. A date's rows meet in one task, which is the number of companies.
    """
    return _by_date(feature_rows, _scores_of, ", ".join(f"{f}_score double" for f in FEATURES))


_RANKED = ", ".join([*[f"{c}_score double" for c in CATEGORIES], "valid_feature_count int, valid_category_count int, overall_score double, overall_rank int, overall_percentile double"])


def ranked_features(feature_rows: DataFrame, beside: tuple[str, ...] = ()) -> DataFrame:
    """rankings(feature_scores(feature_rows)), equal to the last bit, from one shuffle by date: the scores stay in their task.

    beside: columns of the feature rows to keep."""
    return _by_date(feature_rows, _ranked_day, _RANKED, beside)


def _ranked_with_deciles(day: pa.Table) -> tuple[dict[str, np.ndarray | pa.Array], list[np.ndarray], Callable[[np.ndarray], np.ndarray], pa.Array]:
    """A date's rankings, the rows of each of its deciles, what gives each row its own decile's value, and observations."""
    ranked = _ranked_day(day)
    scored = np.flatnonzero(~np.isnan(ranked["overall_score"]))
    best = scored[np.lexsort((day.column("company_id").to_numpy()[scored], -ranked["overall_score"][scored]))]
    # ntile: the first deciles take one more row each
    size, more = divmod(len(best), 10)
    ends = np.cumsum([size + (i < more) for i in range(10)])
    starts = np.concatenate(([0], ends[:-1]))
    own = np.full(len(ranked["overall_score"]), -1)
    own[scored] = np.maximum(1, 10 - np.floor(ranked["overall_percentile"][scored] * 10)).astype(np.int64) - 1
    of_own = lambda x: np.where(own >= 0, np.append(x, np.nan)[own], np.nan)
    counts = of_own((ends - starts).astype(float))
    return ranked, [best[a:b] for a, b in zip(starts, ends, strict=True)], of_own, pa.array(np.nan_to_num(counts).astype(np.int64), mask=~(counts > 0))


def _judged_day(day: pa.Table, horizons: tuple[int, ...]) -> dict[str, np.ndarray | pa.Array]:
    ranked, members, of_own, observations = _ranked_with_deciles(day)
    made = {"observations": observations}
    for n in horizons:
        r = day.column(f"forward_{n}d_return").to_numpy()
        held = [x[~np.isnan(x)] for x in (r[m] for m in members)]
        made[f"avg_{n}d"] = of_own(np.array([x.mean() if len(x) else np.nan for x in held]))
    return {**ranked, **made}


def _cycle_day(day: pa.Table) -> dict[str, np.ndarray | pa.Array]:
    ranked, members, of_own, observations = _ranked_with_deciles(day)
    r = day.column("actual").to_numpy()
    on = day.column("known_on").cast(pa.int32()).to_numpy().astype(float)
    held = [m[~np.isnan(r[m]) & ~np.isnan(on[m])] for m in members]
    first = [on[m].min() if len(m) else np.nan for m in held]
    expected = [r[m][on[m] == f].mean() if len(m) else np.nan for m, f in zip(held, first, strict=True)]
    days = of_own(np.array(first))
    return {**ranked, "observations": observations, "expected": of_own(np.array(expected)), "expected_on": pa.array(np.nan_to_num(days).astype(np.int32), mask=np.isnan(days)).cast(pa.date32())}


def judged_cycles(feature_rows: DataFrame, horizon: int) -> DataFrame:
    """ranked_features with what closed_loop asks of a ranking: its close, its forward return of a horizon and the day that
    makes it known (actual, known_on), and of its decile on the date (that of its percentile) the observations, and the mean
    return of the members that are known first with that day (expected, expected_on).

    The feature rows hold that forward return and its day (pit_features' ahead and dated) and one scope.
    """
    gain = F.col(f"forward_{horizon}d_return")
    rows = feature_rows.withColumns({"actual": gain, "known_on": F.when(gain.isNotNull(), F.col(f"known_{horizon}d"))})
    made = _by_date(rows, _cycle_day, f"{_RANKED}, observations long, expected double, expected_on date", ("close", "actual", "known_on"))
    return made.drop("statement_scope", "valid_feature_count", "valid_category_count", "overall_rank", "overall_percentile")


def judged_features(feature_rows: DataFrame, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """ranked_features with what the loop asks of a ranking: its close and forward returns, and of its decile on the date
    (that of its percentile) the observations and mean forward returns, as decile_backtest(by_date=True) gives them.

    The feature rows hold forward returns of the horizons (pit_features' ahead) and one scope. A date's rows meet in one task anyway, to be
    ranked, so its deciles are told there, and nothing is joined.
    """
    returns = tuple(f"forward_{n}d_return" for n in horizons)
    return _by_date(feature_rows, partial(_judged_day, horizons=horizons), ", ".join([_RANKED, "observations long", *[f"avg_{n}d double" for n in horizons]]), ("close", *returns))


def rankings(scores: DataFrame) -> DataFrame:
    """Category and overall scores, rank and percentile by date; rows without an overall score stay, unranked.

    A category needs two of its features, the overall score three of the four categories; weights are renormalised over
    what is there. Nothing is rounded here, so that close scores rank apart.
    """
    rows = scores.select(
        "company_id", "trade_date", "statement_scope",
        *[weighted_mean({f"{f}_score": w for f, w in fs.items()}, 2).alias(f"{c}_score") for c, (_, fs) in CATEGORIES.items()],
        reduce(lambda a, b: a + b, [F.col(f"{f}_score").isNotNull().cast("int") for f in FEATURES]).alias("valid_feature_count"),
    )
    rows = rows.withColumn("valid_category_count", reduce(lambda a, b: a + b, [F.col(f"{c}_score").isNotNull().cast("int") for c in CATEGORIES]))
    rows = rows.withColumn("overall_score", weighted_mean({f"{c}_score": w for c, (w, _) in CATEGORIES.items()}, 3))
    scored = F.col("overall_score").isNotNull()
    by = Window.partitionBy("trade_date", scored).orderBy(F.col("overall_score").desc_nulls_last())
    return rows.withColumn("overall_rank", F.when(scored, F.rank().over(by))).withColumn("overall_percentile", F.when(scored, 1 - F.percent_rank().over(by)))


def deciles(ranked: DataFrame) -> DataFrame:
    """Scored rows with their decile by date, 1 the best; equal scores are dealt by company."""
    by = Window.partitionBy("trade_date").orderBy(F.col("overall_score").desc(), "company_id", "statement_scope")
    return ranked.where("overall_score IS NOT NULL").withColumn("decile", F.ntile(10).over(by))


def _means(r: Column) -> dict[str, Column]:
    return {"observations_{}d": F.count(r), "avg_{}d": F.avg(r), "hit_rate_{}d": F.avg(F.when(r > 0, 1.0).when(r.isNotNull(), 0.0))}


def decile_backtest(ranked: DataFrame, returns: DataFrame, start: str | None = None, end: str | None = None, by_date: bool = False) -> DataFrame:
    """Per decile (and date, if by_date): observations, ranking dates, and for each horizon count, mean, median and hit rate.

    In order of date and decile. A date's decile is a tenth of the companies, whose median one task can take. A decile of
    all dates is a tenth of all rows: its medians are selected by refining histograms (functions.selection), over the
    joined rows, which are written once, as are the scores before. By date, ranked should be a written table.
    """
    if not by_date:
        # the formulas of the scores, carried through a filter and a join, would fill the driver's memory with what Spark infers from them
        ranked = stage(ranked.select("company_id", "trade_date", "statement_scope", "overall_score"), "scores")
    rows = deciles(ranked).select("company_id", "trade_date", "decile")
    if start is not None:
        rows = rows.where(F.col("trade_date") >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.where(F.col("trade_date") <= F.lit(end).cast("date"))
    each = {n: F.col(f"forward_{n}d_return") for n in HORIZONS}
    joined = rows.join(returns.select("company_id", "trade_date", *each.values()), ["company_id", "trade_date"]).drop("company_id")
    counts = [F.count("*").alias("observations"), F.count_distinct("trade_date").alias("ranking_dates")]
    order = [f"{c}_{n}d" for n in HORIZONS for c in ("observations", "avg", "median", "hit_rate")]
    if by_date:
        aggs = [a.alias(c.format(n)) for n, r in each.items() for c, a in {**_means(r), "median_{}d": F.percentile(r, 0.5)}.items()]
        found = joined.groupBy("trade_date", "decile").agg(*counts, *aggs)
        return found.select("trade_date", "decile", "observations", "ranking_dates", *order).orderBy("trade_date", "decile")
    held = stage(joined, "backtest")
    # dates first, then deciles, so that no task holds the distinct dates of a decile
    per_day = held.groupBy("decile", "trade_date").agg(F.count("*").alias("n")).groupBy("decile").agg(F.sum("n").alias("observations"), F.count("*").alias("ranking_dates"))
    means = held.groupBy("decile").agg(*[a.alias(c.format(n)) for n, r in each.items() for c, a in _means(r).items()])
    long = held.unpivot(["decile"], [f"forward_{n}d_return" for n in HORIZONS], "horizon", "value")
    medians = exact_quantile(long, ["decile", "horizon"], "value").groupBy("decile").agg(*[F.max(F.when(F.col("horizon") == f"forward_{n}d_return", F.col("quantile"))).alias(f"median_{n}d") for n in HORIZONS])
    found = per_day.join(means, "decile").join(medians, "decile", "left")
    return found.select("decile", "observations", "ranking_dates", *order).orderBy("decile")
