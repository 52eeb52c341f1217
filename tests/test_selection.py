"""Exact medians by refinement, as-of joins of several sides at once, and feature rows from one walk."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F
from tidemark.functions.core import Known, asof_joins
from tidemark.functions.selection import exact_quantile
from tidemark.operators import fundamentals, indicators, market, ranking
from tidemark.plans.fixtures import load


def groups():
    r = random.Random(5)
    return {
        "even": [r.gauss(0, 1) for _ in range(1000)],
        "odd": [r.gauss(0, 1e-9) for _ in range(777)],
        "heavy": [r.choice((-1, 1)) * 10 ** r.uniform(-300, 300) for _ in range(901)] + [1.7e308, -1.7e308],
        "same": [4.25] * 500,
        "ties": [float(r.randint(0, 3)) for _ in range(600)],
        "two": [1.0, 2.0],
        "one": [-7.5],
        "close": [1.0 + i * 2**-52 for i in range(300)],
        None: [3.0, 1.0, 2.0],
    }


@pytest.mark.parametrize(("bins", "last"), [(64, 40), (4096, 100_000)])
def test_quantiles_are_exact_for_any_number_of_bins(spark, bins, last):
    made = [(k, v) for k, vs in groups().items() for v in vs] + [("even", None), ("even", math.nan), ("empty", None)]
    random.Random(1).shuffle(made)
    rows = spark.createDataFrame(made, "k string, v double")
    got = {r["k"]: r["quantile"] for r in exact_quantile(rows, ["k"], "v", bins=bins, last=last).collect()}
    assert got == {k: pytest.approx(statistics.median(vs), rel=1e-15) for k, vs in groups().items()}
    tenth = {r["k"]: r["quantile"] for r in exact_quantile(rows, ["k"], "v", 0.1, bins, last).collect()}
    for k, vs in groups().items():
        at, vs = 0.1 * (len(vs) - 1), sorted(vs)
        low, high = vs[math.floor(at)], vs[math.ceil(at)]
        assert tenth[k] == pytest.approx((1 - (at - math.floor(at))) * low + (at - math.floor(at)) * high, rel=1e-12), k
    assert exact_quantile(rows.limit(0), ["k"], "v").count() == 0


def test_no_task_of_the_backtest_holds_a_decile(spark, sf_dir):
    """The medians come out right when at most 20 values may be sorted together."""
    rows = spark.range(5000).select((F.col("id") % 3).alias("k"), F.rand(3).alias("v"))
    whole = {r["k"]: r["m"] for r in rows.groupBy("k").agg(F.percentile("v", 0.5).alias("m")).collect()}
    assert {r["k"]: r["quantile"] for r in exact_quantile(rows, ["k"], "v", bins=64, last=20).collect()} == pytest.approx(whole)


def test_several_sides_are_joined_as_of_in_one_walk(spark):
    left = spark.createDataFrame([(c, d) for c in (1, 2, None) for d in range(10)], "c int, d int")
    a = spark.createDataFrame([(1, 0, "a0"), (1, 4, "a4"), (2, 9, "a9"), (1, None, "never")], "c int, at int, v string")
    b = spark.createDataFrame([(1, 4, 9, "b9"), (1, 6, 3, "b3"), (2, 0, 1, "b1")], "c int, at int, best int, w string")
    got = {(r["c"], r["d"]): (r["x_v"], r["w"]) for r in asof_joins(left, ["c"], "d", [Known(a, "at", ["at"], ["v"], "x_", strict=True), Known(b, "at", ["best"], ["w"])]).collect()}
    assert len(got) == 30
    for (c, d), found in got.items():
        va = max(((r["at"], r["v"]) for r in a.collect() if r["c"] == c and r["at"] is not None and r["at"] < d), default=(None, None))[1]
        vb = max(((r["best"], r["w"]) for r in b.collect() if r["c"] == c and r["at"] <= d), default=(None, None))[1]
        assert found == ((va, vb) if c is not None else (None, None))


def test_feature_rows_of_one_walk_are_those_of_the_stored_parts(spark, sf_dir):
    prices, shares = load(spark, sf_dir, "daily_prices"), load(spark, sf_dir, "share_capital")
    t = fundamentals.ttm(fundamentals.canonical(load(spark, sf_dir, "statements")))
    metrics, ratios = market.market_metrics(prices, shares), fundamentals.ratios(t)
    stored = ranking.features(metrics, indicators.period_returns(prices), t, ratios, market.valuations(metrics, t))
    walked = ranking.pit_features(prices, shares, t, ratios)
    assert sorted(stored.columns) == sorted(walked.columns)
    names = sorted(stored.columns)
    assert stored.select(*names).exceptAll(walked.select(*names)).count() == 0 and stored.count() == walked.count()


def test_scores_are_percent_ranks_of_the_valid_values(spark):
    r = random.Random(2)
    made = [(c, f"2024-01-{d:02d}", "Consolidated", *[r.choice((None, math.nan, -1.0, 0.0, 1.0, r.random())) for _ in ranking.FEATURES]) for d in range(1, 5) for c in range(12)]
    made.append((1, "2024-02-01", "Consolidated", *[0.5 for _ in ranking.FEATURES]))
    rows = spark.createDataFrame(made, "company_id long, trade_date string, statement_scope string, " + ", ".join(f"{f} double" for f in ranking.FEATURES))
    got = {(x["company_id"], x["trade_date"]): x for x in ranking.feature_scores(rows).collect()}
    for i, f in enumerate(ranking.FEATURES):
        ok = lambda v, f=f: v is not None and not math.isnan(v) and (v > 0 or f not in ranking.POSITIVE) and (v >= 0 or f not in ranking.NOT_NEGATIVE)
        for c, d, *_, in made:
            day = {m[0]: m[3 + i] for m in made if m[1] == d and ok(m[3 + i])}
            if c not in day:
                assert got[c, d][f"{f}_score"] is None
                continue
            p = sum(v < day[c] for v in day.values()) / (len(day) - 1) if len(day) > 1 else 0.0
            assert got[c, d][f"{f}_score"] == pytest.approx(1 - p if f in ranking.LOW_IS_GOOD else p, abs=1e-15), (c, d, f)
