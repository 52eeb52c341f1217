"""The loop over rankings that hold their evidence, and sums of decimals in whole units."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.shared import stage
from tidemark.operators import fundamentals, loop, market, ranking
from tidemark.plans import fixtures, queries
from tidemark.plans.fixtures import load


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _features(spark, companies=47, days=90):
    pick = random.Random(3)
    draw = lambda: pick.choice([None, float("nan"), 0.5, 0.5, -1.0, pick.random(), pick.random()])
    rows = [(c, dt.date(2026, 1, 1) + dt.timedelta(d), "Consolidated", None if pick.random() < 0.05 else 10 + 5 * pick.random(), *[draw() for _ in ranking.FEATURES]) for c in range(companies) for d in range(days) if d or c < 7]
    made = spark.createDataFrame(rows, "company_id long, trade_date date, statement_scope string, close double, " + ", ".join(f"{f} double" for f in ranking.FEATURES))
    returns = market.forward_returns(made.select("company_id", "trade_date", "close"))
    return made, returns, made.join(returns.select("company_id", "trade_date", *[f"forward_{n}d_return" for n in market.HORIZONS]), ["company_id", "trade_date"])


def _rows(df):
    return sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in df.collect())


@pytest.mark.parametrize("history", [False, True])
def test_loop_over_judged_rankings_is_the_loop(spark, history):
    made, returns, features = _features(spark)
    ranked = ranking.ranked_features(made)
    stats = ranking.decile_backtest(ranked, returns, by_date=True)
    overrides = spark.sql("SELECT 3L AS company_id, DATE'2026-01-02' AS trade_date, 4.5D AS score_adjustment, true AS applied")
    signals = spark.sql("SELECT id % 50 AS company_id, date_add(DATE'2026-01-01', CAST(id % 90 AS INT)) AS trade_date, 'positive' AS sentiment, 0.5D AS score_adjustment, 'a' AS source, id AS signal_id FROM range(300)")
    prior = spark.sql("SELECT id AS company_id, DATE'2026-01-03' AS trade_date, 11.0D AS sell_target_price, DATE'2026-02-01' AS sell_target_date, DATE'2026-01-05' AS hold_until FROM range(20)")
    if history:
        prior = loop.decision_history(loop.apply_overlay(ranked, overrides, score_scale=100.0))
    want = loop.run_loop(ranked, made, returns, signals, stats, prior, overrides, score_scale=100.0)
    got = loop.run_loop_judged(ranking.judged_features(features), signals, None if history else prior, overrides, score_scale=100.0)
    for part in ("holds", "outcomes", "refined", "overrides"):
        a, b = getattr(got, part), getattr(want, part)
        assert dict(a.dtypes) == dict(b.dtypes), part
        found = _rows(a.select(b.columns))
        assert found and found == _rows(b), part


def test_outcomes_join_nothing_to_the_rankings(spark, sf_dir):
    for name in ("outcomes_all", "hold_decisions_all", "refinement_all"):
        plan = _plan(queries.QUERIES[name](spark, sf_dir))
        above = plan[: plan.index("FlatMapGroupsInArrow")]
        # rankings go back to their companies once, and a walk along their days does the rest
        assert "Join" not in above and above.count("Exchange hashpartitioning") == 1, name
    plan = _plan(queries.QUERIES["outcomes"](spark, sf_dir))
    assert "Join" not in plan and "lineitem" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_overlay_shuffles_no_ranking(spark, sf_dir):
    plan = _plan(queries.QUERIES["overlay"](spark, sf_dir))
    above = plan[: plan.index("FlatMapGroupsInArrow")]
    assert "Exchange" not in above and "Join" not in above


def test_features_ahead_are_forward_returns(spark, sf_dir):
    prices, t = load(spark, sf_dir, "daily_prices"), fundamentals.ttm(fundamentals.canonical(load(spark, sf_dir, "statements")))
    rows = ranking.pit_features(prices, load(spark, sf_dir, "share_capital"), t, fundamentals.ratios(t), ahead=market.HORIZONS)
    columns = ["company_id", "trade_date", *[f"forward_{n}d_return" for n in market.HORIZONS]]
    assert sorted(rows.select(columns).collect(), key=str) == sorted(market.forward_returns(prices).select(columns).collect(), key=str)
    # windows over the rows found lie on their line: one sort for all
    assert _plan(rows).count("Sort [company_id") - _plan(rows.drop(*columns[2:])).count("Sort [company_id") == 0


def test_sums_in_units_are_the_sums_of_decimals(spark):
    odd = [1.005, 2.675, 0.005, -0.005, -1.005, 0.015, 1.115, 8.345, 0.285, 1e-9, -0.0, 99999999.995, 1e8, 123456789012.345, 1.5e13, 4.35, 33.33, -7.77, 5e-324]
    pick = random.Random(5)
    draws = [pick.choice([round(pick.uniform(-1e5, 1e5), k) for k in range(6)]) for _ in range(3000)] + [k / 1000 for k in range(-3000, 3000)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate([*odd, *draws, None])] + [(i % 90 - 100, x) for i, x in enumerate(draws)], "id long, x double")
    for digits in (2, 4):
        text = f"SELECT id, CAST(sum(CAST(x AS DECIMAL(18, {digits}))) AS DOUBLE) AS total, CAST(sum(CAST(x * (1 - 0.07D) AS DECIMAL(18, {digits}))) AS DOUBLE) AS net FROM {{rows}} GROUP BY id"
        fast = fixtures.in_units(text)
        assert "sum(CAST" not in fast
        assert _by_id(spark.sql(fast, rows=rows)) == _by_id(spark.sql(text, rows=rows))
    large = spark.range(3).select(F.lit(9.1e15).alias("x"))
    text = "SELECT CAST(sum(CAST(x AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM {rows}"
    assert spark.sql(fixtures.in_units(text), rows=large).collect() == spark.sql(text, rows=large).collect()


def _by_id(df):
    return {r[0]: tuple(map(repr, r[1:])) for r in df.collect()}


def test_refinement_moves_green_rows_of_one_horizon(spark, sf_dir, monkeypatch):
    written = {}

    def keep(df, name):
        written[name] = df
        return stage(df, name)

    monkeypatch.setattr(queries, "stage", keep)
    for name in ("refinement", "outcomes"):
        queries.QUERIES[name](spark, sf_dir)
        rows = written["judged"]
        assert rows.count() > 0 and rows.where("overall_score IS NULL OR overall_score * 100 < 50").count() == 0
        assert not {"overall_rank", "statement_scope", "avg_20d", "forward_60d_return"} & set(rows.columns)
