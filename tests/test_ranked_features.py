"""Scores and rankings of a date in one pass."""

import datetime as dt
import random

from tidemark.operators import ranking


def _rows(spark, companies, days):
    pick = random.Random(7)
    draw = lambda: pick.choice([None, float("nan"), 0.0, -0.0, -1.5, 0.25, 2.0, pick.random()])
    rows = [(c, dt.date(2026, 1, 1) + dt.timedelta(d), "Consolidated", *[draw() if c else 1.0 for _ in ranking.FEATURES]) for d in range(days) for c in range(companies) if d or not c]
    return spark.createDataFrame(rows, "company_id long, trade_date date, statement_scope string, " + ", ".join(f"{f} double" for f in ranking.FEATURES))


def test_one_pass_ranks_like_two(spark):
    rows = _rows(spark, 60, 8)
    two = ranking.rankings(ranking.feature_scores(rows))
    one = ranking.ranked_features(rows)
    assert dict(one.dtypes) == dict(two.dtypes)
    assert sorted(map(str, one.select(two.columns).collect())) == sorted(map(str, two.collect()))


def test_scores_are_percent_ranks(spark):
    rows = _rows(spark, 40, 3).collect()
    got = {(r.company_id, r.trade_date): r for r in ranking.feature_scores(_rows(spark, 40, 3)).collect()}
    for r in rows:
        for f in ranking.FEATURES:
            ok = lambda x, f=f: x is not None and x == x and (x > 0 if f in ranking.POSITIVE else x >= 0 if f in ranking.NOT_NEGATIVE else True)
            line = [o[f] for o in rows if o.trade_date == r.trade_date and ok(o[f])]
            p = sum(x < r[f] for x in line) / max(len(line) - 1, 1) if ok(r[f]) else None
            want = None if p is None else 1 - p if f in ranking.LOW_IS_GOOD else p
            assert got[r.company_id, r.trade_date][f"{f}_score"] == want


def test_scores_take_no_row_for_each_feature(spark):
    plan = ranking.ranked_features(_rows(spark, 5, 2))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange") == 1
