"""Indicators of new days from a state, against one pass over the whole history."""

import datetime as dt
import random

import pandas as pd
import pytest
from tidemark.operators import indicators, smoothing


def history(n=140):
    r = random.Random(8)
    made = []
    for c in (1, 2, 3, 4):
        p = 100.0
        for i in range(n if c < 4 else 5):
            p *= 1 + r.gauss(0, 0.02) if c < 3 else 1  # the third company never moves
            made.append((c, dt.date(2024, 1, 1) + dt.timedelta(days=i), p * (1.01 if c < 3 else 1), p * (0.99 if c < 3 else 1), p))
    return made


@pytest.mark.parametrize("cuts", [[], [60], [1, 2, 70, 139]])
def test_any_cut_gives_what_one_pass_gives(spark, cuts):
    schema = "company_id long, trade_date date, high double, low double, close double"
    whole = {(r["company_id"], r["trade_date"]): r for r in indicators.smoothed(spark.createDataFrame(history(), schema)).collect()}
    start, state, got = dt.date(2024, 1, 1), None, {}
    for end in [*cuts, 140]:
        until = dt.date(2024, 1, 1) + dt.timedelta(days=end)
        part = [m for m in history() if start <= m[1] < until]
        rows, state = smoothing.smooth_on(spark.createDataFrame(part, schema), state)
        found = rows.collect()
        assert len(found) == len(part)
        got.update({(r["company_id"], r["trade_date"]): r for r in found})
        start = until
    assert set(got) == set(whole)
    for k, r in whole.items():
        for c in indicators.SMOOTHED:
            assert (got[k][c] is None and (r[c] is None or pd.isna(r[c]))) or got[k][c] == pytest.approx(r[c], rel=1e-9, abs=1e-9), (k, c)
    assert {r["company_id"] for r in state.collect()} == {1, 2, 3, 4}
