"""Companies smoothed together against pandas, one at a time."""

import datetime as dt
import random

import pandas as pd
import pyarrow as pa
import pytest
from tidemark.operators import smoothing

SCHEMA = "company_id long, trade_date date, high double, low double, close double"


def _alone(days):
    high, low, close = (pd.Series([d[i] for d in days], dtype=float) for i in (2, 3, 4))
    ewm = lambda s, alpha, n: s.ewm(alpha=alpha, adjust=False, min_periods=n).mean()
    step, before = close.diff(), close.shift()
    gain, loss = ewm(step.clip(lower=0), 1 / 14, 14), ewm(-step.clip(upper=0), 1 / 14, 14)
    macd = ewm(close, 2 / 13, 12) - ewm(close, 2 / 27, 26)
    atr = ewm(pd.concat([high - low, (high - before).abs(), (low - before).abs()], axis=1).max(axis=1), 1 / 14, 14)
    return {"ema50": ewm(close, 2 / 51, 50), "rsi14": (100 - 100 / (1 + gain / loss)).mask(loss == 0, 100.0), "macd_signal": ewm(macd, 0.2, 9), "atr14": atr}


@pytest.mark.parametrize("rows", [1, 4, 9, 100])
def test_no_company_is_cut(monkeypatch, rows):
    monkeypatch.setattr(smoothing, "ROWS", rows)
    numbers = [n for length in (3, 1, 12, 2, 2, 5) for n in range(1, length + 1)]
    batches = [pa.RecordBatch.from_pydict({"_n": numbers[i : i + 3]}) for i in range(0, len(numbers), 3)]
    got = [t.column("_n").to_pylist() for t in smoothing._whole_companies(batches)]
    assert sum(got, []) == numbers and all(g[0] == 1 for g in got) and (len(got) > 1) == (rows < len(numbers))


def test_many_companies_at_once(spark):
    r, made = random.Random(3), []
    for c in range(12):
        for i in range(r.choice([1, 13, 60, 90])):
            p = 100 + r.gauss(0, 5)
            made.append((c, dt.date(2024, 1, 1) + dt.timedelta(i), None if i == 30 else p + 1, p - 1, None if i in (0, 20) else p))
    got = {(x.company_id, x.trade_date): x for x in smoothing.smoothed(spark.createDataFrame(made, SCHEMA)).collect()}
    assert len(got) == len(made)
    for c in range(12):
        days = [m for m in made if m[0] == c]
        for name, line in _alone(days).items():
            for d, want in zip(days, line):
                found = got[c, d[1]][name]
                assert found is None if pd.isna(want) else found == pytest.approx(want, rel=1e-12), (c, d[1], name)


def test_no_python_call_for_each_company(spark):
    plan = smoothing.smoothed(spark.createDataFrame([(1, dt.date(2024, 1, 1), 1.0, 1.0, 1.0)], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan
