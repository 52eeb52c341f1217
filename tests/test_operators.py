"""Small cases with results worked out by hand."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from tidemark.functions import core
from tidemark.operators import fundamentals, indicators, loop, quarters, verify
from tidemark.sources import calendar, listings, price_files

D = dt.date


def test_rolling_and_return_counts(spark):
    n = 300
    first = D(2025, 1, 1)
    rows = [(1, first + dt.timedelta(i), 100 + i / 3 + 2, 100 + i / 3 - 2, 100 + i / 3, 1e5) for i in range(n)]
    out = indicators.technical_indicators(spark.createDataFrame(rows, "company_id long, trade_date date, high double, low double, close double, volume double"))
    got = out.agg(*[F.count(c).alias(c) for c in ("sma20", "sma200", "return_252d", "ema20", "rsi14", "macd", "macd_signal", "atr14")]).first().asDict()
    assert got == {"sma20": n - 19, "sma200": n - 199, "return_252d": n - 252, "ema20": n - 19, "rsi14": n - 14, "macd": n - 25, "macd_signal": n - 33, "atr14": n - 13}
    assert out.agg(F.min("rsi14")).first()[0] == 100.0  # it only rises


def test_asof_takes_the_best_known_row(spark):
    left = spark.createDataFrame([(1, D(2024, 1, 5)), (1, D(2024, 2, 5)), (2, D(2024, 1, 5))], "k int, day date")
    right = spark.createDataFrame([(1, D(2024, 1, 5), 7, "a"), (1, D(2024, 2, 1), 3, "b"), (1, None, 9, "c")], "k int, known date, period int, v string")
    plain = core.asof_join(left, right, ["k"], "day", "known", ["known"], ["v"])
    assert {(r.k, r.day, r.v) for r in plain.collect()} == {(1, D(2024, 1, 5), "a"), (1, D(2024, 2, 5), "b"), (2, D(2024, 1, 5), None)}
    best = core.asof_join(left, right, ["k"], "day", "known", ["period"], ["v"])
    assert {(r.k, r.day, r.v) for r in best.collect()} == {(1, D(2024, 1, 5), "a"), (1, D(2024, 2, 5), "a"), (2, D(2024, 1, 5), None)}
    strict = core.asof_join(left, right, ["k"], "day", "known", ["known"], ["v"], strict=True)
    assert {(r.k, r.day, r.v) for r in strict.collect()} == {(1, D(2024, 1, 5), None), (1, D(2024, 2, 5), "b"), (2, D(2024, 1, 5), None)}


def test_upsert_keeps_what_it_is_told_to(spark):
    old = spark.createDataFrame([(1, "x", 10), (2, "y", 20)], "id int, tag string, v int")
    new = spark.createDataFrame([(2, None, 21), (3, "z", 30)], "id int, tag string, v int")
    out = core.upsert(old, new, ["id"], {"tag": F.coalesce("n.tag", "o.tag")})
    assert sorted(map(tuple, out.collect())) == [(1, "x", 10), (2, "y", 21), (3, "z", 30)]


def test_labels(spark):
    rows = spark.createDataFrame([(None,), (10.0,), (49.99,), (50.0,), (75.0,), (100.0,)], "s double").select(core.red_green("s").alias("l"))
    assert [r.l for r in rows.collect()] == ["needs_data", "red", "red", "green", "green", "green"]


def test_hold_decisions(spark):
    day = D(2026, 10, 22)
    rows = [(1, None, 1.0, None, None), (2, 10.0, 1.0, None, None), (3, 70.0, None, 5.0, None), (4, 70.0, 6.0, 5.0, None), (5, 70.0, 4.0, 5.0, D(2026, 10, 24)), (6, 70.0, 4.0, None, None)]
    df = spark.createDataFrame([(i, day, *r) for i, *r in rows], "company_id long, trade_date date, score double, close double, sell_target_price double, sell_target_date date")
    got = {r.company_id: (r.action, r.reason, r.hold_until) for r in loop.decide_holds(df).collect()}
    until = D(2026, 10, 24)
    assert got == {
        1: ("pending", "missing_score", None), 2: ("hold", "red_score", None), 3: ("pending", "missing_close_price", until),
        4: ("sell", "target_achieved", until), 5: ("sell", "time_to_target_reached", until), 6: ("hold", "initial_hold", until),
    }
    with pytest.raises(ValueError, match="hold_days"):
        loop.decide_holds(df, 0)


def test_statement_metrics(spark):
    now = {k: F.lit(float(v)) for k, v in dict(revenue=200, ebitda=50, ebit=40, net_income=30, eps=15, total_debt=100, total_equity=200, free_cash_flow=20).items()}
    before = {k: F.lit(float(v)) for k, v in dict(revenue=160, eps=10, free_cash_flow=10).items()}
    got = spark.range(1).select(*[c.alias(k) for k, c in fundamentals.statement_metrics(now, before).items()]).first().asDict()
    assert sorted(round(v, 6) for v in got.values()) == sorted([0.25, 0.5, 1.0, 0.25, 0.20, 0.15, 0.10, 0.5, 0.15])


def test_run_comparison(spark):
    schema = "check_name string, trade_date date, status string, expected long, missing long, actual long"
    row = lambda name, status, actual: (name, D(2024, 1, 1), status, 10, 10 - actual, actual)
    old = spark.createDataFrame([row("a", "PASS", 10), row("b", "PASS", 10), row("c", "PASS", 10)], schema)
    new = spark.createDataFrame([row("a", "FAIL", 9), row("b", "PASS", 10), row("d", "PASS", 10)], schema)
    got = {tuple(r)[0]: [x for x in tuple(r) if x in ("changed", "added", "removed", "unchanged")] for r in verify.compare_runs(old, new).collect()}
    assert got == {"a": ["changed"], "b": ["unchanged"], "c": ["removed"], "d": ["added"]}


def test_calendar_and_archives(spark):
    days = spark.createDataFrame([(D(2024, 1, 24),), (D(2024, 1, 26),), (D(2024, 1, 27),)], "d date").select(calendar.classify(F.col("d")).alias("k"), price_files.archive_name(F.col("d")).alias("a"))
    kinds = [r.k for r in days.collect()]
    assert len(set(kinds)) == 3
    names = spark.createDataFrame([(D(2024, 7, 5),), (D(2024, 7, 8),)], "d date").select(price_files.archive_name(F.col("d")).alias("a")).collect()
    assert names[0].a != names[1].a and "2024" in names[0].a + names[1].a


def test_quarters_derived_in_order(spark):
    figures = ("revenue", "profit_before_tax", "net_income", "eps", "ebit", "ebitda", "operating_cash_flow", "capital_expenditure", "free_cash_flow")
    ytd = ("revenue", "profit_before_tax", "net_income", "finance_costs", "depreciation", "operating_cash_flow", "capital_expenditure")
    schema = "raw_filing_id long, company_id long, statement_scope string, submission_type string, period_type string, period_end date, pnl_context string, pnl_start date, ytd_start date, ytd_end date, cash_flow_start date, cash_flow_end date, period_start date, extra string, "
    schema += ", ".join(f"{c} double" for c in (*figures, *(f"ytd_{c}" for c in ytd)))
    year, ends = D(2024, 4, 1), {1: D(2024, 6, 30), 2: D(2024, 9, 30), 3: D(2024, 12, 31), 4: D(2025, 3, 31)}

    def row(i, quarter, context, company=1, scope="Consolidated", kind="quarterly", dates=(None,) * 5, own=None, to_date=None):
        own, to_date = own or {}, to_date or {}
        return (i, company, scope, "Original", kind, ends[quarter], context, *dates, year, "x", *(own.get(c) for c in figures), *(to_date.get(c) for c in ytd))

    def values(revenue, ocf=None, capex=None):
        return {"revenue": revenue, "profit_before_tax": revenue / 5, "net_income": None, "eps": 1.0, "operating_cash_flow": ocf, "capital_expenditure": capex}

    def sums(revenue, ocf=None, capex=None, **more):
        return {"revenue": revenue, "profit_before_tax": revenue / 5, "operating_cash_flow": ocf, "capital_expenditure": capex, **more}

    direct = (year, None, None, year, ends[1])
    upto = lambda q: (year, year, ends[q], year, ends[q])
    rows = [
        # the first quarter is direct and lends the half year its base; nine months lack a figure; the annual gives the fourth
        row(1, 1, "quarter", dates=direct, own=values(100.0, 10.0, -4.0)),
        row(2, 2, "ytd", dates=upto(2), own=values(240.0), to_date=sums(240.0, 26.0, -9.0)),
        row(3, 3, "ytd", dates=upto(3), own=values(390.0), to_date=sums(390.0, 40.0, None, finance_costs=6.0)),
        row(4, 4, "ytd", dates=(None, year, None, None, None), own=values(560.0), to_date=sums(560.0, finance_costs=9.0)),
        row(5, 4, "ytd", kind="annual", dates=upto(4)[:1] + (None, None) + upto(4)[3:], own=values(560.0, 66.0, -20.0)),
        # no base: another scope, and a null company
        row(6, 2, "ytd", scope="Standalone", dates=upto(2), own=values(240.0), to_date=sums(240.0, 26.0, -9.0)),
        row(7, 1, "quarter", company=None, dates=direct, own=values(1.0, 1.0, 1.0)),
        row(8, 2, "ytd", company=None, dates=upto(2), own=values(3.0), to_date=sums(3.0, 3.0, 3.0)),
        # 74 days are not a quarter, so the half year has no cash flow base
        row(9, 1, "quarter", company=2, dates=(year, None, None, D(2024, 4, 17), ends[1]), own=values(100.0, 10.0, -4.0)),
        row(10, 2, "ytd", company=2, dates=upto(2), own=values(240.0), to_date=sums(240.0, 26.0, -9.0)),
    ]
    made = quarters.derive_quarterly_financials(spark.createDataFrame(rows, schema))
    assert made.columns[13] == "extra" and made.columns[-1] == "derivation_sources"
    got = {r.raw_filing_id: (r.revenue, r.eps, r.ebit, r.operating_cash_flow, r.capital_expenditure, r.free_cash_flow) for r in made.collect()}
    assert got == {
        1: (100.0, 1.0, None, 10.0, -4.0, 6.0), 2: (140.0, None, None, 16.0, -5.0, 11.0), 3: (150.0, None, None, 14.0, None, None),
        4: (170.0, None, 37.0, 26.0, None, None), 5: (560.0, 1.0, None, 66.0, -20.0, None),
        6: (None, None, None, None, None, None), 7: (1.0, 1.0, None, 1.0, 1.0, 0.0), 8: (None, None, None, None, None, None),
        9: (100.0, 1.0, None, 10.0, -4.0, None), 10: (140.0, None, None, None, None, None),
    }
    told = {r.raw_filing_id: [(s.source_filing_id, s.component, s.source_role) for s in r.derivation_sources] for r in made.collect()}
    assert told[1] == told[6] == [] and told[2] == [(2, "PNL", "CURRENT_CUMULATIVE"), (1, "PNL", "PREVIOUS_CUMULATIVE"), (2, "CASH_FLOW", "CURRENT_CUMULATIVE"), (1, "CASH_FLOW", "PREVIOUS_CUMULATIVE")]
    assert told[4] == [(4, "PNL", "CURRENT_CUMULATIVE"), (3, "PNL", "PREVIOUS_CUMULATIVE"), (5, "CASH_FLOW", "ANNUAL_TOTAL"), (3, "CASH_FLOW", "PREVIOUS_CUMULATIVE")]
    assert quarters.derive_quarterly_financials(spark.createDataFrame([], schema)).count() == 0


def test_filing_list_and_index_history(spark):
    body = json.dumps({"data": [
        {"symbol": "", "cmName": None, "smName": "Short", "qe_Date": "31-Mar-2024", "type_Sub": "", "consolidated": "Standalone", "seq_Id": 7, "extra": "x"},
        {"symbol": "B", "cmName": "Bee", "qe_Date": "30-Jun-2024", "type_Sub": "Revision"},
        {"symbol": "C", "qe_Date": ""}, {"symbol": "D"},
    ]})
    got = listings.filing_list(spark.createDataFrame([("a", body), ("b", None), ("c", '{"data": []}'), ("d", "no JSON")], "symbol string, body string")).collect()
    rows = {(r.symbol, r.company_name, r.period_end, r.submission_type, r.statement_scope, r.source_reference) for r in got}
    assert rows == {("A", "Short", D(2024, 3, 31), "Unknown", "Standalone", "7"), ("B", "Bee", D(2024, 6, 30), "Revision", "Unknown", None)}
    assert {r.raw.get("extra") for r in got} == {"x", None}
    days = [{"CLOSE": "1.5"}, {"CLOSE": "2"}]
    bodies = spark.createDataFrame([(json.dumps({"d": json.dumps(days)}),), (json.dumps({"d": days}),), (None,), ('{"d": []}',)], "body string")
    assert sorted(r.row["CLOSE"] for r in listings.index_history(bodies).collect()) == ["1.5", "1.5", "2", "2"]


def test_pending_outcomes_are_resolved(spark):
    day = D(2024, 1, 1)
    outcomes = spark.createDataFrame(
        [(1, day, 20, None, None, None, "pending"), (2, day, 5, 0.5, None, None, "pending"), (3, day, 5, 0.1, 0.2, -0.1, "verified"), (4, day, 20, None, None, None, "pending")],
        "company_id long, trade_date date, horizon int, expected_return double, actual_return double, deviation double, status string",
    )
    holds = spark.createDataFrame([(1, day, D(2024, 1, 21)), (2, day, D(2024, 1, 4))], "company_id long, trade_date date, hold_until date")
    ranked = spark.createDataFrame([(c, day, 1, 0.95) for c in (1, 2, 4)], "company_id long, trade_date date, overall_rank int, overall_percentile double")
    decile = ranked.select(loop.decile_of("overall_rank", "overall_percentile")).first()[0]
    stats = spark.createDataFrame([(day, decile, 0.25, 0.75, 1.0)], "trade_date date, decile int, avg_5d double, avg_20d double, avg_60d double")
    returns = spark.createDataFrame([(1, day, 0.0, 0.5, 0.0), (2, day, 0.25, 0.0, 0.0)], "company_id long, trade_date date, forward_5d_return double, forward_20d_return double, forward_60d_return double")
    got = {r.company_id: (r.expected_return, r.actual_return, r.deviation, r.status) for r in loop.resolve_pending(outcomes, holds, ranked, returns, stats).collect()}
    assert got[1] == (0.75, 0.5, 0.25, "verified") and got[2] == (0.5, 0.25, 0.25, "verified") and got[3] == (0.1, 0.2, -0.1, "verified")
    assert got[4][1:] == (None, None, "pending") and len(got) == 4
    assert loop.resolve_pending(outcomes.where("false"), holds, ranked, returns, stats).count() == 0
