"""Queries over whole tables against brute force."""

import datetime as dt
from collections import defaultdict

from pyspark.sql import functions as F
from tidemark.operators import indicators, loop, ranking
from tidemark.plans.fixtures import load
from tidemark.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def test_versions_of_all_companies(spark):
    filings = defaultdict(list)
    for r in load(spark, SMALL, "statements").where("period_type = 'quarterly' AND statement_scope = 'Consolidated' AND filing_date IS NOT NULL").collect():
        filings[r.company_id].append((r.period_end, r.filing_date, r.source_reference, (r.submission_type, r.period_end)))
    want = []
    for company, rows in filings.items():
        for period, as_of, target, _ in rows:
            for of in {p for p, day, _, _ in rows if day <= as_of}:
                last = max(day for p, day, _, _ in rows if p == of and day <= as_of)
                same = [(i, content) for p, day, i, content in rows if p == of and day == last]
                if len({content for _, content in same}) == 1:
                    ids = [i for i, _ in same if i is not None]
                    want.append((company, target, period, of, target if target in ids else min(ids, default=None), last))
    got = [tuple(r) for r in QUERIES["pit_versions"](spark, SMALL).select("company_id", "target_id", "target_period", "period_end", "version_id", "effective_at").collect()]
    assert len(filings) > 20 and {r[0] for r in got} == set(filings)
    assert sorted(got, key=str) == sorted(set(want), key=str)


def test_day_upserted_into_the_whole_price_table(spark, sf_dir):
    traded = {r.id for r in load(spark, sf_dir, "companies").where("series = 'EQ'").collect()}
    day = dt.date(1998, 1, 5)
    want = {(r.company_id, r.trade_date): r.close + (r.trade_date == day and r.company_id in traded) for r in load(spark, sf_dir, "daily_prices").collect()}
    got = {(r.company_id, r.trade_date): r.close for r in QUERIES["price_upsert"](spark, sf_dir).collect()}
    assert min(d for _, d in got) < dt.date(1998, 1, 1)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_runs_compared_over_all_dates(spark, sf_dir):
    got = {r.check_name: r for r in QUERIES["verification_compare_all"](spark, sf_dir).collect()}
    days = {str(r[0]) for r in load(spark, sf_dir, "daily_prices").join(load(spark, sf_dir, "companies").where("is_active"), F.col("company_id") == F.col("id")).select("trade_date").distinct().collect()}
    assert {n for n, r in got.items() if r.new_status is not None} == days
    assert sum(r.old_status is not None for r in got.values()) == len(days)


def test_feature_rows_have_all_columns(spark, sf_dir):
    got = QUERIES["pit_features_all"](spark, sf_dir)
    assert {*ranking.TECHNICAL, *ranking.RETURNS, *ranking.RATIOS, *ranking.MULTIPLES, "close", "market_cap", "volume"} <= set(got.columns)
    want = {(r.company_id, r.trade_date): r for r in indicators.technical_indicators(load(spark, sf_dir, "daily_prices")).collect()}
    rows = got.collect()
    assert all(r[c] == want[r.company_id, r.trade_date][c] for r in rows for c in ("sma20", "sma50", "bb_upper", "bb_lower") if (r.company_id, r.trade_date) in want)
    assert sum(r.sma20 is not None for r in rows) > 0


def test_decisions_are_those_of_a_run_day_by_day(spark):
    scores = {1: [60, 70, 40, 80, 90, 55, None, 51, 50], 2: [10, 60, 60], 3: [75], 4: [None, 99, 20, 99, 99]}
    rows = [(c, dt.date(2026, 1, 1) + dt.timedelta(2 * i * c + i % 2), s and float(s)) for c, of in scores.items() for i, s in enumerate(of)]
    scored = spark.createDataFrame(rows, "company_id long, trade_date date, score double")
    prices = scored.select("company_id", "trade_date", F.lit(5.0).alias("close"))
    want = set()
    for company in scores:
        last = None
        for _, day, score in sorted((r for r in rows if r[0] == company), key=lambda r: r[1]):
            green = score is not None and score >= 50
            target = (last[1] or last[0]) if green and last else None
            until = day + dt.timedelta(2) if green else None
            action = "pending" if score is None else "sell" if target and until >= target else "hold"
            want.add((company, day, action, until, target))
            last = (until, target)
    got = loop.hold_stage(scored, prices, loop.decision_history(scored)).select("company_id", "trade_date", "action", "hold_until", "sell_target_date").collect()
    assert {tuple(r) for r in got} == want and len({r.company_id for r in got if r.action == "sell"}) == 3


def test_decisions_of_all_companies_meet_their_targets(spark, sf_dir):
    got = QUERIES["hold_decisions_all"](spark, sf_dir).where("reason = 'time_to_target_reached'").select("company_id").distinct()
    assert got.where("company_id % 3 <> 0").count() > 0
