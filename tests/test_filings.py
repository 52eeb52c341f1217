"""Version intervals against brute force, filings that don't parse, statement metadata, and signals without a ranking."""

import random

from pyspark.sql import functions as F
from tidemark.operators import audit, loop
from tidemark.sources import filings, shareholding


def test_versions_equal_brute_force(spark):
    r = random.Random(4)
    made = [(r.choice((1, 1, 1, 2, 3, None)), f"p{r.randint(0, 5)}", r.choice((None, *range(12))), f"f{i}", r.choice("ab")) for i in range(160)]
    df = spark.createDataFrame([*made, made[0]], "company_id int, period_end string, effective_at int, filing_id string, content_hash string").withColumn("slot", F.lit("clash"))
    known = [m for m in {*made} if m[0] is not None and m[2] is not None]
    want = set()
    for c, p, at, f, _ in known:
        for period in {m[1] for m in known if m[0] == c}:
            seen = [m for m in known if m[0] == c and m[1] == period and m[2] <= at]
            best = [m for m in seen if m[2] == max(x[2] for x in seen)] if seen else []
            if best and len({m[4] for m in best}) == 1:
                ids = {m[3] for m in best}
                want.add((c, f, p, period, f if f in ids else min(ids), best[0][2]))
    got = [tuple(x) for x in audit.point_in_time_versions(df.drop("slot")).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    intervals = audit.version_intervals(df).collect()
    assert {(x["company_id"], x["period_end"], x["effective_at"]) for x in intervals} == {(m[0], m[1], m[2]) for m in known}
    for x in intervals:
        later = sorted({m[2] for m in known if m[:2] == (x["company_id"], x["period_end"]) and m[2] > x["effective_at"]})
        times = sorted({m[2] for m in known if m[0] == x["company_id"]})
        assert x["until"] == (later[0] if later else None) and x["slot"] == times.index(x["effective_at"]) + 1
        assert x["next_slot"] == (times.index(later[0]) + 1 if later else len(times) + 1)
    assert audit.point_in_time_versions(df.drop("slot").limit(0)).count() == 0


def test_a_broken_shareholding_filing_yields_its_total(spark):
    whole = '<xbrl><context id="ShareholdingPattern_ContextI"/><NumberOfShares contextRef="ShareholdingPattern_ContextI">900</NumberOfShares></xbrl>'
    made = [(1, whole), (2, whole[:-7]), (3, "<x><in:NumberOfShares a='1'> 12.0 </in:NumberOfShares><NumberOfShares>7</NumberOfShares>"), (4, "<x>nothing"), (5, "")]
    docs = spark.createDataFrame([(i, 10 * i, "2024-03-31", t) for i, t in made], "filing_id long, company_id long, period_end string, content string").withColumn("period_end", F.col("period_end").cast("date"))
    got = {r["filing_id"]: (r["company_id"], r["total_shares"], r["error"] is None) for r in shareholding.extract(docs).collect()}
    assert got == {1: (10, 900, True), 2: (20, 900, False), 3: (30, 12, False), 4: (40, None, False), 5: (50, None, False)}


def test_dates_and_standards_of_statements(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "filing_id long, period_type string")
    found = [(1, "05-Feb-2024 18:30:00", "2024-02-01", "x/INDAS_1.xml"), (2, "soon", "2024-02-02", "x/indas"), (3, None, None, "x/other"), (1, "01-Jan-2020 00:00:00", "2019-12-31", "old")]
    catalogue = spark.createDataFrame(found, "filing_id long, broadcast string, effective_date string, url string").withColumn("effective_date", F.col("effective_date").cast("date"))
    got = {r["filing_id"]: (str(r["filing_date"]), r["reporting_standard"]) for r in filings.dated(rows, catalogue).collect()}
    assert got == {1: ("2024-02-05", "Ind AS"), 2: ("2024-02-02", "Ind AS"), 3: ("None", None), 4: ("None", None)}


def test_a_signal_without_a_ranking_is_rejected_and_kept(spark):
    signals = spark.createDataFrame([(1, "2024-01-01", "positive", 5.0, "x"), (2, "2024-01-01", "positive", 5.0, "x"), (1, "2024-01-01", None, 5.0, "y")], "company_id long, trade_date string, sentiment string, score_adjustment double, source string")
    scored = spark.createDataFrame([(1, "2024-01-01", 60.0, 1, 1.0)], "company_id long, trade_date string, score double, overall_rank int, overall_percentile double")
    stats = spark.createDataFrame([("2024-01-01", 1, 10)], "trade_date string, decile int, observations long")
    got = {(r["company_id"], r["source"]): (r["original_score"], r["adjusted_score"], r["significance_status"], r["applied"]) for r in loop.override_stage(signals, scored, stats).collect()}
    assert got == {(1, "x"): (60.0, 65.0, "confirmed", True), (2, "x"): (None, None, "rejected", False), (1, "y"): (60.0, 60.0, "rejected", False)}
