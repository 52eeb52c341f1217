"""The loop over dates against a program that runs it day by day, and runs that start from what others stored."""

import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tidemark.functions.shared import stage
from tidemark.operators import closed_loop, loop, market, ranking
from tidemark.operators.closed_loop import Stored
from tidemark.plans import queries
from tidemark.sinks import tables
from tidemark.sinks.store import Store

SEED, DAYS, COMPANIES = 7, 26, 23
CATS = list(loop.WEIGHTS)


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i + 2 * (i // 5))


def make():
    r = random.Random(SEED)
    prices, ranked, signals = [], [], []
    for d in range(DAYS):
        here = [c for c in range(COMPANIES) if c % 4 or r.random() < 0.6]
        prices += [(c, day(d), r.choice((0.0, 10 + r.random(), 20 + r.random(), 30 + r.random()))) if r.random() < 0.1 else (c, day(d), 10 + r.random() * 5) for c in here]
        scores = {c: r.choice((None, r.random(), 0.4 + r.random() / 5)) for c in here}
        order = sorted((c for c in here if scores[c] is not None), key=lambda c: -scores[c])
        n = len(order)
        for c in here:
            cats = [r.random() if r.random() < 0.8 else None for _ in CATS]
            rank = None if scores[c] is None else 1 + sum(scores[o] > scores[c] for o in order)
            ranked.append((c, day(d), "Consolidated", *cats, scores[c], rank, None if rank is None else 1 - (rank - 1) / max(1, n - 1)))
        for c in r.sample(range(COMPANIES + 2), 8):
            for k in range(r.randint(1, 2)):
                signals.append((c, day(d), r.choice(("positive", "negative", "neutral", None)), r.choice((None, 0.0, r.uniform(-30, 30))), r.choice(("x", "y")), 100 * d + k))
    signals.append((1, day(0) - dt.timedelta(days=1), "positive", 5.0, "x", 1))
    return prices, ranked, signals


def day_by_day(prices, ranked, signals, observations_least):
    """All cycles in turn over dictionaries, as one would run them each evening."""
    close, line = {(c, d): p for c, d, p in prices}, defaultdict(list)
    for c, d, _ in prices:
        line[c].append(d)
    rows = {(r[0], r[1]): r for r in ranked}
    tenth = {}
    for d in {r[1] for r in ranked}:
        best = sorted((r for r in ranked if r[1] == d and r[7] is not None), key=lambda r: (-r[7], r[0]))
        size, more = divmod(len(best), 10)
        cuts = [k + 1 for k in range(10) for _ in range(size + (k < more))]
        tenth.update({(r[0], d): k for r, k in zip(best, cuts, strict=True)})

    def actual(c, d, today):
        days = line[c]
        i = days.index(d) + 5 if d in days else len(days)
        if i >= len(days) or days[i] > today or not (close[c, d] > 0 and close[c, days[i]] > 0):
            return None
        return close[c, days[i]] / close[c, d] - 1

    def decile(c, d):
        r = rows.get((c, d))
        return None if r is None or r[8] is None else max(1, 10 - math.floor(r[9] * 10))

    def expected(c, d, today):
        known = [x for o in range(COMPANIES) if tenth.get((o, d)) == decile(c, d) and (x := actual(o, d, today)) is not None]
        return sum(known) / len(known) if known and decile(c, d) is not None else None

    holds, outs, refined, overs = {}, {}, {}, {}
    for today in sorted({r[1] for r in ranked}):
        fresh = {}
        for (c, d), r in rows.items():
            if d != today:
                continue
            delta = [o["score_adjustment"] for (oc, od, _), o in overs.items() if oc == c and od < today and o["applied"]]
            score = None if r[7] is None else r[7] * 100 if not delta else max(0.0, min(100.0, r[7] * 100 + sum(delta)))
            fresh[c] = score
            green = score is not None and score >= 50
            prior = max(((k[1], h) for k, h in holds.items() if k[0] == c and k[1] < today), key=lambda x: x[0], default=(None, None))[1]
            target = (prior["sell_target_date"] or prior["hold_until"]) if prior and green else None
            until = today + dt.timedelta(days=2)
            action = "pending" if score is None else "sell" if green and target is not None and until >= target else "hold"
            holds[c, today] = {"action": action, "score": score, "hold_until": until if green else None, "sell_target_date": target}
            if action == "hold" and green:
                outs[c, today] = {"expected_return": None, "expected_on": None, "deviation": None, "resolved_on": None}
        for (c, d), o in outs.items():
            if o["deviation"] is not None:
                continue
            if o["expected_return"] is None and (e := expected(c, d, today)) is not None:
                o.update(expected_return=e, expected_on=today)
            a = actual(c, d, today)
            if a is not None and o["expected_return"] is not None:
                o.update(deviation=o["expected_return"] - a, resolved_on=today)
                if o["deviation"] != 0:
                    r = rows[c, d]
                    valid = {k: (v, loop.WEIGHTS[k]) for k, v in zip(CATS, r[3:7], strict=True) if v is not None}
                    total = sum(w for _, w in valid.values())
                    new = {k: max(0.0, min(100.0, v + o["deviation"] * w / total)) for k, (v, w) in valid.items()}
                    refined[c, d] = sum(new[k] * w for k, (_, w) in valid.items()) / total if valid else r[7]
        for c, d, sentiment, adjustment, source, _ in sorted((s for s in signals if s[1] == today), key=lambda s: s[5]):
            seen = sum(k == decile(c, today) for (_, kd), k in tenth.items() if kd == today)
            sound = sentiment in ("positive", "negative") and abs(adjustment or 0) > 0 and decile(c, d) is not None and seen >= observations_least
            overs[c, today, source] = {"score_adjustment": adjustment or 0.0, "significance_status": "confirmed" if sound else "rejected", "applied": sound and fresh.get(c) is not None, "original_score": fresh.get(c)}
    return holds, outs, refined, overs


@pytest.fixture(scope="module")
def world(spark):
    prices, ranked, signals = make()
    cats = ", ".join(f"{c} double" for c in CATS)
    return (
        spark.createDataFrame(ranked, f"company_id long, trade_date date, statement_scope string, {cats}, overall_score double, overall_rank int, overall_percentile double"),
        spark.createDataFrame(prices, "company_id long, trade_date date, close double"),
        spark.createDataFrame(signals, "company_id long, trade_date date, sentiment string, score_adjustment double, source string, signal_id long"),
    )


def as_dict(df, *key):
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}


def close_to(x):
    return pytest.approx(x, abs=1e-9) if isinstance(x, float) else x


def same(found: Stored, want):
    holds, outs, refined, overs = want
    for df, key, expected in ((found.hold_decisions, ("company_id", "trade_date"), holds), (found.outcomes, ("company_id", "trade_date"), outs), (found.overrides, ("company_id", "trade_date", "source"), overs)):
        got = as_dict(df, *key)
        assert set(got) == set(expected)
        for k, values in expected.items():
            assert {c: got[k][c] for c in values} == {c: close_to(v) for c, v in values.items()}, k
    got = as_dict(found.refinements, "company_id", "trade_date")
    assert {k: r["overall_score"] for k, r in got.items()} == {k: close_to(v) for k, v in refined.items()}


def test_loop_equals_a_day_by_day_run_however_it_is_cut(spark, world, tmp_path, monkeypatch):
    monkeypatch.setattr(closed_loop, "LEAST_OBSERVATIONS", 2)
    want = day_by_day(*make(), 2)
    assert sum(o["deviation"] is not None for o in want[1].values()) > 20 and any(o["deviation"] is None for o in want[1].values())
    assert sum(o["applied"] for o in want[3].values()) > 10
    whole = closed_loop.closed_loop(*world, score_scale=100.0)
    same(whole, want)
    store = Store(spark, f"file://{tmp_path}/s")

    def run(start, end):
        stored = Stored(**{n: store.read(n) for n in ("hold_decisions", "outcomes", "refinements", "overrides")}) if store.versions() else None
        made = closed_loop.closed_loop(*world, stored, start, end, score_scale=100.0)
        change = store.change()
        for n in ("hold_decisions", "outcomes", "refinements", "overrides"):
            change.merge(n, getattr(made, n), tables.SINKS[n].keys, "trade_date/year")
        return change, made

    cuts = [None, day(9), day(16)]
    for i, start in enumerate(cuts):
        end = day({0: 8, 1: 15}.get(i, DAYS))
        change, _ = run(str(start) if start else None, str(end))
        change.commit()
    kept = Stored(**{n: store.read(n) for n in ("hold_decisions", "outcomes", "refinements", "overrides")})
    same(kept, want)
    # the last days once more: nothing changes, and nothing is refined a second time
    change, made = run(str(day(16)), str(day(DAYS)))
    assert not change.pending and made.refinements.count() == 0


def test_loop_over_no_dates(spark, world):
    made = closed_loop.closed_loop(*world, start="2030-01-01")
    assert made.hold_decisions.count() == made.outcomes.count() == made.overrides.count() == 0


def test_rankings_with_their_evidence_run_like_tables_and_in_no_python(spark, monkeypatch):
    pick = random.Random(5)
    draw = lambda: pick.choice([None, 0.5, -1.0, pick.random(), pick.random()])
    rows = [(c, day(d), "Consolidated", pick.choice((0.0, 8.0, 10 + 5 * pick.random())) if pick.random() < 0.2 else 10 + 5 * pick.random(), *[draw() for _ in ranking.FEATURES]) for c in range(41) for d in range(20) if c % 5 or pick.random() < 0.7]
    made = spark.createDataFrame(rows, "company_id long, trade_date date, statement_scope string, close double, " + ", ".join(f"{f} double" for f in ranking.FEATURES)).cache()
    line = Window.partitionBy("company_id").orderBy("trade_date")
    ahead = made.withColumns({"close_5d": F.lead("close", 5).over(line), "known_5d": F.lead("trade_date", 5).over(line)}).withColumn("forward_5d_return", market.gain_ahead(5))
    signals = spark.createDataFrame(
        [(pick.randrange(43), day(pick.randrange(20)), pick.choice(("positive", "negative", "neutral", None)), pick.choice((None, 0.0, pick.uniform(-30, 30))), pick.choice("xyz"), i) for i in range(400)],
        "company_id long, trade_date date, sentiment string, score_adjustment double, source string, signal_id long",
    )
    monkeypatch.setattr(closed_loop, "LEAST_OBSERVATIONS", 2)
    plans = []
    monkeypatch.setattr(closed_loop, "stage", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()) if name == "closed-loop" else None, stage(df, name))[1])
    ranked, judged = stage(ranking.ranked_features(made), "ranked"), stage(ranking.judged_cycles(ahead, 5), "judged")
    cut = [(None, str(day(11))), (str(day(12)), None)]
    stored = None
    for start, end in cut:
        want = closed_loop.closed_loop(ranked, made, signals, stored, start, end, score_scale=100.0)
        got = closed_loop.closed_loop_judged(judged, signals, stored, start, end, score_scale=100.0)
        for part in ("hold_decisions", "outcomes", "refinements", "overrides"):
            a, b = getattr(got, part), getattr(want, part)
            assert a.dtypes == b.dtypes
            plain = lambda df: sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in df.collect())
            found = plain(a)
            assert found and found == plain(b), part
        stored = want
    assert stored.outcomes.where(f"trade_date < DATE'{day(12)}' AND status = 'verified'").count() > 0
    assert stored.overrides.where("applied").count() > 5
    # a company's line is put together by one shuffle, and windows say all of it
    assert len(plans) == 4 and all("Pandas" not in p and "Arrow" not in p for p in plans)
    assert "hashpartitioning(company_id" in plans[1] and plans[1].count("Exchange hashpartitioning(company_id") == 1


def test_rows_that_no_override_turns_green_bring_less_and_decide_alike(spark, monkeypatch, sf_dir):
    monkeypatch.setattr(closed_loop, "LEAST_OBSERVATIONS", 1)
    scores = {1: 0.2, 2: 0.486, 3: 0.51, 4: None, 5: 0.484}
    rows = [(c, day(d), *[x] * 4, x, 10.0 + d, 3, 0.01, day(d + 5), 0.02 * c, day(d + 5)) for c, x in scores.items() for d in range(12)]
    judged = spark.createDataFrame(rows, f"company_id long, trade_date date, {', '.join(f'{c} double' for c in CATS)}, overall_score double, close double, observations long, expected double, expected_on date, actual double, known_on date")
    signals = spark.createDataFrame([(c, day(2 + i), "positive", a, "x", 10 * c + i) for c in scores for i, a in enumerate((0.6, None, 0.9))], "company_id long, trade_date date, sentiment string, score_adjustment double, source string, signal_id long")
    light = closed_loop.lightened(judged, signals, 100.0)
    assert {(r.company_id, r.close is None, r.known_on is None, r[CATS[0]] is None) for r in light.collect()} == {(1, *[True] * 3), (2, *[False] * 3), (3, *[False] * 3), (4, *[True] * 3), (5, *[True] * 3)}
    want, got = (closed_loop.closed_loop_judged(x, signals, score_scale=100.0) for x in (judged, light))
    for part in ("hold_decisions", "outcomes", "refinements", "overrides"):
        found = sorted(map(str, getattr(got, part).collect()))
        assert found and found == sorted(map(str, getattr(want, part).collect())), part
    # company 2 is green once both of its adjustments apply
    assert want.hold_decisions.where("company_id = 2 AND red_green = 'green'").count() > 0
    names = []
    monkeypatch.setattr(closed_loop, "stage", lambda df, name: (names.append(name), stage(df, name))[1])
    written = {}
    monkeypatch.setattr(queries, "stage", lambda df, name: written.setdefault(name, stage(df, name)))
    queries.QUERIES["closed_loop_overrides"](spark, sf_dir)
    # rankings and signals are written once for both runs, prices and returns not at all
    assert {"judged", "signals"} <= set(written) and not {"prices", "ranked"} & set(written) and names == ["closed-loop", "closed-loop", "pending"]
    assert written["judged"].where("overall_score IS NULL AND close IS NOT NULL").count() == 0
