"""Queries over the test tables, one per operator; plans/oracles.py has the SQL that they must equal.

Results are rounded as floor(x * 10^d + 0.5) / 10^d, which any engine computes alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.core import red_green, upsert
from tidemark.functions.shared import scratch, stage
from tidemark.operators import audit, closed_loop, fundamentals, indicators, loop, market, quarters, ranking, smoothing, verify
from tidemark.plans.fixtures import load, quarter_base
from tidemark.sinks import layout, tables
from tidemark.sinks.store import Store
from tidemark.sources import artifacts, calendar, filings, listings, price_files, shareholding

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def rnd(c: str | Column, digits: int) -> Column:
    value = F.col(c) if isinstance(c, str) else c
    return (F.floor(value.cast("double") * F.lit(10.0**digits) + F.lit(0.5)) / F.lit(10.0**digits)).cast("double")


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """All double columns rounded."""
    return df.select(*[rnd(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _prices(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "daily_prices")


@query
def forward_returns(spark, d):
    return rounded(market.forward_returns(_prices(spark, d)), 8)


@query
def forward_returns_range(spark, d):
    return rounded(market.forward_returns(_prices(spark, d), "1997-01-01", "1997-12-31"), 8)


@query
def sma(spark, d):
    return rounded(indicators.moving_averages(_prices(spark, d)), 6)


@query
def bollinger(spark, d):
    return rounded(indicators.bollinger(_prices(spark, d)), 4)


@query
def volatility(spark, d):
    return rounded(indicators.volatility(_prices(spark, d)), 6)


@query
def period_returns(spark, d):
    return rounded(indicators.period_returns(_prices(spark, d)), 8)


@query
def relative_volume(spark, d):
    return rounded(indicators.relative_volume(_prices(spark, d)), 8)


@query
def benchmark_relative(spark, d):
    return rounded(indicators.benchmark_relative(_prices(spark, d), load(spark, d, "benchmark_prices")), 8)


def _smoothed(spark, d, *columns):
    return rounded(indicators.smoothed(_prices(spark, d)).select("company_id", "trade_date", *columns), 3)


@query
def ema(spark, d):
    return _smoothed(spark, d, "ema20", "ema50")


@query
def macd(spark, d):
    return _smoothed(spark, d, "macd", "macd_signal", "macd_histogram")


@query
def rsi(spark, d):
    return _smoothed(spark, d, "rsi14")


@query
def atr(spark, d):
    return _smoothed(spark, d, "atr14")


@query
def adx(spark, d):
    return _smoothed(spark, d, "adx14")


@query
def smoothed_from_state(spark, d):
    """Exponential indicators of the last days from the state that the days before have left."""
    prices = _prices(spark, d)
    _, state = smoothing.smooth_on(prices.where("trade_date <= DATE'1998-06-30'"))
    rows, _ = smoothing.smooth_on(prices.where("trade_date > DATE'1998-06-30'"), state)
    return rounded(rows.select("company_id", "trade_date", "ema50", "rsi14", "macd_signal", "atr14", "adx14"), 3)


@query
def indicators_for_date(spark, d):
    """Indicators of the last 550 prices of each active company by a date."""
    rows = indicators.indicators_for_date(_prices(spark, d), load(spark, d, "companies"), "1998-06-30")
    return rounded(rows.select("company_id", "trade_date", "sma200", "ema50", "rsi14", "atr14", "return_252d"), 3)


@query
def carried_indicators(spark, d):
    """Indicators carried to every trading day of a month, for active companies."""
    rows = indicators.period_returns(_prices(spark, d)).select("company_id", "trade_date", "return_5d")
    return rounded(indicators.carry_forward(rows, load(spark, d, "companies"), "2001-01-01", "2001-01-31"), 8)


def _canon(spark, d, quarters=None):
    return fundamentals.canonical(load(spark, d, "statements", quarters))


def _ttm(spark, d, quarters=None):
    return fundamentals.ttm(_canon(spark, d, quarters))


@query
def canonical_statements(spark, d):
    return rounded(_canon(spark, d).select("company_id", "period_type", "period_end", "statement_scope", "submission_type", "source_reference", "filing_date", "revenue", "net_income"), 4)


@query
def best_quarters(spark, d):
    rows = load(spark, d, "statements").where("period_type = 'quarterly'")
    return rounded(fundamentals.best_quarters(rows).select("company_id", "period_end", "statement_scope", "submission_type", "filing_date", "revenue"), 4)


@query
def ttm(spark, d):
    return rounded(_ttm(spark, d), 4)


@query
def ratios(spark, d):
    return rounded(fundamentals.ratios(_ttm(spark, d)), 6)


@query
def ratios_calendar(spark, d):
    return rounded(fundamentals.ratios(_ttm(spark, d), yoy="calendar"), 6)


@query
def yoy_qoq(spark, d):
    return rounded(fundamentals.yoy_qoq(_canon(spark, d)), 6)


@query
def fundamental_history(spark, d):
    return rounded(fundamentals.fundamental_history(_canon(spark, d), load(spark, d, "companies"), "supplier#000000002"), 6)


def _metrics(spark, d):
    return market.market_metrics(_prices(spark, d), load(spark, d, "share_capital"))


def _valuations(spark, d):
    return market.valuations(_metrics(spark, d), _ttm(spark, d))


@query
def market_metrics_asof(spark, d):
    return rounded(_metrics(spark, d), 2)


@query
def valuation(spark, d):
    return rounded(_valuations(spark, d), 6)


def _features(spark, d, ahead=(), dated=False):
    # line items are grouped by quarter once, and TTM rows made once: ratios read them too
    quarters = quarter_base(spark, d)
    t = stage(_ttm(spark, d, quarters), "ttm")
    return ranking.pit_features(_prices(spark, d), load(spark, d, "share_capital", quarters), t, fundamentals.ratios(t), ahead=ahead, dated=dated)


@query
def pit_features(spark, d):
    keep = ["company_id", "trade_date", "statement_scope", "close", "ttm_period_end", "ttm_filing_date", *ranking.RETURNS, *ranking.RATIOS, "pe", "price_to_sales", "ev_to_ebitda", "earnings_yield"]
    return rounded(_features(spark, d).select(*keep), 6)


@query
def pit_features_all(spark, d):
    """pit_features with every column of the feature row: market values, all technical indicators, all multiples."""
    t = _ttm(spark, d)
    rows = ranking.all_features(_prices(spark, d), load(spark, d, "share_capital"), t, fundamentals.ratios(t))
    # means of cents over 20 to 200 days lie on halves of three digits
    return rows.select(*[rnd(c, 6 if c.startswith("sma") else 3).alias(c) if kind == "double" else F.col(c) for c, kind in rows.dtypes])


@query
def pit_leakage(spark, d):
    return ranking.leaks(_features(spark, d)).agg(F.count("*").alias("leaks"))


def _scores(spark, d):
    return ranking.feature_scores(_features(spark, d))


def _ranked(spark, d):
    return ranking.ranked_features(_features(spark, d))


@query
def feature_scores(spark, d):
    return rounded(_scores(spark, d), 5)


@query
def rankings(spark, d):
    return rounded(_ranked(spark, d), 5)


@query
def decile_backtest(spark, d):
    return rounded(ranking.decile_backtest(_ranked(spark, d), market.forward_returns(_prices(spark, d))), 8)


def _judged(spark, d):
    # of the one horizon that the loop asks for
    ahead = (loop.horizon_of(loop.HOLD_DAYS),)
    return ranking.judged_features(_features(spark, d, ahead), ahead)


def _no_overrides(spark):
    # a relation known to be empty, so that joins with it fall away
    return spark.sql("SELECT 0L AS company_id, CAST(NULL AS DATE) AS trade_date, 0D AS score_adjustment, false AS applied WHERE false")


def _loop(spark, d, green=False):
    """green: only rows that are green, which is all that outcomes and refinements are of, and the earlier decisions too."""
    judged = _judged(spark, d)
    if green:
        judged = judged.where("overall_score * 100 >= 50").drop("statement_scope", "valid_feature_count", "valid_category_count", "overall_rank", "overall_percentile")
    # written once: the rankings are scored and stand in for earlier decisions
    judged = stage(judged, "judged")
    # these are of companies that are well in the green two weeks later
    prior = judged.where("overall_score >= 0.6").select("company_id", F.date_add("trade_date", -14).alias("trade_date"), F.lit(None).cast("double").alias("sell_target_price"), F.lit(None).cast("date").alias("sell_target_date"), F.date_add("trade_date", -12).alias("hold_until"))
    return loop.run_loop_judged(judged, load(spark, d, "news_signals"), prior, _no_overrides(spark), score_scale=100.0)


def _loop_all(spark, d):
    """The loop run over all dates of all companies from an empty store."""
    return loop.run_loop_judged(_judged(spark, d), load(spark, d, "news_signals"), None, _no_overrides(spark), score_scale=100.0)


@query
def red_green_counts(spark, d):
    return loop.label_counts(_loop(spark, d).scored)


@query
def hold_decisions(spark, d):
    return rounded(_loop(spark, d).holds.select("company_id", "trade_date", "action", "red_green", "reason", "hold_until", "sell_target_date"), 4)


@query
def hold_decisions_all(spark, d):
    """hold_decisions after the earlier decisions of all companies."""
    return rounded(_loop_all(spark, d).holds.select("company_id", "trade_date", "action", "red_green", "reason", "hold_until", "sell_target_date"), 4)


@query
def outcomes(spark, d):
    return rounded(_loop(spark, d, green=True).outcomes, 8)


@query
def outcomes_all(spark, d):
    """outcomes after the earlier decisions of all companies."""
    return rounded(_loop_all(spark, d).outcomes, 8)


@query
def refinement(spark, d):
    return rounded(_loop(spark, d, green=True).refined.select("company_id", "trade_date", *loop.WEIGHTS, "overall_score"), 6)


@query
def refinement_all(spark, d):
    """refinement after the earlier decisions of all companies."""
    return rounded(_loop_all(spark, d).refined.select("company_id", "trade_date", *loop.WEIGHTS, "overall_score"), 6)


@query
def overrides(spark, d):
    return rounded(_loop(spark, d).overrides, 4)


@query
def overlay(spark, d):
    """Scores after all applied signals, taken as if every one with an adjustment were applied."""
    done = load(spark, d, "news_signals").select("company_id", "trade_date", "score_adjustment", F.col("score_adjustment").isNotNull().alias("applied"))
    known = done.where("applied AND trade_date <= DATE'1998-12-31'")
    # feature rows lie by company: the sums join them there, and rankings are not shuffled again
    ranked = ranking.ranked_features(_features(spark, d).join(loop.adjustments(known), "company_id", "left"), ("_delta",))
    return rounded(loop.overlaid(ranked, score_scale=100.0).select("company_id", "trade_date", "score", "red_green"), 4)


def _in_two_runs(spark, d):
    """A store that the closed loop has filled in two runs, the second from what the first left."""
    n = loop.horizon_of(loop.HOLD_DAYS)
    # written once, for both runs
    signals = stage(load(spark, d, "news_signals"), "signals")
    judged = stage(closed_loop.lightened(ranking.judged_cycles(_features(spark, d, (n,), dated=True), n), signals, 100.0), "judged")
    store = Store(spark, scratch(spark, "loop"))
    for start, end in ((None, "1996-12-31"), ("1997-01-01", None)):
        stored = closed_loop.Stored(**{n: store.read(n) for n in LOOP_TABLES}) if start else None
        made = closed_loop.closed_loop_judged(judged, signals, stored, start, end, score_scale=100.0)
        change = store.change()
        for n in LOOP_TABLES:
            change.merge(n, getattr(made, n), tables.SINKS[n].keys, "trade_date/year", dealt=True)
        change.commit(until=end)
    return store


LOOP_TABLES = ("hold_decisions", "outcomes", "refinements", "overrides")


@query
def closed_loop_decisions(spark, d):
    """Every decision of the closed loop over all dates, with how its outcome stands at the end and what that did to its ranking."""
    store = _in_two_runs(spark, d)
    key = ["company_id", "trade_date"]
    holds = store.read("hold_decisions").select(*key, "action", "score", "reason", "hold_until", "sell_target_date")
    outs = store.read("outcomes").select(*key, "expected_return", "expected_on", "actual_return", "deviation", "status", "resolved_on")
    refined = store.read("refinements").select(*key, F.col("overall_score").alias("refined_score"), "refined_on")
    return rounded(holds.join(outs, key, "left").join(refined, key, "left"), 6)


@query
def closed_loop_overrides(spark, d):
    return rounded(_in_two_runs(spark, d).read("overrides"), 4)


def _cumulative(spark, d):
    return load(spark, d, "cumulative_statements")


@query
def quarterly_pnl(spark, d):
    return rounded(quarters.quarterly_pnl(_cumulative(spark, d)), 4)


@query
def quarterly_cash_flow(spark, d):
    return rounded(quarters.quarterly_cash_flow(_cumulative(spark, d)), 4)


@query
def fourth_quarter(spark, d):
    return rounded(quarters.fourth_quarter(_cumulative(spark, d), load(spark, d, "annual_statements")), 4)


@query
def derived_quarters(spark, d):
    """All filings through the four derivations; the quarterly rows."""
    made = quarters.derive_quarterly_financials(load(spark, d, "filed_statements")).where("period_type = 'quarterly'")
    figures = ("revenue", "profit_before_tax", "net_income", "eps", "ebit", "ebitda", "operating_cash_flow", "capital_expenditure", "free_cash_flow")
    return rounded(made.select("raw_filing_id", "company_id", "period_end", *figures, F.size("derivation_sources").cast("bigint").alias("n_sources")), 4)


@query
def lineage(spark, d):
    return quarters.lineage(_cumulative(spark, d), load(spark, d, "annual_statements"))


@query
def statement_versions(spark, d):
    """Where derived figures come from, after every third filing was processed again and derived less than before."""
    # each is read by both saves
    base = quarter_base(spark, d)
    rows = stage(load(spark, d, "cumulative_statements", base), "cumulative")
    versions = rows.select("raw_filing_id", "period_type", "period_end", "statement_scope", "revenue", F.to_json(F.struct("revenue", "ytd_revenue")).alias("reported_values"))
    sources = stage(quarters.lineage(rows, load(spark, d, "annual_statements", base)).join(versions.select(*tables.VERSION), "raw_filing_id"), "sources")
    store = Store(spark, scratch(spark, "versions"))
    again = F.col("raw_filing_id") % 3 == 0
    for v, s in ((versions, sources), (versions.where(again), sources.where(again & (F.col("component") == "PNL")))):
        change = store.change()
        tables.save_versions(change, v, s)
        change.commit()
    return store.read("version_sources").select("raw_filing_id", *tables.SOURCE)


@query
def statement_upsert(spark, d):
    """Statements, and then those of half the companies once more: figures win, a missing filing date and references don't."""
    rows = load(spark, d, "statements").withColumn("source", F.lit("filings"))
    later = F.when(F.col("company_id") % 4 != 0, F.date_add("filing_date", 1))
    again = rows.where("company_id % 2 = 0").withColumns({"filing_date": later, "source_reference": F.lit("other"), "revenue": F.col("revenue") * 2})
    store = Store(spark, scratch(spark, "statements"))
    for part in (rows, again):
        tables.publish(store, {"financial_statements": part})
    return rounded(store.read("financial_statements").select("company_id", "period_type", "period_end", "statement_scope", "submission_type", "filing_date", "source_reference", "revenue"), 4)


@query
def ranking_update(spark, d):
    """Rankings after new scores for half of the companies, and for one that has none: ranks and percentiles stay."""
    store = Store(spark, scratch(spark, "rankings"))
    change = store.change()
    change.merge("stock_rankings", _ranked(spark, d), tables.SCOPED, "trade_date/year")
    change.commit()
    half = store.read("stock_rankings").where("company_id % 2 = 0").withColumns({c: F.col(c) / 2 for c in (*loop.WEIGHTS, "overall_score")})
    store.update(lambda c: tables.update_rankings(c, half.unionByName(half.limit(1).withColumn("company_id", F.lit(-1).cast("long")))))
    return rounded(store.read("stock_rankings").select("company_id", "trade_date", *loop.WEIGHTS, "overall_score", "overall_rank", "overall_percentile"), 5)


@query
def verification_details(spark, d):
    """Coverage checks of all dates kept as runs, twice; the results of the second, with what their runs say."""
    wanted = verify.active_prices(_prices(spark, d), load(spark, d, "companies"))
    # three runs save the same checks
    checks = stage(verify.coverage(wanted, _metrics(spark, d).where("market_cap IS NOT NULL"), "market_metrics coverage"), "checks")
    store = Store(spark, scratch(spark, "verification"))
    for i, run in enumerate(("first", "second", "second")):
        change = store.change()
        tables.save_verification(change, checks, run, "verify", f"2024-01-0{i // 2 + 1} 12:00:00")
        if change.pending:
            change.commit()
    runs = store.read("verification_runs").where("started_at >= '2024-01-01'").select(F.col("id").alias("run_id"), F.col("status").alias("run_status"), "checks")
    return store.read("verification_results").join(runs, "run_id").where("run_id LIKE 'second/%'")


@query
def claimed_filings(spark, d):
    """All filings after two workers have claimed a batch each, of which one is done."""
    filings_ = _cumulative(spark, d).select(F.col("raw_filing_id").alias("id"), "period_end", F.lit("PENDING").alias("processing_status"), F.lit(None).cast("string").alias("processing_error"), F.lit(None).cast("string").alias("claimed_by"))
    store = Store(spark, scratch(spark, "filings"))
    tables.publish(store, {"raw_filings": filings_})
    batch = tables.claim_batch(store, "a")
    tables.claim_batch(store, "b")
    tables.finish_batch(store, "a", batch.select("id", (F.col("id") % 7 != 0).alias("ok"), F.lit("unreadable").alias("error")))
    return store.read("raw_filings").select("id", "processing_status", "claimed_by")


@query
def shareholding_pct(spark, d):
    out = market.shareholding_percentages(load(spark, d, "shareholding_snapshots"))
    return rounded(out.select("company_id", "effective_date", F.col("total_shares").cast("long").alias("total_shares"), *[F.col(c).cast("double").alias(c) for c in out.columns if c.endswith("_pct")]), 5)


@query
def coverage_checks(spark, d):
    wanted = verify.active_prices(_prices(spark, d), load(spark, d, "companies"))
    return verify.coverage(wanted, _metrics(spark, d).where("market_cap IS NOT NULL"), "market_metrics coverage")


@query
def universe_coverage(spark, d):
    return verify.universe_coverage(_prices(spark, d), load(spark, d, "companies"))


@query
def active_anti_join(spark, d):
    return verify.missing_symbols(_prices(spark, d), load(spark, d, "companies"), "1998-06-15")


@query
def ratio_eligibility(spark, d):
    t = _ttm(spark, d)
    return verify.eligible_ratios(_features(spark, d), fundamentals.ratios(t).where("net_profit_margin > 0"))


@query
def field_availability(spark, d):
    return verify.field_availability(_valuations(spark, d))


@query
def cash_flow_coverage(spark, d):
    return verify.cash_flow_coverage(_canon(spark, d))


def _runs_of(spark, d):
    wanted = verify.active_prices(_prices(spark, d), load(spark, d, "companies"))
    checks = verify.coverage(wanted, _metrics(spark, d).where("market_cap IS NOT NULL"), "x").withColumn("check_name", F.date_format("trade_date", "dd"))
    return checks.where("trade_date BETWEEN DATE'1998-03-01' AND DATE'1998-03-27'"), checks.where("trade_date BETWEEN DATE'1998-04-05' AND DATE'1998-04-30'")


@query
def verification_compare(spark, d):
    return verify.compare_runs(*_runs_of(spark, d))


@query
def verification_compare_all(spark, d):
    """Each day's check against the same day of the month before, over all dates; the name is the newer day."""
    wanted = verify.active_prices(_prices(spark, d), load(spark, d, "companies"))
    checks = verify.coverage(wanted, _metrics(spark, d).where("market_cap IS NOT NULL"), "x")
    named = lambda month: checks.withColumn("check_name", F.concat(F.date_format(month, "yyyy-MM"), F.date_format("trade_date", "-dd")))
    return verify.compare_runs(named(F.add_months(F.trunc("trade_date", "month"), 1)), named(F.col("trade_date")))


@query
def verification_summary(spark, d):
    checks = verify.coverage(verify.active_prices(_prices(spark, d), load(spark, d, "companies")), _metrics(spark, d).where("market_cap IS NOT NULL"), "m").unionByName(verify.field_availability(_valuations(spark, d)))
    return verify.run_summary(checks)


@query
def complete_ingests(spark, d):
    days = load(spark, d, "runs").groupBy("trade_date", "company_id").agg(F.count("*").alias("n")).select("trade_date", "company_id")
    return verify.complete_ingests(load(spark, d, "runs"), days)


@query
def verification_history(spark, d):
    return verify.history(load(spark, d, "runs"), limit=20).select("id", "trade_date", "status", "records_written")


@query
def upsert_merge(spark, d):
    """Statements replaced by their revisions, an old filing date surviving a missing new one."""
    rows = _canon(spark, d).where("period_type = 'quarterly' AND statement_scope = 'Consolidated'").select("company_id", "period_end", "filing_date", "revenue")
    new = rows.where(F.col("company_id") % 2 == 0).select("company_id", "period_end", F.when(F.col("company_id") % 4 == 0, F.col("filing_date")).alias("filing_date"), (F.col("revenue") * 2).alias("revenue"))
    extra = rows.where(F.col("company_id") == 3).select((F.col("company_id") + 1000000).alias("company_id"), "period_end", "filing_date", "revenue")
    return rounded(upsert(rows, new.unionByName(extra), ["company_id", "period_end"], {"filing_date": F.coalesce("n.filing_date", "o.filing_date")}), 4)


@query
def trading_calendar(spark, d):
    """The days of all trades and orders, moved to the calendar's years."""
    days = _prices(spark, d).select(F.col("trade_date").alias("day")).union(load(spark, d, "news_signals").select("trade_date")).distinct()
    days = days.select(F.date_add("day", 10000).alias("day"))
    return days.select("day", calendar.classify(F.col("day")).alias("kind"), calendar.is_trading_day(F.col("day")).alias("open"))


@query
def archive_names(spark, d):
    days = _prices(spark, d).select("trade_date").distinct().select((F.date_add("trade_date", 10000)).alias("day"))
    return days.select("day", price_files.archive_name(F.col("day")).alias("archive"))


@query
def decile_and_horizon(spark, d):
    """Deciles, horizon buckets and labels of runs' numbers, as if they were ranks, percentiles, days and scores."""
    n = load(spark, d, "runs").select("id", F.pmod("records_written", F.lit(130)).alias("n"), F.col("company_id").alias("k"))
    decile = loop.decile_of(F.when(F.col("k") % 5 != 0, F.col("n")), F.when(F.col("k") % 3 == 0, F.col("n") / 130))
    return n.select("id", decile.alias("decile"), loop.horizon_bucket("n").alias("bucket"), red_green(F.when(F.col("k") % 7 != 0, F.col("n"))).alias("label"))


@query
def normalize_prices(spark, d):
    """Price rows as the archives' text and back."""
    raw = _prices(spark, d).join(load(spark, d, "companies"), F.col("company_id") == F.col("id")).select(
        F.concat(F.lit(" "), "symbol").alias("TckrSymb"), F.col("series").alias("SctySrs"), F.format_number("close", 2).alias("ClsPric"),
        F.when(F.col("company_id") % 5 == 0, "-").otherwise(F.format_number("high", 2)).alias("HghPric"), F.when(F.col("company_id") % 7 == 0, "").otherwise(F.format_number("low", 2)).alias("LwPric"),
        F.col("volume").cast("long").cast("string").alias("TtlTradgVol"), F.col("trade_date").cast("string").alias("TradDt"),
    )
    return price_files.normalize(raw).where(F.col("series") == "EQ").select("symbol", "close", "high", "low", "volume", F.col("date").alias("trade_day"))


def _stored_day(spark, d, stored):
    companies = load(spark, d, "companies")
    incoming = stored.where("trade_date = DATE'1998-01-05'").join(companies, F.col("company_id") == F.col("id")).select("symbol", "series", (F.col("close") + 1).alias("close"))
    unknown = spark.createDataFrame([("NOBODY", "EQ", 1.0)], "symbol string, series string, close double")
    return rounded(price_files.store_day(stored, incoming.unionByName(unknown), companies, "1998-01-05", ("EQ",)), 2)


@query
def price_upsert(spark, d):
    """Prices of known symbols of the traded series, replacing what is stored for the day."""
    return _stored_day(spark, d, _prices(spark, d).select("company_id", "trade_date", "close"))


def _documents(spark, d):
    """Generated filings in four tasks a core: their rows are small, but not what is parsed out of each."""
    return filings.sample_documents(_cumulative(spark, d).repartition(4 * spark.sparkContext.defaultParallelism, "raw_filing_id"))


@query
def xbrl_statements(spark, d):
    """Statements out of generated filings, one document per company and quarter."""
    return rounded(filings.statements(filings.parse_facts(_documents(spark, d))), 2)


@query
def xbrl_audit(spark, d):
    return audit.cash_flow_audit(filings.parse_facts(_documents(spark, d)))


@query
def shareholding_extract(spark, d):
    return shareholding.snapshots(filings.parse_facts(shareholding.sample_documents(load(spark, d, "shareholding_snapshots"))))


@query
def shareholding_malformed(spark, d):
    """Totals of all shareholding filings when those of every other company are cut short."""
    documents = shareholding.sample_documents(load(spark, d, "shareholding_snapshots"))
    cut = documents.withColumn("content", F.when(F.col("company_id") % 2 == 1, F.expr("substr(content, 1, length(content) - 7)")).otherwise(F.col("content")))
    return shareholding.extract(cut).select("filing_id", "company_id", F.col("period_end"), "total_shares", F.col("error").isNotNull().alias("malformed"))


@query
def statement_metadata(spark, d):
    """Filing dates and standards of parsed statements: broadcast if it can be read, else the cached date."""
    rows = _cumulative(spark, d)
    n = F.col("raw_filing_id")
    said = F.when(n % 3 == 0, "soon").when(n % 3 == 1, F.date_format(F.date_add("period_end", 40).cast("timestamp"), "dd-MMM-yyyy HH:mm:ss"))
    catalogue = rows.where(n % 11 != 0).select(n.alias("filing_id"), said.alias("broadcast"), F.date_add("period_end", 45).alias("effective_date"), F.concat(F.lit("https://filings/"), F.when(n % 2 == 0, "IndAs_").otherwise("gaap_"), n.cast("string")).alias("url"))
    parsed = filings.statements(filings.parse_facts(filings.sample_documents(rows)))
    return filings.dated(parsed, catalogue).select("filing_id", "period_type", "filing_date", "reporting_standard")


def _artifacts(spark, d):
    """Generated filings as artifacts, by filing id."""
    documents = filings.sample_documents(_cumulative(spark, d))
    named = documents.select(
        "filing_id", F.concat(F.lit("C"), "company_id").alias("symbol"), "period_end", F.lit("Consolidated").alias("statement_scope"), F.concat(F.lit("https://host/corporate/"), "filing_id", F.lit(".xml?x=1")).alias("url"),
        F.col("filing_id").cast("string").alias("source_reference"), "content",
    )
    return artifacts.artifacts(named).withColumnRenamed("filing_id", "id")


@query
def artifact_paths(spark, d):
    """Names of generated filings, without the digest."""
    return _artifacts(spark, d).select("id", F.regexp_replace("raw_relative_path", "__[0-9a-f]{16}", "").alias("path"), (F.get_json_object("sidecar", "$.file_size").cast("long") == F.col("file_size")).alias("sized"))


@query
def artifact_integrity(spark, d):
    """Generated filings, some gone, of another length or another content, against their catalogue."""
    made, n = _artifacts(spark, d), F.col("id")
    files = made.where(n % 7 != 0).select(F.col("raw_relative_path").alias("path"), (F.col("file_size") + (n % 5 == 0).cast("long")).alias("length"), F.when(n % 3 == 0, F.sha2(F.lit("?"), 256)).otherwise(F.col("sha256")).alias("sha256"))
    found = artifacts.integrity(made.withColumn("sha256", F.upper("sha256")), files)
    return found.select("id", "file_exists", "size_matches", "sha256_matches")


@query
def artifact_issues(spark, d):
    """Catalogue rows against sidecars of which 15 of 16 disagree in something, each in one way."""
    made, n = _artifacts(spark, d), F.col("id") % (len(artifacts.ISSUES) + 1) - 1
    wrong = {
        "symbol_mismatch": ("symbol", "NOBODY"), "period_mismatch": ("period_end", "1990-01-01"), "invalid_period": ("period_end", "soon"), "scope_mismatch": ("statement_scope", "Standalone"), "reference_mismatch": ("source_reference", "none"),
        "sha256_mismatch": ("sha256", "00"), "file_size_mismatch": ("file_size", "-1"), "invalid_file_size": ("file_size", "many"), "missing_json_xml_path": ("raw_xml_path", ""), "xml_path_mismatch": ("raw_xml_path", "elsewhere.xml"),
        "invalid_broadcast_datetime": ("broadcast_datetime", "yesterday"), "invalid_revised_datetime": ("revised_datetime", "31-Foo-2024 00:00:00"),
    }
    cells, said = F.from_json("sidecar", "map<string,string>"), F.col("sidecar")
    without = lambda name: F.map_filter(cells, lambda k, _: k != name)
    for kind, (name, value) in wrong.items():
        said = F.when(n == artifacts.ISSUES.index(kind), F.to_json(F.map_concat(without(name), F.create_map(F.lit(name), F.lit(value))))).otherwise(said)
    said = F.when(n == artifacts.ISSUES.index("invalid_json"), F.substring("sidecar", 2, 1 << 30)).otherwise(said)
    files = made.where(n != artifacts.ISSUES.index("missing_xml")).select(F.col("raw_relative_path").alias("path"))
    sidecars = made.where(n != artifacts.ISSUES.index("missing_json")).select(F.col("raw_relative_path").alias("path"), said.alias("content"))
    return artifacts.sidecar_issues(made, files, sidecars).select("id", F.array_join("issues", ",").alias("issues"))


@query
def artifact_changes(spark, d):
    """Files that came, went or changed between two looks, in the folders of every fourth company."""
    rows, n = _cumulative(spark, d), F.col("raw_filing_id")
    table = rows.select("company_id", n, F.concat_ws("/", F.concat(F.lit("C"), "company_id"), "period_end", F.concat(n.cast("string"), F.lit(".xml"))).alias("path"), F.sha2(F.col("revenue").cast("string"), 256).alias("sha256"))
    touched = F.col("company_id") % 4 == 1
    old = table.where(~(touched & (n % 9 == 0)))
    new = table.where(~(touched & (n % 11 == 0))).withColumn("sha256", F.when(touched & (n % 10 == 3), "other").otherwise(F.col("sha256")))
    return artifacts.changed_files(old, new)


@query
def concept_diagnosis(spark, d):
    """Which cash-flow elements each generated filing has."""
    documents = filings.sample_documents(_cumulative(spark, d)).select(F.col("filing_id").cast("string").alias("path"), "content")
    return artifacts.diagnosis(artifacts.inspected_documents(documents)).select(F.col("path").cast("long").alias("id"), "classification", F.col("cash_concepts").cast("long").alias("cash_concepts"))


@query
def filing_list(spark, d):
    """Filings out of list bodies, one body a company."""
    n, code = F.col("raw_filing_id"), F.concat(F.lit("C"), "company_id")
    cells = F.struct(
        F.when(n % 5 != 0, F.date_format("period_end", "dd-MMM-yyyy")).alias("qe_Date"), F.when(n % 3 != 0, code).alias("symbol"), F.when(n % 4 == 0, "first").alias("cmName"), F.lit("second").alias("smName"),
        F.when(n % 2 == 0, "Consolidated").alias("consolidated"), n.cast("string").alias("seq_Id"),
    )
    bodies = _cumulative(spark, d).groupBy(F.lower(code).alias("symbol")).agg(F.to_json(F.struct(F.collect_list(cells).alias("data"))).alias("body"))
    return listings.filing_list(bodies).select("symbol", "company_name", "period_end", "submission_type", "statement_scope", "source_reference")


@query
def index_history(spark, d):
    """Days of an index out of bodies of a month each, of which every other is encoded twice."""
    days = load(spark, d, "benchmark_prices").groupBy(F.trunc("trade_date", "month").alias("month")).agg(F.collect_list(F.struct(F.date_format("trade_date", "dd MMM yyyy").alias("HistoricalDate"), F.col("close_price").cast("decimal(18,2)").cast("string").alias("CLOSE"))).alias("l"))
    inner = F.to_json("l")
    twice = F.to_json(F.struct(inner.alias("d")))
    bodies = days.select(F.when(F.month("month") % 2 == 0, twice).otherwise(F.concat(F.lit('{"d":'), inner, F.lit("}"))).alias("body"))
    row = F.col("row")
    return listings.index_history(bodies).select(F.to_date(row["HistoricalDate"], "dd MMM yyyy").alias("trade_date"), row["CLOSE"].cast("double").alias("close_price"))


@query
def benchmark_history(spark, d):
    """A landed benchmark file saved over what is stored; of the file's cells some are NaN."""
    prices, close = load(spark, d, "benchmark_prices"), F.col("close_price").cast("decimal(18,2)").cast("string")
    landed = prices.where("trade_date >= DATE'1996-01-01'").select(
        F.col("trade_date").cast("string").alias("Date"), F.when(F.dayofmonth("trade_date") % 7 == 0, "NaN").otherwise(close).alias("('Close', '^NSEI')"), F.when(F.dayofmonth("trade_date") % 5 == 0, "").otherwise(close).alias("('Open', '^NSEI')"),
        close.alias("('High', '^NSEI')"), close.alias("('Low', '^NSEI')"), F.lit("1").alias("('Adj Close', '^NSEI')"),
    )
    store = Store(spark, scratch(spark, "benchmark"))
    before = listings.benchmark_history(prices.where("trade_date < DATE'1997-01-01'").select(F.col("trade_date").alias("date"), *[F.lit("1").alias(c) for c in ("open", "high", "low", "close")]))
    tables.publish(store, {"benchmark_prices": before})
    tables.publish(store, {"benchmark_prices": listings.benchmark_history(landed)})
    return store.read("benchmark_prices").select("benchmark", "trade_date", "open_price", "high_price", "close_price", "source")


@query
def valuation_by_company(spark, d):
    """Valuations from prices, share capital and TTM rows that lie bucketed by company."""
    made = {"prices": (_prices(spark, d), ("trade_date",)), "capital": (load(spark, d, "share_capital"), ("filing_date",)), "ttm": (_ttm(spark, d), ("period_end",))}
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    prices, capital, ttm_rows = (layout.write_by_company(df, f"tidemark_{name}", scratch(spark, name), buckets, order) for name, (df, order) in made.items())
    return rounded(market.valuations(market.market_metrics(prices, capital), ttm_rows), 6)


def _quarterly(rows):
    return rows.where("period_type = 'quarterly' AND statement_scope = 'Consolidated'").select(
        "company_id", "period_end", F.col("filing_date").alias("effective_at"), F.col("source_reference").alias("filing_id"), F.md5(F.concat_ws("|", "submission_type", F.col("period_end").cast("string"))).alias("content_hash")
    )


@query
def version_intervals(spark, d):
    """From when to when each filing of a period was the one to use."""
    found = audit.version_intervals(_quarterly(load(spark, d, "statements")))
    return found.select("company_id", "period_end", "effective_at", "until", "slot", "next_slot", "smallest", F.size("ids").cast("bigint").alias("filings"), "ambiguous")


def _versions(rows):
    return audit.point_in_time_versions(_quarterly(rows))


@query
def pit_versions(spark, d):
    """Which filing of each period was the one to use when another filing came."""
    return _versions(load(spark, d, "statements"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
