"""All features along one line of days, against the joined form."""

from pyspark.sql import functions as F
from tidemark.operators import fundamentals, indicators, market, ranking
from tidemark.plans.fixtures import load


def test_one_line_gives_what_joins_give(spark, sf_dir):
    prices, shares = load(spark, sf_dir, "daily_prices").where("company_id < 4"), load(spark, sf_dir, "share_capital")
    # days without a high are no days of the indicators
    prices = prices.withColumn("high", F.when(F.dayofmonth("trade_date") != 7, F.col("high")))
    t = fundamentals.ttm(fundamentals.canonical(load(spark, sf_dir, "statements")))
    metrics = market.market_metrics(prices, shares)
    joined = ranking.features(metrics, indicators.technical_indicators(prices.where("high IS NOT NULL")), t, fundamentals.ratios(t), market.valuations(metrics, t))
    line = ranking.all_features(prices, shares, t, fundamentals.ratios(t))
    assert dict(line.dtypes) == dict(joined.dtypes)
    plain = lambda rows: sorted(str([round(x, 6) + 0.0 if isinstance(x, float) else x for x in r]) for r in rows.collect())
    got = plain(line.select(joined.columns))
    assert len(got) > 100 and got == plain(joined)


def test_wide_rows_are_not_joined(spark, sf_dir):
    t = fundamentals.ttm(fundamentals.canonical(load(spark, sf_dir, "statements")))
    plan = ranking.all_features(load(spark, sf_dir, "daily_prices"), load(spark, sf_dir, "share_capital"), t, fundamentals.ratios(t))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan[: plan.index("Union")]
