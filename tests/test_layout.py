"""Tables bucketed by company: the plans over them hold no shuffle, and the results are those of plain tables."""

import re
from collections import Counter

from tidemark.operators import fundamentals, indicators, market
from tidemark.plans.fixtures import load
from tidemark.sinks import layout


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning.*", plan)


def same(a, b):
    assert Counter(map(str, a.collect())) == Counter(map(str, b.collect()))


def test_no_exchange_over_prices(spark, sf_dir, tmp_path):
    prices, capital = load(spark, sf_dir, "daily_prices"), load(spark, sf_dir, "share_capital")
    ttm = fundamentals.ttm(fundamentals.canonical(load(spark, sf_dir, "statements")))
    put = lambda df, name, order: layout.write_by_company(df, name, f"file://{tmp_path}/{name}", 8, order)
    p, c, t = put(prices, "by_prices", ("trade_date",)), put(capital, "by_capital", ("filing_date",)), put(ttm, "by_ttm", ("period_end",))
    sma, metrics = indicators.moving_averages(p), market.market_metrics(p, c)
    values = market.valuations(metrics, t)
    for df in (sma, metrics, values):
        assert exchanges(df) == []
    same(sma, indicators.moving_averages(prices))
    same(metrics, market.market_metrics(prices, capital))
    same(values, market.valuations(market.market_metrics(prices, capital), ttm))
    assert exchanges(indicators.moving_averages(prices)) != []
    again = put(prices.limit(0), "by_prices", ("trade_date",))
    assert again.count() == 0


def test_csv_is_sorted_and_whole(spark, tmp_path):
    rows = spark.createDataFrame([(3, None, ["a", "b"]), (1, "x,y", []), (2, 'q"', None)], "id long, note string, tags array<string>")
    for one in (False, True):
        layout.write_csv(rows, f"file://{tmp_path}/out", ("id",), one)
        files = sorted(f for f in (tmp_path / "out").glob("*.csv"))
        lines = [x for f in files for x in f.read_text().splitlines()]
        assert [x for x in lines if x != "id,note,tags"] == ["1,\"x,y\",", '2,"q\\"",', "3,,a;b"] and lines[0] == "id,note,tags"
