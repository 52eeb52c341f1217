"""DuckDB SQL that the queries must equal. Named pieces build on each other; a query lists the ones that it needs."""

from __future__ import annotations

from tidemark.operators.ranking import CATEGORIES, FEATURES, LOW_IS_GOOD, NOT_NEGATIVE, POSITIVE, RATIOS, RETURNS
from tidemark.plans.fixtures import FIXTURES, duck
from tidemark.sources.artifacts import ISSUES
from tidemark.sources.calendar import HOLIDAYS, SPECIAL_SESSIONS
from tidemark.sources.shareholding import MEMBERS


def r(x: str, digits: int, name: str | None = None) -> str:
    name = name or x.rpartition(".")[2]
    return f"floor(CAST({x} AS DOUBLE) * 1e{digits} + 0.5) / 1e{digits} AS {name}"


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def grow(a: str, b: str) -> str:
    return f"((({a}) - ({b})) / nullif(abs({b}), 0))"


LINE = "PARTITION BY company_id ORDER BY trade_date"
FLOWS = ("revenue", "ebitda", "ebit", "profit_before_tax", "net_income", "eps")
CASH = ("operating_cash_flow", "capital_expenditure", "free_cash_flow")
BAL = ("total_debt", "total_equity", "total_assets", "cash_and_equivalents")


def full(agg: str, of: str, n: int) -> str:
    frame = f"OVER ({LINE} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({of}) {frame} = {n} THEN {agg} {frame} END"


def change(c: str, n: int) -> str:
    return f"({div(c, f'lag({c}, {n}) OVER ({LINE})')} - 1)"


def ewm(source: str, value: str, alpha: str, n: int, out: str, carry: str = "") -> str:
    """Rows of source with out: the closed form of the recurrence, from the first row where value is there."""
    return f"""SELECT *, CASE WHEN {value} IS NOT NULL AND _i >= {n - 1} THEN power(1 - {alpha}, _i) * sum(CASE WHEN _i = 0 THEN {value} ELSE {alpha} * {value} * power(1 - {alpha}, -_i) END) OVER (PARTITION BY company_id ORDER BY trade_date) END AS {out}
FROM (SELECT *{carry}, CASE WHEN {value} IS NOT NULL THEN count({value}) OVER (PARTITION BY company_id ORDER BY trade_date) - 1 END AS _i FROM {source})"""


PIECES: dict[str, tuple[tuple[str, ...], str]] = {k: ((), duck(k)) for k in FIXTURES}


def piece(name: str, needs: tuple[str, ...], sql: str) -> None:
    PIECES[name] = (needs, sql)


piece("steps", ("daily_prices",), f"""
SELECT *, close - lag(close) OVER w AS step, high - lag(high) OVER w AS up, lag(low) OVER w - low AS down,
       greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr
FROM daily_prices WINDOW w AS ({LINE})""")
piece("moves", ("steps",), "SELECT *, CASE WHEN step IS NOT NULL THEN greatest(step, 0) END AS gain, CASE WHEN step IS NOT NULL THEN greatest(-step, 0) END AS loss, CASE WHEN up > down AND up > 0 THEN up ELSE 0 END AS plus, CASE WHEN down > up AND down > 0 THEN down ELSE 0 END AS minus FROM steps")
for _name, _value, _alpha, _n, _out in (
    ("e20", "close", "(2.0::DOUBLE / 21)", 20, "ema20"), ("e50", "close", "(2.0::DOUBLE / 51)", 50, "ema50"), ("e12", "close", "(2.0::DOUBLE / 13)", 12, "ema12"), ("e26", "close", "(2.0::DOUBLE / 27)", 26, "ema26"),
    ("eg", "gain", "(1.0::DOUBLE / 14)", 14, "g"), ("el", "loss", "(1.0::DOUBLE / 14)", 14, "l"), ("etr", "tr", "(1.0::DOUBLE / 14)", 14, "atr14"), ("ep", "plus", "(1.0::DOUBLE / 14)", 14, "p"), ("em", "minus", "(1.0::DOUBLE / 14)", 14, "m"),
):
    piece(_name, ("moves",), f"SELECT company_id, trade_date, {_out} FROM ({ewm('moves', _value, _alpha, _n, _out)})")
piece("macds", ("e12", "e26"), "SELECT company_id, trade_date, ema12 - ema26 AS macd FROM e12 JOIN e26 USING (company_id, trade_date)")
piece("signals", ("macds",), ewm("macds", "macd", "0.2::DOUBLE", 9, "macd_signal"))
piece("dxs", ("ep", "em", "etr"), f"""
SELECT company_id, trade_date, 100 * abs(a - b) / nullif(a + b, 0) AS dx
FROM (SELECT company_id, trade_date, 100 * p / atr14 AS a, 100 * m / atr14 AS b FROM ep JOIN em USING (company_id, trade_date) JOIN etr USING (company_id, trade_date))""")
piece("adxs", ("dxs",), ewm("dxs", "dx", "(1.0::DOUBLE / 14)", 14, "adx14"))

piece("canon", ("statements",), """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY company_id, period_type, period_end, statement_scope ORDER BY try_cast(source_reference AS BIGINT) DESC NULLS FIRST, submission_type) AS rn FROM statements) WHERE rn = 1""")
_four = "OVER (PARTITION BY company_id, statement_scope ORDER BY period_end ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
piece("ttm_base", ("canon",), f"""
SELECT company_id, statement_scope, period_end,
       {', '.join(f'CASE WHEN count({c}) {_four} = 4 THEN sum({c}) {_four} END AS q_{c}' for c in (*FLOWS, *CASH))},
       {', '.join(f'last_value({c} IGNORE NULLS) {_four} AS {c}' for c in BAL)},
       max(filing_date) {_four} AS filed, row_number() OVER (PARTITION BY company_id, statement_scope ORDER BY period_end) AS n,
       sum(steady) OVER (PARTITION BY company_id, statement_scope ORDER BY period_end ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS steps,
       array_to_string(list(CAST(period_end AS VARCHAR)) {_four}, ',') AS source_periods
FROM (SELECT *, CASE WHEN (year(period_end) - year(before)) * 12 + month(period_end) - month(before) = 3 AND period_end - before BETWEEN 80 AND 100 THEN 1 ELSE 0 END AS steady
      FROM (SELECT *, lag(period_end) OVER (PARTITION BY company_id, statement_scope ORDER BY period_end) AS before FROM canon WHERE period_type = 'quarterly'))""")
piece("ttm", ("ttm_base",), f"""
SELECT b.company_id, b.period_end, b.statement_scope, greatest(b.filed, a.filing_date) AS latest_filing_date,
       {', '.join(f'q_{c} AS {c}_ttm' for c in FLOWS)},
       {', '.join(f'CASE WHEN month(b.period_end) = 3 AND day(b.period_end) = 31 AND a.company_id IS NOT NULL THEN a.{c} ELSE q_{c} END AS {c}_ttm' for c in CASH)},
       {', '.join(f'b.{c}' for c in BAL)},
       CASE WHEN q_eps IS NULL THEN 'FOUR_QUARTERS_EPS_PARTIAL' ELSE 'FOUR_QUARTERS' END AS calculation_method, source_periods
FROM ttm_base b LEFT JOIN (SELECT * FROM canon WHERE period_type = 'annual') a ON a.company_id = b.company_id AND a.statement_scope = b.statement_scope AND a.period_end = b.period_end
WHERE n >= 4 AND steps = 3""")

_RATIO = f"""
t.company_id, t.period_end, t.statement_scope,
{div('t.ebitda_ttm', 't.revenue_ttm')} AS ebitda_margin, {div('t.ebit_ttm', 't.revenue_ttm')} AS ebit_margin, {div('t.net_income_ttm', 't.revenue_ttm')} AS net_profit_margin,
{div('t.operating_cash_flow_ttm', 't.revenue_ttm')} AS ocf_margin, {div('t.free_cash_flow_ttm', 't.revenue_ttm')} AS fcf_margin,
{div('t.net_income_ttm', 't.total_equity')} AS roe, {div('t.net_income_ttm', 't.total_assets')} AS roa,
{', '.join(f"{grow(f't.{c}_ttm', f'p.{c}_ttm')} AS {c}_growth_yoy" for c in ('revenue', 'ebitda', 'ebit', 'net_income', 'eps'))},
{div('t.total_debt', 't.total_equity')} AS debt_to_equity, {div('t.total_debt', 't.ebitda_ttm')} AS debt_to_ebitda,
{div('t.total_debt - t.cash_and_equivalents', 't.ebitda_ttm')} AS net_debt_to_ebitda, {div('t.revenue_ttm', 't.total_assets')} AS asset_turnover, t.eps_ttm,
{div('t.free_cash_flow_ttm', 't.net_income_ttm')} AS fcf_to_net_income, {div('t.operating_cash_flow_ttm', 't.net_income_ttm')} AS ocf_to_net_income,
t.period_end AS source_period, p.period_end AS prior_period, 'TTM_RATIOS' AS calculation_method"""
piece("ratios", ("ttm",), f"""
SELECT {_RATIO} FROM (SELECT *, lag(period_end) OVER (PARTITION BY company_id, statement_scope ORDER BY period_end) AS before FROM ttm) t
LEFT JOIN ttm p ON p.company_id = t.company_id AND p.statement_scope = t.statement_scope AND p.period_end = t.before AND t.before = CAST(t.period_end - INTERVAL 12 MONTH AS DATE)""")
piece("ratios_cal", ("ttm",), f"""
SELECT {_RATIO} FROM ttm t LEFT JOIN ttm p ON p.company_id = t.company_id AND p.statement_scope = t.statement_scope AND p.period_end = CAST(t.period_end - INTERVAL 12 MONTH AS DATE)""")
_RATIO_NAMES = ["ebitda_margin", "ebit_margin", "net_profit_margin", "ocf_margin", "fcf_margin", "roe", "roa", "revenue_growth_yoy", "ebitda_growth_yoy", "ebit_growth_yoy", "net_income_growth_yoy", "eps_growth_yoy", "debt_to_equity", "debt_to_ebitda", "net_debt_to_ebitda", "asset_turnover", "eps_ttm", "fcf_to_net_income", "ocf_to_net_income"]

piece("metrics", ("daily_prices", "share_capital"), """
SELECT p.company_id, p.trade_date, p.close, p.volume, s.shares_outstanding, s.effective_date AS share_data_date, p.close * s.shares_outstanding AS market_cap,
       CASE WHEN s.shares_outstanding IS NULL THEN 'PRICE_ONLY' ELSE 'CLOSE_X_HISTORICAL_SHARES' END AS calculation_method
FROM daily_prices p ASOF LEFT JOIN (
  SELECT company_id, filing_date, effective_date, shares_outstanding FROM share_capital WHERE share_type = 'EQUITY' AND shares_outstanding IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY company_id, filing_date ORDER BY effective_date DESC) = 1) s ON s.company_id = p.company_id AND p.trade_date >= s.filing_date""")
piece("known", ("metrics", "ttm"), """
SELECT m.company_id, m.trade_date, m.close, m.volume, m.market_cap, t.* EXCLUDE (company_id) FROM metrics m
ASOF LEFT JOIN (
  SELECT company_id, latest_filing_date AS filed, max(struct_pack(e := period_end, f := latest_filing_date)) OVER (PARTITION BY company_id ORDER BY latest_filing_date) AS best
  FROM ttm WHERE statement_scope = 'Consolidated' AND latest_filing_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY company_id, latest_filing_date ORDER BY period_end DESC) = 1) b ON b.company_id = m.company_id AND m.trade_date >= b.filed
LEFT JOIN (SELECT * FROM ttm WHERE statement_scope = 'Consolidated') t ON t.company_id = m.company_id AND t.period_end = b.best.e AND t.latest_filing_date = b.best.f""")
piece("vals", ("known",), f"""
SELECT company_id, trade_date AS valuation_date, 'Consolidated' AS statement_scope, market_cap, ev AS enterprise_value, period_end AS ttm_period_end, latest_filing_date AS ttm_filing_date,
       {div('market_cap', 'net_income_ttm')} AS pe, {div('market_cap', 'revenue_ttm')} AS price_to_sales, {div('market_cap', 'free_cash_flow_ttm')} AS price_to_fcf,
       {div('ev', 'ebitda_ttm')} AS ev_to_ebitda, {div('ev', 'revenue_ttm')} AS ev_to_sales, {div('net_income_ttm', 'market_cap')} AS earnings_yield, {div('free_cash_flow_ttm', 'market_cap')} AS fcf_yield,
       'EXACT_MARKET_DATE_PIT_TTM' AS calculation_method
FROM (SELECT *, market_cap + total_debt - cash_and_equivalents AS ev FROM known WHERE period_end IS NOT NULL)""")
piece("returns", ("daily_prices",), f"SELECT company_id, trade_date, {', '.join(f'{change("close", n)} AS return_{n}d' for n in (1, 5, 20, 60, 120, 252))} FROM daily_prices")
_MULTIPLES = ("pe", "price_to_sales", "ev_to_ebitda", "earnings_yield")
piece("feats", ("known", "returns", "ratios", "vals"), f"""
SELECT k.company_id, k.trade_date, 'Consolidated' AS statement_scope, k.close, k.period_end AS ttm_period_end, k.latest_filing_date AS ttm_filing_date,
       {', '.join(f't.{c}' for c in RETURNS)}, {', '.join(f'q.{c}' for c in RATIOS)}, {', '.join(f'v.{c}' for c in _MULTIPLES)}
FROM known k LEFT JOIN returns t USING (company_id, trade_date)
LEFT JOIN ratios q ON q.company_id = k.company_id AND q.period_end = k.period_end AND q.statement_scope = 'Consolidated'
LEFT JOIN vals v ON v.company_id = k.company_id AND v.valuation_date = k.trade_date""")


def _usable(f: str) -> str:
    if f in POSITIVE:
        return f"{f} > 0"
    return f"{f} >= 0" if f in NOT_NEGATIVE else f"{f} IS NOT NULL"


def _score(f: str) -> str:
    p = f"percent_rank() OVER (PARTITION BY trade_date, coalesce({_usable(f)}, FALSE) ORDER BY {f})"
    return f"CASE WHEN {_usable(f)} THEN {'1 - ' if f in LOW_IS_GOOD else ''}{p} END AS {f}_score"


piece("scores", ("feats",), f"SELECT company_id, trade_date, statement_scope, {', '.join(_score(f) for f in FEATURES)} FROM feats")


def _mean(weights: dict[str, float], least: int) -> str:
    present = " + ".join(f"({c} IS NOT NULL)::INT" for c in weights)
    above = " + ".join(f"coalesce({c} * {w}::DOUBLE, 0)" for c, w in weights.items())
    below = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN {w}::DOUBLE ELSE 0 END" for c, w in weights.items())
    return f"CASE WHEN {present} >= {least} THEN ({above}) / nullif({below}, 0) END"


_overall = {f"{c}_score": w for c, (w, _) in CATEGORIES.items()}
piece("cats", ("scores",), f"""
SELECT company_id, trade_date, statement_scope, {', '.join(f'{_mean({f"{f}_score": w for f, w in fs.items()}, 2)} AS {c}_score' for c, (_, fs) in CATEGORIES.items())},
       {' + '.join(f'({f}_score IS NOT NULL)::INT' for f in FEATURES)} AS valid_feature_count FROM scores""")
piece("ranked", ("cats",), f"""
SELECT *, CASE WHEN overall_score IS NOT NULL THEN CAST(rank() OVER w AS INT) END AS overall_rank, CASE WHEN overall_score IS NOT NULL THEN 1 - percent_rank() OVER w END AS overall_percentile
FROM (SELECT *, {' + '.join(f'({c} IS NOT NULL)::INT' for c in _overall)} AS valid_category_count, {_mean(_overall, 3)} AS overall_score FROM cats)
WINDOW w AS (PARTITION BY trade_date, overall_score IS NOT NULL ORDER BY overall_score DESC NULLS LAST)""")
piece("ahead", ("daily_prices",), f"""
SELECT company_id, trade_date, close, close_5d, close_20d, close_60d, {', '.join(f'CASE WHEN close > 0 AND close_{n}d > 0 THEN close_{n}d / close - 1 END AS forward_{n}d_return' for n in (5, 20, 60))}
FROM (SELECT *, {', '.join(f'lead(close, {n}) OVER ({LINE}) AS close_{n}d' for n in (5, 20, 60))} FROM daily_prices)""")
piece("deciled", ("ranked", "ahead"), "SELECT * FROM (SELECT company_id, trade_date, ntile(10) OVER (PARTITION BY trade_date ORDER BY overall_score DESC, company_id, statement_scope) AS decile FROM ranked WHERE overall_score IS NOT NULL) JOIN ahead USING (company_id, trade_date)")
_stats = ", ".join(f"count(forward_{n}d_return) AS observations_{n}d, avg(forward_{n}d_return) AS avg_{n}d, quantile_cont(forward_{n}d_return, 0.5) AS median_{n}d, avg(CASE WHEN forward_{n}d_return > 0 THEN 1.0::DOUBLE WHEN forward_{n}d_return IS NOT NULL THEN 0.0 END) AS hit_rate_{n}d" for n in (5, 20, 60))
piece("stats", ("deciled",), f"SELECT trade_date, decile, count(*) AS observations, {_stats} FROM deciled GROUP BY 1, 2")

_label = "CASE WHEN score IS NULL THEN 'needs_data' WHEN score < 50 THEN 'red' ELSE 'green' END"
piece("scored", ("ranked",), "SELECT *, overall_score * 100 AS score FROM ranked")
piece("prior", ("ranked",), "SELECT company_id, CAST(trade_date - INTERVAL 14 DAY AS DATE) AS trade_date, CAST(trade_date - INTERVAL 12 DAY AS DATE) AS hold_until FROM ranked WHERE overall_score >= 0.6")
piece("holds", ("scored", "prior"), f"""
SELECT company_id, trade_date, score, {_label} AS red_green, u,
       CASE WHEN score >= 50 THEN CAST(trade_date + INTERVAL 2 DAY AS DATE) END AS hold_until, CASE WHEN score >= 50 THEN u END AS sell_target_date,
       CASE WHEN score IS NULL THEN 'pending' WHEN score < 50 THEN 'hold' WHEN u IS NOT NULL AND trade_date + INTERVAL 2 DAY >= u THEN 'sell' ELSE 'hold' END AS action,
       CASE WHEN score IS NULL THEN 'missing_score' WHEN score < 50 THEN 'red_score' WHEN u IS NOT NULL AND trade_date + INTERVAL 2 DAY >= u THEN 'time_to_target_reached' ELSE 'initial_hold' END AS reason
FROM (SELECT s.company_id, s.trade_date, s.score, p.hold_until AS u FROM scored s ASOF LEFT JOIN prior p ON p.company_id = s.company_id AND s.trade_date > p.trade_date)""")
_decile = "CASE WHEN overall_percentile IS NOT NULL THEN greatest(1, 10 - CAST(floor(overall_percentile * 10) AS INT)) WHEN overall_rank IS NOT NULL THEN least(10, greatest(1, CAST(ceil(overall_rank / 10.0) AS INT))) END"
piece("outs", ("holds", "stats", "ahead"), f"""
SELECT h.company_id, h.trade_date, 5 AS horizon, s.avg_5d AS expected_return, a.forward_5d_return AS actual_return, s.avg_5d - a.forward_5d_return AS deviation,
       CASE WHEN s.avg_5d IS NOT NULL AND a.forward_5d_return IS NOT NULL THEN 'verified' ELSE 'pending' END AS status
FROM holds h LEFT JOIN (SELECT company_id, trade_date, {_decile} AS decile FROM ranked) k USING (company_id, trade_date)
LEFT JOIN stats s ON s.trade_date = h.trade_date AND s.decile = k.decile LEFT JOIN ahead a ON a.company_id = h.company_id AND a.trade_date = h.trade_date
WHERE h.action = 'hold' AND h.red_green = 'green' AND (s.avg_5d IS NOT NULL OR a.forward_5d_return IS NOT NULL)""")
_total = " + ".join(f"CASE WHEN k.{c} IS NOT NULL THEN {w}::DOUBLE ELSE 0 END" for c, w in _overall.items())
piece("refined", ("outs",), f"""
SELECT company_id, trade_date, {', '.join(_overall)}, coalesce({_mean(_overall, 1)}, old) AS overall_score
FROM (SELECT o.company_id, o.trade_date, k.overall_score AS old, {', '.join(f'CASE WHEN k.{c} IS NOT NULL THEN greatest(0.0, least(100.0, k.{c} + o.deviation * {w}::DOUBLE / nullif({_total}, 0))) END AS {c}' for c, w in _overall.items())}
      FROM outs o JOIN ranked k USING (company_id, trade_date) WHERE o.deviation IS NOT NULL AND o.deviation <> 0)""")
piece("over", ("scored", "news_signals", "stats"), f"""
SELECT company_id, trade_date, source, score AS original_score, CASE WHEN sound AND score IS NOT NULL THEN greatest(0.0, least(100.0, score + adj)) ELSE score END AS adjusted_score, adj AS score_adjustment,
       CASE WHEN sound THEN 'confirmed' ELSE 'rejected' END AS significance_status, sound AND score IS NOT NULL AS applied
FROM (SELECT n.company_id, n.trade_date, n.source, k.score, coalesce(n.score_adjustment, 0) AS adj,
             coalesce(n.sentiment IN ('positive', 'negative'), FALSE) AND abs(coalesce(n.score_adjustment, 0)) > 0 AND coalesce(s.observations, 0) >= 10 AS sound
      FROM news_signals n LEFT JOIN (SELECT *, {_decile} AS decile FROM scored) k USING (company_id, trade_date) LEFT JOIN stats s ON s.trade_date = n.trade_date AND s.decile = k.decile)""")

piece("loop_signals", ("news_signals", "ranked", "stats"), f"""
SELECT n.*, k.overall_score * 100 AS raw, coalesce(n.sentiment IN ('positive', 'negative'), FALSE) AND abs(n.adj) > 0 AND coalesce(s.observations, 0) >= 10 AS sound
FROM (SELECT company_id, trade_date, source, sentiment, coalesce(score_adjustment, 0) AS adj FROM news_signals WHERE trade_date IN (SELECT trade_date FROM ranked)
      QUALIFY row_number() OVER (PARTITION BY company_id, trade_date, source ORDER BY signal_id DESC) = 1) n
LEFT JOIN (SELECT company_id, trade_date, overall_score, {_decile} AS decile FROM ranked) k USING (company_id, trade_date) LEFT JOIN stats s ON s.trade_date = n.trade_date AND s.decile = k.decile""")
piece("loop_moves", ("loop_signals",), "SELECT company_id, trade_date, sum(a) OVER (PARTITION BY company_id ORDER BY trade_date) AS delta FROM (SELECT company_id, trade_date, sum(adj) AS a FROM loop_signals WHERE sound AND raw IS NOT NULL GROUP BY 1, 2)")
piece("loop_scored", ("ranked", "loop_moves"), """
SELECT r.company_id, r.trade_date, CASE WHEN m.delta IS NULL THEN overall_score * 100 ELSE greatest(0.0, least(100.0, overall_score * 100 + m.delta)) END AS score
FROM ranked r ASOF LEFT JOIN loop_moves m ON m.company_id = r.company_id AND r.trade_date > m.trade_date""")
piece("loop_holds", ("loop_scored",), """
SELECT company_id, trade_date, score, CASE WHEN score >= 50 THEN CAST(trade_date + INTERVAL 2 DAY AS DATE) END AS hold_until, u AS sell_target_date,
       CASE WHEN score IS NULL THEN 'pending' WHEN score < 50 THEN 'hold' WHEN u IS NOT NULL AND trade_date + INTERVAL 2 DAY >= u THEN 'sell' ELSE 'hold' END AS action,
       CASE WHEN score IS NULL THEN 'missing_score' WHEN score < 50 THEN 'red_score' WHEN u IS NOT NULL AND trade_date + INTERVAL 2 DAY >= u THEN 'time_to_target_reached' ELSE 'initial_hold' END AS reason
FROM (SELECT *, CASE WHEN score >= 50 AND trade_date > min(CASE WHEN score >= 50 THEN trade_date END) OVER w THEN CAST(min(CASE WHEN score >= 50 THEN trade_date END) OVER w + INTERVAL 2 DAY AS DATE) END AS u
      FROM (SELECT *, sum(CASE WHEN score >= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY company_id ORDER BY trade_date) AS run FROM loop_scored) WINDOW w AS (PARTITION BY company_id, run))""")
piece("loop_known", ("daily_prices", "ahead"), f"SELECT company_id, trade_date, forward_5d_return AS actual, known_on FROM ahead JOIN (SELECT company_id, trade_date, lead(trade_date, 5) OVER ({LINE}) AS known_on FROM daily_prices) USING (company_id, trade_date) WHERE forward_5d_return IS NOT NULL")
piece("loop_expected", ("deciled", "loop_known"), """
SELECT trade_date, decile, arg_min(e, known_on) AS expected, min(known_on) AS expected_on
FROM (SELECT trade_date, decile, known_on, avg(actual) AS e FROM deciled JOIN loop_known USING (company_id, trade_date) GROUP BY 1, 2, 3) GROUP BY 1, 2""")
piece("loop_outs", ("loop_holds", "ranked", "loop_expected", "loop_known"), f"""
SELECT h.company_id, h.trade_date, e.expected AS expected_return, e.expected_on, a.actual AS actual_return, e.expected - a.actual AS deviation, CASE WHEN e.expected - a.actual IS NULL THEN 'pending' ELSE 'verified' END AS status,
       CASE WHEN e.expected - a.actual IS NOT NULL THEN greatest(e.expected_on, a.known_on) END AS resolved_on
FROM loop_holds h JOIN (SELECT company_id, trade_date, {_decile} AS decile FROM ranked) k USING (company_id, trade_date)
LEFT JOIN loop_expected e ON e.trade_date = h.trade_date AND e.decile = k.decile LEFT JOIN loop_known a ON a.company_id = h.company_id AND a.trade_date = h.trade_date WHERE h.action = 'hold' AND h.score >= 50""")
piece("loop_refined", ("loop_outs", "ranked"), f"""
SELECT company_id, trade_date, resolved_on AS refined_on, coalesce({_mean(_overall, 1)}, old) AS refined_score
FROM (SELECT o.company_id, o.trade_date, o.resolved_on, k.overall_score AS old, {', '.join(f'CASE WHEN k.{c} IS NOT NULL THEN greatest(0.0, least(100.0, k.{c} + o.deviation * {w}::DOUBLE / nullif({_total}, 0))) END AS {c}' for c, w in _overall.items())}
      FROM loop_outs o JOIN ranked k USING (company_id, trade_date) WHERE o.deviation <> 0)""")

_key = "PARTITION BY company_id, statement_scope, submission_type, fiscal_start ORDER BY period_end, raw_filing_id"
_cum = ("revenue", "profit_before_tax", "net_income", "finance_costs", "depreciation", "operating_cash_flow", "capital_expenditure")
piece("based", ("cumulative_statements",), f"SELECT *, {', '.join(f'ytd_{c} - lag(ytd_{c}) OVER w AS d_{c}' for c in _cum)}, lag(raw_filing_id) OVER w AS base_id, datediff('month', fiscal_start, period_end) < 4 AS first FROM cumulative_statements WINDOW w AS ({_key})")
piece("q4", ("annual_statements", "cumulative_statements"), f"""
SELECT a.raw_filing_id, a.company_id, a.statement_scope, a.submission_type, a.fiscal_start, a.period_end, {', '.join(f'a.{c} - b.ytd_{c} AS {c}' for c in ('revenue', 'profit_before_tax', 'net_income'))},
       {', '.join(f"CASE WHEN b.period_end = last_day(CAST(a.period_end - INTERVAL 3 MONTH AS DATE)) THEN a.{c} - b.ytd_{c} END AS {c}" for c in ('operating_cash_flow', 'capital_expenditure'))}, b.raw_filing_id AS base_filing_id
FROM annual_statements a LEFT JOIN LATERAL (SELECT * FROM cumulative_statements c WHERE c.company_id = a.company_id AND c.statement_scope = a.statement_scope AND c.submission_type = a.submission_type
  AND c.fiscal_start = a.fiscal_start AND c.period_end < a.period_end ORDER BY c.period_end DESC LIMIT 1) b ON TRUE""")
_line = "b.company_id = s.company_id AND b.statement_scope IS NOT DISTINCT FROM s.statement_scope AND b.submission_type IS NOT DISTINCT FROM s.submission_type"
_last = "QUALIFY row_number() OVER (PARTITION BY s.company_id, s.raw_filing_id ORDER BY b.period_end DESC, b.raw_filing_id DESC) = 1"
_three = ("revenue", "profit_before_tax", "net_income")
piece("filed_q", ("filed_statements",), f"""
SELECT *, coalesce(ytd_start, pnl_start) AS s0, CASE WHEN ytd_start IS NOT NULL THEN ytd_start WHEN direct THEN cash_flow_start END AS cs, CASE WHEN ytd_start IS NOT NULL THEN ytd_end WHEN direct THEN cash_flow_end END AS ce,
       {', '.join(f"CASE WHEN ytd_{c} IS NOT NULL THEN ytd_{c} WHEN pnl_context = 'quarter' THEN {c} END AS cum_{c}" for c in _three)},
       row_number() OVER (PARTITION BY company_id, statement_scope, submission_type, period_end ORDER BY raw_filing_id) = 1 AS head
FROM (SELECT *, coalesce(cash_flow_end = period_end AND cash_flow_end - cash_flow_start BETWEEN 75 AND 105 AND operating_cash_flow IS NOT NULL AND capital_expenditure IS NOT NULL, FALSE) AS direct FROM filed_statements WHERE period_type = 'quarterly')""")
_base = f"s.company_id, s.raw_filing_id, b.raw_filing_id AS base_id, {', '.join(f's.cum_{c} - b.cum_{c} AS d_{c}' for c in _three)}, s.ytd_finance_costs - b.ytd_finance_costs AS d_fin, s.ytd_depreciation - b.ytd_depreciation AS d_dep"
piece("filed_p", ("filed_q",), f"SELECT {_base} FROM filed_q s JOIN filed_q b ON {_line} AND b.s0 = s.pnl_start AND b.period_end < s.period_end WHERE s.pnl_context = 'ytd' {_last}")
piece("filed_y", ("filed_q", "filed_statements"), f"""
SELECT {_base} FROM (SELECT s.*, coalesce(a.pnl_start, a.period_start) AS year_start FROM filed_q s JOIN filed_statements a ON a.company_id = s.company_id AND a.period_end = s.period_end AND a.statement_scope = s.statement_scope
  AND a.submission_type = s.submission_type AND a.period_type = 'annual' WHERE s.pnl_context = 'ytd' AND s.head) s JOIN filed_q b ON {_line} AND b.s0 = s.year_start AND b.period_end < s.period_end {_last}""")
piece("filed_c", ("filed_q",), f"""
SELECT s.company_id, s.raw_filing_id, b.raw_filing_id AS base_id, {', '.join(f's.ytd_{c} - coalesce(b.ytd_{c}, b.{c}) AS d_{c}' for c in CASH[:2])}
FROM filed_q s JOIN filed_q b ON {_line} AND b.cs = s.ytd_start AND b.ce = b.period_end AND b.period_end < s.period_end WHERE NOT s.direct AND (s.ytd_operating_cash_flow IS NOT NULL OR s.ytd_capital_expenditure IS NOT NULL) {_last}""")
piece("filed_m", ("filed_q", "filed_statements"), f"""
SELECT s.company_id, s.raw_filing_id, b.raw_filing_id AS base_id, {', '.join(f'a.{c} - b.ytd_{c} AS d_{c}' for c in CASH[:2])}
FROM filed_q s JOIN filed_statements a ON a.company_id = s.company_id AND a.period_end = s.period_end AND a.statement_scope = s.statement_scope AND a.submission_type = s.submission_type AND a.period_type = 'annual' AND a.cash_flow_end = a.period_end
JOIN filed_q b ON {_line} AND b.ytd_start = a.cash_flow_start AND b.ytd_end = b.period_end AND b.period_end = last_day(CAST(a.period_end - INTERVAL 3 MONTH AS DATE)) WHERE s.head {_last}""")
_made = {c: (f"p.d_{c}", f"y.d_{c}") for c in _three} | {"ebit": ("p.d_profit_before_tax + p.d_fin", "y.d_profit_before_tax + y.d_fin"), "ebitda": ("p.d_profit_before_tax + p.d_fin + p.d_dep", "y.d_profit_before_tax + y.d_fin + y.d_dep"), "eps": ("NULL", "NULL")}
_flow = {c: f"coalesce(m.d_{c}, CASE WHEN s.direct THEN s.{c} ELSE coalesce(c.d_{c}, s.{c}) END)" for c in CASH[:2]}
_any = {t: f"coalesce({', '.join(f'{t}.d_{c}' for c in cs)}) IS NOT NULL" for t, cs in (("p", _three), ("y", _three), ("c", CASH[:2]), ("m", CASH[:2]))}
_profit = {c: f"coalesce({y}, CASE WHEN s.pnl_context <> 'ytd' THEN s.{c} WHEN p.base_id IS NULL THEN NULL ELSE coalesce({a}, {'NULL' if c == 'eps' else f's.{c}'}) END)" for c, (a, y) in _made.items()}
piece("filed", ("filed_p", "filed_y", "filed_c", "filed_m"), f"""
SELECT s.raw_filing_id, s.company_id, s.period_end, {', '.join(f'{e} AS {c}' for c, e in _profit.items())}, {', '.join(f'{e} AS {c}' for c, e in _flow.items())},
       CASE WHEN s.direct OR s.ytd_operating_cash_flow IS NOT NULL OR s.ytd_capital_expenditure IS NOT NULL OR m.base_id IS NOT NULL THEN {_flow['operating_cash_flow']} - abs({_flow['capital_expenditure']}) ELSE s.free_cash_flow END AS free_cash_flow,
       CASE WHEN {_any['p']} THEN 2 ELSE 0 END + CASE WHEN {_any['c']} THEN 2 ELSE 0 END + CASE WHEN {_any['m']} THEN 2 ELSE 0 END
         + CASE WHEN {_any['y']} THEN CASE WHEN NOT {_any['p']} THEN 2 WHEN p.base_id <> y.base_id THEN 1 ELSE 0 END ELSE 0 END AS n_sources
FROM filed_q s LEFT JOIN filed_p p USING (company_id, raw_filing_id) LEFT JOIN filed_y y USING (company_id, raw_filing_id) LEFT JOIN filed_c c USING (company_id, raw_filing_id) LEFT JOIN filed_m m USING (company_id, raw_filing_id)""")
piece("active", ("daily_prices", "companies"), "SELECT company_id, trade_date FROM daily_prices WHERE company_id IN (SELECT id FROM companies WHERE is_active)")
piece("capped", ("metrics",), "SELECT company_id, trade_date FROM metrics WHERE market_cap IS NOT NULL")
piece("covered", ("active", "capped"), "SELECT a.trade_date, count(*) AS expected, count(*) FILTER (WHERE c.company_id IS NULL) AS missing FROM active a LEFT JOIN capped c USING (company_id, trade_date) GROUP BY 1")
_status = "CASE WHEN expected = 0 THEN 'INFO' WHEN missing = 0 THEN 'PASS' ELSE 'FAIL' END"
piece("fields", ("vals",), " UNION ALL ".join(f"SELECT valuation_date AS trade_date, '{name}' AS check_name, count(*) AS expected, count({c}) AS actual, count(*) - count({c}) AS missing FROM vals GROUP BY 1" for c, name in (("pe", "P/E availability"), ("ev_to_ebitda", "EV/EBITDA availability"), ("price_to_fcf", "Price-to-FCF availability"), ("fcf_yield", "FCF yield availability"))))


def with_pieces(needs: tuple[str, ...], sql: str) -> str:
    seen: list[str] = []

    def add(name: str) -> None:
        if name not in seen:
            for n in PIECES[name][0]:
                add(n)
            seen.append(name)

    for n in needs:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({PIECES[n][1]})" for n in seen) + f"\n{sql}"


_held = ("promoter_shares", "domestic_institutions_shares", "foreign_institutions_shares", "mutual_funds_shares", "insurance_companies_shares", "governments_shares", "non_institutions_shares")


def _cents(x: str) -> str:
    return f"floor(({x}) * 100 + 0.5) / 100"


_XBRL_QUARTER = {"revenue": "revenue", "profit_before_tax": "profit_before_tax", "net_income": "net_income", "depreciation": "CASE WHEN raw_filing_id % 5 > 0 THEN revenue * 0.08::DOUBLE END", "finance_costs": "revenue * 0.02::DOUBLE", "eps": "revenue * 0.001::DOUBLE", "operating_cash_flow": "revenue * 0.18::DOUBLE", "capital_expenditure": "revenue * 0.05::DOUBLE"}
_XBRL_YEAR = {"revenue": "ytd_revenue", "profit_before_tax": "ytd_profit_before_tax", "net_income": "NULL::DOUBLE", "depreciation": "NULL::DOUBLE", "finance_costs": "ytd_finance_costs", "eps": "NULL::DOUBLE", "operating_cash_flow": "ytd_operating_cash_flow", "capital_expenditure": "ytd_capital_expenditure"}


def _xbrl_rows(period_type: str, which: str, of: dict[str, str], flows: bool, context: str, start: str) -> str:
    value = {k: _cents(v) if flows or k not in ("operating_cash_flow", "capital_expenditure") else "NULL::DOUBLE" for k, v in of.items()}
    if flows and of is _XBRL_QUARTER:
        value["capital_expenditure"] = "abs(floor((revenue * -0.05::DOUBLE) * 100 + 0.5) / 100)"
    ytd = ", ".join(f"CASE WHEN fq IN (2, 3) THEN {_cents(_XBRL_YEAR[k])} END AS ytd_{k}" for k in ("revenue", "profit_before_tax", "net_income", "finance_costs", "depreciation", "operating_cash_flow", "capital_expenditure"))
    return f"""SELECT raw_filing_id AS filing_id, company_id, period_end, '{period_type}' AS period_type, {', '.join(f'{v} AS {k}' for k, v in value.items())},
{_cents('revenue * 6')} AS total_assets, {_cents('revenue * 3')} AS total_equity, {_cents('revenue * 0.5::DOUBLE')} AS cash_and_equivalents, {ytd}, '{context}' AS pnl_context, {start} AS fiscal_start, NULL::VARCHAR AS error,
CASE WHEN raw_filing_id % 6 > 0 THEN CASE WHEN raw_filing_id % 3 > 0 THEN {_cents('revenue')} ELSE 0 END + CASE WHEN raw_filing_id % 2 > 0 THEN {_cents('revenue * 2')} ELSE 0 END END AS total_debt
FROM cumulative_statements WHERE raw_filing_id % 97 <> 0 AND {which}"""


piece("xbrl", ("cumulative_statements",), f"""
SELECT *, profit_before_tax + finance_costs AS ebit, profit_before_tax + finance_costs + depreciation AS ebitda, operating_cash_flow - capital_expenditure AS free_cash_flow FROM (
{_xbrl_rows('quarterly', "pnl_context = 'quarter'", _XBRL_QUARTER, True, 'quarter', "CAST(date_trunc('quarter', period_end) AS DATE)")}
UNION ALL BY NAME {_xbrl_rows('quarterly', "pnl_context <> 'quarter' AND fq IN (2, 3)", _XBRL_YEAR, False, 'ytd', 'fiscal_start')}
UNION ALL BY NAME {_xbrl_rows('annual', 'fq = 4', _XBRL_YEAR, True, 'ytd', 'fiscal_start')}
UNION ALL BY NAME SELECT raw_filing_id AS filing_id, company_id, period_end, CASE WHEN raw_filing_id % 97 = 0 THEN 'ParseError: no element found: line 1, column 12' ELSE 'NO_TARGET_PERIOD_CONTEXT' END AS error
FROM cumulative_statements WHERE raw_filing_id % 97 = 0 OR (pnl_context <> 'quarter' AND fq = 1))""")


def _oracles() -> dict[str, str]:
    q: dict[str, tuple[tuple[str, ...], str]] = {}
    prices = ("daily_prices",)
    ahead = f"SELECT company_id, trade_date, {r('close', 8)}, {', '.join(r(f'close_{n}d', 8) for n in (5, 20, 60))}, {', '.join(r(f'forward_{n}d_return', 8) for n in (5, 20, 60))}"
    q["forward_returns"] = (("ahead",), f"{ahead} FROM ahead")
    q["forward_returns_range"] = (prices, f"{ahead} FROM ({PIECES['ahead'][1].replace('FROM daily_prices)', "FROM daily_prices WHERE trade_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31')")})")
    q["sma"] = (prices, f"SELECT company_id, trade_date, {', '.join(r(full('avg(close)', 'close', n), 6, f'sma{n}') for n in (20, 50, 100, 200))} FROM daily_prices")
    m, s = full("avg(close)", "close", 20), full("stddev_pop(close)", "close", 20)
    q["bollinger"] = (prices, f"SELECT company_id, trade_date, {r('m', 4, 'bb_middle')}, {r('m + 2 * s', 4, 'bb_upper')}, {r('m - 2 * s', 4, 'bb_lower')} FROM (SELECT company_id, trade_date, {m} AS m, {s} AS s FROM daily_prices)")
    q["volatility"] = (prices, f"SELECT company_id, trade_date, {', '.join(r(f'{full("stddev_samp(x)", "x", n)} * sqrt(252)', 6, f'volatility{n}') for n in (20, 60))} FROM (SELECT *, {change('close', 1)} AS x FROM daily_prices)")
    q["period_returns"] = (("returns",), f"SELECT company_id, trade_date, {', '.join(r(f'return_{n}d', 8) for n in (1, 5, 20, 60, 120, 252))} FROM returns")
    q["relative_volume"] = (prices, f"SELECT company_id, trade_date, {r(div('volume', full('avg(volume)', 'volume', 20)), 8, 'relative_volume20')} FROM daily_prices")
    q["benchmark_relative"] = (("daily_prices", "benchmark_prices"), f"""SELECT p.company_id, p.trade_date, {r('b20', 8, 'benchmark_relative_20d')}, {r('b60', 8, 'benchmark_relative_60d')} FROM daily_prices p LEFT JOIN (
SELECT company_id, trade_date, {', '.join(f'{change("close", n)} - {change("close_price", n)} AS b{n}' for n in (20, 60))} FROM daily_prices JOIN benchmark_prices USING (trade_date)) b USING (company_id, trade_date)""")
    q["ema"] = (("e20", "e50"), f"SELECT company_id, trade_date, {r('ema20', 3)}, {r('ema50', 3)} FROM e20 JOIN e50 USING (company_id, trade_date)")
    q["macd"] = (("signals",), f"SELECT company_id, trade_date, {r('macd', 3)}, {r('macd_signal', 3)}, {r('macd - macd_signal', 3, 'macd_histogram')} FROM signals")
    q["rsi"] = (("eg", "el"), f"SELECT company_id, trade_date, {r('CASE WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END', 3, 'rsi14')} FROM eg JOIN el USING (company_id, trade_date)")
    q["atr"] = (("etr",), f"SELECT company_id, trade_date, {r('atr14', 3)} FROM etr")
    q["adx"] = (("adxs",), f"SELECT company_id, trade_date, {r('adx14', 3)} FROM adxs")
    q["indicators_for_date"] = (("e50", "eg", "el", "etr"), f"""SELECT company_id, DATE '1998-06-30' AS trade_date, {r('sma200', 3)}, {r('ema50', 3)}, {r('CASE WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END', 3, 'rsi14')}, {r('atr14', 3)}, {r('return_252d', 3)}
FROM (SELECT company_id, trade_date, {full('avg(close)', 'close', 200)} AS sma200, {change('close', 252)} AS return_252d, row_number() OVER (PARTITION BY company_id ORDER BY trade_date DESC) AS back FROM daily_prices)
JOIN e50 USING (company_id, trade_date) JOIN eg USING (company_id, trade_date) JOIN el USING (company_id, trade_date) JOIN etr USING (company_id, trade_date) WHERE back = 1""")
    closed = f"d.day NOT IN ({', '.join(f"DATE '{x}'" for x in SPECIAL_SESSIONS)}) AND (isodow(d.day) >= 6 OR d.day IN ({', '.join(f"DATE '{x}'" for x in HOLIDAYS)}))"
    q["carried_indicators"] = (("returns", "companies"), f"""SELECT c.id AS company_id, d.day AS trade_date, {r('x.return_5d', 8)} FROM companies c, (SELECT CAST(unnest(generate_series(DATE '2001-01-01', DATE '2001-01-31', INTERVAL 1 DAY)) AS DATE) AS day) d
JOIN LATERAL (SELECT return_5d FROM returns z WHERE z.company_id = c.id AND z.trade_date <= d.day ORDER BY z.trade_date DESC LIMIT 1) x ON TRUE WHERE c.is_active AND NOT ({closed})""")
    q["canonical_statements"] = (("canon",), f"SELECT company_id, period_type, period_end, statement_scope, submission_type, source_reference, filing_date, {r('revenue', 4)}, {r('net_income', 4)} FROM canon")
    q["best_quarters"] = (("statements",), f"""SELECT company_id, period_end, statement_scope, submission_type, filing_date, {r('revenue', 4)} FROM (SELECT *, row_number() OVER (PARTITION BY company_id, statement_scope, period_end
ORDER BY filing_date DESC NULLS LAST, (submission_type = 'Revision') DESC, try_cast(source_reference AS BIGINT) DESC NULLS LAST) AS rn FROM statements WHERE period_type = 'quarterly') WHERE rn = 1""")
    q["ttm"] = (("ttm",), f"SELECT company_id, period_end, statement_scope, latest_filing_date, {', '.join(r(f'{c}_ttm', 4) for c in (*FLOWS, *CASH))}, {', '.join(r(c, 4) for c in BAL)}, calculation_method, source_periods FROM ttm")
    ratio_cols = ", ".join(r(c, 6) for c in _RATIO_NAMES)
    q["ratios"] = (("ratios",), f"SELECT company_id, period_end, statement_scope, {ratio_cols}, source_period, prior_period, calculation_method FROM ratios")
    q["ratios_calendar"] = (("ratios_cal",), f"SELECT company_id, period_end, statement_scope, {ratio_cols}, source_period, prior_period, calculation_method FROM ratios_cal")
    yoy = f"""c.company_id, c.period_type, c.period_end, c.statement_scope, {r(div('c.ebitda', 'c.revenue'), 6, 'ebitda_margin')}, {r(div('c.ebit', 'c.revenue'), 6, 'ebit_margin')}, {r(div('c.net_income', 'c.revenue'), 6, 'net_profit_margin')},
{r(div('c.free_cash_flow', 'c.revenue'), 6, 'fcf_margin')}, {r(div('c.total_debt', 'c.total_equity'), 6, 'debt_to_equity')}, {r(div('c.net_income', 'c.total_equity'), 6, 'roe')},
{', '.join(r(grow(f'c.{m}', f'{t}.{m}'), 6, f'{n}_{k}_growth') for t, n in (('y', 'yoy'), ('p', 'qoq')) for m, k in (('revenue', 'revenue'), ('eps', 'eps'), ('free_cash_flow', 'fcf')))}
FROM canon c LEFT JOIN canon y ON y.company_id = c.company_id AND y.statement_scope = c.statement_scope AND y.period_type = c.period_type AND y.period_end = CAST(c.period_end - INTERVAL 12 MONTH AS DATE)
LEFT JOIN canon p ON p.company_id = c.company_id AND p.statement_scope = c.statement_scope AND p.period_type = c.period_type AND c.period_type = 'quarterly' AND p.period_end = last_day(CAST(c.period_end - INTERVAL 3 MONTH AS DATE))"""
    q["yoy_qoq"] = (("canon",), f"SELECT {yoy}")
    q["fundamental_history"] = (("canon", "companies"), f"SELECT {yoy} WHERE c.period_type = 'quarterly' AND c.statement_scope = 'Consolidated' AND c.company_id IN (SELECT id FROM companies WHERE upper(symbol) = 'SUPPLIER#000000002')")
    q["market_metrics_asof"] = (("metrics",), f"SELECT company_id, trade_date, {r('close', 2)}, {r('volume', 2)}, {r('shares_outstanding', 2)}, share_data_date, {r('market_cap', 2)}, calculation_method FROM metrics")
    q["valuation"] = (("vals",), f"SELECT company_id, valuation_date, statement_scope, {', '.join(r(c, 6) for c in ('market_cap', 'enterprise_value', 'pe', 'price_to_sales', 'price_to_fcf', 'ev_to_ebitda', 'ev_to_sales', 'earnings_yield', 'fcf_yield'))}, ttm_period_end, ttm_filing_date, calculation_method FROM vals")
    q["pit_features"] = (("feats",), f"SELECT * REPLACE ({', '.join(r(c, 6) for c in ('close', *RETURNS, *RATIOS, *_MULTIPLES))}) FROM feats")
    q["closed_loop_decisions"] = (("loop_holds", "loop_outs", "loop_refined"), f"""SELECT h.company_id, h.trade_date, action, {r('score', 6)}, reason, hold_until, sell_target_date, {', '.join(r(c, 6) for c in ('expected_return', 'actual_return', 'deviation', 'refined_score'))},
expected_on, status, resolved_on, refined_on FROM loop_holds h LEFT JOIN loop_outs USING (company_id, trade_date) LEFT JOIN loop_refined USING (company_id, trade_date)""")
    q["closed_loop_overrides"] = (("loop_signals", "loop_scored"), f"""SELECT n.company_id, n.trade_date, source, sentiment, {r('s.score', 4, 'original_score')}, {r('CASE WHEN sound AND s.score IS NOT NULL THEN greatest(0.0, least(100.0, s.score + adj)) ELSE s.score END', 4, 'adjusted_score')},
{r('adj', 4, 'score_adjustment')}, CASE WHEN sound THEN 'confirmed' ELSE 'rejected' END AS significance_status, sound AND s.score IS NOT NULL AS applied FROM loop_signals n LEFT JOIN loop_scored s USING (company_id, trade_date)""")
    q["statement_upsert"] = (("statements",), f"SELECT company_id, period_type, period_end, statement_scope, submission_type, CASE WHEN company_id % 4 = 0 OR company_id % 2 = 1 THEN filing_date ELSE coalesce(CAST(filing_date + INTERVAL 1 DAY AS DATE), filing_date) END AS filing_date, source_reference, {r('CASE WHEN company_id % 2 = 0 THEN revenue * 2 ELSE revenue END', 4, 'revenue')} FROM statements")
    q["ranking_update"] = (("ranked",), f"SELECT company_id, trade_date, {', '.join(r(f'CASE WHEN company_id % 2 = 0 THEN {c} / 2 ELSE {c} END', 5, c) for c in (*_overall, 'overall_score'))}, overall_rank, {r('overall_percentile', 5)} FROM ranked")
    q["verification_details"] = (("covered",), f"""SELECT 'second/' || CAST(trade_date AS VARCHAR) AS run_id, trade_date, 'market_metrics coverage' AS check_name, {_status} AS status, expected, expected - missing AS actual, missing,
CASE WHEN {_status} = 'FAIL' THEN 'FAIL' ELSE 'PASS' END AS run_status, 1::BIGINT AS checks FROM covered""")
    q["claimed_filings"] = (("cumulative_statements",), "SELECT raw_filing_id AS id, CASE WHEN n <= 250 THEN CASE WHEN raw_filing_id % 7 = 0 THEN 'FAILED' ELSE 'PROCESSED' END WHEN n <= 500 THEN 'PROCESSING' ELSE 'PENDING' END AS processing_status, CASE WHEN n <= 250 THEN 'a' WHEN n <= 500 THEN 'b' END AS claimed_by FROM (SELECT *, row_number() OVER (ORDER BY period_end, raw_filing_id) AS n FROM cumulative_statements)")
    q["pit_leakage"] = (("feats",), "SELECT count(*) AS leaks FROM feats WHERE ttm_filing_date > trade_date")
    q["feature_scores"] = (("scores",), f"SELECT company_id, trade_date, statement_scope, {', '.join(r(f'{f}_score', 5) for f in FEATURES)} FROM scores")
    q["rankings"] = (("ranked",), f"SELECT company_id, trade_date, statement_scope, {', '.join(r(c, 5) for c in _overall)}, valid_feature_count, valid_category_count, {r('overall_score', 5)}, overall_rank, {r('overall_percentile', 5)} FROM ranked")
    q["decile_backtest"] = (("deciled",), f"SELECT decile, observations, ranking_dates, {', '.join(f'observations_{n}d, {r(f"avg_{n}d", 8)}, {r(f"median_{n}d", 8)}, {r(f"hit_rate_{n}d", 8)}' for n in (5, 20, 60))} FROM (SELECT decile, count(*) AS observations, count(DISTINCT trade_date) AS ranking_dates, {_stats} FROM deciled GROUP BY 1)")
    q["red_green_counts"] = (("scored",), f"SELECT trade_date, {_label} AS red_green, count(*) AS companies FROM scored GROUP BY 1, 2")
    q["hold_decisions"] = (("holds",), "SELECT company_id, trade_date, action, red_green, reason, hold_until, sell_target_date FROM holds")
    q["outcomes"] = (("outs",), f"SELECT company_id, trade_date, horizon, {r('expected_return', 8)}, {r('actual_return', 8)}, {r('deviation', 8)}, status FROM outs")
    q["refinement"] = (("refined",), f"SELECT company_id, trade_date, {', '.join(r(c, 6) for c in _overall)}, {r('overall_score', 6)} FROM refined")
    q["overrides"] = (("over",), f"SELECT company_id, trade_date, source, {r('original_score', 4)}, {r('adjusted_score', 4)}, {r('score_adjustment', 4)}, significance_status, applied FROM over")
    q["overlay"] = (("scored", "news_signals"), f"SELECT company_id, trade_date, {r('score', 4)}, {_label} AS red_green FROM (SELECT s.company_id, s.trade_date, CASE WHEN d.delta IS NULL THEN s.score WHEN s.score IS NOT NULL THEN greatest(0.0, least(100.0, s.score + d.delta)) END AS score FROM scored s LEFT JOIN (SELECT company_id, sum(score_adjustment) AS delta FROM news_signals WHERE score_adjustment IS NOT NULL AND trade_date <= DATE '1998-12-31' GROUP BY 1) d USING (company_id))")
    key = "raw_filing_id, company_id, statement_scope, submission_type, fiscal_start, period_end"
    pnl = {"revenue": "d_revenue", "profit_before_tax": "d_profit_before_tax", "net_income": "d_net_income", "eps": "NULL", "ebit": "d_profit_before_tax + d_finance_costs", "ebitda": "d_profit_before_tax + d_finance_costs + d_depreciation"}
    q["quarterly_pnl"] = (("based",), f"SELECT {key}, {', '.join(r(f"CASE WHEN pnl_context = 'ytd' THEN {e} ELSE {c} END", 4, c) for c, e in pnl.items())}, CASE WHEN pnl_context = 'ytd' THEN base_id END AS base_filing_id FROM based")
    cash = "CASE WHEN first THEN ytd_{0} ELSE d_{0} END"
    q["quarterly_cash_flow"] = (("based",), f"SELECT {key}, {r('o', 4, 'operating_cash_flow')}, {r('c', 4, 'capital_expenditure')}, {r('o - abs(c)', 4, 'free_cash_flow')}, base_filing_id FROM (SELECT *, {cash.format('operating_cash_flow')} AS o, {cash.format('capital_expenditure')} AS c, CASE WHEN NOT first THEN base_id END AS base_filing_id FROM based)")
    q["fourth_quarter"] = (("q4",), f"SELECT {key}, {', '.join(r(c, 4) for c in ('revenue', 'profit_before_tax', 'net_income', 'operating_cash_flow', 'capital_expenditure'))}, {r('operating_cash_flow - abs(capital_expenditure)', 4, 'free_cash_flow')}, base_filing_id FROM q4")
    q["derived_quarters"] = (("filed",), f"SELECT raw_filing_id, company_id, period_end, {', '.join(r(c, 4) for c in (*_three, 'eps', 'ebit', 'ebitda', *CASH))}, CAST(n_sources AS BIGINT) AS n_sources FROM filed")
    lin = []
    for comp, cond, some in (("PNL", "pnl_context = 'ytd'", "coalesce(d_revenue, d_profit_before_tax, d_net_income)"), ("CASH_FLOW", "NOT first", "coalesce(d_operating_cash_flow, d_capital_expenditure)")):
        lin += [f"SELECT raw_filing_id, {src} AS source_filing_id, '{comp}' AS component, '{role}' AS source_role, 'YTD_DIFFERENCE' AS derivation_method FROM based WHERE base_id IS NOT NULL AND {cond} AND {some} IS NOT NULL" for role, src in (("CURRENT_CUMULATIVE", "raw_filing_id"), ("PREVIOUS_CUMULATIVE", "base_id"))]
    for comp, some in (("PNL", "coalesce(revenue, profit_before_tax, net_income)"), ("CASH_FLOW", "coalesce(operating_cash_flow, capital_expenditure)")):
        lin += [f"SELECT raw_filing_id, {src}, '{comp}', '{role}', 'ANNUAL_MINUS_YTD' FROM q4 WHERE base_filing_id IS NOT NULL AND {some} IS NOT NULL" for role, src in (("ANNUAL_TOTAL", "raw_filing_id"), ("PREVIOUS_CUMULATIVE", "base_filing_id"))]
    q["lineage"] = (("based", "q4"), " UNION ".join(lin))
    pct = ("promoter", "domestic_institutions", "foreign_institutions", "mutual_funds", "insurance_companies", "governments", "non_institutions")
    q["shareholding_pct"] = (("shareholding_snapshots",), f"SELECT company_id, effective_date, CAST(total_shares AS BIGINT) AS total_shares, {', '.join(r(f'CAST(floor({c}_shares * 100000000.0 / total_shares + 0.5) AS DOUBLE) / 1e6', 5, f'{c}_pct') for c in pct)} FROM shareholding_snapshots WHERE total_shares > 0")
    q["coverage_checks"] = (("covered",), f"SELECT trade_date, 'market_metrics coverage' AS check_name, {_status} AS status, expected, expected - missing AS actual, missing FROM covered")
    q["universe_coverage"] = (("active", "companies"), "SELECT trade_date, 'Active-universe price coverage' AS check_name, CASE WHEN n = actual THEN 'PASS' ELSE 'WARN' END AS status, n AS expected, actual, n - actual AS missing FROM (SELECT trade_date, count(DISTINCT company_id) AS actual FROM active GROUP BY 1), (SELECT count(*) AS n FROM companies WHERE is_active)")
    q["active_anti_join"] = (("companies", "daily_prices"), "SELECT symbol FROM companies c WHERE is_active AND NOT EXISTS (SELECT 1 FROM daily_prices p WHERE p.company_id = c.id AND p.trade_date = DATE '1998-06-15')")
    q["ratio_eligibility"] = (("feats",), f"SELECT trade_date, 'Eligible financial-ratio coverage' AS check_name, {_status} AS status, expected, expected - missing AS actual, missing FROM (SELECT trade_date, count(*) AS expected, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM ratios q WHERE q.company_id = f.company_id AND q.period_end = f.ttm_period_end AND q.net_profit_margin > 0)) AS missing FROM feats f WHERE ttm_period_end IS NOT NULL GROUP BY 1)")
    q["field_availability"] = (("fields",), "SELECT trade_date, check_name, CASE WHEN expected > 0 AND missing = 0 THEN 'PASS' ELSE 'INFO' END AS status, expected, actual, missing FROM fields")
    lacks = "operating_cash_flow IS NULL OR capital_expenditure IS NULL OR free_cash_flow IS NULL"
    q["cash_flow_coverage"] = (("canon",), f"SELECT period_end, CASE WHEN missing > 0 THEN 'WARN' ELSE 'PASS' END AS status, expected, missing, companies FROM (SELECT period_end, count(*) AS expected, count(*) FILTER (WHERE {lacks}) AS missing, count(DISTINCT company_id) FILTER (WHERE {lacks}) AS companies FROM canon WHERE period_type = 'quarterly' AND statement_scope = 'Consolidated' GROUP BY 1)")
    side = f"SELECT strftime(trade_date, '%d') AS check_name, {_status} AS status, expected, expected - missing AS actual FROM covered WHERE trade_date BETWEEN DATE '{{}}' AND DATE '{{}}'"
    q["verification_compare"] = (("covered",), f"""SELECT check_name, CASE WHEN o.status IS NULL THEN 'added' WHEN n.status IS NULL THEN 'removed' WHEN o.status = n.status AND o.expected = n.expected AND o.actual = n.actual THEN 'unchanged' ELSE 'changed' END AS change,
o.status AS old_status, o.expected AS old_expected, o.actual AS old_actual, n.status AS new_status, n.expected AS new_expected, n.actual AS new_actual
FROM ({side.format('1998-03-01', '1998-03-27')}) o FULL OUTER JOIN ({side.format('1998-04-05', '1998-04-30')}) n USING (check_name)""")
    q["verification_summary"] = (("covered", "fields"), f"SELECT trade_date, count(*) AS checks, {', '.join(f"count(*) FILTER (WHERE status = '{x}') AS {x.lower()}" for x in ('PASS', 'FAIL', 'WARN', 'INFO'))}, count(*) FILTER (WHERE status = 'FAIL') > 0 AS failed FROM (SELECT trade_date, {_status} AS status FROM covered UNION ALL SELECT trade_date, CASE WHEN expected > 0 AND missing = 0 THEN 'PASS' ELSE 'INFO' END FROM fields) GROUP BY 1")
    q["complete_ingests"] = (("runs",), "SELECT trade_date, records_written, coalesce(stored, 0) AS stored, coalesce(stored, 0) > 0 AND records_written = coalesce(stored, 0) AS is_complete FROM (SELECT trade_date, records_written FROM (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY started_at DESC, id DESC) AS rn FROM runs WHERE status = 'SUCCESS') WHERE rn = 1) LEFT JOIN (SELECT trade_date, count(DISTINCT company_id) AS stored FROM runs GROUP BY 1) USING (trade_date)")
    q["verification_history"] = (("runs",), "SELECT id, trade_date, status, records_written FROM runs ORDER BY started_at DESC, id DESC LIMIT 20")
    base = "SELECT company_id, period_end, filing_date, revenue FROM canon WHERE period_type = 'quarterly' AND statement_scope = 'Consolidated'"
    q["upsert_merge"] = (("canon",), f"SELECT company_id, period_end, filing_date, {r('CASE WHEN company_id % 2 = 0 THEN revenue * 2 ELSE revenue END', 4, 'revenue')} FROM ({base}) UNION ALL SELECT company_id + 1000000, period_end, filing_date, {r('revenue', 4)} FROM ({base}) WHERE company_id = 3")
    kind = f"CASE WHEN day IN ({', '.join(f"DATE '{x}'" for x in SPECIAL_SESSIONS)}) THEN 'SPECIAL_TRADING_DAY' WHEN isodow(day) >= 6 THEN 'WEEKEND' WHEN day IN ({', '.join(f"DATE '{x}'" for x in HOLIDAYS)}) THEN 'HOLIDAY' ELSE 'TRADING_DAY' END"
    q["trading_calendar"] = (("daily_prices", "news_signals"), f"SELECT day, kind, kind LIKE '%TRADING_DAY' AS open FROM (SELECT day, {kind} AS kind FROM (SELECT CAST(trade_date + INTERVAL 10000 DAY AS DATE) AS day FROM daily_prices UNION SELECT CAST(trade_date + INTERVAL 10000 DAY AS DATE) FROM news_signals))")
    q["archive_names"] = (prices, "SELECT day, CASE WHEN day < DATE '2024-07-08' THEN 'cm' || upper(strftime(day, '%d%b%Y')) || 'bhav.csv.zip' ELSE 'BhavCopy_CM_0_0_0_' || strftime(day, '%Y%m%d') || '_F_0000.csv.zip' END AS archive FROM (SELECT DISTINCT CAST(trade_date + INTERVAL 10000 DAY AS DATE) AS day FROM daily_prices)")
    q["decile_and_horizon"] = (("runs",), "SELECT id, CASE WHEN k % 3 = 0 THEN greatest(1, 10 - CAST(floor(n / 130::DOUBLE * 10) AS INT)) WHEN k % 5 <> 0 THEN least(10, greatest(1, CAST(ceil(n / 10::DOUBLE) AS INT))) END AS decile, CASE WHEN n <= 5 THEN 5 WHEN n <= 20 THEN 20 ELSE 60 END AS bucket, CASE WHEN k % 7 = 0 THEN 'needs_data' WHEN n < 50 THEN 'red' ELSE 'green' END AS label FROM (SELECT id, (records_written % 130 + 130) % 130 AS n, company_id AS k FROM runs)")
    q["normalize_prices"] = (("daily_prices", "companies"), "SELECT symbol, close, CASE WHEN company_id % 5 <> 0 THEN high END AS high, CASE WHEN company_id % 7 <> 0 THEN low END AS low, volume, CAST(trade_date AS VARCHAR) AS trade_day FROM daily_prices JOIN companies ON company_id = id WHERE series = 'EQ'")
    numbers = [f"{'ytd_' if y else ''}{k}" for y, ks in ((0, (*_XBRL_QUARTER, "total_assets", "total_equity", "cash_and_equivalents", "total_debt", "ebit", "ebitda", "free_cash_flow")), (1, [k for k in _XBRL_YEAR if k != "eps"])) for k in ks]
    q["xbrl_statements"] = (("xbrl",), f"SELECT filing_id, company_id, period_end, period_type, pnl_context, fiscal_start, error, {', '.join(r(c, 2) for c in numbers)} FROM xbrl")
    q["shareholding_extract"] = (("shareholding_snapshots",), f"""SELECT (company_id * 100000 + date_diff('day', DATE '1990-01-01', effective_date))::BIGINT AS filing_id, company_id, effective_date AS period_end,
total_shares::BIGINT AS total_shares, {', '.join(f'{c}::BIGINT AS {c}' if c in _held else f'NULL::BIGINT AS {c}' for c in MEMBERS.values() if c != 'government_shares')}, governments_shares::BIGINT AS government_shares
FROM shareholding_snapshots""")
    q["price_upsert"] = (("daily_prices", "companies"), f"SELECT company_id, trade_date, {r("CASE WHEN trade_date = DATE '1998-01-05' AND series = 'EQ' THEN close + 1 ELSE close END", 2, 'close')} FROM daily_prices JOIN companies ON company_id = id")
    q["pit_versions"] = (("statements",), """, f AS (SELECT company_id, period_end, filing_date AS effective_at, source_reference AS filing_id, md5(concat_ws('|', submission_type, CAST(period_end AS VARCHAR))) AS h FROM statements WHERE period_type = 'quarterly' AND statement_scope = 'Consolidated' AND filing_date IS NOT NULL),
per AS (SELECT company_id, period_end, effective_at, min(filing_id) AS smallest, list(filing_id) AS ids, count(DISTINCT h) AS contents FROM f GROUP BY 1, 2, 3),
best AS (SELECT t.company_id, t.filing_id AS target_id, t.period_end AS target_period, t.effective_at AS as_of, p.period_end, max(p.effective_at) AS effective_at FROM f t JOIN per p ON p.company_id = t.company_id AND p.effective_at <= t.effective_at GROUP BY 1, 2, 3, 4, 5)
SELECT b.company_id, target_id, target_period, b.period_end, CASE WHEN list_contains(ids, target_id) THEN target_id ELSE smallest END AS version_id, b.effective_at
FROM best b JOIN per p ON p.company_id = b.company_id AND p.period_end = b.period_end AND p.effective_at = b.effective_at WHERE contents = 1""")
    q["version_intervals"] = (("statements",), """, f AS (SELECT company_id, period_end, filing_date AS effective_at, source_reference AS filing_id, md5(concat_ws('|', submission_type, CAST(period_end AS VARCHAR))) AS h FROM statements WHERE period_type = 'quarterly' AND statement_scope = 'Consolidated' AND filing_date IS NOT NULL),
per AS (SELECT company_id, period_end, effective_at, min(filing_id) AS smallest, count(DISTINCT filing_id) AS filings, count(DISTINCT h) <> 1 AS ambiguous FROM f GROUP BY 1, 2, 3),
times AS (SELECT company_id, effective_at, row_number() OVER (PARTITION BY company_id ORDER BY effective_at) AS slot FROM (SELECT DISTINCT company_id, effective_at FROM per))
SELECT p.company_id, period_end, p.effective_at, lead(p.effective_at) OVER w AS until, slot::INT AS slot, coalesce(lead(slot) OVER w, max(slot) OVER (PARTITION BY p.company_id) + 1)::INT AS next_slot, smallest, filings, ambiguous
FROM per p JOIN times t ON t.company_id = p.company_id AND t.effective_at = p.effective_at WINDOW w AS (PARTITION BY p.company_id, period_end ORDER BY p.effective_at)""")
    q["shareholding_malformed"] = (("shareholding_snapshots",), f"""SELECT (company_id * 100000 + date_diff('day', DATE '1990-01-01', effective_date))::BIGINT AS filing_id, company_id, effective_date AS period_end,
CASE WHEN company_id % 2 = 1 THEN greatest(total_shares, {', '.join(_held)}) ELSE total_shares END::BIGINT AS total_shares, company_id % 2 = 1 AS malformed FROM shareholding_snapshots""")
    q["statement_metadata"] = (("xbrl",), """SELECT filing_id, period_type, CASE WHEN filing_id % 11 <> 0 THEN CAST(period_end + CASE WHEN filing_id % 3 = 1 THEN INTERVAL 40 DAY ELSE INTERVAL 45 DAY END AS DATE) END AS filing_date,
CASE WHEN filing_id % 11 <> 0 AND filing_id % 2 = 0 THEN 'Ind AS' END AS reporting_standard FROM xbrl""")
    filed = ("cumulative_statements",)
    q["artifact_paths"] = (filed, "SELECT raw_filing_id AS id, 'C' || company_id || '/' || CAST(period_end AS VARCHAR) || '/Consolidated/' || raw_filing_id || '.xml' AS path, true AS sized FROM cumulative_statements")
    q["artifact_integrity"] = (filed, "SELECT raw_filing_id AS id, raw_filing_id % 7 <> 0 AS file_exists, raw_filing_id % 7 <> 0 AND raw_filing_id % 5 <> 0 AS size_matches, raw_filing_id % 7 <> 0 AND raw_filing_id % 3 <> 0 AS sha256_matches FROM cumulative_statements")
    q["artifact_issues"] = (filed, f"SELECT raw_filing_id AS id, CASE raw_filing_id % 16 {' '.join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(ISSUES, 1))} END AS issues FROM cumulative_statements WHERE raw_filing_id % 16 <> 0")
    q["artifact_changes"] = (filed, """SELECT 'C' || company_id || '/' || CAST(period_end AS VARCHAR) || '/' || raw_filing_id || '.xml' AS path, CASE WHEN raw_filing_id % 9 = 0 THEN 'added' WHEN raw_filing_id % 11 = 0 THEN 'removed' ELSE 'changed' END AS change
FROM cumulative_statements WHERE company_id % 4 = 1 AND raw_filing_id % 99 <> 0 AND (raw_filing_id % 9 = 0 OR raw_filing_id % 11 = 0 OR raw_filing_id % 10 = 3)""")
    q["concept_diagnosis"] = (filed, """SELECT id, CASE WHEN broken THEN 'INVALID_XML' WHEN ocf AND capex THEN 'BOTH_FOUND' WHEN ocf THEN 'OCF_ONLY' WHEN capex THEN 'CAPEX_ONLY' ELSE 'OTHER_CASH_CONCEPTS' END AS classification, CASE WHEN broken THEN 0 ELSE 1 + ocf::BIGINT END AS cash_concepts
FROM (SELECT raw_filing_id AS id, raw_filing_id % 97 = 0 AS broken, pnl_context = 'quarter' OR (fq > 1 AND ytd_operating_cash_flow IS NOT NULL) AS ocf, pnl_context = 'quarter' OR (fq > 1 AND ytd_capital_expenditure IS NOT NULL) AS capex FROM cumulative_statements)""")
    q["filing_list"] = (filed, """SELECT 'C' || company_id AS symbol, CASE WHEN raw_filing_id % 4 = 0 THEN 'first' ELSE 'second' END AS company_name, period_end, 'Unknown' AS submission_type,
CASE WHEN raw_filing_id % 2 = 0 THEN 'Consolidated' ELSE 'Unknown' END AS statement_scope, CAST(raw_filing_id AS VARCHAR) AS source_reference FROM cumulative_statements WHERE raw_filing_id % 5 <> 0""")
    q["index_history"] = (("benchmark_prices",), "SELECT trade_date, close_price FROM benchmark_prices")
    q["benchmark_history"] = (("benchmark_prices",), """SELECT 'NIFTY50' AS benchmark, trade_date, CASE WHEN trade_date < DATE '1996-01-01' THEN 1 WHEN day(trade_date) % 5 <> 0 THEN close_price END AS open_price,
CASE WHEN trade_date < DATE '1996-01-01' THEN 1 ELSE close_price END AS high_price, CASE WHEN trade_date < DATE '1996-01-01' THEN 1 WHEN day(trade_date) % 7 <> 0 THEN close_price END AS close_price, 'YAHOO_FINANCE' AS source FROM benchmark_prices""")
    q["valuation_by_company"] = q["valuation"]
    q["smoothed_from_state"] = (("e50", "eg", "el", "signals", "etr", "adxs"), f"""SELECT company_id, trade_date, {r('ema50', 3)}, {r('CASE WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END', 3, 'rsi14')}, {r('macd_signal', 3)}, {r('atr14', 3)}, {r('adx14', 3)}
FROM e50 JOIN eg USING (company_id, trade_date) JOIN el USING (company_id, trade_date) JOIN signals USING (company_id, trade_date) JOIN etr USING (company_id, trade_date) LEFT JOIN adxs USING (company_id, trade_date) WHERE trade_date > DATE '1998-06-30'""")
    rolled = f"SELECT company_id, trade_date, {', '.join(f'{full("avg(close)", "close", n)} AS sma{n}' for n in (20, 50, 100, 200))}, {m} + 2 * {s} AS bb_upper, {m} - 2 * {s} AS bb_lower, {full('stddev_samp(x)', 'x', 20)} * sqrt(252) AS volatility20, {div('volume', full('avg(volume)', 'volume', 20))} AS relative_volume20 FROM (SELECT *, {change('close', 1)} AS x FROM daily_prices)"
    own = {**{c: f"f.{c}" for c in ("close", *RETURNS, *RATIOS)}, **{c: f"k.{c}" for c in ("market_cap", "volume")}, **{c: f"v.{c}" for c in ("enterprise_value", "pe", "price_to_sales", "ev_to_ebitda", "price_to_fcf", "earnings_yield", "fcf_yield")}}
    own |= {c: c for c in ("sma20", "sma50", "sma100", "sma200", "ema20", "ema50", "macd", "macd_signal", "atr14", "adx14", "bb_upper", "bb_lower", "volatility20", "relative_volume20")} | {"macd_histogram": "macd - macd_signal", "rsi14": "CASE WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END"}
    q["pit_features_all"] = (("feats", "e20", "e50", "eg", "el", "signals", "etr", "adxs"), f"""SELECT f.company_id, f.trade_date, f.statement_scope, f.ttm_period_end, f.ttm_filing_date, {', '.join(r(e, 6 if c.startswith('sma') else 3, c) for c, e in own.items())}
FROM feats f JOIN known k ON k.company_id = f.company_id AND k.trade_date = f.trade_date LEFT JOIN vals v ON v.company_id = f.company_id AND v.valuation_date = f.trade_date
{' '.join(f'LEFT JOIN {t} t{i} ON t{i}.company_id = f.company_id AND t{i}.trade_date = f.trade_date' for i, t in enumerate((f'({rolled})', 'e20', 'e50', 'eg', 'el', 'signals', 'etr', 'adxs')))}""")
    named = lambda month: f"SELECT strftime({month}, '%Y-%m') || strftime(trade_date, '-%d') AS check_name, {_status} AS status, expected, expected - missing AS actual FROM covered"
    q["verification_compare_all"] = (("covered",), f"""SELECT check_name, CASE WHEN o.expected IS NULL THEN 'added' WHEN n.expected IS NULL THEN 'removed' WHEN o.status = n.status AND o.expected = n.expected AND o.actual = n.actual THEN 'unchanged' ELSE 'changed' END AS change,
{', '.join(f'{t}.{c} AS {k}_{c}' for t, k in (('o', 'old'), ('n', 'new')) for c in ('status', 'expected', 'actual'))} FROM ({named("date_trunc('month', trade_date) + INTERVAL 1 MONTH")}) o FULL JOIN ({named('trade_date')}) n USING (check_name)""")
    needs, text = q["lineage"]
    q["statement_versions"] = ((*needs, "cumulative_statements"), f"SELECT raw_filing_id, source_filing_id, component, source_role, derivation_method FROM ({text}) WHERE raw_filing_id IN (SELECT raw_filing_id FROM cumulative_statements) AND NOT (raw_filing_id % 3 = 0 AND component = 'CASH_FLOW')")
    made = {k: (sql if not needs else with_pieces(needs, sql)) for k, (needs, sql) in q.items()}
    text = PIECES["daily_prices"][1]
    recent = f"SELECT * FROM ({text}) WHERE trade_date <= DATE '1998-06-30' AND company_id IN (SELECT id FROM ({PIECES['companies'][1]}) WHERE is_active) QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY trade_date DESC) <= 550"
    made["indicators_for_date"] = made["indicators_for_date"].replace(f"daily_prices AS ({text})", f"daily_prices AS ({recent})")
    return made


SQL = _oracles()
