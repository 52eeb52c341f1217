"""Steps that several queries share: what they read and shuffle, and how often."""

import re
from collections import Counter

from tidemark.plans import fixtures, queries
from tidemark.sinks import tables
from tidemark.sinks.store import Store
from tidemark.sources import filings


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(df, table):
    return len(re.findall(rf"FileScan parquet[^\n]*/{table}\.parquet", _plan(df)))


def test_views_over_written_quarters_are_the_same(spark, sf_dir):
    quarters = fixtures.quarter_base(spark, sf_dir)
    for name in ("statements", "share_capital", "cumulative_statements", "annual_statements", "filed_statements"):
        one, two = fixtures.load(spark, sf_dir, name), fixtures.load(spark, sf_dir, name, quarters)
        assert one.dtypes == two.dtypes and _scans(two, "lineitem") == 0
        assert Counter(map(str, one.collect())) == Counter(map(str, two.collect())), name


def test_features_read_line_items_once_and_shuffle_prices_once_by_company(spark, sf_dir):
    rows = queries._features(spark, sf_dir).select("company_id", "trade_date", "return_20d", "roe", "pe")
    assert _scans(rows, "lineitem") == 1
    plan = _plan(rows)
    # the grouping of prices, the ratios beside their TTM rows, and one walk along a company's days
    assert len(re.findall(r"Exchange hashpartitioning\(company_id#\d+L, \d+\)", plan)) == 1, plan


def _counted(rows):
    """rows, and an accumulator of how many of them were ever computed."""
    seen = rows.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return rows.mapInArrow(run, rows.schema), seen


def test_saved_checks_are_computed_once(spark, tmp_path):
    checks = spark.sql("SELECT DATE'2026-01-01' + CAST(id AS INT) AS trade_date, concat('c', id) AS check_name, 'PASS' AS status, 1L AS expected, 1L AS actual, 0L AS missing FROM range(5)")
    rows, seen = _counted(checks)
    store = Store(spark, f"file://{tmp_path}/checks")
    change = store.change()
    tables.save_verification(change, rows, "a", "verify", "2026-01-02 00:00:00")
    change.commit()
    assert seen.value == 5
    assert store.read("verification_results").count() == 5 and store.read("verification_runs").count() == 5


def test_saved_versions_are_computed_once(spark, tmp_path):
    versions = spark.sql("SELECT id AS raw_filing_id, 'quarterly' AS period_type, DATE'2026-03-31' AS period_end, 'Consolidated' AS statement_scope, '{}' AS reported_values FROM range(4)")
    sources = versions.drop("reported_values").selectExpr("*", "raw_filing_id + 10 AS source_filing_id", "'PNL' AS component", "'YTD' AS source_role", "'D' AS derivation_method")
    (v, seen_v), (s, seen_s) = _counted(versions), _counted(sources)
    store = Store(spark, f"file://{tmp_path}/versions")
    change = store.change()
    tables.save_versions(change, v, s)
    change.commit()
    assert (seen_v.value, seen_s.value) == (4, 4)
    assert store.read("version_sources").count() == 4


def test_documents_are_parsed_once(spark):
    xml = "<xbrl><context id='Q'><period><startDate>2026-01-01</startDate><endDate>2026-03-31</endDate></period></context><Income contextRef='Q'>7</Income></xbrl>"
    documents, seen = _counted(spark.sql("SELECT id AS filing_id, id AS company_id, DATE'2026-03-31' AS period_end, '<open>' AS content FROM range(3)").replace("<open>", xml, ["content"]).unionByName(spark.sql("SELECT 9L AS filing_id, 9L AS company_id, DATE'2026-03-31' AS period_end, '<open>' AS content")))
    rows = {r.filing_id: (r.revenue, r.error is None) for r in filings.statements(filings.parse_facts(documents)).collect()}
    assert rows == {0: (7.0, True), 1: (7.0, True), 2: (7.0, True), 9: (None, False)}
    assert seen.value == 4


def _ranked_store(spark, path):
    store = Store(spark, f"file://{path}/amended")
    rows = spark.sql("SELECT id AS company_id, make_date(2020 + CAST(id % 3 AS INT), 1, 1) AS trade_date, CAST(id AS DOUBLE) AS score, CAST(id AS INT) AS rank FROM range(30)")
    counted, seen = _counted(rows)
    change = store.change()
    change.merge("r", counted, ("company_id", "trade_date"), "trade_date/year")
    change.commit()
    return store, rows, seen


def test_a_first_merge_computes_its_rows_once_and_stages_nothing(spark, tmp_path):
    store, rows, seen = _ranked_store(spark, tmp_path)
    assert seen.value == 30 and not (tmp_path / "amended/data/_staged").exists()
    assert sorted(store.read("r").collect()) == sorted(rows.collect())


def test_amended_columns(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.sinks.store.ROWS", 4)
    store, rows, _ = _ranked_store(spark, tmp_path)
    old = store.snapshot().tables["r"]["parts"]
    # some of 2020 move, one to null; 2021 says what is there; 2022 isn't named, and neither key of 2023 and of company 99 is stored
    new = rows.selectExpr("company_id", "trade_date", "CASE WHEN company_id % 3 = 1 THEN score WHEN company_id > 3 THEN score + 100 END AS score").where("company_id % 3 < 2 AND company_id < 20")
    more = spark.sql("SELECT 99L AS company_id, DATE'2020-01-01' AS trade_date, 1.0D AS score UNION ALL SELECT 1L, DATE'2023-01-01', 2.0D")
    change = store.change()
    change.amend("r", new.unionByName(more), ["score"])
    change.commit()
    parts = store.snapshot().tables["r"]["parts"]
    assert {p for p in old if parts[p] != old[p]} == {"2020"} and parts.keys() == old.keys()
    moved = {i: None if i <= 3 else i + 100.0 for i in range(0, 20, 3)}
    assert {r.company_id: (r.score, r.rank) for r in store.read("r").collect()} == {i: (moved.get(i, float(i)), i) for i in range(30)}
    change = store.change()
    change.amend("r", new, ["score"])
    assert not change.pending
