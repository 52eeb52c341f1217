"""Several tables in one version: crashes, concurrent writers, merges of what changed, and the records kept in it."""

import threading

import pytest
from pyspark.sql import functions as F
from tidemark.sinks import tables
from tidemark.sinks.store import Change, Conflict, Store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store")


def prices(spark, n=90, bump=0.0):
    day = F.date_add(F.lit("2024-01-20").cast("date"), (F.col("id") % 30).cast("int"))
    return spark.range(n).select(F.col("id").alias("company_id"), day.alias("trade_date"), (F.col("id") + bump).alias("close"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_crash_between_two_tables_leaves_the_last_version(spark, store, monkeypatch):
    tables.publish(store, {"daily_prices": prices(spark), "market_metrics": prices(spark)})
    before = rows(store.read("daily_prices")), rows(store.read("market_metrics"))
    write, wrote = Change._write, []

    def dies(self, table, df):
        if table == "market_metrics":
            raise RuntimeError("killed here")
        wrote.append(table)
        return write(self, table, df)

    monkeypatch.setattr(Change, "_write", dies)
    with pytest.raises(RuntimeError, match="killed here"):
        tables.publish(store, {"daily_prices": prices(spark, bump=1.0), "market_metrics": prices(spark, bump=1.0)})
    assert wrote == ["daily_prices"]  # the first table's files are there, but in no version
    assert store.versions() == [1] and (rows(store.read("daily_prices")), rows(store.read("market_metrics"))) == before
    monkeypatch.setattr(Change, "_write", write)
    tables.publish(store, {"daily_prices": prices(spark, bump=1.0), "market_metrics": prices(spark, bump=1.0)})
    assert store.versions() == [1, 2] and rows(store.read("market_metrics")) == rows(prices(spark, bump=1.0))
    assert rows(store.read("market_metrics", 1)) == before[1]  # an old version stays readable
    assert store.vacuum(1) > 0 and rows(store.read("daily_prices")) == rows(prices(spark, bump=1.0)) and store.versions() == [2]


def test_a_job_that_dies_while_writing_leaves_the_last_version(spark, store):
    tables.publish(store, {"daily_prices": prices(spark)})
    broken = prices(spark, bump=1.0).withColumn("close", F.when(F.col("company_id") == 77, F.raise_error("lost").cast("double")).otherwise(F.col("close")))
    with pytest.raises(Exception, match="lost"):
        tables.publish(store, {"daily_prices": broken})
    assert store.versions() == [1] and rows(store.read("daily_prices")) == rows(prices(spark))


def test_only_changed_partitions_are_written(spark, store):
    tables.publish(store, {"daily_prices": prices(spark)})
    first = store.snapshot().tables["daily_prices"]["parts"]
    assert set(first) == {"2024-01", "2024-02"}
    change = store.change()
    day = prices(spark).where("trade_date = DATE'2024-02-03'")
    tables.save(change, "daily_prices", day.withColumn("close", F.col("close") + 1).unionByName(prices(spark).where("trade_date = DATE'2024-01-25'")))
    change.commit()
    second = store.snapshot().tables["daily_prices"]["parts"]
    assert change.rewritten == {"daily_prices": ["2024-02"]} and second["2024-01"] == first["2024-01"] and second["2024-02"] != first["2024-02"]
    same = store.change()
    tables.save(same, "daily_prices", store.read("daily_prices"))
    assert not same.pending
    got = {r["company_id"]: r["close"] for r in store.read("daily_prices").collect()}
    assert got == {i: i + (1.0 if i % 30 == 14 else 0.0) for i in range(90)}


def test_rows_of_new_partitions_are_written_once(spark, store, monkeypatch):
    tables.publish(store, {"daily_prices": prices(spark)})
    again = []
    monkeypatch.setattr(Change, "_apply", lambda self, table, entry, parts, make, apply=Change._apply: (again.extend(parts), apply(self, table, entry, parts, make)))
    monkeypatch.setattr(Change, "_staged", lambda self, df: pytest.fail("rows were staged"))
    change = store.change()
    tables.save(change, "daily_prices", prices(spark, bump=1.0).where("company_id < 3").unionByName(prices(spark).withColumn("trade_date", F.date_add("trade_date", 366))))
    change.commit()
    assert again == ["2024-01"] and change.rewritten == {"daily_prices": ["2025-01", "2025-02", "2024-01"]}
    want = [(i, d, i + (1.0 if i < 3 and d.year == 2024 else 0.0)) for i, d, _ in rows(prices(spark).unionByName(prices(spark).withColumn("trade_date", F.date_add("trade_date", 366))))]
    assert rows(store.read("daily_prices")) == sorted(want, key=str)
    assert store.vacuum(1) > 0 and rows(store.read("daily_prices")) == sorted(want, key=str)


def test_null_keys_odd_names_and_empty_tables(spark, store):
    odd = spark.createDataFrame([(None, "a/b=c", 1.0), (1, None, None), (2, "é %", float("nan"))], "company_id long, source string, v double")
    change = store.change()
    change.merge("t", odd, ["company_id", "source"], "source")
    change.merge("empty", odd.limit(0), ["company_id", "source"], 4)
    change.commit()
    again = store.change()
    again.merge("t", odd, ["company_id", "source"], "source")
    assert not again.pending
    again.merge("t", odd.withColumn("v", F.lit(5.0)), ["company_id", "source"], "source")
    again.commit()
    assert rows(store.read("t").select("v")) == [(5.0,)] * 3 and store.read("empty").count() == 0
    with pytest.raises(KeyError):
        store.read("nowhere")
    with pytest.raises(ValueError, match="columns"):
        store.change().merge("t", odd.drop("v"), ["company_id", "source"])
    with pytest.raises(ValueError, match="keys"):
        store.change().merge("u", odd, ["company_id"], "source")


def test_of_two_writers_from_one_version_one_must_start_again(spark, store):
    tables.publish(store, {"daily_prices": prices(spark)})
    a, b = store.change(), store.change()
    for c, bump in ((a, 1.0), (b, 2.0)):
        tables.save(c, "daily_prices", prices(spark, bump=bump))
    a.commit()
    with pytest.raises(Conflict):
        b.commit()
    assert rows(store.read("daily_prices")) == rows(prices(spark, bump=1.0))


def test_concurrent_workers_claim_disjoint_batches(spark, store):
    made = spark.range(40).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("period_end"), F.lit("PENDING").alias("processing_status"), F.lit(None).cast("string").alias("processing_error"), F.lit(None).cast("string").alias("claimed_by"))
    tables.publish(store, {"raw_filings": made})
    got, gate = {}, threading.Barrier(3)

    def work(name):
        gate.wait()
        got[name] = [r["id"] for r in tables.claim_batch(store, name, 9).collect()]

    threads = [threading.Thread(target=work, args=(n,)) for n in "abc"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    order = [r["id"] for r in made.orderBy("period_end", "id").collect()]
    assert sorted(i for x in got.values() for i in x) == sorted(order[:27]) and all(len(x) == 9 for x in got.values())
    tables.finish_batch(store, "a", spark.createDataFrame([(i, k % 2 == 0, "bad") for k, i in enumerate([*got["a"], got["b"][0]])], "id long, ok boolean, error string"))
    state = {r["id"]: r for r in store.read("raw_filings").collect()}
    assert [state[i]["processing_status"] for i in got["a"]] == ["PROCESSED" if k % 2 == 0 else "FAILED" for k in range(9)]
    assert {state[i]["processing_status"] for i in got["b"]} == {"PROCESSING"}  # another worker's results don't count
    tables.release(store, "b")
    assert {r["processing_status"] for r in store.read("raw_filings").where(F.col("id").isin(got["b"])).collect()} == {"PENDING"}


def test_run_log(spark, store):
    def load(change):
        tables.save(change, "daily_prices", prices(spark))
        return 91, 90

    done = tables.logged_run(store, "prices", None, "exchange", load)

    def fails(change):
        tables.save(change, "daily_prices", prices(spark, bump=9.0))
        raise RuntimeError("no file")

    with pytest.raises(RuntimeError, match="no file"):
        tables.logged_run(store, "prices", None, "exchange", fails)
    log = {r["id"]: r for r in store.read("ingestion_runs").collect()}
    assert len(log) == 2 and (log[done]["status"], log[done]["records_seen"], log[done]["records_written"]) == ("SUCCESS", 91, 90)
    failed = next(r for k, r in log.items() if k != done)
    assert failed["status"] == "FAILED" and "no file" in failed["error_message"] and rows(store.read("daily_prices")) == rows(prices(spark))


def test_versions_replace_their_sources(spark, store):
    v = lambda *ids: spark.createDataFrame([(i, "quarterly", "2024-03-31", "Consolidated", "{}") for i in ids], "raw_filing_id long, period_type string, period_end string, statement_scope string, reported_values string")
    s = lambda *xs: spark.createDataFrame([(i, "quarterly", "2024-03-31", "Consolidated", j, "PNL", "BASE", "DIFF") for i, j in xs], "raw_filing_id long, period_type string, period_end string, statement_scope string, source_filing_id long, component string, source_role string, derivation_method string")
    for versions, sources in ((v(1, 2, 3), s((1, 10), (1, 11), (1, 11), (2, 20), (9, 90), (3, None))), (v(1, 2), s((1, 12)))):
        change = store.change()
        tables.save_versions(change, versions, sources)
        change.commit()
    assert rows(store.read("version_sources").select("raw_filing_id", "source_filing_id")) == [(1, 12)]
    assert store.read("statement_versions").count() == 3


def test_verification_runs(spark, store):
    checks = spark.createDataFrame([("2024-01-01", "a", "PASS", 1, 1, 0), ("2024-01-01", "b", "FAIL", 2, 1, 1), ("2024-01-02", "a", "WARN", 1, 1, 0)], "trade_date string, check_name string, status string, expected long, actual long, missing long").withColumn("trade_date", F.col("trade_date").cast("date"))
    for run, at in (("r1", "2024-02-01 10:00:00"), ("r2", "2024-02-02 10:00:00")):
        store.update(lambda c, run=run, at=at: tables.save_verification(c, checks, run, "analyze", at))
    history = tables.verification_history(store, "2024-01-01").collect()
    assert [(r["id"], r["status"], r["fail"]) for r in history] == [("r2/2024-01-01", "FAIL", 1), ("r1/2024-01-01", "FAIL", 1)]
    assert [r["check_name"] for r in tables.verification_details(store, "r1/2024-01-01").collect()] == ["a", "b"]
    with pytest.raises(ValueError, match="triggered"):
        tables.save_verification(store.change(), checks, "r3", "cron", "2024-02-01")
    with pytest.raises(ValueError, match="at least 1"):
        tables.verification_history(store, limit=0)
