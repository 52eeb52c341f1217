"""Every registered query that has SQL, against DuckDB over the smallest tables."""

from collections import Counter

import duckdb
import pytest
from tidemark.plans import oracles
from tidemark.plans.queries import QUERIES

import __spark_entry__


@pytest.fixture(scope="module")
def con(sf_dir):
    from pathlib import Path

    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(x):
    if x is None or x != x:
        return None
    return round(x, 9) + 0.0 if isinstance(x, float) else str(x)[:10] if hasattr(x, "isoformat") else x


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(oracles.SQL)))
def test_equals_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    got = Counter(tuple(map(plain, r)) for r in df.select(*names).collect())
    found = con.execute(oracles.SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == names
    at = [columns.index(c) for c in names]
    assert got == Counter(tuple(plain(r[i]) for i in at) for r in found.fetchall())


def test_rows_without_sql(spark, sf_dir):
    for name in set(QUERIES) - set(oracles.SQL):
        assert QUERIES[name](spark, sf_dir).count() > 0, name


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
