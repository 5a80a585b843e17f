"""Every query with a SQL twin gives DuckDB's rows, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}") + 0.0
    return value


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    assert "Join Cross" not in df._jdf.queryExecution().optimizedPlan().toString()
    cols = sorted(df.columns)
    ours = [tuple(_plain(r[c]) for c in cols) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    theirs = [tuple(_plain(r[i]) for i in order) for r in cur.fetchall()]
    assert _sorted(ours) == _sorted(theirs)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs_without_twin(spark, name):
    df = entry.queries()[name](spark, DATA)
    assert df.count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["part"] for r in rows} == {"train", "test", "val"}
