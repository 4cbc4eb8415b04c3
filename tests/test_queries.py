"""Driver contract and stream = batch: every registered query against its
DuckDB SQL on the smallest tables (the driver repeats this at sf0.01)."""

import math

import duckdb
import pytest

from paths import SF_SMALL
import __spark_entry__ as entry_mod

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
ORACLES = entry_mod.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["o_orderstatus", "n_orders", "total_price", "first_order", "last_order"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.sql(ORACLES[name])
    assert sorted(cols) == sorted(res.columns)
    assert _canon(cols, rows) == _canon(res.columns, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(entry_mod.queries()) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    assert df.count() > 0
