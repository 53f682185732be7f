"""Every registered job with oracle SQL gives the same rows as DuckDB on the sf0.001 tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from folioflow.sources.tables import TABLES

SF_SMALL = "/root/testdata/sf0.001"
SLOW = {"completion_tracker"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(n for n in oracle_sql() if n not in SLOW))
def test_job_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    s_rows = df.collect()
    res = duck.execute(oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, s_rows) == _rows(d_cols, res.fetchall())


def test_every_job_builds(spark):
    names = set(queries())
    assert len(names) >= 80
    for name in sorted(names - set(oracle_sql())):
        assert queries()[name](spark, SF_SMALL).limit(5).count() >= 0


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["doc_id", "barcode", "from_page", "to_page", "page_index"]
    assert df.count() > 0
