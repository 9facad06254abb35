"""Every registered query against its DuckDB oracle on the smallest scale."""

import datetime
import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem".split()
# The corpus operators have tests of their own.
QUERIES = {k: v for k, v in E.queries().items() if k != "pipeline" and not re.match(r"op\d+_", k)}
SQL = {k: v for k, v in E.oracle_sql().items() if not re.match(r"op\d+_", k)}


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        if v.is_integer() and abs(v) < 1e15:
            return (5, str(int(v)))
        return (2, repr(v))
    if isinstance(v, datetime.datetime) or hasattr(v, "to_pydatetime"):
        return (3, str(v)[:19].replace("T", " ").removesuffix(" 00:00:00"))
    if isinstance(v, datetime.date):
        return (3, v.isoformat())
    return (5, str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    s = QUERIES[name](spark, SF_SMALL).toPandas()
    o = con.execute(SQL[name]).fetchdf()
    assert sorted(s.columns) == sorted(o.columns)
    cols = sorted(s.columns)
    s = s.astype(object).where(s.notna(), None)
    o = o.astype(object).where(o.notna(), None)
    a = sorted(tuple(_norm(r[c]) for c in cols) for r in s.to_dict("records"))
    b = sorted(tuple(_norm(r[c]) for c in cols) for r in o.to_dict("records"))
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["kpi_date", "orders_delivered", "gmv", "aov", "freight_pct_gmv", "on_time_pct", "late_pct"]
    assert df.count() > 0
