"""The corpus queries that have SQL, against it on the smallest tables."""

import duckdb
import pytest

from emporia.llm import queries, sql
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(sql.ALL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    want = con.execute(sql.ALL[name])
    columns = [c[0] for c in want.description]
    got = queries.all_queries()[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(repr, want.fetchall()))
