"""Property-based checks (hypothesis) on the custom operators."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from emporia.functions import haversine_km
from emporia.operators.sequence import sequence_within

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "hot", "z"]))
rows = st.lists(st.tuples(keys, st.integers(0, 3)), min_size=0, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows, parts=st.integers(1, 6))
def test_sequence_within_equals_row_number(spark, rows, parts):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "key string, v int, id int")
    order = [F.asc("v"), F.desc("id")]
    got = {r.id: r.seq for r in sequence_within(df, "key", order, num_partitions=parts).collect()}
    want = {r.id: r.n for r in df.select("id", F.row_number().over(
        Window.partitionBy("key").orderBy(*order)).alias("n")).collect()}
    assert got == want


coord = st.floats(-80, 80, allow_nan=False)
lng = st.floats(-179, 179, allow_nan=False)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pts=st.lists(st.tuples(coord, lng, coord, lng), min_size=1, max_size=20))
def test_haversine_symmetric_bounded(spark, pts):
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    out = df.select(
        haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("x"),
        haversine_km(F.col("c"), F.col("d"), F.col("a"), F.col("b")).alias("y"),
    ).collect()
    for r in out:
        assert 0.0 <= r.x <= 3.1416 * 6371.0 + 1e-6
        assert abs(r.x - r.y) < 1e-6
