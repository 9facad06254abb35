import math

import pytest
from pyspark.sql import functions as F

from emporia.functions import first_of, haversine_km, safe_div, zero_pad
from emporia.operators.staging import normalize_status


def test_first_of_skips_absent_columns_and_defaults(spark):
    df = spark.createDataFrame([(None, "7"), ("3", None), (None, None)], "a string, b string")
    out = df.select(
        first_of(df, ["a", "missing", "b"], "int", 1).alias("x"),
        first_of(df, ["nope"], "int").alias("y"),
        first_of(df, ["nope"], "string", "BR").alias("z"),
    ).collect()
    assert [r.x for r in out] == [7, 3, 1]
    assert all(r.y is None for r in out)
    assert all(r.z == "BR" for r in out)


def test_zero_pad_keeps_long_values_whole(spark):
    df = spark.createDataFrame([(1,), (42,), (1234,)], "n int")
    assert [r.p for r in df.select(zero_pad(F.col("n"), 3).alias("p")).collect()] == ["001", "042", "1234"]


def test_haversine_known_distance_and_nulls(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (None, 0.0, 0.0, 1.0), (10.0, 20.0, 10.0, 20.0)],
                               "a double, b double, c double, d double")
    out = [r.d for r in df.select(haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("d")).collect()]
    assert out[0] == pytest.approx(2 * math.pi * 6371.0 / 360.0, rel=1e-9)  # one degree of longitude at the equator
    assert out[1] is None
    assert out[2] == pytest.approx(0.0, abs=1e-9)


def test_safe_div_guards_zero_and_negative(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (1.0, -2.0)], "n double, d double")
    assert [r.q for r in df.select(safe_div(F.col("n"), F.col("d")).alias("q")).collect()] == [0.25, None, None]


def test_normalize_status_synonyms(spark):
    raw = ["Completed", "CANCELLED", "shipping", "created", None, "weird", "Delivered", "refunded"]
    df = spark.createDataFrame([(s,) for s in raw], "s string")
    out = [r.n for r in df.select(normalize_status(F.col("s")).alias("n")).collect()]
    assert out == ["delivered", "canceled", "shipped", "processing", "unknown", "weird", "delivered", "refunded"]
