import os
import uuid

import pytest

from emporia.session import shared_dir
from emporia.sources import csv as src


def _dir(spark):
    d = f"{shared_dir(spark)}/tests-{uuid.uuid4().hex}"
    os.makedirs(d.removeprefix("file:"), exist_ok=True)
    return d.removeprefix("file:")


def test_csv_quoted_newlines_names_and_zip_text(spark):
    d = _dir(spark)
    with open(f"{d}/customers.csv", "w") as f:
        f.write('Customer ID,Customer Zip Code Prefix,Note\n"c1",01000,"two\nlines"\n"c2",20000,plain\n')
    inferred = src.read_csv(spark, f"{d}/customers.csv", multiline=True)
    assert inferred.columns == ["customer_id", "customer_zip_code_prefix", "note"]
    rows = {r.customer_id: r for r in inferred.collect()}
    assert rows["c1"].note == "two\nlines"
    assert rows["c1"].customer_zip_code_prefix == 1000  # inference drops the leading zero
    typed = src.read_csv(spark, f"{d}/customers.csv",
                         src.RAW_SCHEMAS["raw_customers"], multiline=True).collect()
    assert {r.customer_id: r.customer_zip_code_prefix for r in typed} == {"c1": "01000", "c2": "20000"}
    assert all(r.customer_city is None for r in typed)  # absent column -> typed NULL
    assert {r.note for r in typed} == {"two\nlines", "plain"}  # undeclared column -> kept as text


def test_review_comments_and_large_files(spark):
    d = _dir(spark)
    with open(f"{d}/reviews.csv", "w") as f:
        f.write('review_id,order_id,review_score,review_comment_message\nr1,o1,5,"good,\nfast"\n')
    with open(f"{d}/orders.csv", "w") as f:
        f.write("order_id,customer_id,order_status\n" + "".join(f"o{i},c{i},delivered\n" for i in range(40_000)))
    raw = src.ingest_folder(spark, d, {"reviews.csv": "raw_reviews", "orders.csv": "raw_orders"}, src.RAW_SCHEMAS)
    assert [r.review_comment_message for r in raw["raw_reviews"].collect()] == ["good,\nfast"]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        orders = src.read_csv(spark, f"{d}/orders.csv", src.RAW_SCHEMAS["raw_orders"])
        assert orders.rdd.getNumPartitions() > 1 and orders.count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    preview = {(r.table_name, r.column_name): r.type for r in src.schema_preview(raw).collect()}
    assert preview["raw_reviews", "review_score"] == "int"


def test_synthetic_schemas_keep_text_keys(spark):
    d = _dir(spark)
    with open(f"{d}/customers.csv", "w") as f:
        f.write("customer_id,zip_prefix\nc1,01000\n")
    raw = src.ingest_folder(spark, d, {"customers.csv": "raw_customers"}, src.SYNTH_SCHEMAS)
    assert raw["raw_customers"].collect()[0].zip_prefix == "01000"


def test_union_by_name_and_missing_file(spark):
    d = _dir(spark)
    with open(f"{d}/a.csv", "w") as f:
        f.write("x,y\n1,2\n")
    with open(f"{d}/b.csv", "w") as f:
        f.write("y,z\n3,4\n")
    df = src.read_csv(spark, [f"{d}/a.csv", f"{d}/b.csv"])
    assert sorted(df.columns) == ["x", "y", "z"] and df.count() == 2
    with pytest.raises(FileNotFoundError, match="olist_orders_dataset.csv"):
        src.ingest_folder(spark, d, {"olist_orders_dataset.csv": "raw_orders"})


def test_ingest_summary_total(spark):
    a = spark.range(3).toDF("x")
    b = spark.range(5).toDF("y")
    out = {r.table_name: r.rows for r in src.ingest_summary({"a": a, "b": b}).collect()}
    assert out == {"a": 3, "b": 5, "TOTAL": 8}
