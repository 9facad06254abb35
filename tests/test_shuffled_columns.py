"""What travels through shuffles of the build and of the model tests."""

import io
import re
from collections import Counter
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from emporia.operators import contracts, marts
from emporia.plans.build import materialize, new_build_dir, partial_keys
from emporia.plans.warehouse import Warehouse
from tests.conftest import SF_SMALL


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def exchanged(df) -> list[str]:
    """The input columns of every shuffle of ``df``."""
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan(df))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_whole_rows_do_not_travel_to_the_parent_table(spark, no_broadcast):
    child = spark.range(20_000).select(F.col("id").alias("order_item_id"), (F.col("id") % 5_001).alias("order_id"),
                                       F.lit("wide").alias("more"))
    child = child.withColumn("order_id", F.when(F.col("order_item_id") != 7, F.col("order_id")))
    models = {"fct_order_items": child, "fct_orders": spark.range(5_000).select(F.col("id").alias("order_id"))}
    t = contracts.ModelTest("fct_order_items", "order_id", "relationships", "fct_orders.order_id")
    failing = contracts.failing_rows(t, models)
    assert not any("order_item_id" in columns for columns in exchanged(failing))
    want = {str(i) for i in range(5_000, 20_000, 5_001)}
    assert {r.row_key for r in failing.collect()} == want
    assert failing.filter(F.variant_get("failed_row", "$.more", "string") == "wide").count() == len(want)
    assert contracts.run_model_tests(models, [t]).first().failures == len(want)
    models["fct_orders"] = models["fct_orders"].unionByName(spark.createDataFrame([(5_000,), (None,)], "order_id bigint"))
    assert contracts.failing_rows(t, models).count() == 0
    assert contracts.run_model_tests(models, [t]).first().failures == 0


def test_lines_are_numbered_by_source_columns(spark):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    columns, = exchanged(wh.raw["raw_order_items"])
    assert "l_extendedprice" in columns and not re.search("price#|product_id|discount_amount|freight", columns.replace("l_extendedprice#", ""))


def test_tables_by_month_are_shuffled_as_base_columns(spark):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    for name, derived in {"fct_order_items": {"order_item_id", "line_gross", "line_net", "is_delivered"},
                          "fct_orders": {"order_date", "currency", "is_delivered"},
                          "fct_freight": {"order_item_id", "line_gross", "freight_pct_line", "order_freight_pct"}}.items():
        rows, columns = wh.rows_of(name)
        assert not derived & set(rows.columns)
        assert derived <= set(rows.select(*columns).columns)


def test_freight_joins_delivered_lines_only(spark):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    materialize(wh, new_build_dir(wh, "delivered-lines"), tables=["fct_order_items", "fct_orders"])
    scans = re.findall(r"\) Scan parquet.*?\n\n", plan(wh.fct_freight), re.S)
    lines = [s for s in scans if "/fct_order_items" in s]
    assert lines and all("EqualTo(is_delivered,true)" in s for s in lines)
    assert wh.fct_freight.count() == Warehouse.from_testdata(spark, SF_SMALL).fct_freight.count() > 0


def test_lines_are_not_dealt_by_seller(spark, no_broadcast, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    lazy = Warehouse.from_testdata(spark, SF_SMALL)
    assert not any("order_item_seq" in c and "order_gmv" in c for c in exchanged(lazy.fct_freight))
    assert "hashpartitioning(seller_id" not in plan(lazy.fct_freight)
    rows = lazy.fct_freight.collect()
    monkeypatch.setattr(marts, "FEW_SELLERS", 0)  # more sellers than may be sent everywhere: lines go to them without the order's columns
    many = Warehouse.from_testdata(spark, SF_SMALL).fct_freight
    assert "hashpartitioning(seller_id" in plan(many)
    assert not any("order_item_seq" in c and "order_gmv" in c for c in exchanged(many))
    assert sorted(map(str, many.collect())) == sorted(map(str, rows)) and rows


def test_freight_and_deliveries_are_not_dealt_by_month_again(spark, no_broadcast, monkeypatch):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    paths = materialize(wh, new_build_dir(wh, "in-months"), tables=["fct_order_items", "fct_orders", "dim_customers"])
    rows, columns = wh.rows_in_months("fct_deliveries")
    assert not exchanged(rows.select(*columns))
    for few in (marts.FEW_SELLERS, 0):
        monkeypatch.setattr(marts, "FEW_SELLERS", few)
        rows, columns = wh.rows_in_months("fct_freight")
        with partial_keys(spark):
            dealt = [c for c in exchanged(rows.select(*columns)) if "order_item_seq" in c]
        assert len(dealt) == (1 if few else 2) and not any("order_gmv" in c for c in dealt)
    assert wh.rows_in_months("fct_orders") is None and spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    paths = materialize(wh, new_build_dir(wh, "in-months"), tables=["fct_deliveries", "fct_freight"])
    lazy = Warehouse.from_testdata(spark, SF_SMALL)
    for name in paths:
        want = sorted(map(str, getattr(lazy, name).collect()))
        assert sorted(map(str, getattr(wh, name).select(getattr(lazy, name).columns).collect())) == want and want
    # a part of a month is in one task, so a month has no more files than parts
    files = Counter(re.search("order_ym=([^/]*)/", f)[1] for f in wh.fct_freight.inputFiles())
    parts = {r["_ym"]: r["_parts"] for r in marts.month_parts(wh.fct_orders).collect()}
    assert files and all(n <= parts[ym] for ym, n in files.items())


def test_months_have_parts_by_their_orders(spark):
    ym = F.when(F.col("id") < 600, "2020-01").when(F.col("id") < 990, "2020-02").when(F.col("id") < 999, "2020-03")
    got = [tuple(r) for r in marts.month_parts(spark.range(1000).select(ym.alias("order_ym"))).orderBy("_first").collect()]
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = [1, -(-n * 600 // 1000), -(-n * 390 // 1000), 1]
    assert got == [(m, sum(parts[:i]), parts[i]) for i, m in enumerate(["", "2020-01", "2020-02", "2020-03"])]
    assert marts.month_parts(spark.range(0).select(ym.alias("order_ym"))).count() == 0


def test_refresh_numbers_the_lines_of_its_orders_only(spark):
    from emporia.plans.queries import REFRESHED_MONTHS, repriced
    from emporia.plans.refresh import of_orders

    wh = Warehouse.from_testdata(spark, SF_SMALL)
    ids = wh.stg_orders.filter(F.col("order_ym").isin(*REFRESHED_MONTHS)).select("order_id").distinct()
    raw = repriced(wh.raw)["raw_order_items"]
    lines = of_orders(raw, ids)
    tree = plan(lines).split("\n\n")[0]
    assert re.search(r"Window(?s:.*)Exchange(?s:.*)LeftSemi", tree)
    assert "LeftSemi" not in tree[:tree.index("Window")]
    assert lines.exceptAll(raw.join(ids, "order_id", "left_semi")).count() == 0 and lines.count() > 0


def test_text_keys_are_counted_by_their_hashes(spark):
    """Distinct texts are not dealt; what stands twice is counted as before, whatever the type of the column."""
    df = spark.range(2000).select(F.concat(F.lit("order-"), F.col("id")).alias("order_id"))
    more = df.filter("order_id IN ('order-3', 'order-5')").union(spark.createDataFrame([("order-3",), (None,), (None,)], "order_id string"))
    orders = df.union(more)
    own = contracts._candidates(orders, "order_id")
    assert sorted(r.order_id for r in own.collect()) == ["order-3"] * 3 + ["order-5"] * 2
    t = contracts.ModelTest("fct_orders", "order_id", "unique")
    found = contracts.failing_rows(t, {"fct_orders": orders}).select("row_key", F.expr("variant_get(failed_row, '$.n_records', 'int') AS n"))
    assert sorted(map(tuple, found.collect())) == [("order-3", 3), ("order-5", 2)]
    assert contracts.run_model_tests({"fct_orders": orders}, [t]).first().failures == 2
    assert contracts.run_model_tests({"fct_orders": df}, [t]).first().failures == 0
    days = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "n int").select(F.make_date(F.lit(2020), F.lit(1), "n").alias("kpi_date"))
    t = contracts.ModelTest("mrt_kpis_daily", "kpi_date", "unique")
    assert contracts.run_model_tests({"mrt_kpis_daily": days}, [t]).first().failures == 1
