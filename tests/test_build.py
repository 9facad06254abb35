import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from emporia.operators import category
from emporia.plans.build import build_summary, materialize, new_build_dir, store_test_failures
from emporia.plans.warehouse import Warehouse
from tests.conftest import SF_SMALL


def test_materialize_serves_persisted_tables(spark):
    lazy = Warehouse.from_testdata(spark, SF_SMALL)
    expected = lazy.mrt_kpis_daily.agg(F.sum("orders_delivered")).collect()[0][0]
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    out = new_build_dir(wh, "test")
    paths = materialize(wh, out)
    assert set(paths) == {"dim_customers", "dim_products", "fct_order_items", "fct_orders", "fct_deliveries",
                          "fct_freight", "mrt_kpis_daily", "mrt_reviews", "order_payments"}
    assert wh.has("fct_orders") and wh.fct_orders.inputFiles()
    assert wh.mrt_kpis_daily.agg(F.sum("orders_delivered")).collect()[0][0] == expected
    comments = {f.name: f.metadata.get("comment") for f in spark.read.parquet(paths["fct_freight"]).schema.fields}
    assert "great-circle" in comments["distance_km"]
    rows = {r.table_name: r.rows for r in build_summary(wh, paths).collect()}
    assert rows["fct_orders"] == wh.fct_orders.count() > 0

    # the look-back window prunes month partitions of the persisted orders
    df = category.category_rollup(wh.lines, wh.orders_with_items, wh.stg_products)
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    # the lines, and the month of the newest order (once for each bound that reads it)
    assert len(re.findall(r"\) Scan parquet.*\n.*\n(?:.*\n)*?PartitionFilters: \[isnotnull\(order_ym", plan)) >= 2
    assert "Left keys [1]: [order_id" not in plan  # which need no join with the orders
    assert df.count() == category.category_rollup(lazy.stg_order_items, lazy.orders_with_items,
                                                  lazy.stg_products).count()

    q = store_test_failures(wh, out)
    assert q.filter((F.col("model") == "fct_order_items") & (F.col("test") == "expression")).count() > 0


def test_persisted_and_lazy_marts_are_identical(spark):
    from emporia.sources.sinks import fingerprint

    lazy = Warehouse.from_testdata(spark, SF_SMALL)
    built = Warehouse.from_testdata(spark, SF_SMALL)
    materialize(built, new_build_dir(built, "same"))
    for name in ("fct_deliveries", "fct_freight", "mrt_kpis_daily", "mrt_reviews", "dim_customers"):
        a = fingerprint(getattr(lazy, name)).collect()[0]
        b = fingerprint(getattr(built, name).select(getattr(lazy, name).columns)).collect()[0]
        assert (a.rows, a.fingerprint) == (b.rows, b.fingerprint), name


def test_payment_orders_from_persisted_profile(spark):
    from emporia.operators import payments
    from emporia.sources.sinks import fingerprint

    lazy = Warehouse.from_testdata(spark, SF_SMALL)
    built = Warehouse.from_testdata(spark, SF_SMALL)
    materialize(built, new_build_dir(built, "pay"))
    a = fingerprint(payments.payment_orders(lazy.fct_orders, lazy.payments_base)).collect()[0]
    po = payments.payment_orders(built.fct_orders, profile=built.order_payments)
    b = fingerprint(po).collect()[0]
    assert (a.rows, a.fingerprint) == (b.rows, b.fingerprint)
    buf = io.StringIO()
    with redirect_stdout(buf):
        po.explain("formatted")
    assert buf.getvalue().count("PartitionFilters: [isnotnull(order_ym") >= 3  # orders, payments, and the newest order's month


def test_synth_build_reconciles_revenue(spark, tmp_path):
    from pyspark.sql import functions as F

    from emporia.__main__ import main

    out = str(tmp_path / "synth")
    assert main(["build", "--mode", "synth", "--testdata", SF_SMALL, "--out", out], spark=spark) == 0
    wh = Warehouse.from_testdata(spark, SF_SMALL, mode="synth")
    daily = spark.read.parquet(f"{out}/mrt_kpis_daily_synth")
    valid = wh.orders_with_items.filter("status NOT IN ('canceled', 'unavailable')")
    net = valid.agg(F.sum("net_item_revenue")).first()[0] - wh.stg_refunds.agg(F.sum("amount")).first()[0]
    assert daily.agg(F.sum("net_revenue")).first()[0] == pytest.approx(net, rel=1e-9)
    assert daily.count() == daily.select("kpi_date").distinct().count()
