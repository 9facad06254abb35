import datetime as dt

import pytest
from pyspark.sql import functions as F

from emporia.operators import core, staging
from emporia.plans.warehouse import Warehouse
from tests.fixtures import TS, one_order, ts


def test_minimal_chain(spark):
    wh = Warehouse(one_order(spark))
    o = wh.fct_orders.collect()[0]
    assert (o.gmv, o.freight_total, o.lines_count, o.items_qty) == (300.0, 30.0, 2, 2)
    assert o.payment_total == 330.0 and o.max_installments == 3 and o.payment_methods == ["credit_card"]
    d = wh.fct_deliveries.collect()[0]
    assert (d.lead_time_days, d.eta_gap_days, d.is_on_time, d.is_late) == (4, -1, True, False)
    k = wh.mrt_kpis_daily.collect()[0]
    assert k.kpi_date == dt.date(2024, 1, 1)
    assert (k.orders_delivered, k.gmv, k.aov, k.freight_pct_gmv, k.on_time_pct, k.late_pct) == (
        1, 300.0, 300.0, 0.1, 1.0, 0.0)
    f = wh.fct_freight.orderBy("order_item_id").collect()
    assert [r.order_item_id for r in f] == ["o1-001", "o1-002"]
    assert all(r.order_freight_pct == pytest.approx(0.1) for r in f)
    assert f[0].distance_km == pytest.approx(f[1].distance_km) and 300 < f[0].distance_km < 400


def test_real_schema_items_default_qty_and_discount(spark):
    raw = one_order(spark)["raw_order_items"]
    li = staging.stg_order_items(raw).orderBy("order_item_seq").collect()
    assert [(r.qty, r.discount_amount, r.line_gross, r.line_net) for r in li] == [
        (1, 0.0, 100.0, 100.0), (1, 0.0, 200.0, 200.0)]


def test_synth_schema_items(spark):
    raw = spark.createDataFrame([("o9", 7, "sku1", "sel", 3, 10.0, 5.0, 2.5)],
                                "orderid string, line_number int, sku string, seller string, quantity int, "
                                "unit_price double, discount_amount double, shipping_fee double")
    r = staging.stg_order_items(raw).collect()[0]
    assert (r.order_item_id, r.product_id, r.seller_id, r.qty, r.line_gross, r.line_net, r.freight_value) == (
        "o9-007", "sku1", "sel", 3, 30.0, 25.0, 2.5)


def test_staging_is_late_two_valued(spark):
    raw = spark.createDataFrame(
        [("a", "c", "delivered", ts("2024-01-01 00:00:00"), ts("2024-01-09 00:00:00"), ts("2024-01-05 00:00:00")),
         ("b", "c", "delivered", ts("2024-01-01 00:00:00"), None, ts("2024-01-05 00:00:00")),
         ("c", "c", "delivered", ts("2024-01-01 00:00:00"), ts("2024-01-09 00:00:00"), None)],
        f"order_id string, customer_id string, order_status string, order_purchase_timestamp {TS}, "
        f"order_delivered_customer_date {TS}, order_estimated_delivery_date {TS}")
    s = {r.order_id: r for r in staging.stg_orders(raw).collect()}
    assert (s["a"].is_late, s["b"].is_late, s["c"].is_late) == (True, False, False)
    d = {r.order_id: r for r in Warehouse({"raw_orders": raw, "raw_order_items": one_order(spark)[
        "raw_order_items"].limit(0)}).fct_deliveries.collect()}
    assert (d["a"].is_late, d["b"].is_late, d["c"].is_late) == (True, None, None)
    assert d["b"].lead_time_days is None and d["c"].eta_gap_days is None


def test_payment_seq_tie_break(spark):
    raw = spark.createDataFrame([("o", 2, "voucher", 1, 50.0), ("o", 1, "boleto", 1, 50.0), ("o", 3, None, 2, 80.0)],
                                "order_id string, payment_sequential int, payment_type string, "
                                "payment_installments int, payment_value double")
    p = staging.stg_payments(raw).orderBy("payment_seq").collect()
    assert [(r.payment_seq, r.method) for r in p] == [(1, "unknown"), (2, "boleto"), (3, "voucher")]
    t = core.order_payment_totals(staging.stg_payments(raw)).collect()[0]
    assert t.payment_methods == ["boleto", "unknown", "voucher"] and t.max_installments == 2


def test_left_join_nulls(spark):
    raw = one_order(spark)
    extra_customer = spark.createDataFrame([("c2", None, None, None, None)], raw["raw_customers"].schema)
    raw["raw_customers"] = raw["raw_customers"].unionByName(extra_customer)
    orphan = spark.createDataFrame([("zz", 1, "p1", "s1", 5.0, 1.0)], raw["raw_order_items"].schema)
    raw["raw_order_items"] = raw["raw_order_items"].unionByName(orphan)
    empty_order = raw["raw_orders"].withColumn("order_id", F.lit("o2"))
    raw["raw_orders"] = raw["raw_orders"].unionByName(empty_order)
    wh = Warehouse(raw)
    c = {r.customer_id: r for r in wh.dim_customers.collect()}
    assert c["c2"].orders_count is None and c["c2"].first_order_ts is None
    assert c["c1"].orders_count == 2
    items = {r.order_item_id: r for r in wh.fct_order_items.collect()}
    assert items["zz-001"].status is None
    o2 = [r for r in wh.fct_orders.collect() if r.order_id == "o2"][0]
    assert (o2.gmv, o2.lines_count, o2.payment_total, o2.payment_methods) == (0.0, 0, 0.0, [])


def test_geo_centroid_prevents_fan_out(spark):
    raw = one_order(spark)
    more = spark.createDataFrame([("01001", -23.65, -46.73, "sao paulo", "SP")], raw["raw_geolocation"].schema)
    raw["raw_geolocation"] = raw["raw_geolocation"].unionByName(more)
    wh = Warehouse(raw)
    assert wh.fct_freight.count() == 2
    c = {r.zip_prefix: r for r in wh.geo_centroids.collect()}
    assert c["01001"].lat == pytest.approx(-23.60)


def test_empty_inputs_keep_schema(spark):
    raw = {k: v.limit(0) for k, v in one_order(spark).items()}
    wh = Warehouse(raw)
    for name in ("fct_orders", "fct_deliveries", "fct_freight", "mrt_kpis_daily", "mrt_reviews"):
        df = getattr(wh, name)
        assert df.count() == 0 and len(df.columns) > 3


def test_sequence_within_matches_row_number_with_hot_key(spark):
    import random

    from pyspark.sql import Window

    from emporia.operators.sequence import sequence_within

    rnd = random.Random(7)
    rows = [("hot" if rnd.random() < 0.4 else (None if rnd.random() < 0.05 else f"k{rnd.randint(0, 50)}"),
             rnd.randint(0, 9), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "key string, v int, id int")
    order = [F.desc("v"), F.asc("id")]
    got = sequence_within(df, "key", order, num_partitions=5).select("id", "seq")
    want = df.select("id", F.row_number().over(Window.partitionBy("key").orderBy(*order)).alias("want"))
    assert got.join(want, "id").filter(F.col("seq") != F.col("want")).count() == 0
    assert got.count() == 5000


def test_kpi_missing_eta_default_and_option(spark):
    from emporia.operators import marts

    orders = spark.createDataFrame(
        [("a", D2, True, 10.0, 1.0, ts("2024-01-03 00:00:00"), ts("2024-01-05 00:00:00")),
         ("b", D2, True, 30.0, 3.0, ts("2024-01-09 00:00:00"), ts("2024-01-05 00:00:00")),
         ("c", D2, True, 20.0, 2.0, ts("2024-01-04 00:00:00"), None)],
        f"order_id string, order_date date, is_delivered boolean, gmv double, freight_total double, "
        f"delivered_customer_ts {TS}, estimated_delivery_ts {TS}")
    k = marts.mrt_kpis_daily(orders).collect()[0]
    assert (k.orders_delivered, k.gmv, k.aov, k.freight_pct_gmv) == (3, 60.0, 20.0, 0.1)
    assert (k.on_time_pct, k.late_pct) == (pytest.approx(1 / 3), pytest.approx(1 / 3))  # no ETA stays in
    x = marts.mrt_kpis_daily(orders, exclude_missing_eta=True).collect()[0]
    assert (x.on_time_pct, x.late_pct) == (0.5, 0.5)


def test_freight_trend_weights_orders_by_lines(spark):
    from emporia.operators import marts

    fr = spark.createDataFrame([("o1", D2, 0.2), ("o1", D2, 0.2), ("o2", D2, 0.5), ("o3", None, 0.9)],
                               "order_id string, order_date date, order_freight_pct double")
    r = marts.freight_pct_trend(fr).collect()
    assert len(r) == 1 and r[0].freight_pct == pytest.approx(0.3)  # (0.2 + 0.2 + 0.5) / 3, not 0.35


D2 = dt.date(2024, 1, 2)
