import datetime as dt

import pytest
from pyspark.sql import functions as F

from emporia.operators import category, delivery, kpis, payments
from tests.fixtures import TS, ts

D = dt.date


def _kpis(spark):
    rows = [(D(2024, 1, 1), 10, 1000.0, 100.0, 0.10, 0.90, 0.10),
            (D(2024, 3, 1), 5, 500.0, 100.0, 0.30, 0.80, 0.20),
            (D(2024, 3, 2), 4, 400.0, 100.0, None, None, 0.0)]
    return spark.createDataFrame(rows, "kpi_date date, orders_delivered bigint, gmv double, aov double, "
                                       "freight_pct_gmv double, on_time_pct double, late_pct double")


def test_kpi_window_latest_and_alerts(spark):
    k = _kpis(spark)
    assert [r.kpi_date for r in kpis.kpi_window(k, 30).collect()] == [D(2024, 3, 1), D(2024, 3, 2)]
    assert [r.kpi_date for r in kpis.kpi_window(k, 30, as_of="2024-01-20").collect()] == [D(2024, 1, 1)]  # nothing later
    assert kpis.kpi_latest(k, 30, as_of="2024-03-01").collect()[0].kpi_date == D(2024, 3, 1)
    latest = kpis.kpi_latest(k, 30).collect()[0]
    assert latest.kpi_date == D(2024, 3, 2) and latest.on_time_pct_100 is None
    reviews = spark.createDataFrame([(D(2024, 3, 1), 4.5), (D(2024, 3, 2), 3.0)], "as_of_date date, avg_score double")
    alerts = {r.alert: r for r in kpis.kpi_alerts(k, reviews, 30).collect()}
    assert alerts["on_time_pct_below"].value is None and alerts["on_time_pct_below"].fired is False
    assert alerts["freight_pct_gmv_above"].fired is False
    assert alerts["avg_review_score_below"].value == 3.0 and alerts["avg_review_score_below"].fired is True
    past = {r.alert: r for r in kpis.kpi_alerts(k, reviews, 30, as_of="2024-03-01").collect()}
    assert past["avg_review_score_below"].value == 4.5 and past["freight_pct_gmv_above"].fired is True
    long = kpis.kpi_series_long(k)
    assert long.count() == 18 and long.filter(F.col("value").isNull()).count() == 2


def test_on_time_split_and_penalty(spark):
    d = spark.createDataFrame(
        [("a", 3, True, False), ("b", 5, False, True), ("c", 70, None, None), ("d", -1, True, False)],
        "order_id string, lead_time_days bigint, is_on_time boolean, is_late boolean")
    s = delivery.on_time_split(d).collect()[0]
    assert (s.deliveries, s.on_time_pct, s.late_pct) == (3, pytest.approx(2 / 3), pytest.approx(1 / 3))
    assert {r.lead_time_days: r.orders for r in delivery.lead_time_hist(d).collect()} == {3: 1, 5: 1, 70: 1, -1: 1}
    assert {r.lead_time_days: r.orders for r in delivery.lead_time_hist(d, max_days=60).collect()} == {3: 1, 5: 1}
    r = spark.createDataFrame([("a", 5), ("c", 1), ("d", 4), ("x", 2), ("a", None)], "order_id string, score int")
    p = delivery.delay_penalty_overall(r, d).collect()[0]
    # c has unknown lateness: counted in reviews, in neither mean
    assert (p.reviews, p.ontime_avg_score, p.late_avg_score, p.delay_penalty) == (3, 4.5, None, None)
    assert {x.score: x.reviews for x in delivery.score_distribution(r, d).collect()} == {5: 1, 1: 1, 4: 1}


def test_category_metrics_ranks_and_candidates(spark):
    lines = spark.createDataFrame(
        [("o1", "p1", 2, 100.0, 90.0, 10.0), ("o1", "p2", 1, 50.0, 50.0, 60.0), ("o2", "p1", 1, 30.0, 30.0, 3.0),
         ("o3", "p3", 1, 0.0, -5.0, 1.0), ("o4", "p1", 9, 900.0, 900.0, 0.0)],
        "order_id string, product_id string, qty int, line_gross double, line_net double, freight_value double")
    orders = spark.createDataFrame(
        [("o1", D(2024, 6, 30), True), ("o2", D(2024, 6, 1), True), ("o3", D(2024, 6, 29), True),
         ("o4", D(2023, 1, 1), True)],
        "order_id string, order_date date, is_delivered boolean")
    products = spark.createDataFrame([("p1", "toys"), ("p2", None), ("p3", "Tools")], "product_id string, category string")
    roll = {r.category: r for r in category.category_rollup(lines, orders, products, days=30).collect()}
    assert set(roll) == {"toys", "unknown", "tools"}  # o4 is outside the window
    t = roll["toys"]
    assert (t.orders_delivered, t.lines, t.units, t.gmv, t.proxy_margin) == (2, 2, 3.0, 130.0, 107.0)
    assert t.avg_freight_pct == pytest.approx((0.1 + 0.1) / 2)
    assert roll["tools"].avg_freight_pct is None  # zero gross -> no line share
    m = category.category_metrics(category.category_rollup(lines, orders, products, days=30), days=30, min_orders=1)
    ranked = {r.category: r for r in category.category_ranks(m).collect()}
    assert ranked["tools"].margin_pct_of_gmv is None and ranked["tools"].rank_margin_pct is None
    assert ranked["toys"].rank_gmv == 1 and ranked["toys"].velocity_units_per_day == 0.1
    cand = category.discontinue_candidates(m, vel_cut=0.5, margin_cut=0.05).collect()
    assert [c.category for c in cand] == ["tools", "unknown"]  # gmv ascending; missing margin counts as 0
    tot = category.category_totals(m).collect()[0]
    assert (tot.categories, tot.orders_delivered, tot.gmv) == (3, 4, 180.0)


def test_payment_profile_and_insights(spark):
    base = spark.createDataFrame(
        [("o1", 1, "boleto", 1, 10.0), ("o1", 2, "voucher", 3, 10.0), ("o2", 1, "credit_card", 0, 5.0),
         ("o3", 1, "credit_card", 8, 50.0)],
        "order_id string, src_seq int, method string, installments int, value double")
    prof = {r.order_id: r for r in payments.order_payment_profile(base).collect()}
    assert prof["o1"].primary_method == "boleto"  # tie on value: smaller source sequence first
    assert prof["o1"].methods_list == ["boleto", "voucher"] and prof["o1"].installments == 3
    orders = spark.createDataFrame(
        [("o1", D(2024, 1, 1), "delivered", True, False, 20.0, 20.0),
         ("o2", D(2024, 1, 2), "canceled", False, True, 5.0, 5.0),
         ("o3", D(2024, 1, 3), "delivered", True, False, 50.0, 50.0),
         ("o4", D(2024, 1, 3), "canceled", False, True, 7.0, 0.0)],
        "order_id string, order_date date, status string, is_delivered boolean, is_canceled boolean, gmv double, "
        "payment_total double")
    po = payments.payment_orders(orders, base, days=10)
    got = {r.order_id: r for r in po.collect()}
    assert got["o4"].primary_method == "unknown" and got["o4"].installments is None
    dist = {r.installments: r.orders for r in payments.installments_dist(po).collect()}
    assert dist == {3: 1, 1: 2, 8: 1}  # 0 and NULL clip to 1
    ins = payments.payment_insights(po).collect()[0]
    assert ins.aov_low_installments == 6.0 and ins.aov_high_installments == 50.0 and ins.aov_delta == 44.0
    assert (ins.cancel_rate_first, ins.cancel_rate_last, ins.cancel_trend) == (1.0, 0.0, "lower")
    k = payments.payment_kpis(po).collect()[0]
    assert k.orders == 4 and k.avg_installments == pytest.approx((3 + 0 + 8 + 1) / 4)


def test_synth_kpis_by_hand(spark):
    orders = spark.createDataFrame(
        [("a", "c1", "delivered", ts("2024-01-01 10:00:00"), D(2024, 1, 1), 100.0, 90.0),
         ("b", "c1", "delivered", ts("2024-02-15 10:00:00"), D(2024, 2, 15), 50.0, 50.0),
         ("c", "c2", "canceled", ts("2024-01-01 12:00:00"), D(2024, 1, 1), 70.0, 70.0),
         ("d", "c2", "shipped", ts("2024-01-20 00:00:00"), D(2024, 1, 20), 30.0, 25.0)],
        f"order_id string, customer_id string, status string, order_ts {TS}, order_date date, gmv double, "
        "net_item_revenue double")
    refunds = spark.createDataFrame([("r1", "a", 10.0, ts("2024-01-01 20:00:00"))],
                                    f"refund_id string, order_id string, amount double, refund_ts {TS}")
    spend = spark.createDataFrame([(D(2024, 1, 5), "all", 40.0), (D(2024, 2, 5), "all", 9.0)],
                                  "spend_date date, channel string, amount double")
    out = {r.kpi_date: r for r in kpis.mrt_kpis_daily_synth(orders, refunds, spend).collect()}
    jan1 = out[D(2024, 1, 1)]
    assert (jan1.orders, jan1.gmv, jan1.net_revenue, jan1.aov) == (1, 100.0, 80.0, 100.0)
    assert jan1.cac == 20.0  # 40 spend / 2 customers whose first valid order is in January
    # cohort 2024-01: c1 nets 90 + 50 (b is 45 days after its first order, inside
    # the 90-day window), c2 nets 25 (its canceled order does not count) -> 165 / 2
    assert jan1.ltv_90d == 82.5
    feb = out[D(2024, 2, 15)]
    assert feb.cac is None and feb.ltv_90d is None
