"""Category explorer: windowed rollup of delivered lines by product category,
derived metrics, ranks, top list and discontinue candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import as_of_date, money_sum, month_bound, order_window, safe_div
from emporia.functions.columns import MONEY, between_days, rounded
from emporia.operators.sequence import dense_ranks, written

# Page defaults. Fixed values.
DAYS = 180
MIN_ORDERS = 25
TOP_N = 20
VEL_CUT = 0.5
MARGIN_CUT = 0.05


def category_rollup(lines: DataFrame, orders: DataFrame, products: DataFrame, days: int = DAYS,
                    as_of=None) -> DataFrame:
    """Delivered lines of the last ``days`` days, per lower-cased category.

    ``as_of`` defaults to the newest order date. Two aggregation levels:
    per (category, order) and then per category, so the distinct order count
    is a plain count of the first level's rows. This avoids the row expansion
    a count-distinct next to other aggregates needs. Both levels combine
    map-side; the first is keyed by (category, order), so a hot category is
    still spread over many tasks. Money stays decimal between the levels
    (exact sums).
    """
    ref = as_of_date(as_of, orders, "order_date")
    used = ("order_id", "product_id", "qty", "line_gross", "line_net", "freight_value")
    if {"is_delivered", "order_ts"} <= set(lines.columns):
        # The line fact carries its order's flag and time: no join with the orders.
        inside = between_days(F.col("order_ts"), days, ref) & month_bound(lines, days, ref)
        chosen = lines.filter(F.col("is_delivered") & inside).select(*used)
    else:
        o = orders.filter(F.col("is_delivered") & order_window(orders, days, ref)).select("order_id")
        chosen = lines.select(*used).join(o, "order_id", "inner")
    w = chosen.join(products.select("product_id", "category"), "product_id", "left")
    pct = safe_div(F.col("freight_value"), F.col("line_gross"))
    per_order = w.groupBy(
        F.lower(F.coalesce(F.col("category"), F.lit("unknown"))).alias("category"), "order_id"
    ).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("qty").alias("units"),
        F.sum(F.col("line_gross").cast(MONEY)).alias("gmv"),
        F.sum(F.col("line_net").cast(MONEY)).alias("net_revenue"),
        F.sum((F.col("line_net") - F.col("freight_value")).cast(MONEY)).alias("proxy_margin"),
        F.sum(F.col("freight_value").cast(MONEY)).alias("freight_total"),
        F.sum(pct).alias("pct_sum"),
        F.count(pct).alias("pct_n"),
    )
    return per_order.groupBy("category").agg(
        F.count(F.lit(1)).alias("orders_delivered"),
        F.sum("lines").alias("lines"),
        F.sum("units").cast("double").alias("units"),
        F.sum("gmv").cast("double").alias("gmv"),
        F.sum("net_revenue").cast("double").alias("net_revenue"),
        F.sum("proxy_margin").cast("double").alias("proxy_margin"),
        F.sum("freight_total").cast("double").alias("freight_total"),
        safe_div(F.sum("pct_sum"), F.sum("pct_n")).alias("avg_freight_pct"),
    )


def category_metrics(rollup: DataFrame, days: int = DAYS, min_orders: int = MIN_ORDERS) -> DataFrame:
    """Velocity (units/day, 4 dp), margin share (4 dp), AOV (2 dp); categories
    with fewer than ``min_orders`` delivered orders are dropped."""
    return rollup.select(
        "*",
        F.lit(int(days)).alias("days"),
        rounded(F.col("units") / F.lit(float(days)), 4).alias("velocity_units_per_day"),
        rounded(safe_div(F.col("proxy_margin"), F.col("gmv")), 4).alias("margin_pct_of_gmv"),
        rounded(safe_div(F.col("gmv"), F.col("orders_delivered")), 2).alias("avg_order_value"),
    ).filter(F.col("orders_delivered") >= min_orders)


def category_ranks(metrics: DataFrame) -> DataFrame:
    """Dense ranks, 1 = largest, for gmv, velocity and margin share (NULL metric: NULL rank)."""
    return dense_ranks(written(metrics, "category-metrics"), {
        "gmv": "rank_gmv", "velocity_units_per_day": "rank_velocity", "margin_pct_of_gmv": "rank_margin_pct"})


def category_top_n(metrics: DataFrame, top_n: int = TOP_N) -> DataFrame:
    return metrics.orderBy(F.desc("gmv"), F.asc("category")).limit(top_n).select(
        "category", "orders_delivered", "gmv", "avg_order_value", "proxy_margin", "margin_pct_of_gmv",
        "velocity_units_per_day", "avg_freight_pct",
    )


def category_totals(metrics: DataFrame) -> DataFrame:
    """Categories analysed and sums (an order in two categories counts twice)."""
    return metrics.agg(
        F.count(F.lit(1)).alias("categories"),
        F.sum("orders_delivered").alias("orders_delivered"),
        money_sum("gmv").alias("gmv"),
        money_sum("proxy_margin").alias("proxy_margin"),
    )


def discontinue_candidates(metrics: DataFrame, vel_cut: float = VEL_CUT, margin_cut: float = MARGIN_CUT,
                           max_rows: int | None = None) -> DataFrame:
    """All slow and thin categories, smallest gmv first (a missing margin counts as 0); ``max_rows`` is a display limit."""
    cond = (F.col("velocity_units_per_day") <= vel_cut) & (
        F.coalesce(F.col("margin_pct_of_gmv"), F.lit(0.0)) <= margin_cut
    )
    found = metrics.filter(cond).orderBy(F.asc("gmv"), F.asc("category"))
    return (found if max_rows is None else found.limit(max_rows)).select(
        "category", "orders_delivered", "units", "gmv", "proxy_margin", "margin_pct_of_gmv",
        "velocity_units_per_day",
    )
