"""Core facts and dimensions.

Aggregates are always formed per key *before* joining (items and payments are
both many-per-order: joining them first would multiply). Every aggregate here
is algebraic (sum / count / min / max / set of a small domain), so Spark
combines map-side before the shuffle and a hot key costs one partial row per
task, not a hot reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import money_sum
from emporia.operators.staging import LINE_BASE, ORDER_BASE, line_columns, order_columns, status_flags

ORDER_COLUMNS = [
    "order_id", "customer_id", "status", "order_ts", "approved_ts", "delivered_carrier_ts",
    "delivered_customer_ts", "estimated_delivery_ts", "order_date", "order_ym", "currency",
    "is_delivered", "is_canceled", "is_unavailable", "is_late",
]


def customer_first_orders(stg_orders: DataFrame) -> DataFrame:
    return stg_orders.groupBy("customer_id").agg(
        F.min("order_ts").alias("first_order_ts"),
        F.min(F.when(F.col("is_delivered"), F.col("order_ts"))).alias("first_delivered_ts"),
        F.count(F.lit(1)).alias("orders_count"),
    )


def dim_customers(stg_customers: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Customers with first order / first delivered order and order count
    (all NULL for customers without orders)."""
    first = customer_first_orders(stg_orders)
    return stg_customers.join(first, "customer_id", "left").select(
        "customer_id", "customer_unique_id", "signup_ts", "first_order_ts", "first_delivered_ts",
        "orders_count", "country", "state", "city", "zip_prefix",
    )


def dim_products(stg_products: DataFrame) -> DataFrame:
    return stg_products.select(
        "product_id", "category", "name_len", "desc_len", "photos_qty", "weight_g",
        "length_cm", "height_cm", "width_cm",
    )


def order_item_rows(stg_order_items: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Lines with their order's status; lines without an order are kept. ``order_item_columns`` makes the fact of them."""
    o = stg_orders.select("order_id", "status", "is_late", "order_ts")
    return stg_order_items.select(*LINE_BASE).join(o, "order_id", "left")


def order_item_columns() -> list:
    """Order lines with amounts and their order's status flags."""
    more = line_columns()
    return [
        more["order_item_id"], "order_id", "order_ts", "status", *status_flags(), "is_late", "order_item_seq",
        "product_id", "seller_id", "qty", "unit_price", "discount_amount", "freight_value",
        more["line_gross"], more["line_net"],
    ]


def order_item_totals(stg_order_items: DataFrame) -> DataFrame:
    return stg_order_items.groupBy("order_id").agg(
        F.sum("qty").alias("items_qty"),
        F.count(F.lit(1)).alias("lines_count"),
        money_sum("line_gross").alias("gmv"),
        money_sum("line_net").alias("net_item_revenue"),
        money_sum("freight_value").alias("freight_total"),
    )


def order_payment_totals(stg_payments: DataFrame) -> DataFrame:
    """Per order: paid total, max installments, sorted distinct method list."""
    return stg_payments.groupBy("order_id").agg(
        money_sum("value").alias("payment_total"),
        F.max("installments").alias("max_installments"),
        F.sort_array(F.collect_set("method")).alias("payment_methods"),
    )


def orders_with_items(stg_orders: DataFrame, stg_order_items: DataFrame) -> DataFrame:
    """``fct_orders`` without the payment columns (what the delivery, KPI,
    freight and category models need; skips the payment aggregate)."""
    i = order_item_totals(stg_order_items)
    return stg_orders.join(i, "order_id", "left").select(*ORDER_COLUMNS, *_item_totals())


def _item_totals() -> list:
    """The totals of an order's lines, 0 without lines."""
    zeros = {"items_qty": 0, "lines_count": 0, "gmv": 0.0, "net_item_revenue": 0.0, "freight_total": 0.0}
    return [F.coalesce(c, F.lit(zero)).alias(c) for c, zero in zeros.items()]


def order_rows(stg_orders: DataFrame, stg_order_items: DataFrame, stg_payments: DataFrame) -> DataFrame:
    """Orders' base columns with the totals of lines and payments; ``order_fact_columns`` makes the fact of them."""
    i, p = order_item_totals(stg_order_items), order_payment_totals(stg_payments)
    return stg_orders.select(*ORDER_BASE).join(i, "order_id", "left").join(p, "order_id", "left")


def order_fact_columns(currency: str = "BRL") -> list:
    """Orders with date, month, flags and totals (0 without lines or payments)."""
    derived = {c: col for c, col in zip(ORDER_COLUMNS[len(ORDER_BASE):], order_columns(currency), strict=True)}
    return [
        *[derived.get(c, c) for c in ORDER_COLUMNS], *_item_totals(),
        F.coalesce("payment_total", F.lit(0.0)).alias("payment_total"),
        F.coalesce("max_installments", F.lit(0)).alias("max_installments"),
        F.coalesce("payment_methods", F.array().cast("array<string>")).alias("payment_methods"),
    ]
