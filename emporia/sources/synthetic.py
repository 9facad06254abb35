"""Adapter: test tables -> raw tables in the *synthetic* source schema.

The synthetic mode has its own column names (``order_ts``, ``status``,
``unit_price``, ``sku``, ...) and three extra tables: refunds, inventory and
marketing spend. They are derived from the same test tables (FIXTURES.md
section 3b); refunds and spend are aggregates of the data, so they grow with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.sources.testdata import TABLES, read_table

# First possible signup; customers sign up within 240 days of it. Fixed values.
SIGNUP_START = "1994-07-01 00:00:00"
SIGNUP_SPREAD_DAYS = 240


def _ts(orders: DataFrame):
    return F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))


def raw_orders(orders: DataFrame) -> DataFrame:
    k, s, ts = F.col("o_orderkey"), F.col("o_orderstatus"), _ts(orders)
    status = (
        F.when(s == "F", F.lit("completed"))
        .when(s == "O", F.lit("shipped"))
        .when(k % 4 == 0, "cancelled")
        .when(k % 4 == 1, "refunded")
        .when(k % 4 == 2, "processing")
        .otherwise("completed")
    )
    return orders.select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("status"),
        ts.alias("order_ts"),
        (ts + F.make_dt_interval(F.lit(0), F.lit(1))).alias("approved_ts"),
        (ts + F.make_dt_interval(F.lit(2))).alias("delivered_carrier_ts"),
        F.when(s.isin("F", "O") & (k % 97 != 0),
               ts + F.make_dt_interval((k % 29 + 3).cast("int"), F.lit(5))).alias("delivered_customer_ts"),
        (ts + F.make_dt_interval(F.lit(20))).alias("estimated_delivery_ts"),
    )


def raw_order_items(lineitem: DataFrame) -> DataFrame:
    seq = F.row_number().over(Window.partitionBy("order_id").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    keyed = lineitem.withColumn("order_id", F.col("l_orderkey").cast("string"))
    return keyed.select(
        F.concat_ws("-", "order_id", seq.cast("string")).alias("order_item_id"),
        "order_id",
        seq.cast("int").alias("line_number"),
        F.col("l_partkey").cast("string").alias("sku"),
        F.col("l_suppkey").cast("string").alias("seller"),
        F.col("l_quantity").cast("int").alias("qty"),
        unit.alias("unit_price"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
        (unit * 0.6).alias("cogs_unit"),
        (F.lit(5.0) + F.col("l_extendedprice") * F.col("l_tax")).alias("shipping_fee"),
    )


def raw_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    c = customer.join(geo, customer.c_nationkey == geo.n_nationkey, "left")
    key = F.col("c_custkey")
    country = F.when(F.col("c_nationkey") % 3 == 0, "BR").when(F.col("c_nationkey") % 3 == 1, "PT").otherwise("GB")
    return c.select(
        key.cast("string").alias("customer_id"),
        (F.lit(SIGNUP_START).cast("timestamp_ntz")
         + F.make_dt_interval((key % SIGNUP_SPREAD_DAYS).cast("int"))).alias("signup_ts"),
        country.alias("country"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("city"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zip_prefix"),
    )


def raw_refunds(lineitem: DataFrame) -> DataFrame:
    """One refund per order with returned lines: their net value, 30 days after the last shipment."""
    returned = lineitem.filter(F.col("l_returnflag") == "R")
    per_order = returned.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("amount"),
        F.max("l_shipdate").alias("last_ship"),
    )
    return per_order.select(
        F.concat(F.lit("rf"), F.col("l_orderkey").cast("string")).alias("refund_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        "amount",
        (F.col("last_ship") + F.make_dt_interval(F.lit(30))).alias("refund_ts"),
    )


def raw_inventory(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("sku"),
        ((F.col("p_partkey") * 13) % 500 - 3).cast("int").alias("on_hand"),
        (F.col("p_size") % 30).cast("int").alias("lead_time_days"),
    )


def raw_marketing_spend(orders: DataFrame) -> DataFrame:
    """Daily spend: 2% of the value ordered that day."""
    return orders.groupBy(F.to_date("o_orderdate").alias("spend_date")).agg(
        F.lit("all").alias("channel"),
        (F.sum("o_totalprice") * 0.02).alias("amount"),
    )


def load_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = {name: read_table(spark, sf_dir, name) for name in TABLES}
    return {
        "raw_orders": raw_orders(t["orders"]),
        "raw_order_items": raw_order_items(t["lineitem"]),
        "raw_customers": raw_customers(t["customer"], t["nation"], t["region"]),
        "raw_refunds": raw_refunds(t["lineitem"]),
        "raw_inventory": raw_inventory(t["part"]),
        "raw_marketing_spend": raw_marketing_spend(t["orders"]),
    }
