"""Adapter: the driver's TPC-H-like parquet tables -> Olist-shaped raw tables.

The e-commerce models expect raw tables with Olist column names (orders,
order_items, customers, payments, reviews, products, sellers, geolocation).
The test tables are a star schema of a different shape, so this module derives
raw tables from them with plain column expressions. The mapping is specified
in FIXTURES.md section 3 and is mirrored by the DuckDB oracle
(``emporia.plans.oracle``); both must change together.

Everything is a narrow, per-row projection of one scan, except

* ``order_item_id``: a sequence number per order (window per order key),
* customers / geolocation: joins to the 25-row nation and 5-row region tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def raw_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    s = F.col("o_orderstatus")
    ts = F.col("o_orderdate") + _hours(k % 24)
    pending_status = (
        F.when(k % 6 == 0, "CANCELLED")
        .when(k % 6 == 1, "unavailable")
        .when(k % 6 == 2, "refunded")
        .when(k % 6 == 3, "created")
        .when(k % 6 == 4, "canceled")
    )
    status = (
        F.when(s == "F", F.lit("delivered"))
        .when(s == "O", F.when(k % 2 == 0, "Completed").otherwise("shipped"))
        .when(s == "P", pending_status)
    )
    delivered = F.when(
        s.isin("F", "O") & (k % 97 != 0),
        ts + F.make_dt_interval((k % 29 + 3).cast("int"), F.lit(5)),
    )
    return orders.select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("order_status"),
        ts.alias("order_purchase_timestamp"),
        (ts + _hours(F.lit(1))).alias("order_approved_at"),
        (ts + _days(F.lit(2))).alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        F.when(k % 53 != 0, ts + _days(F.lit(20))).alias("order_estimated_delivery_date"),
    )


def raw_order_items(lineitem: DataFrame) -> DataFrame:
    # lineitem (l_orderkey, l_linenumber) is not unique in the test data; this
    # tuple is, and numbers the lines of an order 1..n deterministically. The
    # window is keyed by the string order_id, the key every later join uses,
    # so its shuffle also serves those joins. Only source columns travel there:
    # what follows from them is computed behind the window.
    seq = Window.partitionBy("order_id").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    part = F.col("l_partkey")
    price = F.when(part % 101 == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice") / F.col("l_quantity"))
    freight = F.lit(10.0) + F.col("l_extendedprice") * F.col("l_tax") * F.when(part % 37 == 0, 8.0).otherwise(1.0)
    keyed = lineitem.select(
        F.col("l_orderkey").cast("string").alias("order_id"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    )
    return keyed.withColumn("_line", F.row_number().over(seq)).select(
        "order_id",
        F.col("_line").cast("int").alias("order_item_id"),
        part.cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        price.alias("price"),
        freight.alias("freight_value"),
        F.col("l_quantity").cast("int").alias("qty"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
    )


def _nation_region(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        "n_nationkey", "n_name", "r_name"
    )


def _zip(nationkey: Column) -> Column:
    return F.lpad(nationkey.cast("string"), 5, "0")


def raw_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = _nation_region(nation, region)
    c = customer.join(geo, customer.c_nationkey == geo.n_nationkey, "left")
    key = F.col("c_custkey")
    return c.select(
        key.cast("string").alias("customer_id"),
        key.cast("string").alias("customer_unique_id"),
        F.when(key % 41 != 0, _zip(F.col("c_nationkey"))).alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
    )


def raw_sellers(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = _nation_region(nation, region)
    s = supplier.join(geo, supplier.s_nationkey == geo.n_nationkey, "left")
    return s.select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        _zip(F.col("s_nationkey")).alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    )


def raw_products(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    null_int = F.lit(None).cast("int")
    return part.select(
        key.cast("string").alias("product_id"),
        F.when(key % 31 != 0, F.col("p_brand")).alias("product_category_name"),
        null_int.alias("product_name_lenght"),
        null_int.alias("product_description_lenght"),
        null_int.alias("product_photos_qty"),
        F.col("p_size").cast("int").alias("product_weight_g"),
        null_int.alias("product_length_cm"),
        null_int.alias("product_height_cm"),
        null_int.alias("product_width_cm"),
    )


def raw_geolocation(nation: DataFrame, region: DataFrame) -> DataFrame:
    # Three points per nation zip, two of them identical: exercises both the
    # exact-duplicate removal and the centroid.
    n = F.col("n_nationkey").cast("double")
    pts = (
        _nation_region(nation, region)
        .filter(F.col("n_nationkey") != 24)
        .withColumn("e", F.explode(F.array(F.lit(0.0), F.lit(0.2), F.lit(0.2))))
    )
    return pts.select(
        _zip(F.col("n_nationkey")).alias("geolocation_zip_code_prefix"),
        (F.lit(-30.0) + F.lit(1.3) * n + F.col("e")).alias("geolocation_lat"),
        (F.lit(-70.0) + F.lit(1.1) * ((F.col("n_nationkey") * 7) % 25).cast("double") - F.col("e")).alias(
            "geolocation_lng"
        ),
        F.col("n_name").alias("geolocation_city"),
        F.col("r_name").alias("geolocation_state"),
    )


def raw_payments(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    prio = F.substring("o_orderpriority", 1, 1)
    method = (
        F.when(prio == "1", "credit_card")
        .when(prio == "2", "boleto")
        .when(prio == "3", "Debit_Card")
        .when(prio == "4", "credit_card")
    )
    total = F.col("o_totalprice")
    first = F.struct(
        (k % 71 != 0).alias("keep"),
        F.lit(1).alias("payment_sequential"),
        method.alias("payment_type"),
        (k % 10 + 1).cast("int").alias("payment_installments"),
        F.when(k % 3 == 0, total * 0.6).otherwise(total).alias("payment_value"),
    )
    second = F.struct(
        ((k % 3 == 0) & (k % 71 != 0)).alias("keep"),
        F.lit(2).alias("payment_sequential"),
        F.lit("voucher").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        (total * 0.4).alias("payment_value"),
    )
    return (
        orders.select(k.cast("string").alias("order_id"), F.inline(F.array(first, second)))
        .filter("keep")
        .drop("keep")
    )


def raw_reviews(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    created = F.col("o_orderdate") + _days(F.lit(33))
    return orders.filter(k % 2 == 0).select(
        F.concat(F.lit("r"), k.cast("string")).alias("review_id"),
        k.cast("string").alias("order_id"),
        F.when(k % 37 != 0, (k * 7) % 5 + 1).cast("int").alias("review_score"),
        created.alias("review_creation_date"),
        (created + _days(F.lit(1))).alias("review_answer_timestamp"),
    )


def load_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All eight raw tables (real-mode names) derived from ``sf_dir``."""
    t = {name: read_table(spark, sf_dir, name) for name in TABLES}
    return {
        "raw_orders": raw_orders(t["orders"]),
        "raw_order_items": raw_order_items(t["lineitem"]),
        "raw_customers": raw_customers(t["customer"], t["nation"], t["region"]),
        "raw_payments": raw_payments(t["orders"]),
        "raw_reviews": raw_reviews(t["orders"]),
        "raw_products": raw_products(t["part"]),
        "raw_sellers": raw_sellers(t["supplier"], t["nation"], t["region"]),
        "raw_geolocation": raw_geolocation(t["nation"], t["region"]),
    }
