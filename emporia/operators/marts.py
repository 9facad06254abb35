"""Marts: deliveries, freight with distance, daily KPIs, review impact.

Plan notes (apply at any scale):

* Each delivered order yields exactly one delivery row (``order_id`` is the
  key; contract ``unique(order_id)`` guards it). The KPI and review marts
  therefore derive the delivery flags on the order row itself instead of
  joining the deliveries mart back to the orders it was made from.
* Order totals in the freight mart are the order's item totals, already
  computed once per order by ``orders_with_items``; no aggregate is joined
  back to its own input.
* Coordinates are resolved on the dimension side (customer -> zip -> centroid,
  seller -> zip -> centroid) so the big line table takes part in one join per
  dimension and never in a join with the raw geolocation points.
* Sellers are brought to the lines, not the lines to the sellers, up to
  ``FEW_SELLERS`` of them (counted); more are joined with the lines' own columns,
  before the orders' columns come to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import haversine_km, money_sum, safe_div
from emporia.operators.staging import line_columns


# Some 100 MB in each executor; whatever the session's broadcast threshold, dealing all lines by seller costs more.
FEW_SELLERS = 1 << 20


def delivery_columns(orders: DataFrame) -> list:
    """Lead time, ETA gap and three-valued punctuality of an order row."""
    delivered, eta = F.col("delivered_customer_ts"), F.col("estimated_delivery_ts")
    return [
        F.datediff(F.to_date(delivered), F.col("order_date")).cast("long").alias("lead_time_days"),
        F.when(eta.isNotNull(), F.datediff(F.to_date(delivered), F.to_date(eta))).cast("long").alias("eta_gap_days"),
        F.when(eta.isNotNull(), delivered <= eta).alias("is_on_time"),
        F.when(eta.isNotNull(), delivered > eta).alias("is_late"),
    ]


def fct_deliveries(orders: DataFrame) -> DataFrame:
    """One row per delivered order. ``orders`` is ``fct_orders`` or any frame
    with its order columns (``stg_orders``)."""
    return orders.filter(F.col("is_delivered")).select(
        "order_id", "order_date", "delivered_customer_ts", "estimated_delivery_ts", *delivery_columns(orders)
    )


def mrt_kpis_daily(orders: DataFrame, exclude_missing_eta: bool = False) -> DataFrame:
    """Daily KPIs of delivered orders, keyed by order date.

    By default an order without ETA counts as neither on time nor late but
    stays in the denominator; ``exclude_missing_eta=True`` drops it from both
    ratios instead.
    """
    d = orders.filter(F.col("is_delivered")).select("order_date", "gmv", "freight_total", *delivery_columns(orders))

    def ratio(flag):
        hit = F.when(F.col(flag), 1).otherwise(0)
        return F.avg(F.when(F.col("is_on_time").isNotNull(), hit) if exclude_missing_eta else hit)

    by_day = d.groupBy(F.col("order_date").alias("kpi_date")).agg(
        F.count(F.lit(1)).alias("orders_delivered"),
        money_sum("gmv").alias("gmv"),
        money_sum("freight_total").alias("freight_total"),
        ratio("is_on_time").alias("on_time_pct"),
        ratio("is_late").alias("late_pct"),
    )
    return by_day.select(
        "kpi_date",
        "orders_delivered",
        "gmv",
        safe_div(F.col("gmv"), F.col("orders_delivered")).alias("aov"),
        safe_div(F.col("freight_total"), F.col("gmv")).alias("freight_pct_gmv"),
        "on_time_pct",
        "late_pct",
    )


def _coords(dim: DataFrame, key: str, centroids: DataFrame, prefix: str) -> DataFrame:
    g = centroids.select(
        F.col("zip_prefix").alias(f"{prefix}_zip"),
        F.col("lat").alias(f"{prefix}_lat"),
        F.col("lng").alias(f"{prefix}_lng"),
    )
    return dim.select(key, F.col("zip_prefix").alias(f"{prefix}_zip")).join(g, f"{prefix}_zip", "left")


def month_parts(orders: DataFrame) -> DataFrame:
    """``(_ym, _first, _parts)``: into how many parts each month is cut, by its share of the orders, and the number of the first.

    About two parts per shuffle partition. A row per month of the calendar ('' for none).
    """
    spark = orders.sparkSession
    sizes = orders.groupBy(F.coalesce("order_ym", F.lit("")).alias("ym")).agg(F.count(F.lit(1)).alias("n")).orderBy("ym").collect()
    total, wanted = sum(r.n for r in sizes), 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, first = [], 0
    for r in sizes:
        parts = -(-wanted * r.n // total)
        rows.append((r.ym, first, parts))
        first += parts
    return spark.createDataFrame(rows, "_ym string, _first bigint, _parts bigint")


def lane_coordinates(lines: DataFrame, orders: DataFrame, customers: DataFrame, sellers: DataFrame,
                     centroids: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """Delivered lines with both ends of their lane (zip and coordinates).

    ``lines``: stg/fct order items; ``orders``: orders with item totals
    (``orders_with_items`` or ``fct_orders``); ``customers``: stg or dim
    customers; ``sellers``: stg sellers; ``centroids``: ``geo_centroids``. Lines
    that know their order's status (the fact) are filtered before the join.

    With ``months`` (``month_parts`` of the orders) lines and orders, both with the order's month, meet in parts of
    a month, so that the result stands together by month and need not be dealt by it
    (under ``partial_keys``; else they are dealt by order once more).
    """
    keys = ["order_id"] if months is None else ["order_id", "_part"]

    def placed(df):
        if months is None:
            return df
        part = F.col("_first") + F.pmod(F.xxhash64("order_id"), F.col("_parts"))
        known = df.join(F.broadcast(months), F.coalesce("order_ym", F.lit("")) == F.col("_ym"))
        return known.withColumn("_part", part).drop("_ym", "_first", "_parts", "order_ym")

    def dealt(df):
        return df if months is None else df.repartition("_part")

    month = [] if months is None else ["order_ym"]
    delivered = placed(orders.filter(F.col("is_delivered")).select(
        "order_id", "order_date", "customer_id",
        F.col("freight_total").alias("order_freight_total"),
        F.col("gmv").alias("order_gmv"), *month,
    ))
    if "is_delivered" in lines.columns:
        lines = lines.filter(F.col("is_delivered"))
    li = placed(lines.select("order_id", "order_item_seq", "product_id", "seller_id", "qty", "unit_price", "freight_value", *month))
    delivered = delivered.join(_coords(customers, "customer_id", centroids, "cust"), "customer_id", "left")
    places = _coords(sellers, "seller_id", centroids, "seller")
    if sellers.count() <= FEW_SELLERS:
        lanes = dealt(li).join(dealt(delivered), keys, "inner").join(F.broadcast(places), "seller_id", "left")
    else:
        lanes = dealt(li.join(places, "seller_id", "left")).join(dealt(delivered), keys, "inner")
    more = line_columns()  # of base columns, behind the joins
    return lanes.drop("_part").withColumns({c: more[c] for c in ("order_item_id", "line_gross")})


def freight_rows(coords: DataFrame) -> DataFrame:
    """Lines with lane distance and order totals; ``freight_columns`` makes the mart of them."""
    return coords.select(
        "order_id", "order_item_seq", "order_date", "product_id", "seller_id", "qty", "unit_price", "freight_value",
        haversine_km(F.col("cust_lat"), F.col("cust_lng"), F.col("seller_lat"), F.col("seller_lng")).alias(
            "distance_km"
        ),
        "order_freight_total",
        "order_gmv",
    )


def freight_columns() -> list:
    """Line-level freight economics with lane distance and order totals."""
    more = line_columns()
    return [
        more["order_item_id"], "order_id", "order_date", "product_id", "seller_id", "qty", "unit_price",
        "freight_value", more["line_gross"],
        safe_div(F.col("freight_value"), more["line_gross"]).alias("freight_pct_line"),
        "distance_km",
        "order_freight_total",
        "order_gmv",
        safe_div(F.col("order_freight_total"), F.col("order_gmv")).alias("order_freight_pct"),
    ]


def lane_distances(coords: DataFrame) -> DataFrame:
    """Distinct lanes (customer zip, seller zip) of delivered lines with their distance."""
    return coords.select(
        "cust_zip", "seller_zip",
        haversine_km(F.col("cust_lat"), F.col("cust_lng"), F.col("seller_lat"), F.col("seller_lng")).alias(
            "distance_km"
        ),
    ).distinct()


def mrt_reviews(stg_reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Per review day: volume, mean score, mean score of late / on-time
    deliveries and the delay penalty (on-time minus late, when both exist)."""
    rev = stg_reviews.filter(F.col("score").isNotNull()).select(
        F.to_date("review_creation_ts").alias("as_of_date"), "order_id", "score"
    )
    flags = fct_deliveries(orders).select("order_id", "is_late", "is_on_time")
    by_day = rev.join(flags, "order_id", "left").groupBy("as_of_date").agg(
        F.count(F.lit(1)).alias("reviews_count"),
        F.avg("score").alias("avg_score"),
        F.avg(F.when(F.col("is_late"), F.col("score"))).alias("late_avg_score"),
        F.avg(F.when(F.col("is_on_time"), F.col("score"))).alias("ontime_avg_score"),
    )
    return by_day.select(
        "as_of_date", "reviews_count", "avg_score", "late_avg_score", "ontime_avg_score",
        (F.col("ontime_avg_score") - F.col("late_avg_score")).alias("delay_penalty"),
    )


def freight_pct_trend(freight: DataFrame) -> DataFrame:
    """Mean order freight share per day, over lines (an order with k lines weighs k)."""
    return (
        freight.filter(F.col("order_date").isNotNull() & F.col("order_freight_pct").isNotNull())
        .groupBy("order_date")
        .agg(F.avg("order_freight_pct").alias("freight_pct"))
    )
