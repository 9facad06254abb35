"""Refresh of the months that changed, in a build that is there already.

A full build reads the whole history. Where only some orders changed (came,
went, or got other lines, payments or reviews), ``refresh`` finds their months,
computes the order-grained tables from the raw rows of these months alone, and
overwrites just their partitions (dynamic partition overwrite). Of the small
marts the days of these months, or the review days that the changed orders
touch, are computed anew from the refreshed facts; all other rows stay as
they are. The customer dimension follows the orders of its customers in any
month: those of the changed orders' customers are counted again.

Changes of products, sellers, customers' own data or coordinates have no month
and need a full build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators import core, marts
from emporia.plans.build import DERIVED, PARTITIONS, materialize, persist_frame, stored
from emporia.plans.warehouse import Warehouse

#: Tables of one or more rows per order, each stored by the order's month.
BY_MONTH = ("fct_order_items", "fct_orders", "fct_deliveries", "fct_freight", "order_payments")
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def changed_orders(old: dict[str, DataFrame], new: dict[str, DataFrame]) -> DataFrame:
    """order_id of all orders whose own row, or whose lines, payments or reviews, differ between two states of the raw tables.

    Each table gives a sum of row hashes per order (partial sums before the
    shuffle), taken as an exact decimal; equal sums count as unchanged.
    """
    ids = []
    for name in ("raw_orders", "raw_order_items", "raw_payments", "raw_reviews"):
        sides = []
        for tables in (old, new):
            df = tables[name]
            h = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in sorted(df.columns)])
            sums = df.groupBy("order_id").agg(F.sum(h.cast("decimal(38,0)")).alias("h"), F.count(F.lit(1)).alias("n"))
            sides.append(sums)
        a, b = sides[0].alias("a"), sides[1].alias("b")
        joined = a.join(b, F.col("a.order_id") == F.col("b.order_id"), "full_outer")
        same = F.col("a.h").eqNullSafe(F.col("b.h")) & F.col("a.n").eqNullSafe(F.col("b.n"))
        ids.append(joined.filter(~same).select(F.coalesce("a.order_id", "b.order_id").alias("order_id")))
    out = ids[0]
    for more in ids[1:]:
        out = out.union(more)
    return out.filter(F.col("order_id").isNotNull()).distinct()


def of_orders(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the orders ``ids`` (a table of one column).

    A condition, not a semi-join: Spark pushes it below whatever made the raw rows (numbering by a window, a
    left join, computed columns), so that only these orders' rows are shuffled there.
    """
    return raw.filter(F.col("order_id").isin(ids))


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a partition's folder in whatever store it is in."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def _overwrite(df: DataFrame, path: str) -> None:
    """Replace the table at ``path`` by ``df``, which may read from it: by way of a table of its own."""
    persist_frame(df, "refreshed").write.mode("overwrite").parquet(path)


def refresh(wh: Warehouse, out_dir: str, changed: DataFrame, review_days: DataFrame | None = None) -> list[str | None]:
    """Bring the build under ``out_dir`` up to the raw tables of ``wh``, given the changed orders (``order_id``).

    Returns the months that were written. ``wh`` serves the refreshed tables
    from then on. Lines and payments without an order have no month (None);
    that partition is written anew if a changed order is not there or has no
    time. ``review_days`` (``day``) names days of reviews that are no longer
    there, which the raw tables cannot tell.
    """
    out_dir = out_dir.rstrip("/")
    spark = changed.sparkSession
    paths = {name: f"{out_dir}/{name}" for name in wh.buildable()}
    changed = persist_frame(changed.select("order_id").distinct(), "changed-orders")
    before = stored(wh.fct_orders, paths["fct_orders"], PARTITIONS["fct_orders"])
    was = before.join(changed, "order_id", "left_semi")
    now = wh.stg_orders.join(changed, "order_id", "left_semi")
    touched = persist_frame(was.select("order_ym", "customer_id").union(now.select("order_ym", "customer_id")).distinct(), "touched")
    months = {r["order_ym"] for r in touched.select("order_ym").distinct().collect()}  # a row per month of the calendar
    if changed.join(wh.stg_orders, "order_id", "left_anti").limit(1).count():
        months.add(None)
    known = [m for m in months if m is not None]

    # the raw rows of these months' orders
    in_months = F.col("order_ym").isin(known)
    of_months = (in_months | F.col("order_ym").isNull()) if None in months else in_months
    ids = wh.stg_orders.filter(of_months).select("order_id").union(changed)
    many = ("raw_order_items", "raw_payments")
    if None in months:
        dated = wh.stg_orders.filter("order_ym IS NOT NULL").select("order_id")
        for name in many:
            ids = ids.union(wh.raw[name].select("order_id").join(dated, "order_id", "left_anti"))
    ids = persist_frame(ids.distinct(), "refreshed-orders")
    part = dict(wh.raw)
    for name in ("raw_orders", *many):
        raw = wh.raw[name]
        part[name] = of_orders(raw, ids)
        if None in months:
            part[name] = part[name].select(*raw.columns).union(raw.filter("order_id IS NULL"))
    own = Warehouse(part, currency=wh.currency)
    materialize(own, tables=BY_MONTH[:2])  # the others read these
    for name in BY_MONTH:
        df, column = getattr(own, name), PARTITIONS[name]
        if column not in df.columns:
            df = df.withColumn(column, DERIVED[(name, column)]())
        kept = df.filter(F.col(column).isin(known) | F.col(column).isNull())
        by_month = own.is_persisted(name)  # stored already, in months
        kept = kept if by_month else persist_frame(kept, f"refreshed-{name}")
        there = {r[column] for r in kept.select(column).distinct().collect()}
        # orders without a month share one partition with those of other changes: it is written only if it changed
        kept = kept if None in months else kept.filter(F.col(column).isNotNull())
        (kept if by_month else kept.hint("rebalance", column)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(column).parquet(paths[name])
        for month in months - there:
            _remove(spark, f"{paths[name]}/{column}={_NO_MONTH if month is None else month}")
        wh.replace(name, stored(df, paths[name], column))

    orders = wh.fct_orders
    # days of these months
    day_month = F.date_format("kpi_date", "yyyy-MM")
    kpis = spark.read.parquet(paths["mrt_kpis_daily"])
    stay = ~F.coalesce(day_month, F.lit("")).isin(*[m or "" for m in months])
    again = marts.mrt_kpis_daily(orders.filter(of_months))
    _overwrite(kpis.filter(stay).unionByName(again.select(*kpis.columns)), paths["mrt_kpis_daily"])
    # review days of the changed orders
    reviews = spark.read.parquet(paths["mrt_reviews"])
    of_changed = wh.stg_reviews.join(changed, "order_id", "left_semi").select(F.to_date("review_creation_ts").alias("day"))
    if review_days is not None:
        of_changed = of_changed.union(review_days.select("day"))
    days = persist_frame(of_changed.distinct(), "review-days")
    rev = wh.stg_reviews.withColumn("day", F.to_date("review_creation_ts"))
    rev = rev.join(days, rev["day"].eqNullSafe(days["day"]), "left_semi").drop("day")
    redone = marts.mrt_reviews(rev, orders)
    same = reviews.join(days, reviews["as_of_date"].eqNullSafe(days["day"]), "left_anti")
    _overwrite(same.unionByName(redone.select(*reviews.columns)), paths["mrt_reviews"])
    # customers of the changed orders, from all their orders
    customers = spark.read.parquet(paths["dim_customers"])
    who = persist_frame(touched.select("customer_id").filter("customer_id IS NOT NULL").distinct(), "touched-customers")
    theirs = orders.join(who, "customer_id", "left_semi")
    counted = core.dim_customers(wh.stg_customers.join(who, "customer_id", "left_semi"), theirs)
    _overwrite(customers.join(who, "customer_id", "left_anti").unionByName(counted.select(*customers.columns)), paths["dim_customers"])
    for name in ("mrt_kpis_daily", "mrt_reviews", "dim_customers", "dim_products"):
        wh.replace(name, spark.read.parquet(paths[name]))
    return sorted(known) + [None] * (None in months)
