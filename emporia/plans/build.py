"""Materialised build: write the core tables and marts in dependency order.

Each table is written as Parquet under ``out_dir`` (shared storage on a
cluster; the shared checkpoint folder by default) and read back, and the
warehouse then serves the persisted table to every later model. This is the
lineage cut between layers: downstream marts and analyses scan columnar
files with pruning and pushdown instead of recomputing staging and joins,
and a lost executor costs a re-read, not a recomputation of the chain.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager, nullcontext
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.functions.columns import PARTITION
from emporia.operators import contracts
from emporia.plans.warehouse import Warehouse
from emporia.session import shared_dir
from emporia.sources.sinks import with_comments

# Table descriptions, and column descriptions, stored with the persisted tables.
TABLE_DOCS: dict[str, str] = {
    "dim_customers": "one row per customer, with first orders and their number",
    "dim_products": "one row per product, with category and measures",
    "fct_order_items": "one row per order line, with amounts and the order's flags",
    "fct_orders": "one row per order, with totals of lines and payments",
    "fct_deliveries": "one row per delivered order, with lead time and punctuality",
    "fct_freight": "one row per delivered line, with freight share and lane distance",
    "mrt_kpis_daily": "daily key figures of delivered orders",
    "mrt_reviews": "daily review scores and the penalty of late deliveries",
    "order_payments": "one row per order with payments: methods and installments",
}
DOCS: dict[str, dict[str, str]] = {
    "dim_customers": {
        "customer_id": "customer key",
        "first_order_ts": "first purchase; NULL for customers without orders",
        "orders_count": "orders placed; NULL for customers without orders",
    },
    "fct_order_items": {
        "order_item_id": "order id and zero-padded line sequence",
        "line_gross": "qty * unit_price",
        "line_net": "line_gross - discount_amount",
    },
    "fct_orders": {
        "gmv": "sum of line_gross (0 without lines)",
        "payment_methods": "sorted distinct payment methods (empty without payments)",
    },
    "fct_deliveries": {
        "lead_time_days": "calendar days from order date to delivery",
        "eta_gap_days": "delivery minus estimate in days (positive = late); NULL without estimate",
        "is_on_time": "delivered no later than estimated; NULL without estimate",
    },
    "fct_freight": {
        "distance_km": "great-circle distance between customer and seller zip centroids",
        "order_freight_pct": "order freight / order gmv; NULL when gmv <= 0",
    },
    "mrt_kpis_daily": {
        "on_time_pct": "share of delivered orders on time (no estimate counts as not on time)",
        "freight_pct_gmv": "freight / gmv; NULL when gmv <= 0",
    },
}

# Partition columns for large persisted tables (date pruning on a cluster).
# Lines carry their order's month (from order_ts) so that look-back windows
# prune the largest table too, not only the orders.
PARTITIONS: dict[str, str] = {
    t: "order_ym" for t in ("fct_orders", "fct_order_items", "order_payments", "fct_freight", "fct_deliveries")
}
DERIVED = {
    ("fct_orders", "order_ym"): lambda: F.date_format("order_ts", "yyyy-MM"),
    ("fct_order_items", "order_ym"): lambda: F.date_format("order_ts", "yyyy-MM"),
    ("fct_freight", "order_ym"): lambda: F.date_format("order_date", "yyyy-MM"),
    ("fct_deliveries", "order_ym"): lambda: F.date_format("order_date", "yyyy-MM"),
}

# The month of DERIVED as a number, by which rows are dealt: shorter than its text.
NUMBERED = {
    ("fct_orders", "order_ym"): "order_ts", ("fct_order_items", "order_ym"): "order_ts",
    ("fct_freight", "order_ym"): "order_date", ("fct_deliveries", "order_ym"): "order_date",
}


def new_build_dir(wh: Warehouse, purpose: str = "build") -> str:
    spark = next(iter(wh.raw.values())).sparkSession
    return f"{shared_dir(spark)}/emporia/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def partial_keys(spark: SparkSession):
    """Within it a join takes sides that are dealt alike by some of its keys as they are, as a window or an aggregate always does."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(wh: Warehouse, out_dir: str | None = None, tables: Sequence[str] | None = None,
                partition_by: Mapping[str, str] | None = None) -> dict[str, str]:
    """Write ``tables`` (default: all that the raw tables at hand can make) in order; returns ``{table: path}``."""
    tables = wh.buildable() if tables is None else tables
    out_dir = (out_dir or new_build_dir(wh)).rstrip("/")
    spark = next(iter(wh.raw.values())).sparkSession
    parts = PARTITIONS if partition_by is None else partition_by
    paths: dict[str, str] = {}
    for name in tables:
        path = f"{out_dir}/{name}"
        col = parts.get(name)
        together = wh.rows_in_months(name) if col == "order_ym" else None
        rows, columns = together or wh.rows_of(name)
        if col:
            # REBALANCE lets AQE size the write tasks per partition value: small months are coalesced (few files),
            # a hot month is split. Rows that stand together by month as they come are not dealt again.
            if col in rows.columns:
                rows = rows if together else rows.hint("rebalance", col)
            else:
                if not together:
                    day = NUMBERED[(name, col)]
                    rows = rows.withColumn("_month", F.year(day) * 12 + F.month(day)).hint("rebalance", "_month")
                rows = rows.withColumn(col, DERIVED[(name, col)]())
        df = rows.select(*columns)
        if col and col not in df.columns:
            df = rows.select(*columns, col)  # stays visible so consumers can prune on it
        df = with_comments(df, DOCS.get(name, {}))
        writer = df.write.mode("overwrite").option("compression", "zstd")
        with partial_keys(spark) if together else nullcontext():
            (writer.partitionBy(col) if col else writer).parquet(path)
        wh.replace(name, stored(df, path, col))
        paths[name] = path
    return paths


def stored(like: DataFrame, path: str, partition: str | None = None) -> DataFrame:
    """The table at ``path`` (it may be without any file) with the columns of ``like``, its partition column marked as such."""
    return like.sparkSession.read.schema(like.schema).parquet(path).select(
        *[F.col(c).alias(c, metadata=PARTITION) if c == partition else F.col(c) for c in like.columns])


def publish(wh: Warehouse, paths: Mapping[str, str], database: str) -> str:
    """Persisted tables as external tables of ``database`` in the catalog, with descriptions of tables and columns."""
    spark = next(iter(wh.raw.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{new_build_dir(wh, 'catalog')}'")

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    for name, path in paths.items():
        docs = DOCS.get(name, {})
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {quoted(docs[f.name])}" if f.name in docs else "")
            for f in spark.read.parquet(path).schema.fields)
        by = f"PARTITIONED BY (`{PARTITIONS[name]}`)" if name in PARTITIONS else ""
        about = f"COMMENT {quoted(TABLE_DOCS[name])}" if name in TABLE_DOCS else ""
        spark.sql(f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet {by} {about} LOCATION {quoted(path)}")
        if by:
            spark.sql(f"MSCK REPAIR TABLE `{database}`.`{name}`")
    return database


def describe(wh: Warehouse, database: str) -> DataFrame:
    """``(table_name, column_name, description, filled)`` of all described tables (column '') and columns of ``database``.

    Descriptions are the catalog's; ``filled`` counts the table's rows, or
    those with a value in the column, in one aggregate per table.
    """
    spark = next(iter(wh.raw.values())).sparkSession
    parts = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary:  # a session's own views are listed with every database
            continue
        rows = [("", t.description, F.count(F.lit(1)))]
        rows += [(c.name, c.description, F.count(f"`{c.name}`"))
                 for c in spark.catalog.listColumns(f"{database}.{t.name}") if c.description]
        counts = spark.table(f"`{database}`.`{t.name}`").agg(*[n.alias(f"c{i}") for i, (_, _, n) in enumerate(rows)])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(t.name).alias("table_name"), F.lit(column).alias("column_name"),
                     F.lit(text).cast("string").alias("description"), F.col(f"c{i}").alias("filled"))
            for i, (column, text, _) in enumerate(rows)]))))
    return reduce(DataFrame.unionByName, parts)


def build_summary(wh: Warehouse, paths: Mapping[str, str]) -> DataFrame:
    """``(table_name, rows)`` of the persisted tables (Parquet row counts)."""
    spark = next(iter(wh.raw.values())).sparkSession
    return reduce(DataFrame.unionByName, [
        spark.read.parquet(p).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for n, p in paths.items()
    ])


def persist_model(wh: Warehouse, name: str) -> DataFrame:
    """Write one model as Parquet into the shared folder (unless it is already
    persisted), so that multi-pass analyses read just the columns they need."""
    if not wh.is_persisted(name):
        wh.replace(name, persist_frame(getattr(wh, name), name), persisted=True)
    return getattr(wh, name)


def persist_frame(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder, and read back."""
    path = f"{shared_dir(df.sparkSession)}/emporia/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_test_failures(wh: Warehouse, out_dir: str) -> DataFrame:
    """Run the model tests once, keep every failing row, whole, in the quarantine
    table ``<out_dir>/test_failures`` (partitioned by model), and return that table."""
    models = {name: getattr(wh, name) for name in contracts.MODEL_KEYS}
    path = f"{out_dir.rstrip('/')}/test_failures"
    contracts.store_failures(models).write.mode("overwrite").partitionBy("model").parquet(path)
    spark = next(iter(models.values())).sparkSession
    return spark.read.schema(contracts.FAILURE_SCHEMA).parquet(path)
