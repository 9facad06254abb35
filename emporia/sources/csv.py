"""CSV sources: read one file (or folder of part files), ingest a folder by a
file -> table mapping, register stable raw names, summarise what was loaded.

Reading is schema-on-read *by name*: every column is read as text, header
names are normalised, and the target schema is applied with casts by name.
Columns absent from a file become typed NULLs (union by name), and text keys
such as zip prefixes keep their leading zeros.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# File names of the two source sets and the raw tables they load into. Fixed values.
OLIST_FILES = {
    "olist_orders_dataset.csv": "raw_orders",
    "olist_order_items_dataset.csv": "raw_order_items",
    "olist_customers_dataset.csv": "raw_customers",
    "olist_order_payments_dataset.csv": "raw_payments",
    "olist_order_reviews_dataset.csv": "raw_reviews",
    "olist_products_dataset.csv": "raw_products",
    "olist_sellers_dataset.csv": "raw_sellers",
    "olist_geolocation_dataset.csv": "raw_geolocation",
}
SYNTH_FILES = {
    "orders.csv": "raw_orders",
    "order_items.csv": "raw_order_items",
    "customers.csv": "raw_customers",
    "refunds.csv": "raw_refunds",
    "inventory.csv": "raw_inventory",
    "marketing_spend.csv": "raw_marketing_spend",
}

TS = "timestamp_ntz"
# Typed schemas (DDL) of the real-mode raw tables (zip prefixes stay text).
RAW_SCHEMAS = {
    "raw_orders": (
        f"order_id string, customer_id string, order_status string, order_purchase_timestamp {TS}, "
        f"order_approved_at {TS}, order_delivered_carrier_date {TS}, order_delivered_customer_date {TS}, "
        f"order_estimated_delivery_date {TS}"),
    "raw_order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string, price double, "
        "freight_value double, qty int, discount_amount double, shipping_limit_date timestamp_ntz"),
    "raw_customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"),
    "raw_payments": (
        "order_id string, payment_sequential int, payment_type string, payment_installments int, "
        "payment_value double"),
    "raw_reviews": (
        f"review_id string, order_id string, review_score int, review_comment_title string, "
        f"review_comment_message string, review_creation_date {TS}, review_answer_timestamp {TS}"),
    "raw_products": (
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty int, product_weight_g int, product_length_cm int, "
        "product_height_cm int, product_width_cm int"),
    "raw_sellers": (
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"),
    "raw_geolocation": (
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string"),
}

# Typed schemas of the synthetic-mode raw tables.
SYNTH_SCHEMAS = {
    "raw_orders": (
        f"order_id string, customer_id string, status string, order_ts {TS}, approved_ts {TS}, "
        f"delivered_carrier_ts {TS}, delivered_customer_ts {TS}, estimated_delivery_ts {TS}"),
    "raw_order_items": (
        "order_item_id string, order_id string, line_number int, sku string, seller string, qty int, "
        "unit_price double, discount_amount double, cogs_unit double, shipping_fee double"),
    "raw_customers": (
        f"customer_id string, signup_ts {TS}, country string, state string, city string, zip_prefix string"),
    "raw_refunds": f"refund_id string, order_id string, amount double, refund_ts {TS}",
    "raw_inventory": "sku string, on_hand int, lead_time_days int",
    "raw_marketing_spend": "spend_date date, channel string, amount double",
}
# Tables whose text may hold line breaks. Their files are read whole; all others are split.
MULTILINE_TABLES = frozenset({"raw_reviews"})


def normalize_name(name: str) -> str:
    """Lower-case; runs of non-alphanumerics become one underscore."""
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")


def _read_one(spark: SparkSession, path: str, schema: StructType | str | None, multiline: bool) -> DataFrame:
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    reader = (spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
              .option("mode", "FAILFAST"))
    try:
        if schema is None:
            df = reader.option("inferSchema", True).option("samplingRatio", 1.0).csv(path)
        else:
            df = reader.option("inferSchema", False).csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"Expected file missing: {path}") from e
        raise
    df = df.toDF(*[normalize_name(c) for c in df.columns])
    if schema is None:
        return df
    present, declared = set(df.columns), {f.name for f in schema.fields}
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
        *[c for c in df.columns if c not in declared],  # undeclared columns stay, as text
    )


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None = None,
             multiline: bool = False) -> DataFrame:
    """Headered CSV -> DataFrame with normalised names; columns the schema does not name stay as text.

    ``multiline`` allows line breaks in quoted text, at the price of one task
    per file. Several paths are combined by column name; a column missing in
    one of them is NULL there. Without ``schema`` the types are inferred from
    all rows.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    frames = [_read_one(spark, p, schema, multiline) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ingest_folder(spark: SparkSession, folder: str, mapping: Mapping[str, str],
                  schemas: Mapping[str, StructType | str] | None = None) -> dict[str, DataFrame]:
    """Load every file of ``mapping`` from ``folder``; a missing file fails by name, before any is read."""
    folder = folder.rstrip("/")
    schemas = schemas or {}
    for fname in mapping:
        require(spark, f"{folder}/{fname}")
    return {
        table: read_csv(spark, f"{folder}/{fname}", schemas.get(table), table in MULTILINE_TABLES)
        for fname, table in mapping.items()
    }


def require(spark: SparkSession, path: str) -> None:
    """Fail by name if there is nothing at ``path`` (lists the path, reads no rows)."""
    try:
        spark.read.text(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"Expected file missing: {path}") from e


def schema_preview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, position, column_name, type) of the loaded tables."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, i, c, k) for t, df in tables.items() for i, (c, k) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, type string")


def register_raw(tables: Mapping[str, DataFrame]) -> None:
    """Expose the tables under their stable ``raw_*`` names as temp views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def ingest_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table plus a ``TOTAL`` row, in one aggregate (rollup) over one
    scan of each table."""
    tagged = reduce(DataFrame.unionByName,
                    [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()])
    counts = tagged.rollup("table_name").agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "rows")


def store_raw(tables: Mapping[str, DataFrame], out_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables written as Parquet under ``out_dir``, and the summary of ``ingest_summary`` for them.

    Rows are counted by an ``Observation`` while they are written, so every
    source file is read once; only one number per table reaches the driver.
    """
    out_dir, stored, rows = out_dir.rstrip("/"), {}, []
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        counted = Observation(name)
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{out_dir}/{name}")
        rows.append((name, counted.get["rows"]))
        stored[name] = spark.read.schema(df.schema).parquet(f"{out_dir}/{name}")
    rows.append(("TOTAL", sum(n for _, n in rows)))
    return stored, spark.createDataFrame(rows, "table_name string, rows bigint")


def table_health(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """(table_name, present): which of the expected tables / views exist in the session catalog."""
    return spark.createDataFrame([(n, spark.catalog.tableExists(n)) for n in names], "table_name string, present boolean")
