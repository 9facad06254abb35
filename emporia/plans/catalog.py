"""Registry of the queries exposed to the driver (``__spark_entry__``).

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole test tables. ``present`` is the last projection of every entry: doubles
rounded to 6 decimals and arrays joined to text, the form in which both
engines' results are compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from emporia.functions.columns import rounded
from emporia.plans.warehouse import Warehouse

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = rounded(c.cast("double"), 6)
        elif isinstance(f.dataType, ArrayType):
            c = F.array_join(c, ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, mode: str = "real"):
    def deco(fn: Callable[[Warehouse], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(Warehouse.from_testdata(spark, sf_dir, mode=mode)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return deco


def model(name: str) -> None:
    """Register a model of the warehouse as a query under its own name."""
    register(name)(lambda wh: getattr(wh, name))


for _m in (
    "stg_orders", "stg_order_items", "stg_customers", "stg_sellers", "stg_products", "stg_payments",
    "stg_reviews", "stg_geolocation", "geo_centroids",
    "dim_customers", "dim_products", "fct_order_items", "order_item_totals", "order_payment_totals",
    "fct_orders",
    "fct_deliveries", "fct_freight", "mrt_kpis_daily", "mrt_reviews", "freight_pct_trend",
):
    model(_m)


def all_queries() -> dict[str, QueryFn]:
    from emporia.plans import queries as _q  # noqa: F401  (registers the analyses)

    return dict(QUERIES)
