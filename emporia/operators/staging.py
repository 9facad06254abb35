"""Staging layer: fix names and types of the raw tables (lazy projections).

Every column is the first non-null of the names it may carry in either source
schema (real or synthetic), so the same function serves both modes and absent
columns never fail the analysis.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.functions import first_of, zero_pad

# Status synonyms, normalised after lower-casing. Fixed values.
STATUS_SYNONYMS = {
    "delivered": ("delivered", "complete", "completed"),
    "shipped": ("shipped", "shipping"),
    "approved": ("approved",),
    "invoiced": ("invoiced",),
    "processing": ("processing", "created"),
    "canceled": ("canceled", "cancelled"),
    "unavailable": ("unavailable",),
    "refunded": ("refunded",),
}
UNKNOWN_STATUS = "unknown"

TS = "timestamp_ntz"


def normalize_status(raw: Column) -> Column:
    """Lower-case, map synonyms, NULL -> 'unknown', anything else unchanged."""
    s = F.lower(raw)
    out = F.when(s.isNull(), F.lit(UNKNOWN_STATUS))
    for target, synonyms in STATUS_SYNONYMS.items():
        out = out.when(s.isin(*synonyms), F.lit(target))
    return out.otherwise(s)


#: Columns of a staged order that come from its source; ``order_columns`` follow from them.
ORDER_BASE = ("order_id", "customer_id", "status", "order_ts", "approved_ts", "delivered_carrier_ts",
              "delivered_customer_ts", "estimated_delivery_ts")
#: The same for a staged line and ``line_columns``.
LINE_BASE = ("order_id", "order_item_seq", "product_id", "seller_id", "qty", "unit_price", "discount_amount", "freight_value")


def order_columns(currency: str = "BRL") -> list[Column]:
    """Date, month, currency and flags of an order, from its base columns."""
    delivered, estimated = F.col("delivered_customer_ts"), F.col("estimated_delivery_ts")
    return [
        F.to_date("order_ts").alias("order_date"),
        F.date_format("order_ts", "yyyy-MM").alias("order_ym"),
        F.lit(currency).alias("currency"),
        *status_flags(),
        # staging lateness is two-valued: unknown counts as not late
        F.coalesce(delivered > estimated, F.lit(False)).alias("is_late"),
    ]


def status_flags() -> list[Column]:
    return [(F.col("status") == s).alias(f"is_{s}") for s in ("delivered", "canceled", "unavailable")]


def line_columns() -> dict[str, Column]:
    """Item id and amounts of a line, from its base columns."""
    amount = F.col("qty") * F.col("unit_price")
    return {
        "order_item_id": F.concat(F.col("order_id"), F.lit("-"), zero_pad(F.col("order_item_seq"), 3)).alias("order_item_id"),
        "line_gross": amount.cast("double").alias("line_gross"),
        "line_net": (amount - F.col("discount_amount")).cast("double").alias("line_net"),
    }


def stg_orders(raw: DataFrame, currency: str = "BRL") -> DataFrame:
    status = normalize_status(first_of(raw, ["order_status", "status"], "string"))
    base = raw.select(
        first_of(raw, ["order_id"], "string").alias("order_id"),
        first_of(raw, ["customer_id"], "string").alias("customer_id"),
        status.alias("status"),
        first_of(raw, ["order_purchase_timestamp", "order_ts"], TS).alias("order_ts"),
        first_of(raw, ["order_approved_at", "approved_ts"], TS).alias("approved_ts"),
        first_of(raw, ["order_delivered_carrier_date", "delivered_carrier_ts"], TS).alias("delivered_carrier_ts"),
        first_of(raw, ["order_delivered_customer_date", "delivered_customer_ts"], TS).alias("delivered_customer_ts"),
        first_of(raw, ["order_estimated_delivery_date", "estimated_delivery_ts"], TS).alias("estimated_delivery_ts"),
    )
    return base.select("*", *order_columns(currency))


def stg_order_items(raw: DataFrame) -> DataFrame:
    # where a source has line numbers, its item id is a key of its own kind
    sequence = "line_number" if "line_number" in {c.lower() for c in raw.columns} else "order_item_id"
    base = raw.select(
        first_of(raw, ["order_id", "orderid"], "string").alias("order_id"),
        first_of(raw, [sequence], "int", 1).alias("order_item_seq"),
        first_of(raw, ["product_id", "sku"], "string").alias("product_id"),
        first_of(raw, ["seller_id", "seller"], "string").alias("seller_id"),
        first_of(raw, ["qty", "quantity"], "int", 1).alias("qty"),
        first_of(raw, ["unit_price", "price"], "double", 0.0).alias("unit_price"),
        first_of(raw, ["discount_amount"], "double", 0.0).alias("discount_amount"),
        first_of(raw, ["freight_value", "shipping_fee"], "double", 0.0).alias("freight_value"),
    )
    more = line_columns()
    return base.select(more["order_item_id"], *LINE_BASE, more["line_gross"], more["line_net"])


def stg_customers(raw: DataFrame, default_country: str = "BR") -> DataFrame:
    return raw.select(
        first_of(raw, ["customer_id", "customerid"], "string").alias("customer_id"),
        first_of(raw, ["customer_unique_id", "customer_uuid", "customer_id"], "string").alias("customer_unique_id"),
        first_of(raw, ["signup_ts", "first_order_ts"], TS).alias("signup_ts"),
        first_of(raw, ["customer_state", "state"], "string").alias("state"),
        first_of(raw, ["customer_city", "city"], "string").alias("city"),
        first_of(raw, ["customer_zip_code_prefix", "zip_prefix"], "string").alias("zip_prefix"),
        first_of(raw, ["country"], "string", default_country).alias("country"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        first_of(raw, ["seller_id"], "string").alias("seller_id"),
        first_of(raw, ["seller_city", "city"], "string").alias("city"),
        first_of(raw, ["seller_state", "state"], "string").alias("state"),
        first_of(raw, ["seller_zip_code_prefix", "zip_prefix"], "string").alias("zip_prefix"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    def i(names):
        return first_of(raw, names, "int")

    return raw.select(
        first_of(raw, ["product_id"], "string").alias("product_id"),
        F.lower(first_of(raw, ["product_category_name", "category"], "string")).alias("category"),
        i(["product_name_lenght", "name_len"]).alias("name_len"),
        i(["product_description_lenght", "desc_len"]).alias("desc_len"),
        i(["product_photos_qty", "photos_qty"]).alias("photos_qty"),
        i(["product_weight_g", "weight_g"]).alias("weight_g"),
        i(["product_length_cm", "length_cm"]).alias("length_cm"),
        i(["product_height_cm", "height_cm"]).alias("height_cm"),
        i(["product_width_cm", "width_cm"]).alias("width_cm"),
    )


def payments_base(raw: DataFrame) -> DataFrame:
    """Typed payments before numbering; keeps the source sequence (``src_seq``)."""
    return raw.select(
        first_of(raw, ["order_id"], "string").alias("order_id"),
        first_of(raw, ["payment_sequential"], "int").alias("src_seq"),
        F.lower(first_of(raw, ["payment_type", "method"], "string", "unknown")).alias("method"),
        first_of(raw, ["payment_installments", "installments"], "int", 1).alias("installments"),
        first_of(raw, ["payment_value", "amount"], "double", 0.0).alias("value"),
    )


def payment_rank_key():
    """Orders an order's payments like ``payment_seq`` does, as one comparable
    value: larger = earlier (larger value, then smaller source sequence, NULL
    sequence last). ``max_by(x, payment_rank_key())`` is the first payment's x
    as a plain aggregate, with no per-order window."""
    return F.struct(F.col("value"), F.when(F.col("src_seq").isNotNull(), -F.col("src_seq")))


def stg_payments(raw: DataFrame) -> DataFrame:
    """``payment_seq`` numbers the payments of an order by value, largest first;
    ties are broken by the source sequence so the numbering is reproducible.

    Numbered with ``sequence_within`` (by positions in range-partitioned data, so
    an order with a huge number of payments is spread over many tasks). Consumers that only
    need the first payment use ``payment_rank_key`` on ``payments_base``,
    which is a plain map-side aggregate.
    """
    from emporia.operators.sequence import sequence_within

    numbered = sequence_within(payments_base(raw), "order_id",
                               [F.desc("value"), F.asc_nulls_last("src_seq")], name="payment_seq")
    return numbered.select("order_id", "payment_seq", "method", "installments", "value")


def stg_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        first_of(raw, ["review_id"], "string").alias("review_id"),
        first_of(raw, ["order_id"], "string").alias("order_id"),
        first_of(raw, ["review_score", "score"], "int").alias("score"),
        first_of(raw, ["review_creation_date", "review_creation_ts"], TS).alias("review_creation_ts"),
        first_of(raw, ["review_answer_timestamp", "review_answer_ts"], TS).alias("review_answer_ts"),
        first_of(raw, ["review_comment_title", "comment_title"], "string").alias("comment_title"),
        first_of(raw, ["review_comment_message", "comment_message"], "string").alias("comment_message"),
    )


def stg_geolocation(raw: DataFrame) -> DataFrame:
    """Geolocation points with exact duplicates removed."""
    return raw.select(
        first_of(raw, ["geolocation_zip_code_prefix", "zip_prefix"], "string").alias("zip_prefix"),
        first_of(raw, ["geolocation_city", "city"], "string").alias("city"),
        first_of(raw, ["geolocation_state", "state"], "string").alias("state"),
        first_of(raw, ["geolocation_lat", "lat"], "double").alias("lat"),
        first_of(raw, ["geolocation_lng", "lng"], "double").alias("lng"),
    ).distinct()


def geo_centroids(geo: DataFrame) -> DataFrame:
    """One coordinate per zip prefix: the mean of its distinct points.

    Joining raw points would multiply every line by the number of points of
    its zip; the centroid keeps the lookup one-to-one.
    """
    return (
        geo.select("zip_prefix", "lat", "lng")
        .distinct()
        .groupBy("zip_prefix")
        .agg(F.avg("lat").alias("lat"), F.avg("lng").alias("lng"))
    )


def stg_refunds(raw: DataFrame) -> DataFrame:
    return raw.select(
        first_of(raw, ["refund_id"], "string").alias("refund_id"),
        first_of(raw, ["order_id"], "string").alias("order_id"),
        first_of(raw, ["amount", "refund_amount"], "double", 0.0).alias("amount"),
        first_of(raw, ["refund_ts", "created_at"], TS).alias("refund_ts"),
    )


def stg_marketing_spend(raw: DataFrame) -> DataFrame:
    return raw.select(
        first_of(raw, ["spend_date", "date"], "date").alias("spend_date"),
        first_of(raw, ["channel"], "string", "all").alias("channel"),
        first_of(raw, ["amount", "spend"], "double", 0.0).alias("amount"),
    )
