"""Delivery and review analyses over ``fct_deliveries`` and ``stg_reviews``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lead_time_hist(deliveries: DataFrame, max_days: int | None = None) -> DataFrame:
    """Delivered orders per lead time in days: all of them, or with ``max_days`` the display range 0..max_days."""
    lt = F.col("lead_time_days")
    return (
        deliveries.filter(lt.isNotNull() if max_days is None else lt.between(0, max_days))
        .groupBy(lt.cast("int").alias("lead_time_days"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def on_time_split(deliveries: DataFrame) -> DataFrame:
    """Share on time / late among deliveries with an ETA (no ETA: excluded)."""
    d = deliveries.filter(F.col("is_on_time").isNotNull())
    n = F.count(F.lit(1))
    return d.agg(
        n.alias("deliveries"),
        F.when(n > 0, F.sum(F.when(F.col("is_on_time"), 1).otherwise(0)) / n).alias("on_time_pct"),
        F.when(n > 0, F.sum(F.when(F.col("is_late"), 1).otherwise(0)) / n).alias("late_pct"),
    )


def reviewed_deliveries(reviews: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Scored reviews of delivered orders (inner join on ``order_id``)."""
    r = reviews.filter(F.col("score").isNotNull()).select("order_id", "score")
    return r.join(deliveries.select("order_id", "is_late"), "order_id", "inner")


def delay_penalty_overall(reviews: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Mean score of on-time vs late deliveries and their difference."""
    j = reviewed_deliveries(reviews, deliveries)
    late = F.avg(F.when(F.col("is_late") == F.lit(True), F.col("score")))
    on_time = F.avg(F.when(F.col("is_late") == F.lit(False), F.col("score")))
    return j.agg(
        F.count(F.lit(1)).alias("reviews"),
        on_time.alias("ontime_avg_score"),
        late.alias("late_avg_score"),
        (on_time - late).alias("delay_penalty"),
    )


def score_distribution(reviews: DataFrame, deliveries: DataFrame) -> DataFrame:
    return reviewed_deliveries(reviews, deliveries).groupBy("score").agg(F.count(F.lit(1)).alias("reviews"))
