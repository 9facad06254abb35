"""KPI reads: look-back window, newest tile values, alerts, long series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import as_of_date, money_sum, safe_div, since

KPI_COLUMNS = ("orders_delivered", "gmv", "aov", "freight_pct_gmv", "on_time_pct", "late_pct")

# Alert thresholds (defaults of the overview page). Fixed values.
ONTIME_WARN_PCT = 85.0
FREIGHT_PCT_WARN = 0.20
REVIEW_WARN_SCORE = 3.8


def kpi_window(kpis: DataFrame, days: int = 180, as_of=None) -> DataFrame:
    """KPI rows of the last ``days`` days up to ``as_of`` (default: newest KPI day)."""
    ref = as_of_date(as_of, kpis, "kpi_date")
    return kpis.filter(since(F.col("kpi_date"), days, ref)).orderBy("kpi_date")


def kpi_latest(kpis: DataFrame, days: int = 180, as_of=None) -> DataFrame:
    """The newest row of the window, as the overview tiles show it (percentages x100)."""
    w = kpi_window(kpis, days, as_of)
    return w.orderBy(F.desc("kpi_date")).limit(1).select(
        "kpi_date", "orders_delivered", "gmv", "aov",
        (F.col("on_time_pct") * 100).alias("on_time_pct_100"),
        (F.col("freight_pct_gmv") * 100).alias("freight_pct_gmv_100"),
    )


def kpi_alerts(kpis: DataFrame, reviews: DataFrame, days: int = 180, as_of=None,
               ontime_warn_pct: float = ONTIME_WARN_PCT, freight_pct_warn: float = FREIGHT_PCT_WARN,
               review_warn_score: float = REVIEW_WARN_SCORE) -> DataFrame:
    """Three threshold checks on the newest KPI day and the newest review day up to ``as_of``.

    One row per check ``(alert, value, threshold, fired)``; a NULL value never
    fires. Both inputs are reduced to one row by an aggregate (``max_by``), the
    review value enters as a scalar subquery, so nothing is joined.
    """
    if as_of is not None:
        reviews = reviews.filter(F.col("as_of_date") <= as_of_date(as_of, kpis, "kpi_date"))
    review_score = reviews.select(F.max_by("avg_score", "as_of_date")).scalar()
    latest = kpi_window(kpis, days, as_of).agg(
        (F.max_by("on_time_pct", "kpi_date") * 100).alias("on_time"),
        F.max_by("freight_pct_gmv", "kpi_date").alias("freight"),
    )

    def check(name, value, threshold, fired):
        return F.struct(
            F.lit(name).alias("alert"),
            value.cast("double").alias("value"),
            F.lit(float(threshold)).alias("threshold"),
            F.coalesce(fired, F.lit(False)).alias("fired"),
        )

    on_time, freight = F.col("on_time"), F.col("freight")
    return latest.select(F.inline(F.array(
        check("on_time_pct_below", on_time, ontime_warn_pct, on_time < ontime_warn_pct),
        check("freight_pct_gmv_above", freight, freight_pct_warn, freight > freight_pct_warn),
        check("avg_review_score_below", review_score, review_warn_score, review_score < review_warn_score),
    )))


def kpi_series_long(kpis: DataFrame) -> DataFrame:
    """Every KPI as a (kpi_date, metric, value) series (NULL values kept)."""
    wide = kpis.select("kpi_date", *[F.col(c).cast("double").alias(c) for c in KPI_COLUMNS])
    return wide.unpivot(["kpi_date"], list(KPI_COLUMNS), "metric", "value")


# ---------------------------------------------------------------- synthetic mode
VALID_EXCLUDED = ("canceled", "unavailable")
LTV_DAYS = 90


def mrt_kpis_daily_synth(orders: DataFrame, refunds: DataFrame, spend: DataFrame,
                         ltv_days: int = LTV_DAYS) -> DataFrame:
    """Daily KPIs of the synthetic mode (own definitions; the reference only names them).

    Over valid orders (not canceled / unavailable), per day with an order or a
    refund: ``orders``, ``gmv`` (sum of line_gross), ``net_revenue`` (sum of
    line_net minus refunds dated that day), ``aov`` (NULL without orders);
    plus, for the day's month, ``cac`` = marketing spend of the month / customers whose first valid order
    falls in that month (NULL without new customers) and ``ltv_90d`` = net
    item revenue within ``ltv_days`` of each first order, summed over that
    month's cohort / cohort size.

    ``orders`` needs the ``orders_with_items`` columns. All parts are
    aggregates; the joins are between aggregates keyed by day or month, except
    the one join of orders with their customer's first order (by customer).
    """
    valid = orders.filter(~F.col("status").isin(*VALID_EXCLUDED))
    daily = valid.groupBy(F.col("order_date").alias("kpi_date")).agg(
        F.count(F.lit(1)).alias("orders"),
        money_sum("gmv").alias("gmv"),
        money_sum("net_item_revenue").alias("net_items"),
    )
    refunded = refunds.groupBy(F.to_date("refund_ts").alias("kpi_date")).agg(money_sum("amount").alias("refunds"))
    first = valid.groupBy("customer_id").agg(F.min("order_ts").alias("first_ts"))
    cohorts = first.groupBy(F.date_format("first_ts", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("new_customers"))
    spend_m = spend.groupBy(F.date_format("spend_date", "yyyy-MM").alias("month")).agg(
        money_sum("amount").alias("spend"))
    cac = spend_m.join(cohorts, "month", "left").select(
        "month", F.when(F.col("new_customers") > 0, F.col("spend") / F.col("new_customers")).alias("cac"))
    early = valid.select("customer_id", "order_ts", "net_item_revenue").join(first, "customer_id").filter(
        F.col("order_ts") < F.col("first_ts") + F.make_dt_interval(F.lit(int(ltv_days))))
    ltv = early.groupBy(F.date_format("first_ts", "yyyy-MM").alias("month")).agg(
        money_sum("net_item_revenue").alias("cohort_net")).join(cohorts, "month").select(
        "month", (F.col("cohort_net") / F.col("new_customers")).alias("ltv_90d"))
    return (
        daily.join(refunded, "kpi_date", "full")  # refunds fall on days without orders, too
        .withColumn("month", F.date_format("kpi_date", "yyyy-MM"))
        .join(cac, "month", "left")
        .join(ltv, "month", "left")
        .select(
            "kpi_date",
            F.coalesce("orders", F.lit(0)).alias("orders"),
            F.coalesce("gmv", F.lit(0.0)).alias("gmv"),
            (F.coalesce("net_items", F.lit(0.0)) - F.coalesce("refunds", F.lit(0.0))).alias("net_revenue"),
            safe_div(F.col("gmv"), F.col("orders")).alias("aov"),
            "cac", "ltv_90d",
        )
    )
