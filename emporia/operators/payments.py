"""Payment behaviour: order-level payment rollup and the analyses on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import as_of_date, money_sum, month_bound, order_window, rounded, safe_div
from emporia.operators.staging import payment_rank_key

DAYS = 180
MIN_ORDERS = 25


def order_payment_profile(payments: DataFrame) -> DataFrame:
    """Per order: max installments, sorted distinct methods and the primary
    method, i.e. the method of the largest payment (``payment_seq`` 1).

    ``payments`` is ``payments_base`` (typed, with ``src_seq``): the primary
    method is a ``max_by`` aggregate, so it is combined map-side like the
    other two and a hot order never gathers in one task.
    """
    return payments.groupBy("order_id").agg(
        F.max("installments").alias("installments"),
        F.sort_array(F.collect_set("method")).alias("methods_list"),
        F.max_by("method", payment_rank_key()).alias("primary_method"),
    )


def primary_method(payments: DataFrame) -> DataFrame:
    p = order_payment_profile(payments)
    return p.select(
        "order_id",
        F.coalesce(F.lower("primary_method"), F.lit("unknown")).alias("primary_method"),
        "methods_list",
    )


def order_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payment profile per order with the order's month (``order_ym``), the
    persisted form of ``order_payment_profile``: partitioned by month, a
    look-back window reads only its months of it."""
    return order_payment_profile(payments).join(orders.select("order_id", "order_ym"), "order_id", "left")


def payment_orders(orders: DataFrame, payments: DataFrame | None = None, days: int = DAYS, as_of=None,
                   profile: DataFrame | None = None) -> DataFrame:
    """Orders of the last ``days`` days with their payment profile (left join).

    The profile is aggregated from the ``payments`` (``payments_base``) of these
    orders, the others being left out by a semi-join below the aggregate, or taken
    from a persisted ``order_payments`` table (``profile``), which is then
    pruned to the window's months like the orders.
    """
    ref = as_of_date(as_of, orders, "order_date")
    o = orders.filter(order_window(orders, days, ref)).select(
        "order_id", "order_date", "status", "is_delivered", "is_canceled", "gmv", "payment_total"
    )
    if profile is None:
        # only payments of the window's orders are aggregated
        profile = order_payment_profile(payments.join(o.select("order_id"), "order_id", "left_semi"))
    else:
        profile = profile.filter(month_bound(profile, days, ref)).select(
            "order_id", "installments", "methods_list", "primary_method")
    return o.join(profile, "order_id", "left").select(
        "order_id", "order_date", "status", "is_delivered", "is_canceled", "gmv", "payment_total",
        "installments", "methods_list",
        F.coalesce(F.lower("primary_method"), F.lit("unknown")).alias("primary_method"),
    )


def _installments(c="installments"):
    return F.greatest(F.coalesce(F.col(c), F.lit(1)), F.lit(1))


def payment_kpis(po: DataFrame) -> DataFrame:
    return po.agg(
        F.count(F.lit(1)).alias("orders"),
        F.avg(F.coalesce(F.col("installments"), F.lit(1))).alias("avg_installments"),
        (F.avg(F.col("is_delivered").cast("int")) * 100).alias("delivered_pct"),
        (F.avg(F.col("is_canceled").cast("int")) * 100).alias("cancel_pct"),
    )


def installments_dist(po: DataFrame) -> DataFrame:
    """Orders per installment count (missing -> 1, clipped at >= 1)."""
    return po.groupBy(_installments().alias("installments")).agg(F.count(F.lit(1)).alias("orders"))


def aov_by_method(po: DataFrame, min_orders: int = MIN_ORDERS) -> DataFrame:
    return (
        po.groupBy("primary_method")
        .agg(F.count("order_id").alias("orders"), (money_sum("gmv") / F.count("gmv")).alias("aov"))
        .filter(F.col("orders") >= min_orders)
        .orderBy(F.desc("aov"), F.asc("primary_method"))
    )


def cancel_by_installments(po: DataFrame) -> DataFrame:
    return po.groupBy(_installments().alias("installments")).agg(
        F.count("order_id").alias("orders"),
        F.avg(F.col("is_canceled").cast("int")).alias("cancel_rate"),
    ).select("*", rounded(F.col("cancel_rate") * 100, 2).alias("cancel_rate_pct"))


def payment_insights(po: DataFrame) -> DataFrame:
    """AOV of orders with >= 6 vs <= 2 installments, and whether the cancel rate
    at the highest installment count is higher than at the lowest.

    Both come from one small per-installment rollup (partial aggregation), so
    the orders are read once.
    """
    raw = F.coalesce(F.col("installments"), F.lit(1))
    per = po.groupBy(_installments().alias("inst")).agg(
        F.count(F.lit(1)).alias("n"),
        money_sum(F.when(raw <= 2, F.col("gmv"))).alias("gmv_low"),
        F.count(F.when(raw <= 2, F.col("gmv"))).alias("n_low"),
        money_sum(F.when(raw >= 6, F.col("gmv"))).alias("gmv_high"),
        F.count(F.when(raw >= 6, F.col("gmv"))).alias("n_high"),
        F.avg(F.col("is_canceled").cast("int")).alias("cancel_rate"),
    )
    out = per.agg(
        safe_div(money_sum("gmv_low"), F.sum("n_low")).alias("aov_low_installments"),
        safe_div(money_sum("gmv_high"), F.sum("n_high")).alias("aov_high_installments"),
        F.min_by("cancel_rate", "inst").alias("cancel_rate_first"),
        F.max_by("cancel_rate", "inst").alias("cancel_rate_last"),
    )
    return out.select(
        "aov_low_installments",
        "aov_high_installments",
        (F.col("aov_high_installments") - F.col("aov_low_installments")).alias("aov_delta"),
        "cancel_rate_first",
        "cancel_rate_last",
        F.when(F.col("cancel_rate_last") > F.col("cancel_rate_first"), "higher")
        .when(F.col("cancel_rate_last").isNotNull() & F.col("cancel_rate_first").isNotNull(), "lower")
        .alias("cancel_trend"),
    )
