"""Freight share ~ distance: points, least-squares fit, residual scoring.

The fit is a simple regression ``y = intercept + slope * x`` computed with
Spark's built-in regression aggregates (``regr_*``): partial aggregates per
task, one merge, one row out. No point is ever collected. The residual
spread ``sigma`` needs the fitted line, so it is a second aggregate over the
points with the model entering as a scalar subquery (a one-row value every
task reads; no join). ``sigma`` is computed from the residuals themselves
rather than from the moments formula, which cancels badly.

Model conventions (match the helper the analysis was written against):
* only finite (x, y) pairs count; fewer than 3 is an error;
* ``r2`` is 0 when y is constant; slope/intercept/r2 are NULL when x is constant;
* ``sigma`` = standard deviation of residuals with 2 degrees of freedom removed;
* ``z_resid`` = resid / sigma (resid / 1 when sigma is 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import is_finite

# Page defaults. Fixed values.
Z_CUT = 2.5
TOP_N = 50

MODEL_FIELDS = ("n", "intercept", "slope", "r2", "sigma")


def _within(c, most: float | None):
    return c >= 0 if most is None else c.between(0, most)


def freight_points_line(freight: DataFrame, max_km: float | None = None, max_pct: float | None = None) -> DataFrame:
    """Line-level points (distance_km, freight_pct): all that exist, or those inside the bounds a caller sets."""
    d, p = F.col("distance_km"), F.col("freight_pct_line")
    return freight.filter(_within(d, max_km) & _within(p, max_pct) & (F.col("line_gross") > 0)).select(
        "order_item_id", "order_id", "order_date", "seller_id", "product_id", "distance_km",
        p.alias("freight_pct"), "line_gross",
    )


def freight_points_order(freight: DataFrame, max_km: float | None = None, max_pct: float | None = None) -> DataFrame:
    """Order-level points: median lane distance and order freight share.

    Same columns as the line level; line-only columns are typed NULLs.
    """
    d, p = F.col("distance_km"), F.col("order_freight_pct")
    per_order = (
        freight.filter(_within(d, max_km) & _within(p, max_pct))
        .groupBy("order_id")
        .agg(F.median("distance_km").alias("distance_km"), F.max("order_freight_pct").alias("freight_pct"))
    )
    return per_order.select(
        F.lit(None).cast("string").alias("order_item_id"),
        "order_id",
        F.lit(None).cast("date").alias("order_date"),
        F.lit(None).cast("string").alias("seller_id"),
        F.lit(None).cast("string").alias("product_id"),
        "distance_km",
        "freight_pct",
        F.lit(None).cast("double").alias("line_gross"),
    )


def _finite(points: DataFrame, x: str, y: str) -> DataFrame:
    return points.filter(is_finite(F.col(x)) & is_finite(F.col(y)))


def ols_fit(points: DataFrame, x: str = "distance_km", y: str = "freight_pct") -> DataFrame:
    """One row ``(n, intercept, slope, r2, sigma)``; raises if fewer than 3 finite points."""
    pts = _finite(points, x, y)
    xc, yc = F.col(x), F.col(y)
    n = F.count(F.lit(1))
    first = pts.agg(
        F.when(n >= 3, n).otherwise(F.raise_error(F.lit("ols_fit: need at least 3 finite points"))).alias("n"),
        F.regr_intercept(yc, xc).alias("intercept"),
        F.regr_slope(yc, xc).alias("slope"),
        F.when(F.var_pop(yc) == 0, F.lit(0.0)).otherwise(F.regr_r2(yc, xc)).alias("r2"),
    )
    line = first.select(F.struct("n", "intercept", "slope").alias("m")).scalar()
    resid = yc - (line["intercept"] + line["slope"] * xc)
    spread = pts.agg(F.var_pop(resid).alias("v"), F.count(F.lit(1)).alias("k")).select(
        F.sqrt(F.col("v") * F.col("k") / (F.col("k") - 2)).alias("sigma")
    ).scalar()
    return first.select("n", "intercept", "slope", "r2", spread.alias("sigma"))


def ols_score(points: DataFrame, model: DataFrame, x: str = "distance_km", y: str = "freight_pct",
              zcut: float = Z_CUT) -> DataFrame:
    """Points with ``y_hat``, ``resid``, ``z_resid`` and ``is_outlier`` (|z| > zcut).

    ``model`` is the one-row output of ``ols_fit``; it is read as a scalar
    subquery, so the points are not shuffled.
    """
    m = model.select(F.struct(*MODEL_FIELDS)).scalar()
    pts = _finite(points, x, y)
    y_hat = m["intercept"] + m["slope"] * F.col(x)
    resid = F.col(y) - F.col("y_hat")
    scale = F.when(m["sigma"] > 0, m["sigma"]).otherwise(F.lit(1.0))
    return (
        pts.withColumn("y_hat", y_hat)
        .withColumn("resid", resid)
        .withColumn("z_resid", F.col("resid") / scale)
        .withColumn("is_outlier", F.abs(F.col("z_resid")) > F.lit(float(zcut)))
    )


def ols_summary(scored: DataFrame, model: DataFrame) -> DataFrame:
    """Rows analysed, r2, slope in percentage points per km, outliers flagged."""
    m = model.select(F.struct(*MODEL_FIELDS)).scalar()
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("is_outlier"), 1)).alias("outliers"),
    ).select("rows", m["r2"].alias("r2"), (m["slope"] * 100).alias("slope_pp_per_km"), "outliers")


def ols_trend_line(points: DataFrame, model: DataFrame, x: str = "distance_km", y: str = "freight_pct") -> DataFrame:
    """Fitted line at the smallest and largest x."""
    m = model.select(F.struct(*MODEL_FIELDS)).scalar()
    ext = _finite(points, x, y).agg(F.min(x).alias("x_min"), F.max(x).alias("x_max"))
    return ext.select(
        "x_min",
        (m["intercept"] + m["slope"] * F.col("x_min")).alias("y_at_min"),
        "x_max",
        (m["intercept"] + m["slope"] * F.col("x_max")).alias("y_at_max"),
    )


OUTLIER_COLUMNS = ("order_id", "order_item_id", "seller_id", "product_id", "distance_km", "freight_pct",
                   "y_hat", "resid", "z_resid")


def outlier_lanes(scored: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """The ``top_n`` outliers by |z| (ties: line id, then order id)."""
    return (
        scored.filter(F.col("is_outlier"))
        .orderBy(F.desc(F.abs(F.col("z_resid"))), F.asc_nulls_last("order_item_id"), F.asc("order_id"))
        .limit(top_n)
        .select(*OUTLIER_COLUMNS)
    )


def freight_insights(scored: DataFrame, model: DataFrame) -> DataFrame:
    """One row: fit quality, slope direction, outlier count and the worst
    outlier (first row of ``outlier_lanes``)."""
    m = model.select(F.struct(*MODEL_FIELDS)).scalar()
    w = outlier_lanes(scored, 1).select(F.struct("order_id", "seller_id", "product_id", "z_resid")).scalar()
    return scored.agg(F.count(F.when(F.col("is_outlier"), 1)).alias("outliers")).select(
        m["r2"].alias("r2"),
        (m["slope"] * 100).alias("slope_pp_per_km"),
        (m["slope"] > 0).alias("freight_rises_with_distance"),
        "outliers",
        w["order_id"].alias("worst_order_id"),
        w["z_resid"].alias("worst_z_resid"),
        w["seller_id"].alias("worst_seller_id"),
        w["product_id"].alias("worst_product_id"),
    )

