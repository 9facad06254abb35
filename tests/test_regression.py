import numpy as np
import pytest
from pyspark.sql import functions as F

from emporia.operators import regression


def _points(spark, x, y):
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "distance_km double, freight_pct double")


def test_ols_recovers_line_with_noise(spark):
    rng = np.random.default_rng(42)
    x = rng.uniform(0, 1000, size=500)
    y = 0.5 + 0.002 * x + rng.normal(0, 0.02, size=500)
    pts = _points(spark, x, y)
    m = regression.ols_fit(pts).collect()[0]
    beta, *_ = np.linalg.lstsq(np.c_[np.ones_like(x), x], y, rcond=None)
    resid = y - (beta[0] + beta[1] * x)
    assert m.n == 500
    assert m.intercept == pytest.approx(beta[0], rel=1e-9) and m.slope == pytest.approx(beta[1], rel=1e-9)
    assert m.r2 > 0.9 and m.r2 == pytest.approx(1 - (resid ** 2).sum() / ((y - y.mean()) ** 2).sum(), rel=1e-9)
    assert m.sigma == pytest.approx(np.std(resid, ddof=2), rel=1e-9)
    scored = regression.ols_score(pts, regression.ols_fit(pts)).toPandas()
    assert abs(scored.resid.mean()) < 1e-3
    assert 0.8 < np.std(scored.z_resid, ddof=2) < 1.2
    assert abs(m.intercept - 0.5) < 0.05 and abs(m.slope - 0.002) < 5e-4


def test_ols_needs_three_finite_points(spark):
    pts = _points(spark, [1.0, 2.0, float("nan"), float("inf")], [1.0, 2.0, 3.0, 4.0])
    with pytest.raises(Exception, match="at least 3 finite points"):
        regression.ols_fit(pts).collect()


def test_ols_non_finite_pairs_are_dropped(spark):
    pts = _points(spark, [1, 2, 3, float("nan"), 5], [2, 4, 6, 100, float("inf")])
    m = regression.ols_fit(pts).collect()[0]
    assert m.n == 3 and m.slope == pytest.approx(2.0) and m.intercept == pytest.approx(0.0, abs=1e-12)


def test_ols_constant_x_and_constant_y(spark):
    cx = regression.ols_fit(_points(spark, [3, 3, 3, 3], [1, 2, 3, 4])).collect()[0]
    assert cx.slope is None and cx.r2 is None
    cy = regression.ols_fit(_points(spark, [1, 2, 3, 4], [5, 5, 5, 5])).collect()[0]
    assert cy.r2 == 0.0 and cy.slope == pytest.approx(0.0) and cy.sigma == pytest.approx(0.0)
    scored = regression.ols_score(_points(spark, [1, 2, 3, 4], [5, 5, 5, 5]),
                                  regression.ols_fit(_points(spark, [1, 2, 3, 4], [5, 5, 5, 5])))
    assert scored.filter(F.col("is_outlier")).count() == 0


def test_outliers_ordered_by_abs_z_with_tie_break(spark):
    x = list(range(20))
    y = [0.0] * 20
    y[5], y[15] = 10.0, -10.0
    rows = [(f"l{i:02d}", "o", float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    pts = spark.createDataFrame(rows, "order_item_id string, order_id string, distance_km double, freight_pct double")
    pts = pts.withColumn("seller_id", F.lit("s")).withColumn("product_id", F.lit("p"))
    model = regression.ols_fit(pts)
    out = regression.outlier_lanes(regression.ols_score(pts, model, zcut=1.0)).collect()
    assert [r.order_item_id for r in out] == ["l05", "l15"]
    ins = regression.freight_insights(regression.ols_score(pts, model, zcut=1.0), model).collect()[0]
    assert ins.worst_order_id == "o" and ins.outliers == 2
