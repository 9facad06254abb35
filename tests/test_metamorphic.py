from pyspark.sql import functions as F

from emporia.plans.warehouse import Warehouse
from emporia.sources import sinks
from tests.conftest import SF_SMALL


def test_daily_kpis_add_up(spark):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    k = wh.mrt_kpis_daily.agg(F.sum("orders_delivered").alias("n"), F.sum("gmv").alias("g")).collect()[0]
    d = wh.fct_orders.filter("is_delivered").agg(F.count(F.lit(1)).alias("n"), F.sum("gmv").alias("g")).collect()[0]
    assert k.n == d.n and abs(k.g - d.g) < 1e-6 * max(1.0, abs(d.g))
    s = wh.fct_deliveries.agg(
        F.count(F.when(F.col("is_on_time"), 1)).alias("on"), F.count(F.when(F.col("is_late"), 1)).alias("late"),
        F.count(F.when(F.col("is_on_time").isNull(), 1)).alias("unknown"), F.count(F.lit(1)).alias("all")).collect()[0]
    assert s.on + s.late + s.unknown == s.all == d.n


def test_repartitioning_does_not_change_results(spark):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    base = sinks.fingerprint(wh.mrt_kpis_daily).collect()[0]
    raw = {k: v.repartition(7) for k, v in wh.raw.items()}
    again = sinks.fingerprint(Warehouse(raw).mrt_kpis_daily).collect()[0]
    assert base.rows == again.rows and base.fingerprint == again.fingerprint


def test_fingerprint_sees_values_that_move_and_ignores_order(spark):
    def of(rows):
        return sinks.fingerprint(spark.createDataFrame(rows, "a double, b double, c string")).collect()[0].fingerprint

    base = [(None, 0.5, "x"), (1.25, float("nan"), None), (1e300, -0.5, "")]
    assert of(base) == of(base[::-1])
    assert of(base) != of([(0.5, None, "x")] + base[1:])
    assert of(base) != of(base[:2] + [(1e300, -0.5, None)])
    assert of(base) != of(base + base[:1])
    assert of([]) == "0"
