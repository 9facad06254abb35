from pyspark.sql import functions as F

from emporia.operators import contracts
from emporia.plans.warehouse import Warehouse
from tests.fixtures import one_order


def _report(spark, raw, mode="real"):
    rep = contracts.run_checks(spark, raw, contracts.contracts(mode)).collect()
    return {(r.check_name, r.table_name, r.detail): (r.violations, r.passed) for r in rep}


def test_clean_fixture_passes_all_real_contracts(spark):
    rep = _report(spark, one_order(spark))
    assert all(passed for _, passed in rep.values()), rep


def test_planted_violations(spark):
    raw = one_order(spark)
    items = raw["raw_order_items"]
    raw["raw_order_items"] = items.unionByName(
        spark.createDataFrame([("o1", 1, "pX", "s1", -5.0, 1.0), (None, 3, "p1", "s1", 1.0, 1.0)], items.schema))
    raw["raw_orders"] = raw["raw_orders"].unionByName(raw["raw_orders"].withColumn("order_status", F.lit(None)))
    raw["raw_payments"] = raw["raw_payments"].withColumn("payment_value", F.lit(-1.0))
    raw["raw_sellers"] = raw["raw_sellers"].limit(0)
    rep = _report(spark, raw)
    assert rep[("unique", "raw_order_items", "order_id, order_item_id")] == (1, False)
    assert rep[("unique", "raw_orders", "order_id")] == (1, False)
    assert rep[("not_null", "raw_order_items", "order_id, order_item_id")] == (1, False)
    assert rep[("fk", "raw_order_items", "product_id -> raw_products(product_id)")] == (1, False)
    # NULL child keys count as orphans
    assert rep[("fk", "raw_order_items", "order_id -> raw_orders(order_id)")] == (1, False)
    assert rep[("fk", "raw_order_items", "seller_id -> raw_sellers(seller_id)")] == (4, False)
    assert rep[("values", "raw_order_items", "price < 0 OR freight_value < 0")] == (1, False)
    assert rep[("values", "raw_payments", "payment_value < 0")] == (1, False)
    assert rep[("essential_nulls", "raw_orders",
                "order_purchase_timestamp IS NULL OR order_status IS NULL OR customer_id IS NULL")] == (1, False)
    assert rep[("nonempty", "raw_sellers", "rows > 0")] == (1, False)


def test_missing_table_fails_its_checks(spark):
    raw = one_order(spark)
    del raw["raw_reviews"]
    rep = _report(spark, raw)
    assert rep[("nonempty", "raw_reviews", "rows > 0")] == (None, False)
    assert rep[("fk", "raw_reviews", "order_id -> raw_orders(order_id)")] == (None, False)


def test_model_tests_warn_and_fail(spark):
    raw = one_order(spark)
    raw["raw_orders"] = raw["raw_orders"].withColumn("order_estimated_delivery_date", F.lit(None).cast("timestamp_ntz"))
    items = raw["raw_order_items"]
    raw["raw_order_items"] = items.unionByName(
        spark.createDataFrame([("o1", 3, "p1", "s1", -2.0, 1.0)], items.schema))
    wh = Warehouse(raw)
    models = {n: getattr(wh, n) for n in contracts.MODEL_KEYS}
    res = {(r.model, r.column_name, r.test): (r.failures, r.status)
           for r in contracts.run_model_tests(models).collect()}
    assert res[("fct_deliveries", "is_late", "not_null")] == (1, "warn")
    assert res[("fct_order_items", "unit_price", "expression")] == (1, "fail")
    assert res[("fct_orders", "order_id", "unique")] == (0, "pass")
    stored = contracts.store_failures(models)
    failing = stored.filter(F.col("test") == "expression").collect()
    assert {r.row_key for r in failing} == {"o1-003"}
    counted = {(r.model, r.column_name, r.test): (r.failures, r.status)
               for r in contracts.results_of(stored).collect() if r.test != "expression"}
    assert counted == {k: v for k, v in res.items() if k[2] != "expression"}
    bad = contracts.results_of(stored).filter("test = 'expression' AND failures > 0").collect()
    assert {(r.model, r.column_name, r.failures, r.status) for r in bad} == {
        (t.model, t.column, 1, "fail") for t in contracts.MODEL_TESTS
        if t.test == "expression" and (t.model, t.column) in {(r.model, r.column_name) for r in failing}}


def test_mart_sanity_reports_missing_columns_and_wrong_types(spark):
    wh = Warehouse(one_order(spark))
    kpis = wh.mrt_kpis_daily.drop("aov").withColumn("gmv", F.col("gmv").cast("string"))
    got = {r.check_name: (r.value, r.passed) for r in contracts.mart_sanity(
        wh.fct_orders, wh.fct_order_items, wh.dim_customers, kpis, wh.fct_freight, wh.mrt_reviews).collect()}
    assert got["kpi_missing_columns"] == (1.0, False)
    assert got["kpi_wrong_types"] == (1.0, False)
    assert got["fct_orders_rows"] == (1.0, True)
