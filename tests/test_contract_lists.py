"""The declared checks, written out by hand from their definitions: what each list has to hold, no more and no less."""

import pytest

from emporia.operators import contracts
from emporia.plans.warehouse import Warehouse
from tests.fixtures import one_order

REAL = {
    "nonempty": {"raw_orders", "raw_order_items", "raw_customers", "raw_payments", "raw_reviews", "raw_products", "raw_sellers"},
    "unique": {("raw_orders", "order_id"), ("raw_order_items", "order_id, order_item_id"), ("raw_customers", "customer_id"),
               ("raw_reviews", "review_id"), ("raw_products", "product_id"), ("raw_sellers", "seller_id")},
    "fk": {("raw_orders", "customer_id", "raw_customers"), ("raw_order_items", "order_id", "raw_orders"),
           ("raw_order_items", "product_id", "raw_products"), ("raw_order_items", "seller_id", "raw_sellers"),
           ("raw_payments", "order_id", "raw_orders"), ("raw_reviews", "order_id", "raw_orders")},
}
SYNTH = {
    "nonempty": {"raw_orders", "raw_order_items", "raw_customers", "raw_refunds", "raw_inventory", "raw_marketing_spend"},
    "unique": {("raw_orders", "order_id"), ("raw_order_items", "order_item_id"), ("raw_customers", "customer_id"), ("raw_refunds", "refund_id")},
    "fk": {("raw_order_items", "order_id", "raw_orders"), ("raw_refunds", "order_id", "raw_orders")},
}


@pytest.mark.parametrize("mode, want", [("real", REAL), ("synth", SYNTH)])
def test_tables_keys_and_references(mode, want):
    checks = contracts.contracts(mode)
    assert {c.table_name for c in checks if c.check_name == "nonempty"} == want["nonempty"]
    keys = {(c.table_name, c.detail) for c in checks if c.check_name == "unique"}
    assert keys == want["unique"] == {(c.table_name, c.detail) for c in checks if c.check_name == "not_null"}
    assert {(c.table_name, c.columns[0], c.parent) for c in checks if c.check_name == "fk"} == want["fk"]
    assert all(c.columns[0] == c.parent_columns[0] for c in checks if c.check_name == "fk")


def violating(spark, predicate, columns, rows):
    """Which of ``rows`` (by number) the predicate marks."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {columns}")
    return {r.i for r in df.filter(predicate).collect()}


def test_row_predicates_mark_the_rows_they_should(spark):
    real = {(c.check_name, c.table_name): [] for c in contracts.contracts("real") if c.kind == "rows"}
    for c in contracts.contracts("real"):
        if c.kind == "rows":
            real[c.check_name, c.table_name].append(c.predicate)
    money = "price double, freight_value double"
    assert violating(spark, real["values", "raw_order_items"][0], money, [(1.0, 1.0), (-1.0, 1.0), (1.0, -1.0), (0.0, 0.0), (None, None)]) == {1, 2}
    assert violating(spark, real["values", "raw_payments"][0], "payment_value double", [(0.0,), (-0.5,), (None,)]) == {1}
    times = "order_purchase_timestamp int, order_delivered_customer_date int, order_estimated_delivery_date int"
    rows = [(5, 6, 7), (5, 4, 7), (5, 6, 4), (5, 5, 5), (None, 1, 1), (5, None, None)]
    assert [violating(spark, p, times, rows) for p in real["time_order", "raw_orders"]] == [{1}, {2}]
    essential = "order_purchase_timestamp int, order_status string, customer_id string"
    rows = [(1, "a", "b"), (None, "a", "b"), (1, None, "b"), (1, "a", None), (1, "", "")]
    assert violating(spark, real["essential_nulls", "raw_orders"][0], essential, rows) == {1, 2, 3}
    assert {k: len(v) for k, v in real.items() if k[0] != "not_null"} == {
        ("values", "raw_order_items"): 1, ("values", "raw_payments"): 1, ("essential_nulls", "raw_orders"): 1, ("time_order", "raw_orders"): 2}

    synth = [(c.check_name, c.table_name, c.predicate) for c in contracts.contracts("synth") if c.check_name in ("values", "signup_order")]
    items = [p for n, t, p in synth if t == "raw_order_items"]
    columns = "qty int, unit_price double, discount_amount double, cogs_unit double"
    rows = [(1, 2.0, 1.0, 1.0), (0, 2.0, 1.0, 1.0), (1, -2.0, -3.0, 1.0), (1, 2.0, -1.0, 1.0), (1, 2.0, 1.0, -1.0), (1, 2.0, 3.0, 1.0), (None,) * 4]
    assert [violating(spark, p, columns, rows) for p in items] == [{1, 2, 3, 4}, {5}]
    stock = next(p for n, t, p in synth if t == "raw_inventory")
    assert violating(spark, stock, "on_hand int, lead_time_days int", [(0, 0), (-1, 0), (0, -1), (None, None)]) == {1, 2}
    spend = next(p for n, t, p in synth if t == "raw_marketing_spend")
    assert violating(spark, spend, "amount double", [(0.0,), (-1.0,)]) == {1}
    signup = next(p for n, t, p in synth if n == "signup_order").replace("o.", "").replace("c.", "")
    assert violating(spark, signup, "order_ts int, signup_ts int", [(2, 1), (1, 1), (1, 2), (None, 1), (1, None)]) == {2, 3, 4}
    assert len(synth) == 5


#: Model tests: (model, column) by kind.
NOT_NULL = """dim_customers.customer_id dim_products.product_id fct_order_items.order_item_id fct_order_items.order_id
    fct_orders.order_id fct_orders.customer_id fct_orders.is_delivered fct_orders.is_late fct_deliveries.order_id
    fct_deliveries.is_late fct_freight.order_item_id mrt_kpis_daily.kpi_date mrt_reviews.as_of_date"""
UNIQUE = """dim_customers.customer_id dim_products.product_id fct_order_items.order_item_id fct_orders.order_id
    fct_deliveries.order_id fct_freight.order_item_id mrt_kpis_daily.kpi_date mrt_reviews.as_of_date"""
RELATED = {("fct_order_items.order_id", "fct_orders.order_id"), ("fct_orders.customer_id", "dim_customers.customer_id"),
           ("fct_deliveries.order_id", "fct_orders.order_id")}
#: Expressions: passing and failing values of the columns they read.
EXPRESSIONS = {
    "fct_order_items.qty": ("qty int", [(1,), (None,)], [(0,), (-1,)]),
    "fct_order_items.unit_price": ("unit_price double", [(0.0,)], [(-0.1,)]),
    "fct_order_items.discount_amount": ("discount_amount double", [(0.0,)], [(-0.1,)]),
    "fct_order_items.line_net": ("line_net double, discount_amount double", [(0.0, 1.0), (-1.0, 0.0)], [(-1.0, 1.0)]),
    "fct_orders.gmv": ("gmv double", [(0.0,)], [(-1.0,)]),
    "fct_orders.payment_total": ("payment_total double", [(0.0,)], [(-1.0,)]),
    "fct_deliveries.lead_time_days": ("lead_time_days bigint", [(0,), (None,)], [(-1,)]),
    "fct_freight.freight_pct_line": ("freight_pct_line double", [(0.0,), (9.9,), (None,)], [(-0.1,), (10.0,)]),
    "mrt_kpis_daily.gmv": ("gmv double", [(0.0,)], [(-1.0,)]),
    "mrt_kpis_daily.on_time_pct": ("on_time_pct double", [(0.0,), (1.0,), (None,)], [(-0.1,), (1.1,)]),
}


def test_model_tests_are_all_declared(spark):
    of = {kind: [t for t in contracts.MODEL_TESTS if t.test == kind] for kind in ("not_null", "unique", "relationships", "expression")}
    assert {f"{t.model}.{t.column}" for t in of["not_null"]} == set(NOT_NULL.split())
    assert {f"{t.model}.{t.column}" for t in of["unique"]} == set(UNIQUE.split())
    assert {(f"{t.model}.{t.column}", t.arg) for t in of["relationships"]} == RELATED
    assert {f"{t.model}.{t.column}" for t in of["expression"]} == set(EXPRESSIONS)
    assert [t for t in contracts.MODEL_TESTS if t.severity == "warn"] == [t for t in of["not_null"] if (t.model, t.column) == ("fct_deliveries", "is_late")]
    for t in of["expression"]:
        columns, good, bad = EXPRESSIONS[f"{t.model}.{t.column}"]
        assert violating(spark, f"NOT ({t.arg})", columns, good + bad) == set(range(len(good), len(good) + len(bad)))
    wh = Warehouse(one_order(spark))
    assert all(t.column in getattr(wh, t.model).columns for t in contracts.MODEL_TESTS)
