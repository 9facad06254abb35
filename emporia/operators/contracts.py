"""Data contracts on the raw tables and tests on the models.

Checks are declared as data (``Check`` / ``ModelTest``) and evaluated into
one report DataFrame ``(check_name, table_name, detail, violations, passed)``.

Plan shape: all row predicates of one table (NULL keys, value ranges, time
order) are folded into a single aggregate, i.e. one scan per table however
many predicates it has. Uniqueness is a grouped count (map-side combined, a
hot key is one partial row per task); referential checks are anti joins.
Nothing is collected: the report is a union of one-row aggregates.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from emporia.operators.sequence import written
from emporia.sources.sinks import canonical_text


@dataclass(frozen=True)
class Check:
    check_name: str      # nonempty | unique | not_null | fk | values | essential_nulls | time_order | signup_order
    table_name: str
    detail: str          # key columns, predicate or "col -> parent(col)"
    kind: str            # nonempty | unique | rows | fk | join_rows
    columns: tuple = ()
    predicate: str = ""  # SQL predicate marking a violating row
    parent: str = ""
    parent_columns: tuple = ()


def _keys(cols: str) -> tuple:
    return tuple(c.strip() for c in cols.split(","))


def nonempty(table: str) -> Check:
    return Check("nonempty", table, "rows > 0", "nonempty")


def unique(table: str, cols: str) -> Check:
    return Check("unique", table, cols, "unique", _keys(cols))


def not_null(table: str, cols: str) -> Check:
    pred = " OR ".join(f"{c} IS NULL" for c in _keys(cols))
    return Check("not_null", table, cols, "rows", _keys(cols), pred)


def fk(child: str, col: str, parent: str, pcol: str) -> Check:
    return Check("fk", child, f"{col} -> {parent}({pcol})", "fk", (col,), parent=parent, parent_columns=(pcol,))


def rows(check_name: str, table: str, predicate: str) -> Check:
    return Check(check_name, table, predicate, "rows", predicate=predicate)


# Contract sets. Fixed values (tables, keys, predicates of the checks).
REAL_TABLES = ("raw_orders", "raw_order_items", "raw_customers", "raw_payments", "raw_reviews", "raw_products",
               "raw_sellers")
REAL_KEYS = (("raw_orders", "order_id"), ("raw_order_items", "order_id, order_item_id"),
             ("raw_customers", "customer_id"), ("raw_reviews", "review_id"), ("raw_products", "product_id"),
             ("raw_sellers", "seller_id"))
REAL_FKS = (("raw_orders", "customer_id", "raw_customers", "customer_id"),
            ("raw_order_items", "order_id", "raw_orders", "order_id"),
            ("raw_order_items", "product_id", "raw_products", "product_id"),
            ("raw_order_items", "seller_id", "raw_sellers", "seller_id"),
            ("raw_payments", "order_id", "raw_orders", "order_id"),
            ("raw_reviews", "order_id", "raw_orders", "order_id"))
REAL_ROWS = (
    ("values", "raw_order_items", "price < 0 OR freight_value < 0"),
    ("values", "raw_payments", "payment_value < 0"),
    ("essential_nulls", "raw_orders",
     "order_purchase_timestamp IS NULL OR order_status IS NULL OR customer_id IS NULL"),
    ("time_order", "raw_orders",
     "order_delivered_customer_date IS NOT NULL AND order_purchase_timestamp IS NOT NULL "
     "AND order_delivered_customer_date < order_purchase_timestamp"),
    ("time_order", "raw_orders",
     "order_estimated_delivery_date IS NOT NULL AND order_purchase_timestamp IS NOT NULL "
     "AND order_estimated_delivery_date < order_purchase_timestamp"),
)

SYNTH_TABLES = ("raw_orders", "raw_order_items", "raw_customers", "raw_refunds", "raw_inventory",
                "raw_marketing_spend")
SYNTH_KEYS = (("raw_orders", "order_id"), ("raw_order_items", "order_item_id"), ("raw_customers", "customer_id"),
              ("raw_refunds", "refund_id"))
SYNTH_FKS = (("raw_order_items", "order_id", "raw_orders", "order_id"),
             ("raw_refunds", "order_id", "raw_orders", "order_id"))
SYNTH_ROWS = (
    ("values", "raw_order_items", "qty < 1 OR unit_price < 0 OR discount_amount < 0 OR cogs_unit < 0"),
    ("values", "raw_order_items", "unit_price < discount_amount"),
    ("values", "raw_inventory", "on_hand < 0 OR lead_time_days < 0"),
    ("values", "raw_marketing_spend", "amount < 0"),
)
# Orders joined to their customer: a NULL order or signup time, or an order
# placed before signup, violates.
SYNTH_SIGNUP = "o.order_ts IS NULL OR c.signup_ts IS NULL OR o.order_ts < c.signup_ts"


def contracts(mode: str = "real") -> list[Check]:
    if mode == "real":
        tables, keys, fks, preds = REAL_TABLES, REAL_KEYS, REAL_FKS, REAL_ROWS
    elif mode == "synth":
        tables, keys, fks, preds = SYNTH_TABLES, SYNTH_KEYS, SYNTH_FKS, SYNTH_ROWS
    else:
        raise ValueError(f"unknown mode {mode!r}")
    out = [nonempty(t) for t in tables]
    for t, cols in keys:
        out += [unique(t, cols), not_null(t, cols)]
    out += [fk(*f) for f in fks]
    out += [rows(name, t, p) for name, t, p in preds]
    if mode == "synth":
        out.append(Check("signup_order", "raw_orders", SYNTH_SIGNUP, "join_rows", predicate=SYNTH_SIGNUP,
                         parent="raw_customers"))
    return out


REPORT_SCHEMA = "check_name string, table_name string, detail string, violations bigint, passed boolean"
# nonempty: violations is 1 for an empty table, 0 otherwise.


def _row(c: Check, violations) -> list:
    return [F.lit(c.check_name).alias("check_name"), F.lit(c.table_name).alias("table_name"),
            F.lit(c.detail).alias("detail"), violations.cast("long").alias("violations")]


def _evaluate(c: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    df = tables[c.table_name]
    if c.kind == "unique":
        dup = df.groupBy(*c.columns).count().filter(F.col("count") > 1)
        return dup.agg(*_row(c, F.count(F.lit(1))))
    if c.kind == "fk":
        parent = tables[c.parent].select(F.col(c.parent_columns[0]).alias("_pk"))
        orphans = df.join(parent, df[c.columns[0]] == parent["_pk"], "left_anti")
        return orphans.agg(*_row(c, F.count(F.lit(1))))
    if c.kind == "join_rows":
        o = df.alias("o")
        cust = tables[c.parent].alias("c")
        j = o.join(cust, F.col("o.customer_id") == F.col("c.customer_id"), "left")
        return j.agg(*_row(c, F.count(F.when(F.expr(c.predicate), 1))))
    raise ValueError(c.kind)


def run_checks(spark: SparkSession, tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Evaluate ``checks`` into the report. A missing table fails its checks
    (reported with NULL violations) instead of aborting the run."""
    checks = list(checks)
    parts: list[DataFrame] = []
    missing = [c for c in checks if c.table_name not in tables or (c.parent and c.parent not in tables)]
    present = [c for c in checks if c not in missing]
    # Emptiness and row predicates: one aggregate (one scan) per table.
    by_table: dict[str, list[Check]] = {}
    for c in present:
        if c.kind in ("rows", "nonempty"):
            by_table.setdefault(c.table_name, []).append(c)
        else:
            parts.append(_evaluate(c, tables))

    def violation(c: Check):
        if c.kind == "nonempty":
            return F.when(F.count(F.lit(1)) > 0, 0).otherwise(1)
        return F.count(F.when(F.expr(c.predicate), 1))

    for table, cs in by_table.items():
        counts = tables[table].agg(*[violation(c).alias(f"c{i}") for i, c in enumerate(cs)])
        structs = [F.struct(*_row(c, F.col(f"c{i}"))) for i, c in enumerate(cs)]
        parts.append(counts.select(F.inline(F.array(*structs))))
    if missing:
        parts.append(spark.createDataFrame(
            [(c.check_name, c.table_name, c.detail, None) for c in missing],
            "check_name string, table_name string, detail string, violations bigint",
        ))
    report = reduce(DataFrame.unionByName, parts)
    return report.select(
        "check_name", "table_name", "detail", "violations",
        F.coalesce(F.col("violations") == 0, F.lit(False)).alias("passed"),
    )


def failures(report: DataFrame) -> DataFrame:
    """Failed checks only (what makes the contract step exit with status 2)."""
    return report.filter(~F.col("passed"))


# ---------------------------------------------------------------- model tests
@dataclass(frozen=True)
class ModelTest:
    model: str
    column: str
    test: str            # not_null | unique | relationships | expression
    arg: str = ""        # parent "model.column" or SQL expression
    severity: str = "error"


# Tests declared on the models. Fixed values.
MODEL_TESTS = (
    ModelTest("dim_customers", "customer_id", "not_null"),
    ModelTest("dim_customers", "customer_id", "unique"),
    ModelTest("dim_products", "product_id", "not_null"),
    ModelTest("dim_products", "product_id", "unique"),
    ModelTest("fct_order_items", "order_item_id", "not_null"),
    ModelTest("fct_order_items", "order_item_id", "unique"),
    ModelTest("fct_order_items", "order_id", "not_null"),
    ModelTest("fct_order_items", "order_id", "relationships", "fct_orders.order_id"),
    ModelTest("fct_order_items", "qty", "expression", "qty >= 1"),
    ModelTest("fct_order_items", "unit_price", "expression", "unit_price >= 0"),
    ModelTest("fct_order_items", "discount_amount", "expression", "discount_amount >= 0"),
    ModelTest("fct_order_items", "line_net", "expression", "line_net >= 0 OR discount_amount = 0"),
    ModelTest("fct_orders", "order_id", "not_null"),
    ModelTest("fct_orders", "order_id", "unique"),
    ModelTest("fct_orders", "customer_id", "not_null"),
    ModelTest("fct_orders", "customer_id", "relationships", "dim_customers.customer_id"),
    ModelTest("fct_orders", "gmv", "expression", "gmv >= 0"),
    ModelTest("fct_orders", "payment_total", "expression", "payment_total >= 0"),
    ModelTest("fct_orders", "is_delivered", "not_null"),
    ModelTest("fct_orders", "is_late", "not_null"),
    ModelTest("fct_deliveries", "order_id", "not_null"),
    ModelTest("fct_deliveries", "order_id", "unique"),
    ModelTest("fct_deliveries", "order_id", "relationships", "fct_orders.order_id"),
    ModelTest("fct_deliveries", "lead_time_days", "expression", "lead_time_days >= 0"),
    # NULL by design when the ETA is unknown: reported, but only as a warning
    ModelTest("fct_deliveries", "is_late", "not_null", severity="warn"),
    ModelTest("fct_freight", "order_item_id", "not_null"),
    ModelTest("fct_freight", "order_item_id", "unique"),
    ModelTest("fct_freight", "freight_pct_line", "expression",
              "freight_pct_line IS NULL OR (freight_pct_line >= 0 AND freight_pct_line < 10)"),
    ModelTest("mrt_kpis_daily", "kpi_date", "not_null"),
    ModelTest("mrt_kpis_daily", "kpi_date", "unique"),
    ModelTest("mrt_kpis_daily", "gmv", "expression", "gmv >= 0"),
    ModelTest("mrt_kpis_daily", "on_time_pct", "expression", "on_time_pct BETWEEN 0 AND 1"),
    ModelTest("mrt_reviews", "as_of_date", "not_null"),
    ModelTest("mrt_reviews", "as_of_date", "unique"),
)


# Row identifier of each model, used to point at failing rows. Fixed values.
MODEL_KEYS = {
    "dim_customers": "customer_id", "dim_products": "product_id", "fct_order_items": "order_item_id",
    "fct_orders": "order_id", "fct_deliveries": "order_id", "fct_freight": "order_item_id",
    "mrt_kpis_daily": "kpi_date", "mrt_reviews": "as_of_date",
}


def _whole(columns) -> Column:
    """The named columns of a row as one VARIANT, whatever the model."""
    return F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("failed_row")


def failing_rows(t: ModelTest, models: Mapping[str, DataFrame]) -> DataFrame:
    """``(row_key, failed_row)`` of the rows failing one test.

    ``unique`` gives one row per duplicated value, with the value and its
    number of rows (``n_records``), so a value that all rows share is one row too.
    """
    df = models[t.model]
    c = F.col(t.column)
    key = F.col(MODEL_KEYS[t.model]).cast("string").alias("row_key")
    if t.test == "not_null":
        return df.filter(c.isNull()).select(key, _whole(df.columns))
    if t.test == "unique":
        twice = _candidates(df, t.column).groupBy(t.column).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")
        return twice.select(c.cast("string").alias("row_key"), _whole([t.column, "n_records"]))
    if t.test == "relationships":
        # whole rows do not travel to the parent: its unknown keys, stored, are brought to the rows
        unknown = written(_unknown_keys(t, models).select("_fk"), "unknown-keys")
        return df.join(unknown, c == unknown["_fk"], "left_semi").select(key, _whole(df.columns))
    if t.test == "expression":
        return df.filter(~F.expr(t.arg)).select(key, _whole(df.columns))
    raise ValueError(t.test)


def _candidates(df: DataFrame, column: str) -> DataFrame:
    """The values of a column that may stand in it twice, NULL left out.

    Of texts, those whose hash does: nearly all keys are distinct, so a count of
    the texts themselves would hold and send every one, where eight bytes do.
    """
    known = df.select(column).filter(F.col(f"`{column}`").isNotNull())
    if dict(known.dtypes)[column] != "string":
        return known
    digest = F.xxhash64(f"`{column}`")
    again = known.groupBy(digest.alias("_hash")).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select("_hash")
    again = written(again, "twice")  # small where keys are keys: then the texts are not dealt by it
    return known.join(again, digest == again["_hash"], "left_semi")


def _unknown_keys(t: ModelTest, models: Mapping[str, DataFrame]) -> DataFrame:
    """``(_fk, _rows)``: the values of a relationship's column that its parent does not have, and their numbers of rows."""
    pm, pc = t.arg.split(".")
    keys = models[t.model].groupBy(F.col(t.column).alias("_fk")).agg(F.count(F.lit(1)).alias("_rows")).filter("_fk IS NOT NULL")
    parent = models[pm].select(F.col(pc).alias("_pk"))
    return keys.join(parent, keys["_fk"] == parent["_pk"], "left_anti")


def _test_cols(t: ModelTest):
    return [F.lit(t.model).alias("model"), F.lit(t.column).alias("column_name"), F.lit(t.test).alias("test"),
            F.lit(t.arg).alias("arg"), F.lit(t.severity).alias("severity")]


def _row_condition(t: ModelTest):
    """Failing-row predicate of a row-level test (not_null / expression);
    a NULL expression result passes, as a filter would treat it."""
    if t.test == "not_null":
        return F.col(t.column).isNull()
    return F.coalesce(~F.expr(t.arg), F.lit(False))


def run_model_tests(models: Mapping[str, DataFrame], tests: Iterable[ModelTest] = MODEL_TESTS) -> DataFrame:
    """``(model, column_name, test, arg, severity, failures, status)`` per test;
    status is pass / fail / warn. Row-level tests of one model share one
    aggregate (one scan); unique and relationship tests are grouped counts
    and anti joins."""
    tests = list(tests)
    parts = []
    by_model: dict[str, list[ModelTest]] = {}
    for t in tests:
        if t.test in ("not_null", "expression"):
            by_model.setdefault(t.model, []).append(t)
        elif t.test == "relationships":
            rows = F.coalesce(F.sum("_rows"), F.lit(0)).alias("failures")
            parts.append(_unknown_keys(t, models).agg(*_test_cols(t), rows))
        else:
            parts.append(failing_rows(t, models).agg(*_test_cols(t), F.count(F.lit(1)).alias("failures")))
    for model, ts in by_model.items():
        counts = models[model].agg(*[F.count(F.when(_row_condition(t), 1)).alias(f"f{i}") for i, t in enumerate(ts)])
        structs = [F.struct(*_test_cols(t), F.col(f"f{i}").alias("failures")) for i, t in enumerate(ts)]
        parts.append(counts.select(F.inline(F.array(*structs))))
    return reduce(DataFrame.unionByName, parts).select("*", _status())


def _status():
    return (F.when(F.col("failures") == 0, "pass")
            .when(F.col("severity") == "warn", "warn").otherwise("fail").alias("status"))


FAILURE_SCHEMA = ("column_name string, test string, arg string, severity string, row_key string, failed_row variant, "
                  "model string")


def store_failures(models: Mapping[str, DataFrame], tests: Iterable[ModelTest] = MODEL_TESTS) -> DataFrame:
    """All failing rows of all tests, whole, tagged with their test (the quarantine table).

    ``failed_row`` is the row itself as a VARIANT: rows of all models fit into
    one table, and each field can be read back with its type
    (``variant_get(failed_row, '$.gmv', 'double')``).

    The row-level tests of one model are one pass over it: each row gives the
    array of the tests it fails. Unique and relationship tests have plans of
    their own; unknown keys of relationships, and hashes that come twice, are looked
    up right away, not when the result is read.
    """
    parts = []
    by_model: dict[str, list[ModelTest]] = {}
    for t in tests:
        if t.test in ("not_null", "expression"):
            by_model.setdefault(t.model, []).append(t)
        else:
            parts.append(failing_rows(t, models).select(*_test_cols(t), "row_key", "failed_row"))
    for model, ts in by_model.items():
        failed = F.filter(F.array(*[F.when(_row_condition(t), F.struct(*_test_cols(t))) for t in ts]),
                          lambda x: x.isNotNull())
        key = F.col(MODEL_KEYS[model]).cast("string").alias("row_key")
        df = models[model]
        failing = df.withColumn("_failed", failed).filter(F.size("_failed") > 0)
        parts.append(failing.select(key, _whole(df.columns), F.inline("_failed")))
    return reduce(DataFrame.unionByName, parts)


def failed_fields(failures: DataFrame) -> DataFrame:
    """The quarantine table's rows field by field: ``field`` and ``value`` as text (doubles in whole millionths)."""
    spark = failures.sparkSession
    fields = spark.tvf.variant_explode(F.col("failed_row").outer())
    kind = F.schema_of_variant("value")
    text = F.when(kind == "DOUBLE", canonical_text(F.try_variant_get("value", "$", "double"), DoubleType())).otherwise(
        F.try_variant_get("value", "$", "string"))
    return failures.lateralJoin(fields).select(
        "model", "column_name", "test", "arg", "severity", "row_key", F.col("key").alias("field"), text.alias("value"))


def results_of(failures: DataFrame, tests: Iterable[ModelTest] = MODEL_TESTS) -> DataFrame:
    """The report of ``run_model_tests``, counted from stored failing rows."""
    names = ["model", "column_name", "test", "arg", "severity"]
    declared = failures.sparkSession.createDataFrame(
        [(t.model, t.column, t.test, t.arg, t.severity) for t in tests], ", ".join(f"{n} string" for n in names))
    counts = failures.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    out = declared.join(counts, names, "left").select(*names, F.coalesce("n", F.lit(0)).alias("failures"))
    return out.select("*", _status())


# ---------------------------------------------------------------- mart sanity
# Required columns of the daily KPI mart and their types. Fixed values.
KPI_REQUIRED = {"kpi_date": "date", "orders_delivered": "bigint", "gmv": "double", "aov": "double",
                "on_time_pct": "double", "freight_pct_gmv": "double"}
KPI_INVALID = {"gmv": "gmv < 0", "aov": "aov < 0", "on_time_pct": "on_time_pct < 0 OR on_time_pct > 1",
               "freight_pct_gmv": "freight_pct_gmv < 0"}


def mart_sanity(fct_orders: DataFrame, fct_order_items: DataFrame, dim_customers: DataFrame,
                kpis: DataFrame, freight: DataFrame, reviews: DataFrame) -> DataFrame:
    """End-to-end smoke checks as rows ``(check_name, value, passed)``; one aggregate per table."""
    types = dict(kpis.dtypes)
    missing = [c for c in KPI_REQUIRED if c not in types]
    wrong = [c for c, kind in KPI_REQUIRED.items() if c in types and types[c] != kind]
    rows = F.count(F.lit(1))
    invalid = [F.expr(p) for c, p in KPI_INVALID.items() if types.get(c) == KPI_REQUIRED[c]]
    usable = F.col("distance_km").isNotNull() & (F.col("freight_pct_line").isNotNull()
                                                 | F.col("order_freight_pct").isNotNull())
    on_line = F.col("distance_km").isNotNull() & F.col("freight_pct_line").isNotNull()

    def measured(df, *checks):
        """Rows of ``(name, value, condition on the value)``, all from one aggregate over ``df``."""
        values = df.agg(*[v.cast("double").alias(n) for n, v, _ in checks])
        return values.select(F.inline(F.array(*[
            F.struct(F.lit(n).alias("check_name"), F.col(n).alias("value"), ok(F.col(n)).alias("passed"))
            for n, _, ok in checks])))

    parts = [
        measured(fct_orders, ("fct_orders_rows", rows, lambda v: v >= 1)),
        measured(fct_order_items, ("fct_order_items_rows", rows, lambda v: v >= 1)),
        measured(dim_customers, ("dim_customers_rows", rows, lambda v: v >= 1)),
        measured(kpis,
                 ("kpi_rows", rows, lambda v: v >= 1),
                 ("kpi_missing_columns", F.lit(len(missing)), lambda v: v == 0),
                 ("kpi_wrong_types", F.lit(len(wrong)), lambda v: v == 0),
                 ("kpi_invalid_rows", F.count(F.when(reduce(Column.__or__, invalid, F.lit(False)), 1)),
                  lambda v: v == 0)),
        measured(freight,
                 ("freight_usable_rows", F.count(F.when(usable, 1)), lambda v: v >= 10),
                 ("freight_distance_var_pop", F.var_pop(F.when(on_line, F.col("distance_km"))),
                  lambda v: F.coalesce(v, F.lit(0.0)) > 0)),
        measured(reviews, ("reviews_penalty_rows", F.count("delay_penalty"), lambda v: v >= 1)),
    ]
    return reduce(DataFrame.unionByName, parts)
