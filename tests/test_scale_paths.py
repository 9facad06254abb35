"""Distributed ranks and numbers, whole failing rows, month refresh, observed ingest, catalog descriptions."""

import io
import os
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from emporia.operators import category, contracts, kpis, payments
from emporia.operators.sequence import dense_ranks, positions, sequence_within
from emporia.plans.build import describe, materialize, new_build_dir, publish, store_test_failures
from emporia.plans.refresh import changed_orders, refresh
from emporia.plans.warehouse import Warehouse
from emporia.sources import csv as csv_source
from emporia.sources.sinks import fingerprint
from tests.conftest import SF_SMALL
from tests.fixtures import one_order


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


# ------------------------------------------------------------------ ranks and row numbers
def test_dense_ranks_of_a_million_rows_with_ties(spark):
    v = F.col("id")
    df = spark.range(1_000_000).select(
        "id",
        F.when(v % 7 != 0, (v * 7919 % 1000).cast("double")).alias("few"),          # 1,000 values, many NULLs
        (v * 104_729 % 999_983 / 8).alias("many"),                                   # ties of two
        F.when(v % 3 == 0, F.lit(0.0)).when(v % 3 == 1, F.lit(-0.0)).alias("zeros"),  # one value, in two spellings
    )
    metrics = {"few": "rank_few", "many": "rank_many", "zeros": "rank_zeros"}
    got = dense_ranks(df, metrics)
    want = df
    for c, name in metrics.items():
        w = Window.orderBy(F.desc_nulls_last(c))
        want = want.withColumn(name, F.when(F.col(c).isNotNull(), F.dense_rank().over(w)))
    both = got.select("id", *metrics.values()).exceptAll(want.select("id", *metrics.values()))
    assert got.count() == 1_000_000 and both.count() == 0


def test_category_ranks_have_no_window_over_rows(spark):
    df = spark.range(50).select(
        F.concat(F.lit("c"), "id").alias("category"), (F.col("id") % 5).cast("double").alias("gmv"),
        F.lit(1.0).alias("velocity_units_per_day"), F.lit(None).cast("double").alias("margin_pct_of_gmv"))
    ranked = category.category_ranks(df)
    assert "Window" not in plan(ranked) and "SinglePartition" not in plan(ranked)
    over = re.findall(r"\) Window.*?\n\n", plan(positions(df, [F.desc("gmv")])), re.S)
    assert len(over) == 1 and "_part" in over[0] and "gmv" not in over[0]  # over ranges, not rows
    assert {(r.gmv, r.rank_gmv, r.rank_velocity, r.rank_margin_pct) for r in ranked.collect()} == {
        (float(4 - i), i + 1, 1, None) for i in range(5)}


def test_positions_and_numbers_stay_in_the_jvm(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 < 4, F.lit("hot")).when(F.col("id") % 10 == 9, F.lit(None))
                                  .otherwise((F.col("id") % 97).cast("string")).alias("key"))
    at = positions(df, [F.desc("id")], "at", num_partitions=7)
    assert at.filter("at <> 4999 - id").count() == 0 and at.count() == 5000
    got = sequence_within(df, "key", [F.desc("id")], num_partitions=7)
    want = df.withColumn("seq", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("id"))))
    assert got.exceptAll(want).count() == 0 and got.count() == 5000
    assert not re.search("Python|Pandas|Arrow", plan(got))
    empty = df.filter("false")
    assert sequence_within(empty, "key", [F.desc("id")]).count() == 0
    assert dense_ranks(empty.withColumn("m", F.lit(1.0)), {"m": "r"}).count() == 0


# ------------------------------------------------------------------ look-backs
def test_payments_outside_the_window_are_left_out_below_the_aggregate(spark):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    po = payments.payment_orders(wh.fct_orders, wh.payments_base)
    tree = plan(po).split("\n\n")[0]
    semi = re.search(r"LeftSemi|Semi", plan(po))
    assert semi and re.search(r"Aggregate(?s:.*)Join LeftSemi", tree)


def test_default_as_of_reads_one_month(spark):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    materialize(wh, new_build_dir(wh, "asof"))
    from emporia.functions import as_of_date

    newest = wh.fct_orders.agg(F.max("order_date")).first()[0]
    df = spark.range(1).select(as_of_date(None, wh.fct_orders, "order_date").alias("d"))
    text = plan(df)
    assert df.first()[0] == newest
    scans = re.findall(r"\) Scan parquet.*?\n\n", text, re.S)
    # one scan reads partition values only, the other the dates of the month they name
    assert len(scans) == 2 and sum("ReadSchema: struct<>" in s for s in scans) == 1
    assert sum("PartitionFilters: [isnotnull(order_ym" in s and "Subquery" in s for s in scans) == 1
    lazy = Warehouse.from_testdata(spark, SF_SMALL)
    a = fingerprint(payments.payment_orders(lazy.fct_orders, lazy.payments_base)).first()
    assert a == fingerprint(payments.payment_orders(wh.fct_orders, profile=wh.order_payments)).first()
    assert kpis.kpi_window(wh.mrt_kpis_daily, 30).count() > 0


# ------------------------------------------------------------------ failing rows
def failing_models(spark):
    raw = one_order(spark)
    items = raw["raw_order_items"]
    raw["raw_order_items"] = items.unionByName(spark.createDataFrame(
        [("o1", 3, "p1", "s1", -2.0, 1.0), ("o1", 3, "p2", "s1", 4.0, 1.0), ("oX", 1, "p1", "s1", 1.0, 1.0)], items.schema))
    raw["raw_orders"] = raw["raw_orders"].withColumn("order_estimated_delivery_date", F.lit(None).cast("timestamp_ntz"))
    wh = Warehouse(raw)
    return wh, {n: getattr(wh, n) for n in contracts.MODEL_KEYS}


def test_failing_rows_are_kept_whole(spark):
    wh, models = failing_models(spark)
    stored = store_test_failures(wh, new_build_dir(wh, "failures"))
    report = {(r.model, r.column_name, r.test, r.arg): r.failures for r in contracts.run_model_tests(models).collect()}
    kept = {(r.model, r.column_name, r.test, r.arg): r["count"]
            for r in stored.groupBy("model", "column_name", "test", "arg").count().collect()}
    assert kept == {k: n for k, n in report.items() if n}
    assert {k[2] for k in kept} == {"not_null", "unique", "relationships", "expression"}

    def field(row, name, kind):
        return F.try_variant_get(row, f"$.{name}", kind)

    lines = stored.filter("model = 'fct_order_items' AND column_name = 'unit_price'")
    got = lines.select("row_key", field("failed_row", "unit_price", "double"), field("failed_row", "order_id", "string"),
                       field("failed_row", "qty", "int"), field("failed_row", "order_ts", "timestamp_ntz")).collect()
    want = models["fct_order_items"].filter("unit_price < 0").select("order_item_id", "unit_price", "order_id", "qty", "order_ts").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    twice = stored.filter("test = 'unique'").select("row_key", field("failed_row", "n_records", "int").alias("n")).distinct().collect()
    assert [tuple(r) for r in twice] == [("o1-003", 2)]
    # every field of every failing row can be read back
    fields = contracts.failed_fields(stored)
    for model in ("fct_order_items", "fct_deliveries"):
        names = {r.field for r in fields.filter((F.col("model") == model) & (F.col("test") != "unique")).select("field").distinct().collect()}
        assert names == set(models[model].columns)
    price = fields.filter("model = 'fct_order_items' AND column_name = 'unit_price' AND field = 'unit_price'").first()
    assert price.value == "-2000000"
    assert fields.filter("model = 'fct_deliveries' AND field = 'is_late'").first().value is None


# ------------------------------------------------------------------ month refresh
def tables_of(wh, names):
    return {n: tuple(fingerprint(getattr(wh, n)).first()) for n in names}


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_refresh_writes_only_the_months_that_changed(spark):
    old = Warehouse.from_testdata(spark, SF_SMALL)
    out = new_build_dir(old, "refresh-test")
    paths = materialize(old, out)
    orders = old.raw["raw_orders"]
    ym = F.date_format("order_purchase_timestamp", "yyyy-MM")
    months = [r.m for r in orders.select(ym.alias("m")).groupBy("m").count().filter("count > 1").orderBy("m").limit(8).collect()]
    repriced, emptied, moved_from, moved_to = months[1], months[3], months[5], months[7]
    raw = dict(old.raw)
    # one month's lines get other prices, another month's orders go, a third's move to another month
    priced = orders.filter(ym == repriced).select("order_id", F.lit(3.0).alias("by"))
    items = raw["raw_order_items"].join(priced, "order_id", "left")
    raw["raw_order_items"] = items.withColumn("price", F.col("price") * F.coalesce("by", F.lit(1.0))).select(*raw["raw_order_items"].columns)
    later = F.to_timestamp_ntz(F.lit(f"{moved_to}-03 04:05:06"))
    time = F.when(ym == moved_from, later).otherwise(F.col("order_purchase_timestamp"))
    raw["raw_orders"] = orders.filter(ym != emptied).withColumn("order_purchase_timestamp", time).select(*orders.columns)
    gone = orders.filter(ym == emptied).select("order_id")
    for t in ("raw_order_items", "raw_payments", "raw_reviews"):
        raw[t] = raw[t].join(gone, "order_id", "left_anti").select(*raw[t].columns)

    changed = changed_orders(old.raw, raw)
    want_ids = {r.order_id for r in orders.filter(ym.isin(repriced, emptied, moved_from)).select("order_id").collect()}
    assert {r.order_id for r in changed.collect()} <= want_ids
    days = old.raw["raw_reviews"].join(gone, "order_id", "left_semi").select(F.to_date("review_creation_date").alias("day"))
    before = {t: files(paths[t]) for t in ("fct_orders", "fct_order_items", "order_payments", "fct_freight", "fct_deliveries")}
    new = Warehouse(raw)
    written = refresh(new, out, changed, review_days=days.distinct())
    assert set(written) <= {repriced, emptied, moved_from, moved_to, None} and repriced in written

    full = Warehouse(raw)
    materialize(full, new_build_dir(full, "refresh-full"))
    names = ("fct_order_items", "fct_orders", "fct_deliveries", "fct_freight", "order_payments", "mrt_kpis_daily", "mrt_reviews", "dim_customers")
    for n in names:
        a = fingerprint(getattr(new, n).select(*getattr(full, n).columns)).first()
        assert a == fingerprint(getattr(full, n)).first(), n
    for t, was in before.items():
        now = files(paths[t])
        for month in {re.search("order_ym=([^/]*)", f)[1] for f in was} - {str(m) for m in written} - {"__HIVE_DEFAULT_PARTITION__"}:
            part = f"order_ym={month}/"
            assert {f: x for f, x in was.items() if part in f} == {f: x for f, x in now.items() if part in f}, (t, month)
        assert not any(f"order_ym={emptied}/" in f for f in now)


def test_refresh_of_lines_without_an_order(spark):
    def raw(price):
        tables = one_order(spark)
        items = tables["raw_order_items"]
        tables["raw_order_items"] = items.unionByName(spark.createDataFrame(
            [("lost", 1, "p1", "s1", price, 1.0), (None, 1, "p1", "s1", 2.0, 1.0), ("other", 1, "p2", "s1", 7.0, 1.0)], items.schema))
        return tables

    old = Warehouse(raw(5.0))
    out = new_build_dir(old, "refresh-lost")
    materialize(old, out)
    new = Warehouse(raw(9.0))
    changed = changed_orders(old.raw, new.raw)
    assert [r.order_id for r in changed.collect()] == ["lost"]
    assert refresh(new, out, changed) == [None]
    full = Warehouse(raw(9.0))
    materialize(full, new_build_dir(full, "refresh-lost-full"))
    for n in ("fct_order_items", "fct_orders", "order_payments", "mrt_kpis_daily", "dim_customers"):
        assert fingerprint(getattr(new, n).select(*getattr(full, n).columns)).first() == fingerprint(getattr(full, n)).first(), n


# ------------------------------------------------------------------ ingest and catalog
def test_rows_are_observed_while_tables_are_stored(spark):
    tables = {k: v for k, v in one_order(spark).items() if k in ("raw_orders", "raw_order_items", "raw_reviews")}
    tables["raw_empty"] = tables["raw_orders"].filter("false")
    stored, summary = csv_source.store_raw(tables, new_build_dir(Warehouse(one_order(spark)), "observed"))
    rows = {r.table_name: r.rows for r in summary.collect()}
    assert rows == {"raw_orders": 1, "raw_order_items": 2, "raw_reviews": 1, "raw_empty": 0, "TOTAL": 4}
    # the scan has no row for an empty table
    assert {**{r.table_name: r.rows for r in csv_source.ingest_summary(tables).collect()}, "raw_empty": 0} == rows
    assert stored["raw_order_items"].exceptAll(tables["raw_order_items"]).count() == 0 and stored["raw_empty"].count() == 0


@pytest.fixture
def published(spark):
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    paths = materialize(wh, new_build_dir(wh, "catalog-test"))
    name = publish(wh, paths, "emporia_catalog_test")
    yield wh, name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_descriptions_are_those_of_the_catalog(spark, published):
    wh, database = published
    assert spark.catalog.getTable(f"{database}.fct_orders").description == "one row per order, with totals of lines and payments"
    comments = {c.name: c.description for c in spark.catalog.listColumns(f"{database}.fct_freight")}
    assert "great-circle" in comments["distance_km"] and comments["qty"] is None
    assert spark.table(f"{database}.fct_orders").count() == wh.fct_orders.count() > 0
    rows = {(r.table_name, r.column_name): (r.description, r.filled) for r in describe(wh, database).collect()}
    assert rows["fct_orders", ""][1] == wh.fct_orders.count()
    assert rows["fct_deliveries", "is_on_time"][1] == wh.fct_deliveries.filter("is_on_time IS NOT NULL").count()
