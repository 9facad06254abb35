"""Analyses registered as queries (beyond the plain models)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from emporia.functions import money_sum
from emporia.operators import marts, staging
from emporia.plans.build import (
    build_summary,
    describe,
    materialize,
    new_build_dir,
    persist_frame,
    persist_model,
    publish,
    store_test_failures,
)
from emporia.plans.refresh import refresh
from emporia.sources import csv as csv_source
from emporia.sources import sinks
from emporia.plans.catalog import register
from emporia.plans.warehouse import Warehouse


@register("normalize_status")
def q_normalize_status(wh: Warehouse):
    """Raw status value -> normalised status, with order counts."""
    raw = wh.raw["raw_orders"]
    return raw.groupBy(
        F.col("order_status").alias("raw_status"),
        staging.normalize_status(F.col("order_status")).alias("status"),
    ).agg(F.count(F.lit(1)).alias("orders"))


@register("order_flags")
def q_order_flags(wh: Warehouse):
    """Order counts per combination of status flags."""
    return wh.stg_orders.groupBy("status", "is_delivered", "is_canceled", "is_unavailable", "is_late").agg(
        F.count(F.lit(1)).alias("orders")
    )


@register("lane_coordinates")
def q_lane_coordinates(wh: Warehouse):
    return wh.lane_coordinates.select(
        "order_item_id", "order_id", "cust_zip", "seller_zip", "cust_lat", "cust_lng", "seller_lat", "seller_lng"
    )


@register("haversine_km")
def q_haversine(wh: Warehouse):
    return marts.lane_distances(wh.lane_coordinates)


# ---------------------------------------------------------------- KPI reads
from emporia.operators import category, delivery, kpis, payments, regression  # noqa: E402

KPI_DAYS = 180


@register("kpi_window")
def q_kpi_window(wh: Warehouse):
    return kpis.kpi_window(wh.mrt_kpis_daily, KPI_DAYS)


@register("kpi_latest")
def q_kpi_latest(wh: Warehouse):
    return kpis.kpi_latest(wh.mrt_kpis_daily, KPI_DAYS)


@register("kpi_alerts")
def q_kpi_alerts(wh: Warehouse):
    return kpis.kpi_alerts(wh.mrt_kpis_daily, wh.mrt_reviews, KPI_DAYS)


@register("kpi_series_long")
def q_kpi_series_long(wh: Warehouse):
    return kpis.kpi_series_long(wh.mrt_kpis_daily)


# ---------------------------------------------------------------- delivery
@register("lead_time_hist")
def q_lead_time_hist(wh: Warehouse):
    return delivery.lead_time_hist(wh.fct_deliveries)


@register("on_time_split")
def q_on_time_split(wh: Warehouse):
    return delivery.on_time_split(wh.fct_deliveries)


@register("delay_penalty_overall")
def q_delay_penalty_overall(wh: Warehouse):
    return delivery.delay_penalty_overall(wh.stg_reviews, wh.fct_deliveries)


@register("score_distribution")
def q_score_distribution(wh: Warehouse):
    return delivery.score_distribution(wh.stg_reviews, wh.fct_deliveries)


# ---------------------------------------------------------------- regression
def _freight(wh: Warehouse):
    # The fit, the residual spread and the scoring each read the points:
    # persist the freight mart once instead of recomputing its joins per pass.
    return persist_model(wh, "fct_freight")


def _line_points(wh: Warehouse):
    return regression.freight_points_line(_freight(wh))


def _line_model(wh: Warehouse):
    pts = _line_points(wh)
    return pts, persist_frame(regression.ols_fit(pts), "ols-model")  # one fit, read by every consumer


@register("freight_points_line")
def q_freight_points_line(wh: Warehouse):
    return _line_points(wh)


@register("freight_points_order")
def q_freight_points_order(wh: Warehouse):
    return regression.freight_points_order(wh.fct_freight)


@register("ols_fit")
def q_ols_fit(wh: Warehouse):
    return _line_model(wh)[1]


@register("ols_fit_order")
def q_ols_fit_order(wh: Warehouse):
    return regression.ols_fit(regression.freight_points_order(_freight(wh)))


@register("ols_score")
def q_ols_score(wh: Warehouse):
    pts, model = _line_model(wh)
    return regression.ols_score(pts, model)


@register("ols_summary")
def q_ols_summary(wh: Warehouse):
    pts, model = _line_model(wh)
    return regression.ols_summary(regression.ols_score(pts, model), model)


@register("ols_trend_line")
def q_ols_trend_line(wh: Warehouse):
    pts, model = _line_model(wh)
    return regression.ols_trend_line(pts, model)


@register("outlier_lanes")
def q_outlier_lanes(wh: Warehouse):
    pts, model = _line_model(wh)
    return regression.outlier_lanes(regression.ols_score(pts, model))


@register("freight_insights")
def q_freight_insights(wh: Warehouse):
    pts, model = _line_model(wh)
    return regression.freight_insights(regression.ols_score(pts, model), model)


# ---------------------------------------------------------------- categories
# At sf0.01 the default cut-offs select nothing; these select a few (FIXTURES.md).
DISCONTINUE_VEL_CUT = 12.0
DISCONTINUE_MARGIN_CUT = 0.90


def _cat_metrics(wh: Warehouse):
    rollup = category.category_rollup(wh.lines, wh.orders_with_items, wh.stg_products)
    return category.category_metrics(rollup)


@register("category_rollup")
def q_category_rollup(wh: Warehouse):
    return category.category_rollup(wh.lines, wh.orders_with_items, wh.stg_products)


@register("category_metrics")
def q_category_metrics(wh: Warehouse):
    return _cat_metrics(wh)


@register("category_ranks")
def q_category_ranks(wh: Warehouse):
    return category.category_ranks(_cat_metrics(wh))


@register("category_top_n")
def q_category_top_n(wh: Warehouse):
    return category.category_top_n(_cat_metrics(wh))


@register("category_totals")
def q_category_totals(wh: Warehouse):
    return category.category_totals(_cat_metrics(wh))


@register("discontinue_candidates")
def q_discontinue_candidates(wh: Warehouse):
    return category.discontinue_candidates(_cat_metrics(wh), DISCONTINUE_VEL_CUT, DISCONTINUE_MARGIN_CUT)


# ---------------------------------------------------------------- payments
def _pay_orders(wh: Warehouse):
    return payments.payment_orders(wh.fct_orders, wh.payments_base)


@register("payment_orders")
def q_payment_orders(wh: Warehouse):
    return _pay_orders(wh)


@register("primary_method")
def q_primary_method(wh: Warehouse):
    return payments.primary_method(wh.payments_base)


@register("payment_kpis")
def q_payment_kpis(wh: Warehouse):
    return payments.payment_kpis(_pay_orders(wh))


@register("installments_dist")
def q_installments_dist(wh: Warehouse):
    return payments.installments_dist(_pay_orders(wh))


@register("aov_by_method")
def q_aov_by_method(wh: Warehouse):
    return payments.aov_by_method(_pay_orders(wh))


@register("cancel_by_installments")
def q_cancel_by_installments(wh: Warehouse):
    return payments.cancel_by_installments(_pay_orders(wh))


@register("payment_insights")
def q_payment_insights(wh: Warehouse):
    return payments.payment_insights(_pay_orders(wh))


# ---------------------------------------------------------------- contracts
from emporia.operators import contracts  # noqa: E402


def _real_report(wh: Warehouse, *names: str):
    checks = [c for c in contracts.contracts("real") if not names or c.check_name in names]
    return contracts.run_checks(wh.raw["raw_orders"].sparkSession, wh.raw, checks)


for _key, _names in (
    ("contract_nonempty", ("nonempty",)),
    ("contract_unique", ("unique",)),
    ("contract_not_null", ("not_null",)),
    ("contract_fk", ("fk",)),
    ("contract_values_real", ("values",)),
    ("contract_essential_nulls", ("essential_nulls",)),
    ("contract_time_order", ("time_order",)),
    ("contract_report", ()),
):
    register(_key)(lambda wh, _n=_names: _real_report(wh, *_n))


def _models(wh: Warehouse) -> dict:
    """The tested models, built once in the shared folder: the tests then scan tables, not their chains."""
    materialize(wh, tables=[t for t in wh.buildable() if t in contracts.MODEL_KEYS])
    return {name: getattr(wh, name) for name in contracts.MODEL_KEYS}


@register("model_tests")
def q_model_tests(wh: Warehouse):
    return contracts.run_model_tests(_models(wh))


@register("store_failures")
def q_store_failures(wh: Warehouse):
    return contracts.store_failures(_models(wh)).drop("failed_row")


@register("failed_rows")
def q_failed_rows(wh: Warehouse):
    """The quarantine table as it is stored: every failing row, read back field by field."""
    _models(wh)
    return contracts.failed_fields(store_test_failures(wh, new_build_dir(wh, "failures")))


@register("mart_sanity")
def q_mart_sanity(wh: Warehouse):
    m = _models(wh)
    return contracts.mart_sanity(m["fct_orders"], m["fct_order_items"], m["dim_customers"], m["mrt_kpis_daily"],
                                 m["fct_freight"], m["mrt_reviews"])


# ---------------------------------------------------------------- sources / sinks
@register("csv_source")
def q_csv_source(wh: Warehouse):
    """Raw orders written as CSV to shared storage and read back by name."""
    path = f"{new_build_dir(wh, 'csv')}/olist_orders_dataset.csv"
    sinks.write_csv(wh.raw["raw_orders"], path)
    spark = wh.raw["raw_orders"].sparkSession
    return csv_source.read_csv(spark, path, csv_source.RAW_SCHEMAS["raw_orders"])


@register("ingest_summary")
def q_ingest_summary(wh: Warehouse):
    """All raw tables exported as the eight source CSV files, ingested back
    through the file -> table mapping, registered, and counted."""
    folder = new_build_dir(wh, "ingest")
    for fname, table in csv_source.OLIST_FILES.items():
        sinks.write_csv(wh.raw[table], f"{folder}/{fname}")
    spark = wh.raw["raw_orders"].sparkSession
    tables = csv_source.ingest_folder(spark, folder, csv_source.OLIST_FILES, csv_source.RAW_SCHEMAS)
    stored, summary = csv_source.store_raw(tables, new_build_dir(wh, "raw"))
    csv_source.register_raw(stored)
    return summary


@register("table_health")
def q_table_health(wh: Warehouse):
    """Which of the expected raw tables are in the catalog, and with how many rows; refunds are of the other mode."""
    spark = wh.raw["raw_orders"].sparkSession
    prefix = f"health_{uuid.uuid4().hex}_"
    views = {prefix + t: df for t, df in wh.raw.items()}
    csv_source.register_raw(views)
    health = csv_source.table_health(spark, [prefix + t for t in (*csv_source.OLIST_FILES.values(), "raw_refunds")])
    for name in views:
        spark.catalog.dropTempView(name)
    found = health.join(csv_source.ingest_summary(views), "table_name", "left")
    return found.select(F.regexp_replace("table_name", f"^{prefix}", "").alias("table_name"), "present", "rows")


@register("mart_build")
def q_mart_build(wh: Warehouse):
    """Full build of core tables and marts to Parquet; rows per persisted table."""
    return build_summary(wh, materialize(wh))


@register("mart_schema_doc")
def q_mart_schema_doc(wh: Warehouse):
    """A build published in the catalog: descriptions of tables and columns as the catalog has them, with the rows that fill each."""
    paths = materialize(wh, tables=wh.buildable())
    return describe(wh, publish(wh, paths, f"emporia_{uuid.uuid4().hex}"))


REFRESHED_MONTHS = ("1995-06", "1997-01")


def repriced(raw: dict, months=REFRESHED_MONTHS) -> dict:
    """``raw`` with the prices of some months' orders doubled."""
    ym = F.date_format("order_purchase_timestamp", "yyyy-MM")
    orders = raw["raw_orders"].filter(ym.isin(*months)).select("order_id", F.lit(2.0).alias("_by"))
    items = raw["raw_order_items"]
    price = (F.col("price") * F.coalesce("_by", F.lit(1.0))).alias("price")
    joined = items.join(orders, "order_id", "left")
    return raw | {"raw_order_items": joined.select(*[price if c == "price" else c for c in items.columns])}


@register("mart_refresh")
def q_mart_refresh(wh: Warehouse):
    """A build, then two months' prices change and only those months are built anew: stored totals by month, and the daily KPIs' by month."""
    out = new_build_dir(wh, "refresh")
    materialize(wh, out)
    newer = Warehouse(repriced(wh.raw))
    ym = F.date_format("order_purchase_timestamp", "yyyy-MM")
    changed = newer.raw["raw_orders"].filter(ym.isin(*REFRESHED_MONTHS)).select("order_id")
    refresh(newer, out, changed)
    orders = newer.fct_orders.groupBy("order_ym").agg(F.count(F.lit(1)).alias("orders"), money_sum("gmv").alias("gmv"))
    lines = newer.fct_order_items.groupBy("order_ym").agg(money_sum("line_net").alias("line_net"))
    days = newer.mrt_kpis_daily.groupBy(F.date_format("kpi_date", "yyyy-MM").alias("order_ym")).agg(money_sum("gmv").alias("kpi_gmv"))
    return orders.join(lines, "order_ym", "left").join(days, "order_ym", "left")


OUTLIER_SCHEMA = ("order_id string, order_item_id string, seller_id string, product_id string, "
                  "distance_km double, freight_pct double, y_hat double, resid double, z_resid double")


@register("csv_export")
def q_csv_export(wh: Warehouse):
    """Outlier list exported as CSV and read back."""
    pts, model = _line_model(wh)
    path = f"{new_build_dir(wh, 'export')}/freight_distance_outliers.csv"
    sinks.write_csv(regression.outlier_lanes(regression.ols_score(pts, model)), path)
    return csv_source.read_csv(pts.sparkSession, path, OUTLIER_SCHEMA)


DISCONTINUE_SCHEMA = ("category string, orders_delivered bigint, units double, gmv double, proxy_margin double, "
                      "margin_pct_of_gmv double, velocity_units_per_day double")


@register("discontinue_export")
def q_discontinue_export(wh: Warehouse):
    """Discontinue candidates exported as CSV and read back."""
    path = f"{new_build_dir(wh, 'export')}/discontinue_candidates.csv"
    found = category.discontinue_candidates(_cat_metrics(wh), DISCONTINUE_VEL_CUT, DISCONTINUE_MARGIN_CUT)
    sinks.write_csv(found, path)
    return csv_source.read_csv(found.sparkSession, path, DISCONTINUE_SCHEMA)


@register("kpi_fingerprint")
def q_kpi_fingerprint(wh: Warehouse):
    """Order-insensitive fingerprint of the daily KPI mart."""
    return sinks.fingerprint(wh.mrt_kpis_daily)


# ---------------------------------------------------------------- synthetic mode
@register("synth_kpis", mode="synth")
def q_synth_kpis(wh: Warehouse):
    return wh.mrt_kpis_daily_synth


def _synth_report(wh: Warehouse, *names: str):
    checks = [c for c in contracts.contracts("synth") if not names or c.check_name in names]
    return contracts.run_checks(wh.raw["raw_orders"].sparkSession, wh.raw, checks)


for _key, _names in (
    ("contract_values_synth", ("values",)),
    ("contract_signup_order", ("signup_order",)),
    ("contract_report_synth", ()),
):
    register(_key, mode="synth")(lambda wh, _n=_names: _synth_report(wh, *_n))
