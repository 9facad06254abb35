"""Final SELECTs of the oracle, one per registered query."""

from __future__ import annotations

from emporia.plans.build import DOCS, TABLE_DOCS
from emporia.plans.oracle import QUERIES, query

# plain models
query("stg_orders", "SELECT * FROM stg_orders")
query("stg_order_items", "SELECT * FROM stg_order_items",
      ["unit_price", "discount_amount", "freight_value", "line_gross", "line_net"])
query("stg_customers", "SELECT * FROM stg_customers")
query("stg_sellers", "SELECT * FROM stg_sellers")
query("stg_products", "SELECT * FROM stg_products")
query("stg_payments", "SELECT * FROM stg_payments", ["value"])
query("stg_reviews", "SELECT * FROM stg_reviews")
query("stg_geolocation", "SELECT * FROM stg_geolocation", ["lat", "lng"])
query("geo_centroids", "SELECT * FROM geo_centroids", ["lat", "lng"])
query("dim_customers", "SELECT * FROM dim_customers")
query("dim_products", "SELECT product_id, category, name_len, desc_len, photos_qty, weight_g, length_cm, "
      "height_cm, width_cm FROM stg_products")
query("fct_order_items", "SELECT * FROM fct_order_items",
      ["unit_price", "discount_amount", "freight_value", "line_gross", "line_net"])
query("order_item_totals", "SELECT * FROM order_item_totals", ["gmv", "net_item_revenue", "freight_total"])
query("order_payment_totals", "SELECT * FROM order_payment_totals", ["payment_total"])
query("fct_orders", "SELECT * FROM fct_orders", ["gmv", "net_item_revenue", "freight_total", "payment_total"])
query("fct_deliveries", "SELECT * FROM fct_deliveries")
query("fct_freight", "SELECT * FROM fct_freight",
      ["unit_price", "freight_value", "line_gross", "freight_pct_line", "distance_km", "order_freight_total",
       "order_gmv", "order_freight_pct"])
query("mrt_kpis_daily", "SELECT * FROM mrt_kpis_daily",
      ["gmv", "aov", "freight_pct_gmv", "on_time_pct", "late_pct"])
query("mrt_reviews", "SELECT * FROM mrt_reviews",
      ["avg_score", "late_avg_score", "ontime_avg_score", "delay_penalty"])
query("freight_pct_trend", """
SELECT order_date, avg(order_freight_pct) AS freight_pct FROM fct_freight
WHERE order_date IS NOT NULL AND order_freight_pct IS NOT NULL GROUP BY order_date
""", ["freight_pct"])

query("normalize_status", """
SELECT order_status AS raw_status, status, count(*) AS orders
FROM (SELECT r.order_status, s.status FROM raw_orders r JOIN stg_orders s USING (order_id))
GROUP BY ALL
""")
query("order_flags", """
SELECT status, is_delivered, is_canceled, is_unavailable, is_late, count(*) AS orders
FROM stg_orders GROUP BY ALL
""")
query("lane_coordinates", """
SELECT order_item_id, order_id, cust_zip, seller_zip, cust_lat, cust_lng, seller_lat, seller_lng
FROM freight_coords
""", ["cust_lat", "cust_lng", "seller_lat", "seller_lng"])
query("haversine_km", "SELECT DISTINCT cust_zip, seller_zip, distance_km FROM freight_coords "
      "JOIN freight_lines USING (order_item_id)", ["distance_km"])

KPI = ["gmv", "aov", "freight_pct_gmv", "on_time_pct", "late_pct"]
query("kpi_window", "SELECT * FROM kpi_win", KPI)
query("kpi_latest", """
SELECT kpi_date, orders_delivered, gmv, aov, on_time_pct * 100 AS on_time_pct_100,
  freight_pct_gmv * 100 AS freight_pct_gmv_100
FROM kpi_win ORDER BY kpi_date DESC LIMIT 1
""", ["gmv", "aov", "on_time_pct_100", "freight_pct_gmv_100"])
query("kpi_alerts", """
WITH l AS (SELECT on_time_pct * 100 AS on_time, freight_pct_gmv AS freight FROM kpi_win
           ORDER BY kpi_date DESC LIMIT 1),
     r AS (SELECT avg_score AS score FROM mrt_reviews ORDER BY as_of_date DESC LIMIT 1)
SELECT 'on_time_pct_below' AS alert, on_time AS value, CAST(85.0 AS DOUBLE) AS threshold,
  coalesce(on_time < 85.0, false) AS fired FROM l
UNION ALL
SELECT 'freight_pct_gmv_above', freight, CAST(0.20 AS DOUBLE), coalesce(freight > 0.20, false) FROM l
UNION ALL
SELECT 'avg_review_score_below', (SELECT score FROM r), CAST(3.8 AS DOUBLE),
  coalesce((SELECT score FROM r) < 3.8, false)
""", ["value", "threshold"])
query("kpi_series_long", " UNION ALL ".join(
    f"SELECT kpi_date, '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM mrt_kpis_daily"
    for c in ["orders_delivered", "gmv", "aov", "freight_pct_gmv", "on_time_pct", "late_pct"]), ["value"])

query("lead_time_hist", """
SELECT CAST(lead_time_days AS INTEGER) AS lead_time_days, count(*) AS orders FROM fct_deliveries
WHERE lead_time_days IS NOT NULL GROUP BY 1
""")
query("on_time_split", """
SELECT count(*) AS deliveries,
  CASE WHEN count(*) > 0 THEN sum(CASE WHEN is_on_time THEN 1 ELSE 0 END) / count(*) END AS on_time_pct,
  CASE WHEN count(*) > 0 THEN sum(CASE WHEN is_late THEN 1 ELSE 0 END) / count(*) END AS late_pct
FROM fct_deliveries WHERE is_on_time IS NOT NULL
""", ["on_time_pct", "late_pct"])
query("delay_penalty_overall", """
SELECT count(*) AS reviews,
  avg(CASE WHEN is_late = false THEN score END) AS ontime_avg_score,
  avg(CASE WHEN is_late = true THEN score END) AS late_avg_score,
  avg(CASE WHEN is_late = false THEN score END) - avg(CASE WHEN is_late = true THEN score END) AS delay_penalty
FROM stg_reviews r JOIN fct_deliveries d USING (order_id) WHERE r.score IS NOT NULL
""", ["ontime_avg_score", "late_avg_score", "delay_penalty"])
query("score_distribution", """
SELECT score, count(*) AS reviews
FROM stg_reviews r JOIN fct_deliveries d USING (order_id) WHERE r.score IS NOT NULL GROUP BY score
""")

PTS = ["distance_km", "freight_pct", "line_gross"]
FIT = ["intercept", "slope", "r2", "sigma"]
query("freight_points_line", "SELECT * FROM pts_line", PTS)
query("freight_points_order", "SELECT * FROM pts_order", PTS)
query("ols_fit", "SELECT * FROM fit_line", FIT)
query("ols_fit_order", "SELECT * FROM fit_order", FIT)
query("ols_score", "SELECT * FROM scored_line", PTS + ["y_hat", "resid", "z_resid"])
query("ols_summary", """
SELECT count(*) AS rows, (SELECT r2 FROM fit_line) AS r2, (SELECT slope FROM fit_line) * 100 AS slope_pp_per_km,
  count(*) FILTER (WHERE is_outlier) AS outliers
FROM scored_line
""", ["r2", "slope_pp_per_km"])
query("ols_trend_line", """
SELECT x_min, m.intercept + m.slope * x_min AS y_at_min, x_max, m.intercept + m.slope * x_max AS y_at_max
FROM (SELECT min(distance_km) AS x_min, max(distance_km) AS x_max FROM pts_line
      WHERE isfinite(distance_km) AND isfinite(freight_pct)), fit_line m
""", ["x_min", "y_at_min", "x_max", "y_at_max"])
query("outlier_lanes", "SELECT * FROM outliers_line",
      ["distance_km", "freight_pct", "y_hat", "resid", "z_resid"])
query("freight_insights", """
SELECT m.r2, m.slope * 100 AS slope_pp_per_km, m.slope > 0 AS freight_rises_with_distance,
  (SELECT count(*) FROM scored_line WHERE is_outlier) AS outliers,
  w.order_id AS worst_order_id, w.z_resid AS worst_z_resid, w.seller_id AS worst_seller_id,
  w.product_id AS worst_product_id
FROM fit_line m LEFT JOIN (SELECT * FROM outliers_line LIMIT 1) w ON true
""", ["r2", "slope_pp_per_km", "worst_z_resid"])

CAT = ["units", "gmv", "net_revenue", "proxy_margin", "freight_total", "avg_freight_pct",
       "velocity_units_per_day", "margin_pct_of_gmv", "avg_order_value"]
query("category_rollup", "SELECT * FROM cat_rollup", CAT[:6])
query("category_metrics", "SELECT * FROM cat_metrics", CAT)
query("category_ranks", """
SELECT *,
  CASE WHEN gmv IS NOT NULL THEN CAST(dense_rank() OVER (ORDER BY gmv DESC NULLS LAST) AS INTEGER) END AS rank_gmv,
  CASE WHEN velocity_units_per_day IS NOT NULL
       THEN CAST(dense_rank() OVER (ORDER BY velocity_units_per_day DESC NULLS LAST) AS INTEGER) END AS rank_velocity,
  CASE WHEN margin_pct_of_gmv IS NOT NULL
       THEN CAST(dense_rank() OVER (ORDER BY margin_pct_of_gmv DESC NULLS LAST) AS INTEGER) END AS rank_margin_pct
FROM cat_metrics
""", CAT)
query("category_top_n", """
SELECT category, orders_delivered, gmv, avg_order_value, proxy_margin, margin_pct_of_gmv,
  velocity_units_per_day, avg_freight_pct
FROM cat_metrics ORDER BY gmv DESC, category LIMIT 20
""", ["gmv", "avg_order_value", "proxy_margin", "margin_pct_of_gmv", "velocity_units_per_day", "avg_freight_pct"])
query("category_totals", """
SELECT count(*) AS categories, CAST(sum(orders_delivered) AS BIGINT) AS orders_delivered,
  CAST(sum(CAST(gmv AS DECIMAL(38,6))) AS DOUBLE) AS gmv, CAST(sum(CAST(proxy_margin AS DECIMAL(38,6))) AS DOUBLE) AS proxy_margin
FROM cat_metrics
""", ["gmv", "proxy_margin"])
query("discontinue_candidates", """
SELECT category, orders_delivered, units, gmv, proxy_margin, margin_pct_of_gmv, velocity_units_per_day
FROM cat_metrics
WHERE velocity_units_per_day <= 12.0 AND coalesce(margin_pct_of_gmv, 0) <= 0.90
ORDER BY gmv, category
""", ["units", "gmv", "proxy_margin", "margin_pct_of_gmv", "velocity_units_per_day"])

query("payment_orders", "SELECT * FROM pay_orders", ["gmv", "payment_total"])
query("primary_method", """
SELECT order_id, coalesce(lower(primary_method), 'unknown') AS primary_method, methods_list FROM pay_profile
""")
query("payment_kpis", """
SELECT count(*) AS orders, avg(coalesce(installments, 1)) AS avg_installments,
  avg(CAST(is_delivered AS INTEGER)) * 100 AS delivered_pct, avg(CAST(is_canceled AS INTEGER)) * 100 AS cancel_pct
FROM pay_orders
""", ["avg_installments", "delivered_pct", "cancel_pct"])
query("installments_dist", """
SELECT greatest(coalesce(installments, 1), 1) AS installments, count(*) AS orders FROM pay_orders GROUP BY 1
""")
query("aov_by_method", """
SELECT primary_method, count(order_id) AS orders, CAST(sum(CAST(gmv AS DECIMAL(38,6))) AS DOUBLE) / count(gmv) AS aov FROM pay_orders
GROUP BY primary_method HAVING count(order_id) >= 25
""", ["aov"])
query("cancel_by_installments", "SELECT * FROM cancel_inst", ["cancel_rate", "cancel_rate_pct"])
query("payment_insights", """
SELECT low AS aov_low_installments, high AS aov_high_installments, high - low AS aov_delta,
  c_first AS cancel_rate_first, c_last AS cancel_rate_last,
  CASE WHEN c_last > c_first THEN 'higher' WHEN c_last IS NOT NULL AND c_first IS NOT NULL THEN 'lower' END
    AS cancel_trend
FROM (SELECT CAST(sum(CAST(CASE WHEN coalesce(installments, 1) <= 2 THEN gmv END AS DECIMAL(38,6))) AS DOUBLE)
               / count(CASE WHEN coalesce(installments, 1) <= 2 THEN gmv END) AS low,
             CAST(sum(CAST(CASE WHEN coalesce(installments, 1) >= 6 THEN gmv END AS DECIMAL(38,6))) AS DOUBLE)
               / count(CASE WHEN coalesce(installments, 1) >= 6 THEN gmv END) AS high,
             (SELECT cancel_rate FROM cancel_inst ORDER BY installments LIMIT 1) AS c_first,
             (SELECT cancel_rate FROM cancel_inst ORDER BY installments DESC LIMIT 1) AS c_last
      FROM pay_orders)
""", ["aov_low_installments", "aov_high_installments", "aov_delta", "cancel_rate_first", "cancel_rate_last"])

# ---------------------------------------------------------------- contracts
from emporia.operators import contracts as _c  # noqa: E402  (the declared check lists)


def _check_sql(c, names=None) -> str:
    head = f"SELECT '{c.check_name}' AS check_name, '{c.table_name}' AS table_name, '{c.detail}' AS detail, "
    if names:
        from dataclasses import replace
        c = replace(c, table_name=names.get(c.table_name, c.table_name), parent=names.get(c.parent, c.parent))
    if c.kind == "nonempty":
        return head + f"CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS violations FROM {c.table_name}"
    if c.kind == "unique":
        cols = ", ".join(c.columns)
        return head + (f"count(*) AS violations FROM (SELECT {cols}, count(*) AS n FROM {c.table_name} "
                       f"GROUP BY {cols}) WHERE n > 1")
    if c.kind == "rows":
        return head + f"count(*) AS violations FROM {c.table_name} WHERE {c.predicate}"
    if c.kind == "fk":
        col, pcol = c.columns[0], c.parent_columns[0]
        return head + (f"count(*) AS violations FROM {c.table_name} ch LEFT JOIN {c.parent} p "
                       f"ON ch.{col} = p.{pcol} WHERE p.{pcol} IS NULL")
    if c.kind == "join_rows":
        return head + (f"count(*) AS violations FROM {c.table_name} o LEFT JOIN {c.parent} c "
                       f"ON o.customer_id = c.customer_id WHERE {c.predicate}")
    raise ValueError(c.kind)


def _report_sql(checks, names=None) -> str:
    body = "\nUNION ALL\n".join(_check_sql(c, names) for c in checks)
    return f"SELECT *, coalesce(violations = 0, false) AS passed FROM (\n{body}\n)"


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
    query(_key, _report_sql([c for c in _c.contracts("real") if not _names or c.check_name in _names]))


def _failing_sql(t) -> str:
    key = _c.MODEL_KEYS[t.model]
    if t.test == "not_null":
        return f"SELECT CAST({key} AS VARCHAR) AS row_key FROM {t.model} WHERE {t.column} IS NULL"
    if t.test == "unique":
        return (f"SELECT CAST({t.column} AS VARCHAR) AS row_key FROM {t.model} WHERE {t.column} IS NOT NULL "
                f"GROUP BY {t.column} HAVING count(*) > 1")
    if t.test == "relationships":
        pm, pc = t.arg.split(".")
        return (f"SELECT CAST(m.{key} AS VARCHAR) AS row_key FROM {t.model} m WHERE m.{t.column} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {pm} p WHERE p.{pc} = m.{t.column})")
    return f"SELECT CAST({key} AS VARCHAR) AS row_key FROM {t.model} WHERE NOT ({t.arg})"


def _tcols(t) -> str:
    return (f"'{t.model}' AS model, '{t.column}' AS column_name, '{t.test}' AS test, "
            f"'{t.arg}' AS arg, '{t.severity}' AS severity")


query("model_tests", "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
      "ELSE 'fail' END AS status FROM (\n" + "\nUNION ALL\n".join(
          f"SELECT {_tcols(t)}, count(*) AS failures FROM ({_failing_sql(t)})" for t in _c.MODEL_TESTS) + "\n)")
query("store_failures", "\nUNION ALL\n".join(
    f"SELECT {_tcols(t)}, row_key FROM ({_failing_sql(t)})" for t in _c.MODEL_TESTS))


# Stored tables have their month.
_WITH_MONTH = {"fct_order_items": "order_ts", "fct_deliveries": "order_date", "fct_freight": "order_date"}


def _stored_sql(t) -> str:
    """The failing row itself, as a JSON object: what the quarantine table keeps of it."""
    rows = t.model
    if t.model in _WITH_MONTH:
        rows = f"(SELECT *, strftime({_WITH_MONTH[t.model]}, '%Y-%m') AS order_ym FROM {t.model})"
    key = _c.MODEL_KEYS[t.model]
    if t.test == "unique":
        return (f"SELECT CAST({t.column} AS VARCHAR) AS row_key, to_json({{'{t.column}': {t.column}, 'n_records': count(*)}}) AS j "
                f"FROM {t.model} WHERE {t.column} IS NOT NULL GROUP BY {t.column} HAVING count(*) > 1")
    failing = {
        "not_null": f"m.{t.column} IS NULL",
        "expression": f"NOT ({t.arg})",
        "relationships": f"m.{t.column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {t.arg.split('.')[0]} p "
                         f"WHERE p.{t.arg.split('.')[-1]} = m.{t.column})",
    }[t.test]
    return f"SELECT CAST(m.{key} AS VARCHAR) AS row_key, to_json(m) AS j FROM {rows} m WHERE {failing}"


query("failed_rows", """
SELECT * FROM (WITH failed AS (FAILED), fields AS (
  SELECT model, column_name, test, arg, severity, row_key, j, unnest(json_keys(j)) AS field FROM failed
), typed AS (
  SELECT *, json_type(j, '$."' || field || '"') AS kind, json_extract_string(j, '$."' || field || '"') AS text FROM fields
)
SELECT model, column_name, test, arg, severity, row_key, field,
  CASE WHEN kind = 'DOUBLE' THEN CAST(CAST(floor(CAST(text AS DOUBLE) * CAST(1000000 AS DOUBLE) + CAST(0.5 AS DOUBLE))
    AS DECIMAL(38,0)) AS VARCHAR) ELSE text END AS value
FROM typed) AS q
""".replace("FAILED", "\nUNION ALL\n".join(f"SELECT {_tcols(t)}, row_key, j FROM ({_stored_sql(t)})" for t in _c.MODEL_TESTS)))
query("mart_sanity", """
SELECT 'fct_orders_rows' AS check_name, CAST(count(*) AS DOUBLE) AS value, count(*) >= 1 AS passed FROM fct_orders
UNION ALL SELECT 'fct_order_items_rows', count(*), count(*) >= 1 FROM fct_order_items
UNION ALL SELECT 'dim_customers_rows', count(*), count(*) >= 1 FROM dim_customers
UNION ALL SELECT 'kpi_rows', count(*), count(*) >= 1 FROM mrt_kpis_daily
UNION ALL SELECT 'kpi_missing_columns', 0, true
UNION ALL SELECT 'kpi_wrong_types', n, n = 0 FROM (SELECT max(CAST(typeof(kpi_date) <> 'DATE' AS INTEGER)
    + CAST(typeof(orders_delivered) <> 'BIGINT' AS INTEGER) + CAST(typeof(gmv) <> 'DOUBLE' AS INTEGER)
    + CAST(typeof(aov) <> 'DOUBLE' AS INTEGER) + CAST(typeof(on_time_pct) <> 'DOUBLE' AS INTEGER)
    + CAST(typeof(freight_pct_gmv) <> 'DOUBLE' AS INTEGER)) AS n FROM mrt_kpis_daily)
UNION ALL SELECT 'kpi_invalid_rows', count(*), count(*) = 0 FROM mrt_kpis_daily
  WHERE gmv < 0 OR aov < 0 OR on_time_pct < 0 OR on_time_pct > 1 OR freight_pct_gmv < 0
UNION ALL SELECT 'freight_usable_rows', count(*), count(*) >= 10 FROM fct_freight
  WHERE distance_km IS NOT NULL AND (freight_pct_line IS NOT NULL OR order_freight_pct IS NOT NULL)
UNION ALL SELECT 'freight_distance_var_pop', var_pop(distance_km), coalesce(var_pop(distance_km), 0) > 0
  FROM fct_freight WHERE distance_km IS NOT NULL AND freight_pct_line IS NOT NULL
UNION ALL SELECT 'reviews_penalty_rows', count(delay_penalty), count(delay_penalty) >= 1 FROM mrt_reviews
""", ["value"])

# ---------------------------------------------------------------- sources / sinks
query("csv_source", "SELECT * FROM raw_orders")
query("ingest_summary", "SELECT table_name, rows FROM (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in
    ["raw_orders", "raw_order_items", "raw_customers", "raw_payments", "raw_reviews", "raw_products",
     "raw_sellers", "raw_geolocation"]) + ") UNION ALL SELECT 'TOTAL', (" + " + ".join(
    f"(SELECT count(*) FROM {t})" for t in
    ["raw_orders", "raw_order_items", "raw_customers", "raw_payments", "raw_reviews", "raw_products",
     "raw_sellers", "raw_geolocation"]) + ")")
query("table_health", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, true AS present, count(*) AS rows FROM {t}" for t in
    ["raw_orders", "raw_order_items", "raw_customers", "raw_payments", "raw_reviews", "raw_products",
     "raw_sellers", "raw_geolocation"]) + " UNION ALL SELECT 'raw_refunds', false, NULL")
query("mart_build", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in
    ["dim_customers", "dim_products", "fct_order_items", "fct_orders", "fct_deliveries", "fct_freight",
     "mrt_kpis_daily", "mrt_reviews"]) + " UNION ALL SELECT 'order_payments', count(*) FROM pay_profile")
def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_STORED = {"order_payments": "pay_profile"}
_DOCUMENTED = [(t, "", text) for t, text in TABLE_DOCS.items()] + [
    (t, c, text) for t, columns in DOCS.items() for c, text in columns.items()]
query("mart_schema_doc", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {_literal(text)} AS description, count({c or '*'}) AS filled "
    f"FROM {_STORED.get(t, t)}" for t, c, text in _DOCUMENTED))
query("mart_refresh", """
WITH o AS (
  SELECT order_ym, order_id, order_date, is_delivered, CASE WHEN order_ym IN ('1995-06', '1997-01') THEN 2 ELSE 1 END AS times
  FROM stg_orders
), l AS (
  SELECT order_id, sum(CAST(qty * unit_price * times AS DECIMAL(38,6))) AS gmv,
    sum(CAST(qty * unit_price * times - discount_amount AS DECIMAL(38,6))) AS line_net
  FROM stg_order_items JOIN o USING (order_id) GROUP BY order_id
), t AS (
  SELECT o.*, coalesce(l.gmv, 0) AS gmv, l.line_net FROM o LEFT JOIN l USING (order_id)
), d AS (
  SELECT strftime(order_date, '%%Y-%%m') AS order_ym, sum(gmv) AS kpi_gmv FROM t WHERE is_delivered GROUP BY ALL
)
SELECT order_ym, count(*) AS orders, CAST(sum(gmv) AS DOUBLE) AS gmv, CAST(sum(line_net) AS DOUBLE) AS line_net,
  CAST(any_value(kpi_gmv) AS DOUBLE) AS kpi_gmv
FROM t LEFT JOIN d USING (order_ym) GROUP BY order_ym
""".replace("%%", "%"), ["gmv", "line_net", "kpi_gmv"])
query("csv_export", "SELECT * FROM outliers_line", ["distance_km", "freight_pct", "y_hat", "resid", "z_resid"])

query("discontinue_export", *QUERIES["discontinue_candidates"])


def _text_sql(text: str) -> str:
    return f"coalesce('V' || length({text}) || ':' || {text}, 'N')"


def _micros_sql(col: str) -> str:
    """Half up to whole millionths, as in ``present``, written as an integer."""
    return f"CAST(CAST(floor({col} * CAST(1000000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS DECIMAL(38,0)) AS VARCHAR)"


_KPI_TEXT = " || ".join(
    [_text_sql(f"CAST({c} AS VARCHAR)") for c in ("kpi_date", "orders_delivered")]
    + [_text_sql(_micros_sql(c)) for c in ("gmv", "aov", "freight_pct_gmv", "on_time_pct", "late_pct")])
query("kpi_fingerprint", f"""
SELECT count(*) AS rows, CAST(coalesce(sum(CAST('0x' || substr(md5({_KPI_TEXT}), 1, 15) AS BIGINT)), 0) AS VARCHAR)
  AS fingerprint
FROM mrt_kpis_daily""")

# ---------------------------------------------------------------- synthetic mode
query("synth_kpis", "SELECT * FROM s_kpis", ["gmv", "net_revenue", "aov", "cac", "ltv_90d"])
_SYNTH = {t: f"s_{t}" for t in _c.SYNTH_TABLES}
for _key, _names in (
    ("contract_values_synth", ("values",)),
    ("contract_signup_order", ("signup_order",)),
    ("contract_report_synth", ()),
):
    query(_key, _report_sql([c for c in _c.contracts("synth") if not _names or c.check_name in _names], _SYNTH))
