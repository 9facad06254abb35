"""Benchmark: full build of core tables and marts, then the analyses on them.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line. Every timed step runs its whole plan: builds write
Parquet, analyses are executed into Spark's ``noop`` sink (computed, not
collected).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from emporia.operators import category, contracts, delivery, kpis, payments, regression  # noqa: E402
from emporia.plans.build import materialize, new_build_dir, persist_frame  # noqa: E402
from emporia.plans.warehouse import Warehouse  # noqa: E402
from emporia.session import local_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8), app="emporia-bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    wh = Warehouse.from_testdata(spark, sf_dir)
    out = new_build_dir(wh, "bench")
    timed("full_build", lambda: materialize(wh, out))

    kp, rv = wh.mrt_kpis_daily, wh.mrt_reviews
    timed("kpi_window", lambda: run(kpis.kpi_window(kp, 180)))
    timed("kpi_alerts", lambda: run(kpis.kpi_alerts(kp, rv, 180)))
    timed("lead_time_hist", lambda: run(delivery.lead_time_hist(wh.fct_deliveries)))
    timed("delay_penalty", lambda: run(delivery.delay_penalty_overall(wh.stg_reviews, wh.fct_deliveries)))

    def freight():
        pts = regression.freight_points_line(wh.fct_freight)
        model = regression.ols_fit(pts)
        scored = regression.ols_score(pts, model)
        run(regression.outlier_lanes(scored))
        run(regression.ols_summary(scored, model))

    timed("freight_regression", freight)

    def categories():
        # one row per category, read by both analyses
        rollup = category.category_rollup(wh.lines, wh.orders_with_items, wh.stg_products)
        m = persist_frame(category.category_metrics(rollup), "bench-categories")
        run(category.category_ranks(m))
        run(category.discontinue_candidates(m, 12.0, 0.90))

    timed("category_explorer", categories)

    def pay():
        po = persist_frame(payments.payment_orders(wh.fct_orders, profile=wh.order_payments), "bench-payments")
        run(payments.payment_insights(po))
        run(payments.aov_by_method(po))

    timed("payments", pay)
    timed("contracts_real", lambda: run(contracts.run_checks(spark, wh.raw, contracts.contracts("real"))))
    models = {name: getattr(wh, name) for name in contracts.MODEL_KEYS}
    timed("model_tests", lambda: run(contracts.run_model_tests(models)))

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "full_build_plus_analyses", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
