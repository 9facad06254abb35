"""Print the physical plans of the headline queries over a materialised build.

Usage: python tools/show_plans.py [sf_dir]
Shows the operator tree and the scan lines (PushedFilters, PartitionFilters,
ReadSchema) for each query; ``--no-broadcast`` disables broadcast joins to
show the shuffle plan a large cluster would run.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from emporia.operators import category, kpis, payments, regression  # noqa: E402
from emporia.plans.build import materialize, new_build_dir  # noqa: E402
from emporia.plans.warehouse import Warehouse  # noqa: E402
from emporia.session import local_session  # noqa: E402


def show(name, df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    print(f"===== {name}")
    print(text.split("\n\n")[0])
    for line in text.split("\n"):
        if any(k in line for k in ("PushedFilters", "PartitionFilters", "ReadSchema")):
            print("   ", line.strip()[:240])


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session()
    wh = Warehouse.from_testdata(spark, sf)
    materialize(wh, new_build_dir(wh, "plans"))
    if "--no-broadcast" in sys.argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    pts = regression.freight_points_line(wh.fct_freight)
    show("kpi_window", kpis.kpi_window(wh.mrt_kpis_daily, 180))
    show("category_rollup", category.category_rollup(wh.lines, wh.orders_with_items, wh.stg_products))
    show("payment_orders", payments.payment_orders(wh.fct_orders, wh.payments_base))
    show("ols_score", regression.ols_score(pts, regression.ols_fit(pts)))


if __name__ == "__main__":
    main()
