"""Command line: ``python -m emporia {ingest,quality,build} ...``.

* ``ingest``  load the source CSV files of a mode and print rows per table
  (exit 2 when an expected file is missing);
* ``quality`` run the data contracts and print the failures (exit 2 if any);
* ``build``   materialise core tables and marts, run the model tests and keep
  their failing rows (exit 2 if an error-severity test fails).

Inputs come either from a folder of source CSV files (``--data-dir``) or from
the test tables (``--testdata SF_DIR``). Nothing but small reports reaches
the driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from emporia.session import configure


def _raw(spark: SparkSession, args) -> dict:
    if args.testdata:
        if args.mode == "synth":
            from emporia.sources import synthetic

            return synthetic.load_raw(spark, args.testdata)
        from emporia.sources import testdata

        return testdata.load_raw(spark, args.testdata)
    from emporia.sources import csv

    mapping = csv.OLIST_FILES if args.mode == "real" else csv.SYNTH_FILES
    schemas = csv.RAW_SCHEMAS if args.mode == "real" else csv.SYNTH_SCHEMAS
    tables = csv.ingest_folder(spark, args.data_dir, mapping, schemas)
    csv.register_raw(tables)
    return tables


def cmd_ingest(spark, args) -> int:
    from emporia.sources import csv

    for r in csv.ingest_summary(_raw(spark, args)).collect():
        print(f"{r.table_name:<24} rows={r.rows:,}")
    return 0


def cmd_quality(spark, args) -> int:
    from emporia.operators import contracts

    report = contracts.run_checks(spark, _raw(spark, args), contracts.contracts(args.mode))
    failed = contracts.failures(report).collect()
    for i, r in enumerate(failed, 1):
        print(f" {i:02d}. {r.check_name} {r.table_name} [{r.detail}] violations={r.violations}")
    print("contracts passed" if not failed else f"{len(failed)} contract(s) failed")
    return 2 if failed else 0


def cmd_build(spark, args) -> int:
    from emporia.operators import contracts
    from emporia.plans.build import materialize, store_test_failures
    from emporia.plans.warehouse import Warehouse

    wh = Warehouse(_raw(spark, args))
    paths = materialize(wh, args.out)
    for name, path in paths.items():
        print(f"{name:<18} {path}")
    if args.mode == "synth":
        return 0  # the model tests are those of the real mode's tables
    failures = store_test_failures(wh, args.out)
    results = contracts.results_of(failures).filter("status != 'pass'").collect()
    for r in results:
        print(f" {r.status.upper():<4} {r.model}.{r.column_name} {r.test} {r.arg} failures={r.failures}")
    print(f"failing rows kept in {args.out.rstrip('/')}/test_failures")
    return 2 if any(r.status == "fail" for r in results) else 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="emporia")
    p.add_argument("command", choices=["ingest", "quality", "build"])
    p.add_argument("--mode", choices=["real", "synth"], default="real")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--data-dir", help="folder with the source CSV files of the mode")
    src.add_argument("--testdata", help="folder with the test parquet tables")
    p.add_argument("--out", help="output folder of the build (shared storage)")
    args = p.parse_args(argv)
    if args.command == "build" and not args.out:
        p.error("build needs --out")
    spark = configure(spark or SparkSession.builder.appName(f"emporia-{args.command}").getOrCreate())
    try:
        return {"ingest": cmd_ingest, "quality": cmd_quality, "build": cmd_build}[args.command](spark, args)
    except FileNotFoundError as e:
        print(f"[ERROR] {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
