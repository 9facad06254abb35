from emporia.__main__ import main
from emporia.plans.build import new_build_dir
from emporia.plans.warehouse import Warehouse
from tests.conftest import SF_SMALL


def test_quality_reports_planted_violations(spark, capsys):
    # the test tables carry NULL statuses: the essential-nulls contract fails
    assert main(["quality", "--testdata", SF_SMALL], spark) == 2
    assert "essential_nulls raw_orders" in capsys.readouterr().out
    assert main(["quality", "--mode", "synth", "--testdata", SF_SMALL], spark) == 2


def test_ingest_missing_folder_exits_2(spark, tmp_path):
    assert main(["ingest", "--data-dir", str(tmp_path / "nope")], spark) == 2


def test_build_writes_marts(spark, capsys):
    out = new_build_dir(Warehouse.from_testdata(spark, SF_SMALL), "cli")
    code = main(["build", "--testdata", SF_SMALL, "--out", out], spark)
    text = capsys.readouterr().out
    assert "mrt_kpis_daily" in text and "failing rows kept in" in text
    assert code == 2  # zero-price lines with a discount fail the line_net expression test


def test_csv_folder_ingest_and_quality(spark, capsys):
    from emporia.sources import csv, sinks, testdata

    raw = testdata.load_raw(spark, SF_SMALL)
    folder = new_build_dir(Warehouse(raw), "cli-csv")
    for fname, table in csv.OLIST_FILES.items():
        sinks.write_csv(raw[table], f"{folder}/{fname}")
    assert main(["ingest", "--data-dir", folder], spark) == 0
    out = capsys.readouterr().out
    assert "raw_order_items" in out and "TOTAL" in out
    assert main(["quality", "--data-dir", folder], spark) == 2  # planted NULL statuses
