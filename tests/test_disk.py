"""What a query takes of the disk while it runs."""

import os
import time

import pytest

from orderlake.plans.registry import run, tables_for
from orderlake.session import ensure_checkpoint_dir, shuffles_dropped
from orderlake.sources import csv_io, testdata
from orderlake.sources.schema import BASE_SCHEMAS, ORDER

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _csv_folders(spark):
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {d for d, _, names in os.walk(top) if any(".csv" in n for n in names)}


def _shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {x for x in blocks.split("\n") if "/shuffle_" in x}


def test_ingest_holds_one_table_as_csv(spark, monkeypatch):
    """Each table is written, read back and gone before the next one is written."""
    before, held, write = _csv_folders(spark), [], csv_io.write_csv

    def watched(df, path, **options):
        held.append(len(_csv_folders(spark) - before))
        write(df, path, **options)
        assert len(_csv_folders(spark) - before) == 1

    monkeypatch.setattr(csv_io, "write_csv", watched)
    got = run("ingest_base_tables", spark, SF)
    assert held == [0] * len(BASE_SCHEMAS) and _csv_folders(spark) == before
    t = tables_for(spark, SF)
    rows = {r.table_name: r.n_rows for r in got.collect()}
    assert rows == {n: t.base(n).count() for n in BASE_SCHEMAS}


def test_stored_tables_leave_no_shuffle(spark):
    before = _shuffle_files(spark)
    t = testdata.StoredTables(spark, SF)
    assert t.orders.count() and t.order_lines.count() and t.districts.count()
    for _ in range(50):  # deleted in the background
        if not (left := {x for x in _shuffle_files(spark) - before if os.path.getsize(x) > 500}):
            break
        time.sleep(0.2)
    assert not left


def test_shuffles_dropped_puts_the_setting_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        assert spark.conf.get(key) == "true"
        1 / 0
    assert spark.conf.get(key, None) == before


def test_lines_are_the_same_with_suppliers_joined_by_key(spark, monkeypatch):
    few = testdata.Tables(spark, SF).order_lines_keyed.collect()
    monkeypatch.setattr(testdata, "FEW_SUPPLIERS", 0)
    assert sorted(testdata.Tables(spark, SF).order_lines_keyed.collect(), key=str) == sorted(few, key=str)


def test_compressed_csv_comes_back_whole(spark, tmp_path, monkeypatch):
    """Files of few rows, so that many tasks can read what none can split."""
    monkeypatch.setattr(csv_io, "ROWS_A_FILE", 100)
    rows = tables_for(spark, SF).orders.select(*ORDER.fieldNames()).coalesce(1)
    csv_io.write_csv(rows, str(tmp_path / "c"), compression="gzip")
    files = [x for x in os.listdir(tmp_path / "c") if x.startswith("part-")]
    assert len(files) == -(-rows.count() // 100) and all(x.endswith(".csv.gz") for x in files)
    assert sorted(csv_io.read_csv(spark, str(tmp_path / "c"), ORDER).collect(), key=str) == sorted(rows.collect(), key=str)
