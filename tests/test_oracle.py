"""Every registered query against its DuckDB oracle on the smallest data set."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from orderlake import plans
from tools.check_oracle import TABLES, fingerprint

SF = os.environ.get("ORDERLAKE_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(plans.QUERIES) == set(plans.ORACLE) <= set(entry.queries())
    assert len(plans.QUERIES) >= 69


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    a, b = fingerprint(got), fingerprint(want)
    assert a[1] == b[1], f"columns differ: {a[1]} vs {b[1]}"
    assert a[0] == b[0], f"row counts differ: {a[0]} vs {b[0]}"
    assert a[2] == b[2], f"values differ: {sorted(set(a[3]) ^ set(b[3]))[:4]}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["w_id", "d_id", "c_id", "r_w_id", "r_d_id", "r_c_id"]


def test_entry_imports_without_a_session():
    """The driver imports the entry module before it builds a session."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
