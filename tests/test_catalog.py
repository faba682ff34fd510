"""Catalog tables: create, bulk load, bucketed join without a shuffle, drop."""

import os

import pytest

from orderlake.operators import derived
from orderlake.plans.registry import tables_for
from orderlake.sources import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    db = "orderlake_test"
    names = catalog.create_base_tables(spark, str(tmp_path / "wh"), db, bucketed=True, buckets=4)
    assert len(names) == 7
    t = tables_for(spark, SF)
    for n in ("orders", "order_lines", "customers"):
        catalog.load_table(t.base(n), db, n)
    o, ol = spark.table(f"{db}.orders"), spark.table(f"{db}.order_lines")
    assert o.count() == t.orders.count() and ol.count() == t.order_lines.count()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = o.join(ol, (o.o_w_id == ol.ol_w_id) & (o.o_d_id == ol.ol_d_id) & (o.o_id == ol.ol_o_id))
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert derived.order_amounts(ol).count() == derived.order_amounts(t.order_lines).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert catalog.drop_tables(spark, db) == 7
    assert spark.catalog.listTables(db) == []
