"""Invariants of the change operators on the smallest driver data set
"""

import os

import pytest
from pyspark.sql import functions as F

from orderlake.operators import changes
from orderlake.plans.registry import SPLIT, run, tables_for
from orderlake.sources.schema import PRIMARY_KEYS

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _sum(df, c):
    return df.agg(F.sum(c)).first()[0] or 0


def test_payment_deltas_agree(spark):
    t = tables_for(spark, SF)
    p = t.payment_requests
    paid = _sum(p, "amount")
    dw = _sum(changes.payment_warehouses(t.warehouses, p), "w_ytd") - _sum(t.warehouses, "w_ytd")
    dd = _sum(changes.payment_districts(t.districts, p), "d_ytd") - _sum(t.districts, "d_ytd")
    nc = changes.payment_customers(t.customers, p)
    dc = _sum(nc, "c_ytd_payment") - _sum(t.customers, "c_ytd_payment")
    db = _sum(t.customers, "c_balance") - _sum(nc, "c_balance")
    assert paid > 0 and dw == dd == dc == db == paid
    assert _sum(nc, "c_payment_cnt") == p.count()


def test_new_order_invariants(spark):
    t = tables_for(spark, SF, split=True)
    req, lr = t.new_order_requests, t.new_order_line_requests
    nd = changes.new_order_districts(t.districts, req)
    assert _sum(nd, "d_next_o_id") - _sum(t.districts, "d_next_o_id") == req.count()
    h = changes.new_order_headers(req, lr, t.districts, t.items, t.stocks)
    accepted = changes.new_order_checked_lines(lr, req, t.items, t.stocks).filter("accepted")
    ns = changes.new_order_stock(t.stocks, lr, req, t.items)
    assert _sum(ns, "s_ytd") - _sum(t.stocks, "s_ytd") == _sum(accepted, "quantity")
    assert _sum(ns, "s_order_cnt") == accepted.count() == _sum(h, "o_ol_cnt")
    # every stock stays at or above the floor after refills
    assert ns.filter("s_quantity < 10").count() == 0
    # new order numbers continue each district without gaps or clashes
    merged = changes.insert_if_absent(t.orders, h, ["o_w_id", "o_d_id", "o_id"])
    assert merged.count() == t.orders.count() + req.count()
    assert merged.groupBy(*PRIMARY_KEYS["orders"]).count().filter("count > 1").count() == 0


def test_delivery_invariants(spark):
    t = tables_for(spark, SF)
    dl = changes.delivered_orders(t.orders, t.delivery_requests)
    n = dl.count()
    q0 = t.orders.filter("o_carrier_id IS NULL").count()
    assert changes.deliver_remaining_queue(t.orders, dl).count() == q0 - n
    assert dl.join(changes.deliver_remaining_queue(t.orders, dl).withColumnRenamed("o_w_id", "w_id")
                   .withColumnRenamed("o_d_id", "d_id"), ["w_id", "d_id", "o_id"]).count() == 0
    nc = changes.deliver_customers(t.customers, t.order_lines, dl)
    assert _sum(nc, "c_delivery_cnt") == n
    no = changes.deliver_orders(t.orders, dl)
    assert no.filter("o_carrier_id IS NULL").count() == q0 - n
    # at most one delivered order per district per request, and warehouses with three requests deliver three
    assert dl.groupBy("seq", "w_id", "d_id").count().filter("count > 1").count() == 0
    assert dl.groupBy("w_id", "d_id").count().filter("count > 3").count() == 0
    assert dl.groupBy("w_id", "d_id").count().filter("count > 1").count() > 0


def test_whole_batch_invariants(spark):
    t = tables_for(spark, SF, split=True)
    base = {n: t.base(n) for n in ("warehouses", "districts", "customers", "orders", "order_lines",
                                   "items", "stocks")}
    new = changes.apply_batch(base, t.payment_requests, t.new_order_requests, t.new_order_line_requests,
                              t.delivery_requests)
    n_new, n_pay = t.new_order_requests.count(), t.payment_requests.count()
    assert _sum(new["districts"], "d_next_o_id") - _sum(base["districts"], "d_next_o_id") == n_new
    assert new["orders"].count() == base["orders"].count() + n_new
    assert new["orders"].groupBy(*PRIMARY_KEYS["orders"]).count().filter("count > 1").count() == 0
    assert _sum(new["customers"], "c_payment_cnt") == n_pay
    paid = _sum(t.payment_requests, "amount")
    assert _sum(new["warehouses"], "w_ytd") - _sum(base["warehouses"], "w_ytd") == paid
    assert _sum(new["districts"], "d_ytd") - _sum(base["districts"], "d_ytd") == paid
    n_del = _sum(new["customers"], "c_delivery_cnt")
    # one order per district per Delivery request at most
    assert 0 < n_del <= 10 * t.delivery_requests.count()
    undelivered_before = base["orders"].filter("o_carrier_id IS NULL").count() + n_new
    assert new["orders"].filter("o_carrier_id IS NULL").count() == undelivered_before - n_del
    assert new["stocks"].filter("s_quantity < 10").count() == 0


def test_repeated_requests_get_the_same_answer(spark):
    from orderlake.operators import reads
    t = tables_for(spark, SF)
    for count_lines, out in ((False, "low_stock_count"), (True, "low_stock_lines")):
        once = t.stock_level_requests.dropDuplicates(["w_id", "d_id", "threshold", "last_l"])
        a = {(r.w_id, r.d_id): r[out] for r in reads.stock_level(once, t.districts, t.order_lines, t.stocks, count_lines).collect()}
        rows = reads.stock_level(t.stock_level_requests, t.districts, t.order_lines, t.stocks, count_lines).collect()
        assert len(rows) == t.stock_level_requests.count() > len(a)
        assert all(r[out] == a[r.w_id, r.d_id] for r in rows)


def test_script_order_status_reads_all_orders(spark):
    """Each customer's last order, those included that New-Order queries hold back."""
    t = tables_for(spark, SF)
    last = {tuple(r) for r in t.orders.groupBy("o_w_id", "o_d_id", "o_c_id").agg(F.max("o_id")).collect()}
    got = run("script_order_status", spark, SF).select("w_id", "d_id", "c_id", "o_id").distinct().collect()
    assert {tuple(r) for r in got} == last


@pytest.mark.parametrize("name", ["script_order_status", "script_stock_level", "script_popular_items", "script_related_customers", "script_top_balance"])
def test_script_reads_hold_no_orders_back(name):
    assert name not in SPLIT


def test_stored_tables_come_back_when_the_folder_is_cleared(spark):
    import shutil
    t = tables_for(spark, SF, split=True)
    n = t.districts.count()
    assert tables_for(spark, SF, split=True) is t and t.districts.inputFiles()[0].count("tables-")
    shutil.rmtree(t.folder.removeprefix("file:"))
    again = tables_for(spark, SF, split=True)
    assert again is not t and again.districts.count() == n
