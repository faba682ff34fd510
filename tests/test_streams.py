"""Streams over files in any order, against the batch result."""

import datetime as dt
import math
import os
import random
from collections import defaultdict
from decimal import Decimal

import pytest

from orderlake.operators import upkeep
from orderlake.sources.schema import BASE_SCHEMAS
from orderlake.streaming import streams
from test_fixtures import lines, orders, table

DAY = dt.datetime(2024, 1, 1)


def write_events(spark, place, files):
    for n, rows in enumerate(files):
        spark.createDataFrame(rows, streams.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{place}/events.parquet")


@pytest.mark.parametrize("order", ["oldest", "newest", "mixed", "one"])
def test_no_event_is_lost_in_any_file_order(spark, tmp_path, order):
    rnd = random.Random(1)
    rows = [(i, DAY + dt.timedelta(hours=6 * i), i % 3, "view", round(rnd.uniform(-5, 900), 2), None) for i in range(40)]
    files = {"oldest": [rows[k:k + 10] for k in range(0, 40, 10)], "newest": [rows[k:k + 10] for k in (30, 20, 10, 0)],
             "mixed": [rows[k::4] for k in (2, 0, 3, 1)], "one": [rows]}[order]
    write_events(spark, tmp_path, files)
    got = streams.stream_window_latency(spark, str(tmp_path), location=f"{tmp_path}/state", files_per_batch=1).collect()
    want = defaultdict(list)
    for r in rows:
        want[r[1].replace(hour=0), r[2] % 20].append(r[4])
    assert {(r.window_start, r.client): (r.n_txn, r.max_latency_ms) for r in got} == {k: (len(v), max(v)) for k, v in want.items()}
    assert sum(r.n_txn for r in got) == 40


def test_window_quantiles_are_within_their_error(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i, DAY, 0 if i % 2 else rnd.randint(1, 4), "view", round(rnd.choice([rnd.uniform(0, 1), rnd.lognormvariate(5, 3), -rnd.random() * 10]), 4), None)
            for i in range(4000)]
    write_events(spark, tmp_path, [rows[k::3] for k in range(3)])
    values = defaultdict(list)
    for r in rows:
        values[r[2]].append(round(r[4] * 10**6))
    for r in streams.stream_window_quantiles(spark, str(tmp_path), location=f"{tmp_path}/state", files_per_batch=1).collect():
        own = sorted(values[r.client])
        for p in (50, 95, 99):
            exact = own[math.ceil(len(own) * p / 100) - 1]
            assert abs(r[f"p{p}_ns"] - exact) <= abs(exact) / 256 + 1


def customers(spark, n, rnd):
    return table(spark, "customers", [dict(c_w_id=i % 3, c_d_id=1, c_id=i, c_first="a", c_middle="OE", c_last=f"n{i}",
                                           c_balance=Decimal(rnd.randint(0, 400))) for i in range(n)])


def test_top_balances_are_kept_under_falls_and_rises(spark, tmp_path):
    rnd = random.Random(3)
    cu = customers(spark, 90, rnd)
    wh = table(spark, "warehouses", [dict(w_id=w, w_name=f"w{w}") for w in range(3)])
    di = table(spark, "districts", [dict(d_w_id=w, d_id=1, d_name="d") for w in range(3)])
    balance = {r.c_id: r.c_balance for r in cu.collect()}
    home = {r.c_id: r.c_w_id for r in cu.collect()}
    rank = lambda: [c for _, _, _, c in sorted((-b, home[c], 1, c) for c, b in balance.items())][:4]
    for batch in range(5):
        leaders = [c for _, c in sorted(((-b, c) for c, b in balance.items()))[:12]]
        rows = [(i, DAY, rnd.choice(leaders), "purchase", float(rnd.randint(50, 200)), None) for i in range(12)]
        rows += [(i, DAY, rnd.randrange(90), "purchase", -float(rnd.randint(0, 300)), None) for i in range(2 if batch % 2 else 0)]
        write_events(spark, tmp_path, [rows])
        for r in rows:
            balance[r[2]] -= Decimal(r[4])
        got = streams.stream_top_balance(spark, str(tmp_path), cu, di, wh, k=4, location=f"{tmp_path}/state", files_per_batch=1, spare=2)
        assert [r.c_id for r in got.orderBy("rank").collect()] == rank()
    assert len([d for d in os.listdir(f"{tmp_path}/state/top")]) <= 3  # older versions go


def test_kept_rows_only_change_in_a_batch(spark, tmp_path):
    """As long as no list runs dry the customer table isn't read again."""
    rnd = random.Random(4)
    cu = customers(spark, 60, rnd)
    wh = table(spark, "warehouses", [dict(w_id=w, w_name=f"w{w}") for w in range(3)])
    di = table(spark, "districts", [dict(d_w_id=w, d_id=1, d_name="d") for w in range(3)])
    path = f"{tmp_path}/customers"
    cu.write.parquet(path)
    place = f"{tmp_path}/state"
    write_events(spark, tmp_path, [[(1, DAY, 0, "purchase", 1.0, None)]])
    streams.stream_top_balance(spark, str(tmp_path), spark.read.parquet(path), di, wh, k=2, location=place)
    unread = spark.read.schema(BASE_SCHEMAS["customers"]).parquet(path)
    for f in os.listdir(path):
        os.remove(f"{path}/{f}")
    write_events(spark, tmp_path, [[(2, DAY, 3, "purchase", 1.0, None)]])
    assert streams.stream_top_balance(spark, str(tmp_path), unread, di, wh, k=2, location=place).count() == 2


def test_new_orders_in_several_batches(spark, tmp_path):
    di = table(spark, "districts", [dict(d_w_id=1, d_id=d, d_next_o_id=10 * d) for d in (1, 2)])
    it = table(spark, "items", [dict(i_id=i, i_name="x", i_price=Decimal("2.00")) for i in (1, 2)])
    st = table(spark, "stocks", [dict(s_w_id=1, s_i_id=i, s_quantity=q) for i, q in ((1, 12), (2, 4))])
    rnd = random.Random(5)
    next_id, stock, want, place = {1: 10, 2: 20}, {1: 12, 2: 4}, {}, f"{tmp_path}/state"
    seq, numbered = 0, None
    for batch in range(3):
        rows = []
        for _ in range(6):
            seq, d = seq + 1, rnd.choice([1, 1, 2])
            own = [(n, rnd.choice([1, 2, 3]), 1, rnd.randint(1, 150)) for n in range(1, rnd.randint(1, 4))]
            rows.append((seq, 1, d, 5, DAY, own))
            want[seq] = (d, next_id[d], sum(x[1] != 3 for x in own))
            next_id[d] += 1
            for _, i, _, q in own:
                if i != 3:
                    stock[i] -= q
                    stock[i] += 100 if stock[i] < 10 else 0
        spark.createDataFrame(rows, streams.ORDERS_SCHEMA).write.mode("append").parquet(f"{tmp_path}/feed")
        numbered, stocks = streams.stream_new_orders(spark, f"{tmp_path}/feed", di, it, st, location=place)
    assert {r.seq: (r.o_d_id, r.o_id, r.o_ol_cnt) for r in numbered.collect()} == want
    assert {r.s_i_id: r.s_quantity for r in stocks.collect()} == stock


# --- stored derived tables


def test_only_touched_partitions_are_written(spark, tmp_path):
    o = orders(spark, [(w, 1, k, 7) for w in (1, 2, 3) for k in (1, 2)])
    ol = lines(spark, [(1, 1, 10, 1), (1, 2, 10, 1), (1, 3, 11, 1), (2, 1, 12, 1)], w=1)
    ol = ol.unionByName(lines(spark, [(1, 1, 10, 1)], w=2)).unionByName(lines(spark, [(2, 1, 10, 1)], w=3))
    path = f"{tmp_path}/items"
    upkeep.store(upkeep.customer_order_items(o, ol), path, ["w_id"])
    stamp = {w: sorted(os.listdir(f"{path}/w_id={w}")) for w in (1, 2, 3)}
    rows = lambda: sorted((r.w_id, r.o_id, r.i_id) for r in upkeep.read(spark, path).collect())
    full = [(1, 1, 10), (1, 1, 11), (1, 2, 12), (2, 1, 10), (3, 2, 10)]
    assert rows() == full
    gone = lambda cond: upkeep.customer_order_items_delta(o, None, ol, upkeep.went(ol.where(cond)))
    # one of two lines with item 10: the item stays
    upkeep.apply(spark, path, gone("ol_w_id = 1 and ol_o_id = 1 and ol_number = 1"), ["w_id"])
    assert rows() == full
    # the other one: it goes; the last row of a partition goes too
    upkeep.apply(spark, path, gone("ol_w_id = 1 and ol_o_id = 1 and ol_number = 2 or ol_w_id = 2"), ["w_id"])
    assert rows() == [(1, 1, 11), (1, 2, 12), (3, 2, 10)]
    after = {w: sorted(os.listdir(f"{path}/w_id={w}")) for w in (1, 2, 3)}
    assert after[1] != stamp[1] and after[2] != stamp[2] and after[3] == stamp[3]
    # what goes and comes touches nothing
    both = gone("ol_w_id = 3").unionByName(upkeep.customer_order_items_delta(o, None, ol, upkeep.came(ol.where("ol_w_id = 3"))))
    assert upkeep.apply(spark, path, both, ["w_id"]).count() == 0
    # and a row can come again to an empty partition
    upkeep.apply(spark, path, upkeep.customer_order_items_delta(o, None, ol, upkeep.came(ol.where("ol_w_id = 2"))), ["w_id"])
    assert rows() == [(1, 1, 11), (1, 2, 12), (2, 1, 10), (3, 2, 10)]


def test_both_sides_of_a_join_change(spark, tmp_path):
    rnd = random.Random(6)
    o = orders(spark, [(1, 1, k, k % 4) for k in range(1, 20)])
    ol = lines(spark, [(rnd.randint(1, 19), n, rnd.randint(1, 5), 1) for n in range(40)])
    d_o = upkeep.went(o.where("o_id % 5 = 0")).unionByName(upkeep.came(orders(spark, [(1, 1, k, 9) for k in (20, 21)])))
    d_l = upkeep.went(ol.where("ol_number % 4 = 0")).unionByName(upkeep.came(lines(spark, [(20, 1, 3, 1), (21, 1, 3, 1), (7, 90, 5, 1)])))
    path = f"{tmp_path}/items"
    upkeep.store(upkeep.customer_order_items(o, ol), path, ["w_id"])
    upkeep.apply(spark, path, upkeep.customer_order_items_delta(o, d_o, ol, d_l), ["w_id"])
    new_o = o.where("o_id % 5 <> 0").unionByName(d_o.where("weight = 1").drop("weight"))
    new_l = ol.where("ol_number % 4 <> 0").unionByName(d_l.where("weight = 1").drop("weight"))
    want = upkeep.customer_order_items(new_o, new_l).distinct()
    got = upkeep.read(spark, path).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
