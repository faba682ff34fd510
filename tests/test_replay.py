"""Order-dependent operators against plain loops, on random rows with hot keys."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderlake.operators import changes
from orderlake.operators.skew import running_lows
from orderlake.operators.stock import final_stock, stock_trace
from orderlake.sources import txlog
from test_fixtures import orders, table

TS = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("width", [4, 64, 1 << 16])
def test_running_lows(spark, width):
    rnd = random.Random(width)
    rows = [(0 if rnd.random() < 0.5 else rnd.randint(1, 9), s, rnd.randint(-3, 3)) for s in range(400)]
    got = {(r.k, r.s): (r.run, r.low, r.low_before) for r in
           running_lows(spark.createDataFrame(rows, "k int, s long, v int"), ["k"], ["s"], F.col("v"), width=width).collect()}
    run, low, want = defaultdict(int), defaultdict(int), {}
    for k, s, v in rows:
        before = low[k]
        run[k] += v
        low[k] = min(low[k], run[k])
        want[k, s] = (run[k], low[k], before)
    assert got == want


@pytest.mark.parametrize("seed", [1, 2])
def test_delivery_replay_equals_the_loop(spark, seed):
    rnd = random.Random(seed)
    queues, base, next_id = {}, [], {}
    for w in (1, 2):
        for d in range(1, 11):
            n = rnd.choice([0, 0, 1, 3, 8])
            queues[w, d] = [(o, 100 + o) for o in range(1, n + 1) if o % 3]
            base += [(w, d, o, 100 + o, *([] if o % 3 else [7])) for o in range(1, n + 1)]
            next_id[w, d] = n + 1
    requests, arrivals, want = [], [], []
    first = dict(next_id)
    for seq in range(300):
        w = rnd.choice([1, 1, 2])
        if rnd.random() < 0.5:
            d = rnd.choice([1, 1, 1, 2, 3])
            arrivals.append((seq, w, d, next_id[w, d], 500 + seq))
            queues[w, d].append((next_id[w, d], 500 + seq))
            next_id[w, d] += 1
        elif rnd.random() < 0.4:
            requests.append((seq, w, seq % 10, TS))
            for d in range(1, 11):
                got = queues[w, d].pop(0) if queues[w, d] else (None, None)
                want.append((seq, w, d, *got, seq % 10, TS))
    assert any(x[3] is None for x in want)
    districts = table(spark, "districts", [dict(d_w_id=w, d_id=d, d_next_o_id=n) for (w, d), n in first.items()])
    found = changes.delivery_replay(orders(spark, base), spark.createDataFrame(requests, "seq long, w_id int, carrier_id int, delivery_d timestamp_ntz"),
                                    spark.createDataFrame(arrivals, "seq long, o_w_id int, o_d_id int, o_id int, o_c_id long"), districts)
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(want, key=str)


def test_only_the_head_of_the_queue_is_numbered(spark):
    base = spark.range(1, 5001).select(F.lit(1).alias("o_w_id"), F.lit(1).alias("o_d_id"), F.col("id").cast("int").alias("o_id"), F.col("id").alias("o_c_id"),
                                       F.lit(None).cast("int").alias("o_carrier_id"))
    got = changes.oldest_in_queue(base, spark.createDataFrame([(1, 1, 70)], "w_id int, d_id int, most long"), width=64)
    assert sorted(r.o_id for r in got.collect()) == list(range(1, 71)) and got.where("k <> o_id").count() == 0


@pytest.mark.parametrize("width", [4, 1024])
def test_stock_of_any_quantity(spark, width):
    rnd = random.Random(3)
    rows, want, last = [], {}, {}
    for key in range(32):
        q = q0 = rnd.choice([-50, 0, 5, 10, 37, 109, 500])
        low, high = [(0, 50), (0, 400), (60, 130), (-40, 150)][key % 4]
        for s in sorted(rnd.sample(range(400), 1 if key == 0 else rnd.randint(1, 100))):
            x = rnd.randint(low, high)
            q -= x
            if q < 10:
                q += 100
            rows.append((key, s, 1, x, q0))
            want[key, s] = last[key] = q
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, seq long, line_no int, quantity int, q0 int")
    assert {(r.k, r.seq): r.s_quantity_after for r in stock_trace(df, ["k"], ["seq", "line_no"], width=width).collect()} == want
    assert {r.k: r.s_quantity for r in final_stock(df, ["k"], ["seq", "line_no"], width=width).collect()} == last


def test_item_lines_need_numbers(spark, tmp_path):
    (tmp_path / "0.txt").write_text("N,1,1,1,2\n3,1,y\n4,1,5\nN,1,1,1,1\n3,1\nN,1,1,1,0\nN,1,1,1,-1\nN,1,1,1,1\n3,1,2\n")
    parsed = txlog.parse_scripts(txlog.read_script_lines(spark, str(tmp_path)))
    valid, rejects = txlog.transactions(parsed)
    assert sorted((r.line_no, r.n_items) for r in valid.collect()) == [(6, 0), (8, 1)]
    assert sorted((r.line_no, r.reason) for r in rejects.collect()) == [
        (1, "incomplete_order"), (2, "bad_number"), (4, "incomplete_order"), (5, "short_record"), (7, "bad_number")]
    lines = txlog.request_tables(valid, parsed)["new_lines"]
    assert [(r.i_id, r.quantity) for r in lines.collect()] == [(3, 2)]


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    import os

    from orderlake.sources import versions
    path = f"{tmp_path}/orders"
    versions.write_partitioned(orders(spark, [(w, 1, k, 5) for w in (1, 2, 3) for k in (1, 2)]), path, ["o_w_id"])
    before = {w: sorted(os.listdir(f"{path}/o_w_id={w}")) for w in (1, 2, 3)}
    dl = spark.createDataFrame([(2, 1, 2, 9)], "w_id int, d_id int, o_id int, carrier_id int")
    versions.rewrite_touched(spark, path, dl.select(F.col("w_id").alias("o_w_id")), ["o_w_id"], lambda old: changes.deliver_orders(old, dl))
    after = {w: sorted(os.listdir(f"{path}/o_w_id={w}")) for w in (1, 2, 3)}
    assert after[1] == before[1] and after[3] == before[3] and after[2] != before[2]
    rows = {(r.o_w_id, r.o_id): r.o_carrier_id for r in spark.read.parquet(path).collect()}
    assert rows == {(w, k): 9 if (w, k) == (2, 2) else None for w in (1, 2, 3) for k in (1, 2)}
