"""Hand-sized fixtures, one per behaviour decision (FIXTURES.md section 4)."""

import datetime as dt
import os
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlake.operators import changes, derived, metrics, reads
from orderlake.sources import csv_io, txlog
from orderlake.sources.schema import BASE_SCHEMAS, ORDER

TS = dt.datetime(2024, 1, 1)


def table(spark, name, rows):
    schema = BASE_SCHEMAS[name]
    full = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(full, schema)


def lines(spark, specs, w=1, d=1):
    """specs: (o_id, ol_number, i_id, quantity[, supply_w])"""
    return table(spark, "order_lines", [
        dict(ol_w_id=w, ol_d_id=d, ol_o_id=o, ol_number=n, ol_i_id=i, ol_quantity=q,
             ol_supply_w_id=(s[0] if s else w), ol_amount=Decimal("1.00"))
        for o, n, i, q, *s in specs])


def orders(spark, specs):
    """specs: (w, d, o_id, c_id[, carrier])"""
    return table(spark, "orders", [
        dict(o_w_id=w, o_d_id=d, o_id=o, o_c_id=c, o_carrier_id=(rest[0] if rest else None),
             o_ol_cnt=1, o_all_local=1, o_entry_d=TS)
        for w, d, o, c, *rest in specs])


# ------------------------------------------------------------ Popular-Item


def test_popular_ties_max_min_all(spark):
    ol = lines(spark, [(1, 1, 10, 5), (1, 2, 11, 9), (1, 3, 12, 9), (1, 4, 13, 2)])
    got = {m: sorted(r.ol_i_id for r in derived.popular_lines(ol, m).collect()) for m in ("max", "min", "all")}
    assert got == {"max": [11, 12], "min": [13], "all": [10, 11, 12, 13]}


def test_popular_denominator(spark):
    o = orders(spark, [(1, 1, 1, 1), (1, 1, 2, 1), (1, 1, 3, 1)])
    ol = lines(spark, [(1, 1, 7, 5), (2, 1, 7, 5), (3, 1, 8, 5)])
    d = table(spark, "districts", [dict(d_w_id=1, d_id=1, d_next_o_id=4)])
    it = table(spark, "items", [dict(i_id=7, i_name="seven"), dict(i_id=8, i_name="eight")])
    req = spark.createDataFrame([(1, 1, 10)], "w_id int, d_id int, last_l int")
    by_found = {r.i_id: r.pct for r in reads.popular_items_pct(req, d, o, ol, it).collect()}
    by_l = {r.i_id: r.pct for r in reads.popular_items_pct(req, d, o, ol, it, denominator="L").collect()}
    assert by_found[7] == Decimal("66.67") and by_l[7] == Decimal("20.00")


# ------------------------------------------------------------- Stock-Level


def test_stock_level_distinct_vs_lines(spark):
    ol = lines(spark, [(1, 1, 7, 5), (1, 2, 7, 5), (1, 3, 8, 5)])
    d = table(spark, "districts", [dict(d_w_id=1, d_id=1, d_next_o_id=2)])
    st = table(spark, "stocks", [dict(s_w_id=1, s_i_id=7, s_quantity=5), dict(s_w_id=1, s_i_id=8, s_quantity=50)])
    req = spark.createDataFrame([(1, 1, 10, 5)], "w_id int, d_id int, threshold int, last_l int")
    assert reads.stock_level(req, d, ol, st).first().low_stock_count == 1
    assert reads.stock_level(req, d, ol, st, count_lines=True).first().low_stock_lines == 2


# --------------------------------------------------------------- New-Order


def _new_order_world(spark, stock_rows=None):
    wh = table(spark, "warehouses", [dict(w_id=1, w_tax=Decimal("0.0500"), w_ytd=Decimal("0")),
                                     dict(w_id=2, w_tax=Decimal("0.0100"), w_ytd=Decimal("0"))])
    di = table(spark, "districts", [dict(d_w_id=1, d_id=1, d_tax=Decimal("0.1000"), d_next_o_id=100)])
    cu = table(spark, "customers", [dict(c_w_id=1, c_d_id=1, c_id=5, c_discount=Decimal("0.1000"),
                                         c_balance=Decimal("0"))])
    it = table(spark, "items", [dict(i_id=i, i_name=f"item{i}", i_price=Decimal("10.01")) for i in (1, 2, 3)])
    st = table(spark, "stocks", stock_rows or [
        dict(s_w_id=w, s_i_id=i, s_quantity=12, s_ytd=Decimal("0"), s_order_cnt=0, s_remote_cnt=0)
        for w in (1, 2) for i in (1, 2, 3)])
    return wh, di, cu, it, st


def test_new_order_counts_and_total(spark):
    wh, di, cu, it, st = _new_order_world(spark)
    req = spark.createDataFrame([(1, 1, 1, 5, TS)], "seq long, w_id int, d_id int, c_id long, entry_d timestamp_ntz")
    lr = spark.createDataFrame([(1, 1, 1, 1, 3), (1, 2, 2, 2, 4), (1, 3, 3, 1, 5)],
                               "seq long, line_no int, i_id long, supply_w_id int, quantity int")
    h = changes.new_order_headers(req, lr, di, it, st).first()
    assert (h.o_id, h.o_ol_cnt, h.o_all_local, h.total_quantity) == (100, 3, 0, 12)
    nl = changes.new_order_lines(changes.new_order_headers(req, lr, di, it, st), lr, req, it, st)
    tot = changes.new_order_totals(changes.new_order_headers(req, lr, di, it, st), nl, wh, di, cu).first()
    amount = Decimal("10.01") * 12
    expect = (amount * Decimal("1.15") * Decimal("0.90")).quantize(Decimal("0.01"), "ROUND_HALF_EVEN")
    assert tot.total_amount == expect


def test_new_order_numbers_follow_request_order(spark):
    wh, di, cu, it, st = _new_order_world(spark)
    req = spark.createDataFrame([(30, 1, 1, 5, TS), (10, 1, 1, 5, TS), (20, 1, 1, 5, TS)],
                                "seq long, w_id int, d_id int, c_id long, entry_d timestamp_ntz")
    lr = spark.createDataFrame([], "seq long, line_no int, i_id long, supply_w_id int, quantity int")
    got = {r.seq: r.o_id for r in changes.new_order_headers(req, lr, di, it, st).collect()}
    assert got == {10: 100, 20: 101, 30: 102}
    nd = changes.new_order_districts(di, req).first()
    assert nd.d_next_o_id == 103


def test_missing_stock_row_is_rejected(spark):
    wh, di, cu, it, st = _new_order_world(spark, [dict(s_w_id=1, s_i_id=1, s_quantity=50)])
    req = spark.createDataFrame([(1, 1, 1, 5, TS)], "seq long, w_id int, d_id int, c_id long, entry_d timestamp_ntz")
    lr = spark.createDataFrame([(1, 1, 1, 1, 3), (1, 2, 2, 1, 4)],
                               "seq long, line_no int, i_id long, supply_w_id int, quantity int")
    chk = {r.line_no: r.accepted for r in changes.new_order_checked_lines(lr, req, it, st).collect()}
    assert chk == {1: True, 2: False}
    assert changes.new_order_headers(req, lr, di, it, st).first().o_ol_cnt == 1


def test_stock_refill_trace(spark):
    wh, di, cu, it, st = _new_order_world(spark)
    req = spark.createDataFrame([(s, 1, 1, 5, TS) for s in (1, 2, 3)],
                                "seq long, w_id int, d_id int, c_id long, entry_d timestamp_ntz")
    lr = spark.createDataFrame([(1, 1, 1, 1, 5), (2, 1, 1, 1, 90), (3, 1, 1, 1, 99)],
                               "seq long, line_no int, i_id long, supply_w_id int, quantity int")
    trace = [r.s_quantity_after for r in
             changes.new_order_stock_trace(lr, req, it, st).orderBy("seq").collect()]
    assert trace == [107, 17, 18]
    final = changes.new_order_stock(st, lr, req, it).filter("s_w_id = 1 AND s_i_id = 1").first()
    assert (final.s_quantity, final.s_order_cnt, final.s_ytd) == (18, 3, Decimal("194.00"))


def _fold(q0, xs):
    out = []
    for x in xs:
        q0 -= x
        if q0 < 10:
            q0 += 100
        out.append(q0)
    return out


def test_closed_form_fold_matches_loop(spark):
    import random
    rnd = random.Random(7)
    rows, expect = [], {}
    for key in range(300):
        q0 = rnd.randint(10, 100)
        xs = [rnd.randint(1, 50) for _ in range(rnd.randint(1, 12))]
        for k, (x, q) in enumerate(zip(xs, _fold(q0, xs))):
            rows.append((key, k, q0, x))
            expect[(key, k)] = q
    df = spark.createDataFrame(rows, "key long, k long, q0 int, x int")
    from orderlake.functions.scalar import refilled_stock
    from orderlake.operators.skew import running_totals
    run = running_totals(df, ["key"], ["k"], {"used": F.col("x")}, width=4)
    got = {(r.key, r.k): r.q for r in run.select("key", "k", refilled_stock("q0", "used").alias("q")).collect()}
    assert got == expect


# ---------------------------------------------------------------- Delivery


def test_delivery_increments_count_and_skips_empty_district(spark):
    o = orders(spark, [(1, 1, 1, 5, None), (1, 1, 2, 5, None), (1, 2, 1, 6, 3)])
    ol = table(spark, "order_lines", [dict(ol_w_id=1, ol_d_id=1, ol_o_id=1, ol_number=1, ol_i_id=1,
                                           ol_amount=Decimal("7.50"), ol_quantity=1)])
    cu = table(spark, "customers", [dict(c_w_id=1, c_d_id=1, c_id=5, c_balance=Decimal("1.00"), c_delivery_cnt=4),
                                    dict(c_w_id=1, c_d_id=2, c_id=6, c_balance=Decimal("1.00"), c_delivery_cnt=0)])
    req = spark.createDataFrame([(1, 1, 3, dt.datetime(2024, 2, 1))],
                                "seq long, w_id int, carrier_id int, delivery_d timestamp_ntz")
    dl = changes.delivered_orders(o, req)
    assert [(r.d_id, r.o_id) for r in dl.collect()] == [(1, 1)]
    c = {r.c_id: (r.c_balance, r.c_delivery_cnt) for r in changes.deliver_customers(cu, ol, dl).collect()}
    assert c == {5: (Decimal("8.50"), 5), 6: (Decimal("1.00"), 0)}
    queue = [(r.o_d_id, r.o_id) for r in changes.deliver_remaining_queue(o, dl).collect()]
    assert queue == [(1, 2)]


# ---------------------------------------------------------------- Related


def test_related_customer_cases(spark):
    o = orders(spark, [(1, 1, 1, 1), (2, 1, 1, 2), (3, 1, 1, 3), (1, 2, 1, 4),
                       (4, 1, 1, 5), (4, 1, 2, 5)])
    specs = [
        (1, 1, 1, [10, 11, 12]),       # me
        (2, 1, 1, [10, 11]),           # shares two items, other warehouse: related
        (3, 1, 1, [10, 10, 13]),       # one common item twice: not related
        (1, 2, 1, [10, 11]),           # same warehouse: not related
        (4, 1, 1, [10]), (4, 1, 2, [11]),  # 1 + 1 in different orders: not related
    ]
    rows = []
    for w, d, oid, items in specs:
        for n, i in enumerate(items, 1):
            rows.append(dict(ol_w_id=w, ol_d_id=d, ol_o_id=oid, ol_number=n, ol_i_id=i, ol_quantity=1))
    ol = table(spark, "order_lines", rows)
    req = spark.createDataFrame([(1, 1, 1)], "w_id int, d_id int, c_id long")
    got = [(r.r_w_id, r.r_c_id) for r in reads.related_customers(o, ol, req).collect()]
    assert got == [(2, 2)]
    got2 = [(r.r_w_id, r.r_c_id) for r in reads.related_customers_overlap(o, ol, req).collect()]
    assert got2 == [(2, 2)]
    # the hot-key path gives the same answer
    got3 = [(r.r_w_id, r.r_c_id) for r in reads.related_customers(o, ol, req, cell_rows=1).collect()]
    assert got3 == [(2, 2)]


# ------------------------------------------------------------- Top-Balance


def test_balance_ties_at_rank_ten(spark):
    keys = [(2, c) for c in (3, 2, 1, 4, 5)] + [(1, c) for c in (6, 5, 4, 3, 2, 1)]   # 11 ties
    cu = table(spark, "customers", [dict(c_w_id=1, c_d_id=d, c_id=c, c_balance=Decimal("5.00"))
                                    for d, c in keys])
    di = table(spark, "districts", [dict(d_w_id=1, d_id=d, d_name=f"D{d}") for d in (1, 2)])
    wh = table(spark, "warehouses", [dict(w_id=1, w_name="W")])
    got = [(r.c_d_id, r.c_id) for r in reads.top_balance(cu, di, wh).orderBy("rank").collect()]
    assert len(got) == 10 and got[:6] == [(1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (1, 6)]
    assert got[6:] == [(2, 1), (2, 2), (2, 3), (2, 4)] and (2, 5) not in got


def test_order_status_not_found(spark):
    cu = table(spark, "customers", [dict(c_w_id=1, c_d_id=1, c_id=1), dict(c_w_id=1, c_d_id=1, c_id=2)])
    o = orders(spark, [(1, 1, 1, 1)])
    req = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (1, 1, 9)], "w_id int, d_id int, c_id long")
    got = {r.c_id: r.status for r in reads.order_status_check(req, cu, o).collect()}
    assert got == {1: "ok", 2: "no_order", 9: "not_found"}


# ----------------------------------------------------------------- Metrics


def test_exclusive_and_linear_quantiles(spark):
    ev = spark.createDataFrame([(0, float(v)) for v in range(1, 11)], "client int, latency_ms double")
    ex = metrics.client_latency_stats_exclusive(ev).first()
    lin = metrics.client_latency_stats(ev).first()
    assert ex.p95_ms == Decimal("10.4500") and lin.p95_ms == Decimal("9.5500")
    ref = statistics.quantiles([float(v) for v in range(1, 11)], n=100, method="exclusive")
    assert float(ex.p99_ms) == pytest.approx(ref[98])
    assert ex.median_ms == Decimal("5.5000") and ex.mean_ms == Decimal("5.5000")


def test_exclusive_quantiles_random(spark):
    import random
    rnd = random.Random(3)
    data = {c: [round(rnd.uniform(0, 500), 2) for _ in range(rnd.randint(2, 60))] for c in range(6)}
    ev = spark.createDataFrame([(c, v) for c, vs in data.items() for v in vs], "client int, latency_ms double")
    got = {r.client: r for r in metrics.client_latency_stats_exclusive(ev).collect()}
    for c, vs in data.items():
        q = statistics.quantiles(vs, n=100, method="exclusive")
        assert float(got[c].p95_ms) == pytest.approx(q[94], abs=1e-4)
        assert float(got[c].p99_ms) == pytest.approx(q[98], abs=1e-4)
        assert float(got[c].median_ms) == pytest.approx(statistics.median(vs), abs=1e-4)


# ------------------------------------------------------- transaction scripts


def test_transaction_script_parse(spark, tmp_path):
    d = tmp_path / "client=0"
    d.mkdir()
    (d / "part-0.txt").write_text("N,1,1,1,2\n5,1,3\n6,1,4\nT\nP,1\n7,1,1\np,1,1,1,10.50\n")
    parsed = txlog.parse_scripts(txlog.read_script_lines(spark, str(tmp_path)))
    valid, rejects = txlog.transactions(parsed)
    got = sorted((r.txn_type, r.n_items) for r in valid.collect())
    assert got == [("N", 2), ("P", None), ("T", None)]
    assert sorted(r.reason for r in rejects.collect()) == ["orphan_line", "short_record"]
    items = txlog.new_order_items(parsed).filter("header_line = 1").orderBy("line_no").collect()
    assert [(r.i_id, r.quantity) for r in items[:2]] == [(5, 3), (6, 4)]


def test_null_token_csv(spark, tmp_path):
    p = str(tmp_path / "orders")
    os.makedirs(p)
    with open(os.path.join(p, "part-0.csv"), "w") as f:
        f.write("1,1,1,7,null,2,1,2024-01-01 00:00:00\n1,1,2,7,3,1,1,2024-01-02 00:00:00\n")
    rows = csv_io.read_csv(spark, p, ORDER).orderBy("o_id").collect()
    assert rows[0].o_carrier_id is None and rows[1].o_carrier_id == 3
    assert rows[1].o_entry_d == dt.datetime(2024, 1, 2)


def test_transaction_script_parse_across_splits(spark, tmp_path):
    """Small splits cut New-Order records apart; numbering and header carry
    must still follow the file."""
    d = tmp_path / "client=3"
    d.mkdir()
    text, expect_items = [], 0
    for k in range(1, 121):
        m = k % 5
        text.append(f"N,{k},1,1,{m}")
        text += [f"{k},1,{j}" for j in range(1, m + 1)]
        expect_items += m
        text.append(f"P,1,1,{k},1.25")
    (d / "part-0.txt").write_text("\n".join(text) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        lines = txlog.read_script_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 5
        parsed = txlog.parse_scripts(lines)
        valid, rejects = txlog.transactions(parsed)
        got = {r.txn_type: r.n for r in valid.groupBy("txn_type").agg(F.count("*").alias("n")).collect()}
        assert got == {"N": 120, "P": 120} and rejects.count() == 0
        nums = [r.line_no for r in parsed.orderBy("line_no").collect()]
        assert nums == list(range(1, len(text) + 1))
        items = txlog.new_order_items(parsed).filter(F.col("line_no") >= 1).count()
        assert items == expect_items
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _event_files(spark, tmp_path, numbers):
    """Events as a folder of part files, as any table of more than one file is."""
    from orderlake.streaming import streams
    d = tmp_path / "events.parquet"
    d.mkdir(exist_ok=True)
    for b in numbers:
        rows = [(b * 100 + c, dt.datetime(2024, 1, 1, b), c, "purchase", float(c * (b + 1)), "{}")
                for c in range(1, 13)] + [(b * 100 + 50, dt.datetime(2024, 1, 1, b), 1, "view", 99.0, "{}")]
        spark.createDataFrame(rows, streams.EVENTS_SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"batch{b}"))
        src = next(p for p in (tmp_path / f"batch{b}").iterdir() if p.name.endswith(".parquet"))
        src.rename(d / f"part-{b}.parquet")


def test_streams_over_several_batches_stop_and_resume(spark, tmp_path):
    """Two event files, one per micro-batch; then a third one arrives at the same location."""
    from orderlake.streaming import streams
    cu = table(spark, "customers", [dict(c_w_id=1, c_d_id=1, c_id=c, c_first="F", c_middle="OE",
                                         c_last=f"C{c}", c_balance=Decimal("100.00"),
                                         c_ytd_payment=Decimal("0"), c_payment_cnt=0)
                                    for c in range(1, 13)])
    di = table(spark, "districts", [dict(d_w_id=1, d_id=1, d_name="D1")])
    wh = table(spark, "warehouses", [dict(w_id=1, w_name="W")])
    sf = str(tmp_path)

    def top():
        got = streams.stream_top_balance(spark, sf, cu, di, wh, k=3, location=f"{sf}/top", files_per_batch=1)
        return [(r.rank, r.c_id, r.c_balance) for r in got.orderBy("rank").collect()]

    def paid():
        got = streams.stream_payment_totals(spark, sf, cu, location=f"{sf}/paid", files_per_batch=1)
        return {r.c_id: (r.paid, r.n_payments) for r in got.collect()}

    def days():
        got = streams.stream_window_latency(spark, sf, location=f"{sf}/days", files_per_batch=1)
        return {r.client: (r.n_txn, r.max_latency_ms) for r in got.collect()}

    _event_files(spark, tmp_path, [0, 1])
    # customer c has paid c * (1 + 2)
    assert top() == [(1, 1, Decimal("97.00")), (2, 2, Decimal("94.00")), (3, 3, Decimal("91.00"))]
    assert paid() == {c: (Decimal(3 * c), 2) for c in range(1, 13)}
    assert days()[2] == (2, 4.0)
    assert top() == [(1, 1, Decimal("97.00")), (2, 2, Decimal("94.00")), (3, 3, Decimal("91.00"))]  # nothing new
    _event_files(spark, tmp_path, [2])
    assert top() == [(1, 1, Decimal("94.00")), (2, 2, Decimal("88.00")), (3, 3, Decimal("82.00"))]
    assert paid() == {c: (Decimal(6 * c), 3) for c in range(1, 13)}
    assert days()[2] == (3, 6.0)


def test_stream_counts_equal_the_batch(spark, tmp_path):
    """Incomplete orders and bad numbers don't count in either."""
    from orderlake.streaming import streams
    (tmp_path / "0.txt").write_text("N,1,1,1,2\n5,1,3\nP,1,1,x,1.00\nT\n")
    (tmp_path / "1.txt").write_text("P,1,1,1,1.00\nT\n")
    want = {"T": 2, "P": 1}
    got = streams.stream_transaction_counts(spark, str(tmp_path), location=str(tmp_path / "_state"))
    assert {r.txn_type: r.n_txn for r in got.collect()} == want
    valid, _ = txlog.transactions(txlog.parse_scripts(txlog.read_script_lines(spark, str(tmp_path / "*.txt"))))
    assert {r.txn_type: r["count"] for r in valid.groupBy("txn_type").count().collect()} == want


def test_several_files_of_a_client_keep_their_orders_apart(spark, tmp_path):
    """Files named by client, and part files of one client: unique request numbers, lines with their order."""
    d = tmp_path / "client=3"
    d.mkdir()
    for k in range(2):
        (d / f"part-{k}.txt").write_text(f"N,{k},1,1,2\n{k}1,1,3\n{k}2,1,4\n")
    (tmp_path / "7.txt").write_text("P,1,1,1,10.50\n")
    (tmp_path / "notes.txt").write_text("T\n")
    parsed = txlog.parse_scripts(txlog.read_script_lines(spark, f"{tmp_path}/{{*.txt,client=3}}"))
    valid, rejects = txlog.transactions(parsed)
    assert sorted((r.client, r.txn_type) for r in valid.collect()) == [(3, "N"), (3, "N"), (7, "P")]
    assert [r.reason for r in rejects.collect()] == ["unknown_client"]
    req = txlog.request_tables(valid, parsed)
    orders_ = {r.seq: r.c_id for r in req["new_orders"].collect()}
    items = sorted((orders_[r.seq], r.line_no, r.i_id) for r in req["new_lines"].collect())
    assert len(orders_) == 2 and items == [(0, 1, 1), (0, 2, 2), (1, 1, 11), (1, 2, 12)]


def test_insert_if_absent_takes_the_first_of_a_key(spark):
    base = spark.createDataFrame([(1, "old")], "k int, v string")
    rows = spark.createDataFrame([(1, "no", 1), (2, "late", 9), (2, "first", 2), (3, "only", 3)], "k int, v string, seq int")
    got = sorted((r.k, r.v) for r in changes.insert_if_absent(base, rows, ["k"], ["seq"]).collect())
    assert got == [(1, "old"), (2, "first"), (3, "only")]


def test_csv_keeps_malformed_lines_apart(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    schema = StructType([StructField("a", IntegerType()), StructField("b", IntegerType()), StructField("c", StringType())])
    p = tmp_path / "f.csv"
    p.write_text("a,b,c\n1,2,x\n3,null,y\nq,4,z\n5,6\n7,8,9,10\n")
    rows, rejects = csv_io.read_csv_checked(spark, str(p), schema, header=True)
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 2, "x"), (3, None, "y")]
    assert sorted(r.line for r in rejects.collect()) == ["5,6", "7,8,9,10", "q,4,z"]
    assert rows.select("a").count() == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_io.read_csv(spark, str(p), schema, header=True, fail=True).collect()


def test_means_are_of_raw_latencies(spark):
    ev = spark.createDataFrame([(0, 0.004)] * 3, "client int, latency_ms double")
    assert metrics.client_latency_stats(ev).first().mean_ms == Decimal("0.0040")
    assert metrics.client_latency_stats_exclusive(ev).first().mean_ms == Decimal("0.0040")


def test_dist_info_literal_or_from_stock(spark):
    rows = []
    for w in (1, 2):
        for i in (1, 2, 3):
            r = dict(s_w_id=w, s_i_id=i, s_quantity=50, s_ytd=Decimal("0"), s_order_cnt=0, s_remote_cnt=0)
            r.update({f"s_dist_{k:02d}": f"w{w}i{i}d{k}" for k in range(1, 11)})
            rows.append(r)
    wh, di, cu, it, st = _new_order_world(spark, rows)
    req = spark.createDataFrame([(1, 1, 1, 5, TS)], "seq long, w_id int, d_id int, c_id long, entry_d timestamp_ntz")
    lr = spark.createDataFrame([(1, 1, 2, 2, 3)], "seq long, line_no int, i_id long, supply_w_id int, quantity int")
    h = changes.new_order_headers(req, lr, di, it, st)
    lit_ = changes.new_order_lines(h, lr, req, it, st).first().ol_dist_info
    stock = changes.new_order_lines(h, lr, req, it, st, dist_info="stock").first().ol_dist_info
    assert (lit_, stock) == ("S_DIST_1", "w2i2d1")


def test_delivery_without_time_is_stamped_now(spark):
    o = orders(spark, [(1, 1, 1, 5, None)])
    req = spark.createDataFrame([(1, 1, 3, None)], "seq long, w_id int, carrier_id int, delivery_d timestamp_ntz")
    got = changes.delivered_orders(o, req).first()
    assert got.delivery_d is not None and got.delivery_d.year >= 2024


def test_dense_rank_snapshot_equals_arg_max(spark):
    ol = lines(spark, [(1, 1, 10, 5), (1, 2, 11, 9), (1, 3, 12, 9), (1, 4, 13, 2), (2, 1, 14, 3)])
    for m in ("max", "min"):
        a = sorted(r.ol_i_id for r in derived.ranked_lines(ol, m).collect())
        b = sorted(r.ol_i_id for r in derived.popular_lines(ol, m).collect())
        assert a == b


def test_new_order_rewrites_only_touched_stock_partitions(spark, tmp_path):
    import os as _os
    from orderlake.sources import versions
    wh, di, cu, it, st = _new_order_world(spark)
    path = str(tmp_path / "stocks")
    versions.write_partitioned(st, path, ["s_w_id"])
    untouched = {f: _os.path.getmtime(_os.path.join(path, "s_w_id=2", f))
                 for f in _os.listdir(_os.path.join(path, "s_w_id=2"))}
    req = spark.createDataFrame([(1, 1, 1, 5, TS)], "seq long, w_id int, d_id int, c_id long, entry_d timestamp_ntz")
    lr = spark.createDataFrame([(1, 1, 1, 1, 5), (1, 2, 3, 1, 4)],
                               "seq long, line_no int, i_id long, supply_w_id int, quantity int")
    cur = spark.read.parquet(path)
    new = changes.new_order_stock(cur.select(*st.columns), lr, req, it)
    delta = lr.select(F.col("supply_w_id").alias("s_w_id"))
    versions.write_touched_partitions(versions.touched_rows(new, delta, ["s_w_id"]), path, ["s_w_id"])
    after = {f: _os.path.getmtime(_os.path.join(path, "s_w_id=2", f))
             for f in _os.listdir(_os.path.join(path, "s_w_id=2"))}
    assert after == untouched
    got = {(r.s_w_id, r.s_i_id): r.s_quantity for r in spark.read.parquet(path).collect()}
    assert got == {(1, 1): 107, (1, 2): 12, (1, 3): 108, (2, 1): 12, (2, 2): 12, (2, 3): 12}
