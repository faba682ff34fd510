"""Sorted positions, interval joins, fingerprints and the grid of a hot pair, on skewed rows."""

import random

import pytest
from pyspark.sql import functions as F

from orderlake.operators import fingerprints, ordered, overlap, reads, upkeep
from orderlake.operators.skew import INTERVAL_PARTS, grid_join, interval_join
from orderlake.sources import catalog
from test_fixtures import lines, orders, table


def test_positions_are_those_of_a_sort(spark):
    rnd = random.Random(1)
    rows = [(1 if rnd.random() < 0.5 else rnd.randint(0, 5), rnd.randint(0, 9) or None, k) for k in range(2000)]
    got = ordered.with_positions(spark.createDataFrame(rows, "a int, b int, k int").repartition(7), ["a", F.col("b").desc_nulls_last()])
    want = sorted(rows, key=lambda r: (r[0], r[1] is None, -(r[1] or 0), r[2]))
    assert [(r.a, r.b, r.k) for r in got.orderBy("position").collect()] == want
    assert sorted(r.position for r in got.collect()) == list(range(1, 2001))


def test_ranks_start_anew_in_each_group(spark):
    rows = [(g, v) for g in (1, 2, 3) for v in random.Random(g).sample(range(100), 40 * g if g < 3 else 1)]
    got = ordered.with_ranks(spark.createDataFrame(rows, "seq int, n_orders int"), ["seq"], [F.col("n_orders").desc()])
    for g in (1, 2, 3):
        own = sorted((r.rank, r.n_orders) for r in got.where(f"seq = {g}").collect())
        assert own == list(enumerate(sorted((v for h, v in rows if h == g), reverse=True), 1))


def test_sorted_files(spark, tmp_path):
    got = ordered.with_positions(spark.range(500).select((F.col("id") * 7919 % 500).alias("v")).repartition(5), ["v"])
    assert got.where("position <> v + 1").count() == 0 and ordered.with_positions(got.limit(0).drop("position"), ["v"]).count() == 0


@pytest.mark.parametrize("most", [10, 5000])
def test_interval_join(spark, most):
    rnd = random.Random(most)
    rows = [(0 if rnd.random() < 0.6 else 1, rnd.randint(0, 6000), k) for k in range(1500)]
    asked = []
    for n in range(40):
        low = rnd.randint(0, 6000)
        asked.append((rnd.randint(0, 1), low, low + rnd.randint(-1, most), n))
    a, r = spark.createDataFrame(asked, "k int, low long, high long, n int"), spark.createDataFrame(rows, "k int, at int, row int")
    got = interval_join(r, a, ["k"], "at", "low", "high")
    assert sorted((x.n, x.row) for x in got.collect()) == sorted((n, row) for k, low, high, n in asked for j, at, row in rows if j == k and low <= at <= high)


def test_long_windows_are_not_listed(spark):
    """A request for a million orders makes no more rows than one for some hundred."""
    d = table(spark, "districts", [dict(d_w_id=1, d_id=1, d_next_o_id=3_000_001)])
    req = spark.createDataFrame([(1, 1, 1_000_000)], "w_id int, d_id int, last_l int")
    o = spark.range(1, 3_000_001, 1000).select(F.lit(1).alias("o_w_id"), F.lit(1).alias("o_d_id"), F.col("id").cast("int").alias("o_id"), F.col("id").alias("o_c_id"),
                                               F.lit(None).cast("timestamp_ntz").alias("o_entry_d"))
    got = reads.last_l_orders(req, d, o)
    assert got.count() == 1000 and got.agg(F.min("o_id")).first()[0] > 2_000_000
    window = reads._last_l(req, d)
    level = 14  # 2^14 is the least power of two that a million holds no more than 64 times
    ranges = window.select(F.explode(F.sequence(F.shiftright("__low", level), F.shiftright("__high", level)))).count()
    assert ranges <= 2 * INTERVAL_PARTS + 1


def test_fingerprints_see_content(spark):
    rows = [(w, k, "a|b" if k % 3 else None) for w in (1, 2, 3) for k in range(50)]
    df = spark.createDataFrame(rows, "w int, k int, t string")
    prints = lambda d, **kw: fingerprints.fingerprints(d, "x", F.col("w"), **kw)
    base = prints(df)
    assert fingerprints.differing(base, prints(df.repartition(9))).count() == 0
    other = df.withColumn("t", F.when((F.col("w") == 2) & (F.col("k") == 7), "a").otherwise(F.col("t")))
    assert [(r.part, r.left_rows, r.right_rows) for r in fingerprints.differing(base, prints(other)).collect()] == [("2", 50, 50)]
    # a repeated row and a lost one don't cancel out
    twice = df.where("not (w = 3 and k = 1)").unionByName(df.where("w = 3 and k = 2"))
    assert [r.part for r in fingerprints.differing(base, prints(twice)).collect()] == ["3"]
    # separators and NULL markers inside values don't make rows alike
    pair = [spark.createDataFrame([(1, 1, t, u)], "w int, k int, t string, u string") for t, u in (("a|b", "c"), ("a", "b|c"))]
    assert fingerprints.differing(prints(pair[0]), prints(pair[1])).count() == 1
    pair = [spark.createDataFrame([(1, 1, t)], "w int, k int, t string") for t in (None, "\\N")]
    assert fingerprints.differing(prints(pair[0]), prints(pair[1])).count() == 1
    # carried on by a change
    change = upkeep.replaced(df.where("w = 1 and k < 5"), df.where("w = 1 and k < 5").withColumn("t", F.lit("new"))).unionByName(upkeep.went(df.where("w = 3")))
    after = df.where("w <> 3").withColumn("t", F.when(F.expr("w = 1 and k < 5"), "new").otherwise(F.col("t")))
    carried = fingerprints.merged(base, prints(change, weight=F.col("weight")))
    assert sorted(map(tuple, carried.collect())) == sorted(map(tuple, prints(after).collect()))


def test_grid_join_of_a_hot_pair(spark):
    left = spark.range(900).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(900).select(F.when(F.col("id") < 500, 0).otherwise(F.col("id") + 200).alias("k"), F.col("id").alias("b"))
    got = grid_join(left, right, ["k"], cell_rows=50)
    want = left.join(right, "k")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_colocated_join_has_no_exchange(spark, tmp_path):
    db = "colocated_test"
    catalog.create_base_tables(spark, str(tmp_path / "wh"), db, bucketed=True, buckets=4)
    catalog.load_table(orders(spark, [(1, 1, k, 5) for k in range(1, 50)]), db, "orders", buckets=4)
    catalog.load_table(lines(spark, [(k, n, n, 1) for k in range(1, 50) for n in (1, 2)]), db, "order_lines", buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = catalog.colocated_order_lines(spark, db)
        assert got.count() == 49 and got.where("n_lines <> 2").count() == 0
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
        one = spark.table(f"{db}.orders").where("o_w_id = 1 and o_d_id = 1 and o_id = 7")
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(o_id,7)" in plan  # row groups of the sorted files are skipped by it
        assert len(spark.table(f"{db}.orders").inputFiles()) == 4  # a file a bucket
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        catalog.drop_tables(spark, db)


@pytest.mark.parametrize("light_most", [0, 5, 20, 10**6])
def test_related_customers_by_weight(spark, light_most):
    rnd = random.Random(light_most)
    head, body, own = [], [], {}
    for k in range(150):
        w, c = rnd.randint(1, 3), k % 60
        head.append((w, 1, k, c))
        items = {rnd.choice([1, 2, 3, 4]) if rnd.random() < 0.5 else rnd.randint(5, 220) for _ in range(rnd.randint(1, 5))}
        own[k] = (w, c, items)
        body += [(w, k, i) for i in items for _ in range(rnd.choice([1, 2]))]
    o = orders(spark, head)
    ol = None
    for w in (1, 2, 3):
        part = lines(spark, [(k, n, i, 1) for n, (v, k, i) in enumerate(body) if v == w], w=w)
        ol = part if ol is None else ol.unionByName(part)
    req = spark.createDataFrame([(w, 1, c) for w in (1, 2, 3) for c in range(0, 60, 2)], "w_id int, d_id int, c_id long")
    want = {(w, 1, c, v, 1, d) for w, c, a in own.values() for v, d, b in own.values() if w != v and len(a & b) >= 2 and c % 2 == 0}
    got = overlap.related_customers(o, ol, req, light_most=light_most)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sorted(map(tuple, reads.related_customers(o, ol, req).collect())) == sorted(want)


def test_a_pair_with_many_buyers_is_one_mask(spark):
    """4,000 customers who bought the same two items: one mask, and cells of bounded size instead of 16 million listed pairs."""
    n = 4_000
    o = spark.range(n).select((F.col("id") % 2 + 1).cast("int").alias("w_id"), F.lit(1).alias("d_id"), F.col("id").alias("c_id"), F.col("id").cast("int").alias("o_id"))
    items = o.withColumn("i_id", F.explode(F.array(F.lit(7), F.lit(8)).cast("array<long>")))
    masks = overlap.with_masks(items, overlap.heavy_items(items))
    assert [tuple(r) for r in masks.select("low", "high", F.size("light")).distinct().collect()] == [(3, 0, 0)]
    asked = masks.where("c_id % 100 = 0")
    found = overlap._by_masks(asked, masks).where("w_id <> r_w_id")
    assert found.count() == 40 * n // 2
