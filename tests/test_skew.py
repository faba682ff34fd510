"""The range-split running totals and the salted join against plain plans,
on data where one key holds a third or more of all rows."""

import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlake.operators.skew import grid_join, running_totals, sequence_numbers


def _hot_rows(n=3000, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 2 == 0 else rnd.randint(1, 40)   # key 0 holds half of all rows
        rows.append((key, i * 3 + rnd.randint(0, 2), rnd.randint(-5, 50)))
    return rows


def test_running_totals_equal_window(spark):
    df = spark.createDataFrame(_hot_rows(), "k int, seq long, v int")
    got = running_totals(df, ["k"], ["seq"], {"run": F.col("v")}, width=64)
    w = W.partitionBy("k").orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    want = df.withColumn("run", F.sum("v").over(w))
    assert sorted(got.collect()) == sorted(want.collect())


def test_sequence_numbers_equal_row_number(spark):
    df = spark.createDataFrame(_hot_rows(), "k int, seq long, v int")
    got = sequence_numbers(df, ["k"], ["seq"], "rn", width=100)
    want = df.withColumn("rn", F.row_number().over(W.partitionBy("k").orderBy("seq")).cast("long"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_grid_join_equals_join(spark):
    left = spark.createDataFrame([(0 if i % 3 else i % 5, i) for i in range(600)], "k int, a int")
    right = spark.createDataFrame([(k, k * 10 + j) for k in range(6) for j in range(30)], "k int, b int")
    got = grid_join(left, right, ["k"], cell_rows=16)
    want = left.join(right, "k")
    assert sorted(got.select("k", "a", "b").collect()) == sorted(want.select("k", "a", "b").collect())


def test_one_hot_pair_is_spread_by_its_output(spark):
    """4,000 buyers of one pair on each side: no cell holds more than its share of 16 million rows."""
    left = spark.range(4000).select(F.lit(1).alias("i"), F.col("id").alias("a"))
    right = spark.range(4000).select(F.lit(1).alias("i"), F.col("id").alias("b"))
    j = grid_join(left, right, ["i"], cell_rows=500)
    assert j.count() == 4000 * 4000
    cell = (F.pmod(F.xxhash64("i", "a"), F.lit(8)), F.pmod(F.xxhash64("i", "b"), F.lit(8)))
    most = j.groupBy(*cell).count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert most[1] == 64 and most[0] < 16_000_000 / 64 * 1.3


def test_running_totals_of_a_sparse_key(spark):
    """Ordering values far apart: a range for nearly every row, in many stretches."""
    rnd = random.Random(9)
    rows = [(i % 3, rnd.randrange(1 << 50), rnd.randint(-9, 9)) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, seq long, v int")
    got = running_totals(df, ["k"], ["seq"], {"run": F.col("v"), "n": F.lit(1)}, width=64)
    w = W.partitionBy("k").orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    want = df.withColumn("run", F.sum("v").over(w)).withColumn("n", F.count("v").over(w))
    assert sorted(got.collect()) == sorted(want.collect())


def test_stocks_are_made_by_as_many_tasks_as_their_rows_need(spark, monkeypatch):
    """However few files hold the items: a task makes about ROWS_A_TASK stock rows, and the rows stay the same."""
    from orderlake.operators import skew
    from orderlake.sources.testdata import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    items = t.raw("part").count()
    monkeypatch.setattr(skew, "ROWS_A_TASK", items)
    stocks = t.stocks
    assert stocks.rdd.getNumPartitions() == 25
    assert stocks.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 4 * items
    assert stocks.count() == stocks.select("s_w_id", "s_i_id").distinct().count() == 25 * items


def test_only_pairs_that_can_match_are_built(spark, monkeypatch):
    """Orders of customers that nobody asked for: only their items that a requested customer has in a pair make pairs."""
    from orderlake.operators import reads
    rnd = random.Random(8)
    lines = [(w, 1, o, rnd.randint(1, 60)) for w in range(3) for o in range(1, 31) for _ in range(rnd.randint(1, 5))]
    orders = spark.createDataFrame([(w, 1, o, o % 10) for w in range(3) for o in range(1, 31)], "o_w_id int, o_d_id int, o_id int, o_c_id long")
    order_lines = spark.createDataFrame(lines, "ol_w_id int, ol_d_id int, ol_o_id int, ol_i_id long")
    asked = spark.createDataFrame([(0, 1, 3), (2, 1, 7)], "w_id int, d_id int, c_id long")
    items = {}
    for w, _, o, i in lines:
        items.setdefault((w, o), set()).add(i)
    mine = {k: v for k, v in items.items() if (k[0], k[1] % 10) in {(0, 3), (2, 7)}}
    wanted = set().union(*[v for v in mine.values() if len(v) > 1])
    seen, pairs = [], reads.item_pairs
    monkeypatch.setattr(reads, "item_pairs", lambda arrays, keep_order=False: seen.append(arrays) or pairs(arrays, keep_order))
    got = {tuple(r) for r in reads.order_overlaps(orders, order_lines, asked).collect()}
    assert got == {(a[0], 1, a[1] % 10, a[1], b[0], 1, b[1] % 10, b[1], len(mine[a] & items[b]))
                   for a in mine for b in items if a[0] != b[0] and len(mine[a] & items[b]) >= 2}
    assert got and len(seen) == 2 and {i for r in seen[1].collect() for i in r["items"]} <= wanted
    related = {tuple(r) for r in reads.related_customers(orders, order_lines, asked).collect()}
    assert related == {r[:3] + r[4:7] for r in got}
