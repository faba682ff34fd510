"""Read transactions as set-valued operators: many requests in one job.

Order-Status, Stock-Level, Popular-Item, Top-Balance and Related-Customer.
A request DataFrame holds any number of keys; the result holds the answer of
every request. Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalar import full_name
from ..session import cut_lineage
from . import derived
from .skew import grid_join, interval_join

# ---------------------------------------------------------------- Order-Status


def last_orders(orders: DataFrame) -> DataFrame:
    """Newest order of every customer (W5): a grouped max, combined map-side,
    so a customer with very many orders costs one partial row per task."""
    return (orders.groupBy(F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"),
                           F.col("o_c_id").alias("c_id"))
                  .agg(F.max("o_id").alias("o_id")))


def order_status(requests: DataFrame, customers: DataFrame, orders: DataFrame,
                 order_lines: DataFrame) -> DataFrame:
    """Last order of each requested customer with its lines (T-O).

    One row per line of that order; an order without lines gives one row
    with empty line fields. Customers without orders are reported by
    ``order_status_check``.
    """
    req = requests.select("w_id", "d_id", "c_id").distinct()
    last = last_orders(orders).join(req, ["w_id", "d_id", "c_id"], "left_semi")
    o = orders.select(F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"), "o_id",
                      "o_entry_d", "o_carrier_id")
    c = customers.select(F.col("c_w_id").alias("w_id"), F.col("c_d_id").alias("d_id"), "c_id",
                         "c_first", "c_middle", "c_last", "c_balance")
    ol = order_lines.select(F.col("ol_w_id").alias("w_id"), F.col("ol_d_id").alias("d_id"),
                            F.col("ol_o_id").alias("o_id"), "ol_number", "ol_i_id",
                            "ol_supply_w_id", "ol_quantity", "ol_amount", "ol_delivery_d")
    j = (last.join(o, ["w_id", "d_id", "o_id"], "inner")
             .join(c, ["w_id", "d_id", "c_id"], "inner")
             .join(ol, ["w_id", "d_id", "o_id"], "left"))
    return j.select("w_id", "d_id", "c_id", "c_first", "c_middle", "c_last", "c_balance",
                    "o_id", "o_entry_d", "o_carrier_id", "ol_number", "ol_i_id",
                    "ol_supply_w_id", "ol_quantity", "ol_amount", "ol_delivery_d")


def order_status_check(requests: DataFrame, customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Status of every request: ``ok``, ``no_order`` or ``not_found``."""
    req = requests.select("w_id", "d_id", "c_id")
    c = customers.select(F.col("c_w_id").alias("w_id"), F.col("c_d_id").alias("d_id"), "c_id",
                         F.lit(True).alias("__cust"))
    has = (orders.select(F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"),
                         F.col("o_c_id").alias("c_id")).distinct()
                 .withColumn("__ord", F.lit(True)))
    j = req.join(c, ["w_id", "d_id", "c_id"], "left").join(has, ["w_id", "d_id", "c_id"], "left")
    return j.select("w_id", "d_id", "c_id",
                    F.when(F.col("__cust").isNull(), "not_found")
                     .when(F.col("__ord").isNull(), "no_order").otherwise("ok").alias("status"))


# ------------------------------------------------------------- last L orders


def _last_l(requests: DataFrame, districts: DataFrame) -> DataFrame:
    """Requests with the order numbers ``__low`` to ``__high`` that they ask for: the half-open [N - L, N)."""
    d = districts.select(F.col("d_w_id").alias("w_id"), "d_id", "d_next_o_id")
    return requests.join(d, ["w_id", "d_id"], "inner").select(
        *requests.columns, F.greatest(F.col("d_next_o_id") - F.col("last_l"), F.lit(1)).alias("__low"), (F.col("d_next_o_id") - 1).alias("__high"))


def last_l_orders(requests: DataFrame, districts: DataFrame, orders: DataFrame) -> DataFrame:
    """The last L orders of each request's district, a range join (``skew.interval_join``): a request costs the same for any L."""
    o = orders.select(F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"), "o_id",
                      F.col("o_c_id").alias("c_id"), "o_entry_d")
    j = interval_join(o, _last_l(requests, districts), ["w_id", "d_id"], "o_id", "__low", "__high")
    return j.select(*requests.columns, "o_id", "c_id", "o_entry_d")


# ---------------------------------------------------------------- Stock-Level


def _last_l_lines(requests: DataFrame, districts: DataFrame, order_lines: DataFrame) -> DataFrame:
    ol = order_lines.select(F.col("ol_w_id").alias("w_id"), F.col("ol_d_id").alias("d_id"),
                            F.col("ol_o_id").alias("o_id"), "ol_number", "ol_i_id", "ol_quantity")
    return interval_join(ol, _last_l(requests, districts), ["w_id", "d_id"], "o_id", "__low", "__high").drop("__low", "__high")


def stock_level(requests: DataFrame, districts: DataFrame, order_lines: DataFrame,
                stocks: DataFrame, count_lines: bool = False) -> DataFrame:
    """Items of the last L orders whose home stock is below T (T-S).

    ``count_lines=False`` counts distinct items; ``True`` counts joined lines,
    an item on two lines counting twice (V4). Each distinct (w, d, T, L) is
    computed once; every request row, also a repeated one, gets its own
    answer. Requests with no such item report 0.
    """
    keys = ["w_id", "d_id", "threshold", "last_l"]
    lines = _last_l_lines(requests.select(*keys).distinct(), districts, order_lines)
    if not count_lines:
        lines = lines.select(*keys, "ol_i_id").distinct()
    s = stocks.select(F.col("s_w_id").alias("w_id"), F.col("s_i_id").alias("ol_i_id"), "s_quantity")
    low = (lines.join(s, ["w_id", "ol_i_id"], "inner")
                .filter(F.col("s_quantity") < F.col("threshold"))
                .groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    out = "low_stock_lines" if count_lines else "low_stock_count"
    return (requests.join(low, keys, "left")
                    .select(*requests.columns, F.coalesce(F.col("n"), F.lit(0)).cast("long").alias(out)))


# --------------------------------------------------------------- Popular-Item


def _popular_lines_of(selected_orders: DataFrame, order_lines: DataFrame, mode: str) -> DataFrame:
    """Popular lines of the selected orders only: the lines are cut to those
    orders (semi join on the full order key) before the per-order window."""
    keys = selected_orders.select(F.col("w_id").alias("ol_w_id"), F.col("d_id").alias("ol_d_id"),
                                  F.col("o_id").alias("ol_o_id")).distinct()
    lines = order_lines.join(keys, ["ol_w_id", "ol_d_id", "ol_o_id"], "left_semi")
    return derived.popular_lines(lines, mode)


def popular_items(requests: DataFrame, districts: DataFrame, orders: DataFrame,
                  order_lines: DataFrame, items: DataFrame, customers: DataFrame,
                  mode: str = "max") -> DataFrame:
    """Popular lines of the last L orders of each district, with names (T-I)."""
    req = requests.select("w_id", "d_id", "last_l").distinct()
    o = last_l_orders(req, districts, orders)
    pl = _popular_lines_of(o, order_lines, mode).select(
        F.col("ol_w_id").alias("w_id"), F.col("ol_d_id").alias("d_id"),
        F.col("ol_o_id").alias("o_id"), F.col("ol_i_id").alias("i_id"), "ol_quantity")
    c = customers.select(F.col("c_w_id").alias("w_id"), F.col("c_d_id").alias("d_id"), "c_id",
                         "c_first", "c_middle", "c_last")
    it = items.select("i_id", "i_name")
    j = (o.join(pl, ["w_id", "d_id", "o_id"], "inner")
          .join(c, ["w_id", "d_id", "c_id"], "inner")
          .join(it, "i_id", "inner")
          .join(requests, ["w_id", "d_id", "last_l"], "inner"))  # each request its own answer
    return j.select(*requests.columns, "o_id", "o_entry_d", "c_first", "c_middle", "c_last",
                    "i_id", "i_name", "ol_quantity")


def popular_items_pct(requests: DataFrame, districts: DataFrame, orders: DataFrame,
                      order_lines: DataFrame, items: DataFrame, denominator: str = "found",
                      count: str = "orders", mode: str = "max") -> DataFrame:
    """Share of the last L orders in which each popular item appears.

    ``denominator='found'`` divides by the orders actually found, ``'L'`` by
    the requested L (V2); ``count='orders'`` counts an order once, ``'lines'``
    counts every popular line (V3).
    """
    keys = ["w_id", "d_id", "last_l"]
    # The selected orders feed three branches: computed once per distinct request.
    o = cut_lineage(last_l_orders(requests.select(*keys).distinct(), districts, orders).select(*keys, "o_id"), "last-l-orders")
    found = o.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_found"))
    pl = _popular_lines_of(o, order_lines, mode).select(
        F.col("ol_w_id").alias("w_id"), F.col("ol_d_id").alias("d_id"),
        F.col("ol_o_id").alias("o_id"), F.col("ol_i_id").alias("i_id"))
    hits = o.join(pl, ["w_id", "d_id", "o_id"], "inner")
    if count == "orders":
        hits = hits.distinct()
    per_item = hits.groupBy(*keys, "i_id").agg(F.count(F.lit(1)).alias("n_orders"))
    it = items.select("i_id", "i_name")
    j = per_item.join(found, keys, "inner").join(it, "i_id", "inner").join(requests, keys, "inner")
    den = F.col("n_found") if denominator == "found" else F.col("last_l")
    pct = F.bround(F.col("n_orders") * F.lit(100.0) / den, 2).cast("decimal(6,2)")
    return j.select(*requests.columns, "i_id", "i_name", "n_orders", "n_found", pct.alias("pct"))


# ---------------------------------------------------------------- Top-Balance


def top_balance(customers: DataFrame, districts: DataFrame, warehouses: DataFrame,
                k: int = 10) -> DataFrame:
    """The k customers with the highest balance (T-T, O2).

    The top-k runs first (TakeOrderedAndProject keeps k rows per task), then
    only those k rows meet the dimension tables, so the joins stay tiny
    however large the customer table is. NULL balances sort last; ties are
    broken by the customer key.
    """
    top = (customers.select("c_w_id", "c_d_id", "c_id", "c_first", "c_middle", "c_last", "c_balance")
                    .orderBy(F.col("c_balance").desc_nulls_last(), "c_w_id", "c_d_id", "c_id")
                    .limit(k))
    ranked = top.withColumn("rank", F.row_number().over(
        W.orderBy(F.col("c_balance").desc_nulls_last(), "c_w_id", "c_d_id", "c_id")).cast("int"))
    d = districts.select("d_w_id", "d_id", "d_name")
    w = warehouses.select("w_id", "w_name")
    # ``ranked`` has at most k rows: it is broadcast to cut each dimension to
    # at most k rows, which in turn are broadcast (an outer join can't broadcast
    # the side it preserves).
    few = F.broadcast(ranked.select("c_w_id", "c_d_id").distinct())
    d = d.join(few, (d.d_w_id == few.c_w_id) & (d.d_id == few.c_d_id), "left_semi")
    w = w.join(few, w.w_id == few.c_w_id, "left_semi")
    j = (ranked.join(F.broadcast(d), (ranked.c_w_id == d.d_w_id) & (ranked.c_d_id == d.d_id), "left")
         .join(F.broadcast(w), ranked.c_w_id == w.w_id, "left"))
    return j.select("rank", "c_w_id", "c_d_id", "c_id", "c_first", "c_middle", "c_last",
                    full_name("c_first", "c_middle", "c_last").alias("customer_name"),
                    "c_balance", "w_name", "d_name")


def top_balance_per_warehouse(customers: DataFrame, k: int = 10) -> DataFrame:
    """Top k balances of every warehouse.

    ``row_number() <= k`` over a partition is planned with WindowGroupLimit,
    which keeps k rows per warehouse in each task before the shuffle, so a
    warehouse with a third of all customers still ships only k rows per task.
    """
    w = W.partitionBy("c_w_id").orderBy(F.col("c_balance").desc_nulls_last(), "c_d_id", "c_id")
    return (customers.select("c_w_id", "c_d_id", "c_id", "c_balance")
                     .withColumn("w_rank", F.row_number().over(w).cast("int"))
                     .filter(F.col("w_rank") <= k))


def top_balance_two_phase(customers: DataFrame, k: int = 10) -> DataFrame:
    """Per-warehouse top k, then the global top k of those (O3)."""
    per_w = top_balance_per_warehouse(customers, k)
    return (per_w.orderBy(F.col("c_balance").desc_nulls_last(), "c_w_id", "c_d_id", "c_id").limit(k)
                 .withColumn("rank", F.row_number().over(
                     W.orderBy(F.col("c_balance").desc_nulls_last(), "c_w_id", "c_d_id", "c_id")).cast("int"))
                 .select("rank", "c_w_id", "c_d_id", "c_id", "c_balance"))


# ----------------------------------------------------------- Related-Customer


def order_items(orders: DataFrame, order_lines: DataFrame) -> DataFrame:
    """Distinct (w, d, c, o, i): the input of the related-customer search."""
    return derived.customer_order_items(orders, order_lines)


def order_item_arrays(orders: DataFrame, order_lines: DataFrame) -> DataFrame:
    """(w, d, c, o, items): the sorted distinct items of every order.

    Lines are reduced to one row per order before the join with orders, so
    the join is one-to-one on the order key. An order holds at most a few
    dozen lines (o_ol_cnt is a two-digit number): the array is bounded.
    """
    per_order = (order_lines.groupBy(F.col("ol_w_id").alias("w_id"), F.col("ol_d_id").alias("d_id"),
                                     F.col("ol_o_id").alias("o_id"))
                 .agg(F.array_sort(F.collect_set("ol_i_id")).alias("items")))
    o = orders.select(F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"), "o_id",
                      F.col("o_c_id").alias("c_id"))
    return o.join(per_order, ["w_id", "d_id", "o_id"], "inner").select("w_id", "d_id", "c_id", "o_id", "items")


# Pairs (x, y) with x < y of a sorted distinct array, built by higher-order
# functions inside the task: no self join, no shuffle.
_PAIRS = ("flatten(transform(items, (x, k) -> "
          "transform(slice(items, k + 2, greatest(size(items) - k - 1, 0)), y -> named_struct('i1_id', x, 'i2_id', y))))")


def item_pairs(arrays: DataFrame, keep_order: bool = False) -> DataFrame:
    """Distinct pairs i1 < i2 of items bought together in one order.

    ``i1 < i2`` halves the pairs and drops an item paired with itself.
    Without ``keep_order`` the pair is reduced to the customer.
    """
    cols = ["w_id", "d_id", "c_id"] + (["o_id"] if keep_order else [])
    p = arrays.select(*cols, F.explode(F.expr(_PAIRS)).alias("p"))
    return p.select(*cols, "p.i1_id", "p.i2_id").distinct()


def _matching_pairs(orders: DataFrame, order_lines: DataFrame, requests: DataFrame | None, keep_order: bool) -> tuple[DataFrame, DataFrame]:
    """Item pairs of the requested customers, and those of everyone that are among them, both written.

    Only orders of requested customers have all their pairs built; of all others, the
    lines are cut to the items of those pairs first, as only pairs of two such items can match.
    """
    if requests is None:
        pairs = cut_lineage(item_pairs(order_item_arrays(orders, order_lines), keep_order), "item-pairs")
        return pairs, pairs
    asked = requests.select(F.col("w_id").alias("o_w_id"), F.col("d_id").alias("o_d_id"), F.col("c_id").alias("o_c_id")).distinct()
    their_orders = orders.join(asked, ["o_w_id", "o_d_id", "o_c_id"], "left_semi")
    keys = their_orders.select(F.col("o_w_id").alias("ol_w_id"), F.col("o_d_id").alias("ol_d_id"), F.col("o_id").alias("ol_o_id"))
    their_lines = order_lines.join(keys, ["ol_w_id", "ol_d_id", "ol_o_id"], "left_semi")
    mine = cut_lineage(item_pairs(order_item_arrays(their_orders, their_lines), keep_order), "asked-pairs")
    items = mine.select(F.explode(F.array("i1_id", "i2_id")).alias("ol_i_id")).distinct()
    pairs = item_pairs(order_item_arrays(orders, order_lines.join(items, "ol_i_id", "left_semi")), keep_order)
    return mine, cut_lineage(pairs.join(mine.select("i1_id", "i2_id").distinct(), ["i1_id", "i2_id"], "left_semi"), "matching-pairs")


def _pair_matches(orders: DataFrame, order_lines: DataFrame, requests: DataFrame | None, keep_order: bool, cell_rows: int) -> DataFrame:
    """Join item pairs of requested customers with item pairs of everyone,
    keeping only customers in another warehouse (J7, F4).

    The join is on (i1, i2), and both sides of a pair are split: with m and n
    rows it becomes a grid of ceil(m / cell_rows) x ceil(n / cell_rows) cells,
    so no task emits more than about cell_rows^2 rows of one pair, whatever
    the counts (see ``skew.grid_join``).
    """
    ks = ["w_id", "d_id", "c_id"] + (["o_id"] if keep_order else [])
    mine, theirs = _matching_pairs(orders, order_lines, requests, keep_order)
    theirs = theirs.select(*[F.col(c).alias(f"r_{c}") for c in ks], "i1_id", "i2_id")
    return grid_join(mine, theirs, ["i1_id", "i2_id"], cell_rows).filter(F.col("w_id") != F.col("r_w_id"))


def related_customers(orders: DataFrame, order_lines: DataFrame, requests: DataFrame | None = None,
                      cell_rows: int = 1_000) -> DataFrame:
    """Customers of other warehouses with an order sharing at least two
    distinct items with an order of the requested customer (T-R).

    Output: one row per (requested customer, related customer).
    """
    m = _pair_matches(orders, order_lines, requests, False, cell_rows)
    return m.select("w_id", "d_id", "c_id", F.col("r_w_id"), F.col("r_d_id"), F.col("r_c_id")).distinct()


def order_overlaps(orders: DataFrame, order_lines: DataFrame, requests: DataFrame | None = None,
                   cell_rows: int = 1_000) -> DataFrame:
    """Orders of the requested customers and orders in other warehouses that
    share at least two distinct items, with the number of shared items (J19, U3).

    Candidates come from the pair join (every qualifying order pair shares a
    pair of items); the overlap is then counted from the matched pairs: the
    distinct items appearing in them.
    """
    m = _pair_matches(orders, order_lines, requests, True, cell_rows)
    ks = ["w_id", "d_id", "c_id", "o_id", "r_w_id", "r_d_id", "r_c_id", "r_o_id"]
    return (m.select(*ks, F.explode(F.array("i1_id", "i2_id")).alias("i_id"))
             .groupBy(*ks).agg(F.count_distinct("i_id").alias("overlap")))


def related_customers_overlap(orders: DataFrame, order_lines: DataFrame,
                              requests: DataFrame | None = None) -> DataFrame:
    """Related customers derived from order-level overlaps (cross-check)."""
    ov = order_overlaps(orders, order_lines, requests)
    return (ov.filter(F.col("overlap") >= 2)
              .select("w_id", "d_id", "c_id", "r_w_id", "r_d_id", "r_c_id").distinct())


def orders_containing_items(order_items_df: DataFrame, wanted_items: DataFrame) -> DataFrame:
    """Orders holding any of the wanted items (F12, J13): a semi join on the
    distinct wanted items."""
    want = wanted_items.select("i_id").distinct()
    return order_items_df.join(want, "i_id", "left_semi").select("w_id", "d_id", "c_id", "o_id", "i_id")
