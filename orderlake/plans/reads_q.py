"""Registered read-transaction queries (T-O, T-S, T-I, T-T, T-R) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import derived, ordered, overlap, reads
from .registry import register

# ------------------------------------------------------------------ T-T

register("top_balance", """
, top AS (
  SELECT c_w_id, c_d_id, c_id, c_first, c_middle, c_last, c_balance FROM customers
  ORDER BY c_balance DESC NULLS LAST, c_w_id, c_d_id, c_id LIMIT 10)
SELECT CAST(row_number() OVER (ORDER BY t.c_balance DESC NULLS LAST, t.c_w_id, t.c_d_id, t.c_id) AS INTEGER) AS rank,
  t.c_w_id, t.c_d_id, t.c_id, t.c_first, t.c_middle, t.c_last,
  concat_ws(' ', t.c_first, t.c_middle, t.c_last) AS customer_name, t.c_balance, w.w_name, d.d_name
FROM top t
LEFT JOIN districts d ON d.d_w_id = t.c_w_id AND d.d_id = t.c_d_id
LEFT JOIN warehouses w ON w.w_id = t.c_w_id
""")(lambda t: reads.top_balance(t.customers, t.districts, t.warehouses))

register("top_balance_per_warehouse", """
SELECT c_w_id, c_d_id, c_id, c_balance, w_rank FROM (
  SELECT c_w_id, c_d_id, c_id, c_balance,
    CAST(row_number() OVER (PARTITION BY c_w_id ORDER BY c_balance DESC NULLS LAST, c_d_id, c_id) AS INTEGER) AS w_rank
  FROM customers) x
WHERE w_rank <= 10
""")(lambda t: reads.top_balance_per_warehouse(t.customers))

register("top_balance_two_phase", """
SELECT CAST(row_number() OVER (ORDER BY c_balance DESC NULLS LAST, c_w_id, c_d_id, c_id) AS INTEGER) AS rank,
  c_w_id, c_d_id, c_id, c_balance
FROM (SELECT c_w_id, c_d_id, c_id, c_balance FROM customers
      ORDER BY c_balance DESC NULLS LAST, c_w_id, c_d_id, c_id LIMIT 10) x
""")(lambda t: reads.top_balance_two_phase(t.customers))

# ------------------------------------------------------------------ T-O

register("order_status", """
, last AS (
  SELECT o_w_id AS w_id, o_d_id AS d_id, o_c_id AS c_id, max(o_id) AS o_id
  FROM w_orders GROUP BY o_w_id, o_d_id, o_c_id)
SELECT l.w_id, l.d_id, l.c_id, c.c_first, c.c_middle, c.c_last, c.c_balance,
  l.o_id, o.o_entry_d, o.o_carrier_id, ol.ol_number, ol.ol_i_id, ol.ol_supply_w_id,
  ol.ol_quantity, ol.ol_amount, ol.ol_delivery_d
FROM last l
JOIN (SELECT DISTINCT w_id, d_id, c_id FROM customer_requests) r
  ON r.w_id = l.w_id AND r.d_id = l.d_id AND r.c_id = l.c_id
JOIN w_orders o ON o.o_w_id = l.w_id AND o.o_d_id = l.d_id AND o.o_id = l.o_id
JOIN customers c ON c.c_w_id = l.w_id AND c.c_d_id = l.d_id AND c.c_id = l.c_id
LEFT JOIN order_lines ol ON ol.ol_w_id = l.w_id AND ol.ol_d_id = l.d_id AND ol.ol_o_id = l.o_id
""")(lambda t: reads.order_status(t.customer_requests, t.customers, t.orders, t.order_lines))

register("order_status_not_found", """
SELECT r.w_id, r.d_id, r.c_id,
  CASE WHEN NOT EXISTS (SELECT 1 FROM customers c WHERE c.c_w_id = r.w_id AND c.c_d_id = r.d_id AND c.c_id = r.c_id)
       THEN 'not_found'
       WHEN NOT EXISTS (SELECT 1 FROM w_orders o WHERE o.o_w_id = r.w_id AND o.o_d_id = r.d_id AND o.o_c_id = r.c_id)
       THEN 'no_order' ELSE 'ok' END AS status
FROM customer_requests r
""")(lambda t: reads.order_status_check(t.customer_requests, t.customers, t.orders))

# ------------------------------------------------------------ last L orders

register("last_l_orders", """
SELECT r.seq, r.w_id, r.d_id, r.last_l, o.o_id, o.o_c_id AS c_id, o.o_entry_d
FROM popular_requests r
JOIN districts d ON d.d_w_id = r.w_id AND d.d_id = r.d_id
JOIN w_orders o ON o.o_w_id = r.w_id AND o.o_d_id = r.d_id
  AND o.o_id >= d.d_next_o_id - r.last_l AND o.o_id < d.d_next_o_id
""")(lambda t: reads.last_l_orders(t.popular_requests, t.districts, t.orders)
     .select("seq", "w_id", "d_id", "last_l", "o_id", "c_id", "o_entry_d"))

# Whatever L is: the last million orders of every district.
register("last_l_orders_million", """
SELECT r.seq, r.w_id, r.d_id, CAST(1000000 AS INTEGER) AS last_l, o.o_id, o.o_c_id AS c_id, o.o_entry_d
FROM popular_requests r JOIN districts d ON d.d_w_id = r.w_id AND d.d_id = r.d_id
JOIN w_orders o ON o.o_w_id = r.w_id AND o.o_d_id = r.d_id AND o.o_id >= d.d_next_o_id - 1000000 AND o.o_id < d.d_next_o_id
""")(lambda t: reads.last_l_orders(t.popular_requests.withColumn("last_l", F.lit(1_000_000)), t.districts, t.orders))

# ------------------------------------------------------------------ T-S

_STOCK_KEYS = """
, keys AS (
  SELECT r.w_id, r.d_id, r.threshold, r.last_l, d.d_next_o_id
  FROM (SELECT DISTINCT w_id, d_id, threshold, last_l FROM stock_level_requests) r JOIN districts d ON d.d_w_id = r.w_id AND d.d_id = r.d_id),
lines AS (
  SELECT k.w_id, k.d_id, k.threshold, k.last_l, ol.ol_i_id
  FROM keys k JOIN order_lines ol ON ol.ol_w_id = k.w_id AND ol.ol_d_id = k.d_id
   AND ol.ol_o_id >= k.d_next_o_id - k.last_l AND ol.ol_o_id < k.d_next_o_id)
"""

register("stock_level", _STOCK_KEYS + """
, low AS (
  SELECT l.w_id, l.d_id, l.threshold, l.last_l, count(*) AS n
  FROM (SELECT DISTINCT * FROM lines) l
  JOIN stocks s ON s.s_w_id = l.w_id AND s.s_i_id = l.ol_i_id
  WHERE s.s_quantity < l.threshold GROUP BY 1, 2, 3, 4)
SELECT r.seq, r.w_id, r.d_id, r.threshold, r.last_l, CAST(coalesce(low.n, 0) AS BIGINT) AS low_stock_count
FROM stock_level_requests r
LEFT JOIN low ON low.w_id = r.w_id AND low.d_id = r.d_id AND low.threshold = r.threshold AND low.last_l = r.last_l
""")(lambda t: reads.stock_level(t.stock_level_requests, t.districts, t.order_lines, t.stocks))

register("stock_level_lines", _STOCK_KEYS + """
, low AS (
  SELECT l.w_id, l.d_id, l.threshold, l.last_l, count(*) AS n
  FROM lines l JOIN stocks s ON s.s_w_id = l.w_id AND s.s_i_id = l.ol_i_id
  WHERE s.s_quantity < l.threshold GROUP BY 1, 2, 3, 4)
SELECT r.seq, r.w_id, r.d_id, r.threshold, r.last_l, CAST(coalesce(low.n, 0) AS BIGINT) AS low_stock_lines
FROM stock_level_requests r
LEFT JOIN low ON low.w_id = r.w_id AND low.d_id = r.d_id AND low.threshold = r.threshold AND low.last_l = r.last_l
""")(lambda t: reads.stock_level(t.stock_level_requests, t.districts, t.order_lines, t.stocks,
                                 count_lines=True))

# ------------------------------------------------------------------ T-I

_POPULAR_MAX = """
pl AS (
  SELECT x.ol_w_id AS w_id, x.ol_d_id AS d_id, x.ol_o_id AS o_id, x.ol_i_id AS i_id, x.ol_quantity
  FROM order_lines x
  WHERE x.ol_quantity = (SELECT max(y.ol_quantity) FROM order_lines y
                         WHERE y.ol_w_id = x.ol_w_id AND y.ol_d_id = x.ol_d_id AND y.ol_o_id = x.ol_o_id))
"""

_LAST_L = """
lo AS (
  SELECT r.seq, r.w_id, r.d_id, r.last_l, o.o_id, o.o_c_id AS c_id, o.o_entry_d
  FROM popular_requests r
  JOIN districts d ON d.d_w_id = r.w_id AND d.d_id = r.d_id
  JOIN w_orders o ON o.o_w_id = r.w_id AND o.o_d_id = r.d_id
   AND o.o_id >= d.d_next_o_id - r.last_l AND o.o_id < d.d_next_o_id)
"""

register("popular_lines_max", ", " + _POPULAR_MAX + """
SELECT x.ol_w_id, x.ol_d_id, x.ol_o_id, x.ol_number, x.ol_i_id, x.ol_quantity
FROM order_lines x
WHERE x.ol_quantity = (SELECT max(y.ol_quantity) FROM order_lines y
                       WHERE y.ol_w_id = x.ol_w_id AND y.ol_d_id = x.ol_d_id AND y.ol_o_id = x.ol_o_id)
""")(lambda t: derived.popular_lines(t.order_lines, "max")
     .select("ol_w_id", "ol_d_id", "ol_o_id", "ol_number", "ol_i_id", "ol_quantity"))

register("popular_items", ", " + _POPULAR_MAX + ", " + _LAST_L + """
SELECT lo.seq, lo.w_id, lo.d_id, lo.last_l, lo.o_id, lo.o_entry_d, c.c_first, c.c_middle, c.c_last,
  pl.i_id, it.i_name, pl.ol_quantity
FROM lo JOIN pl ON pl.w_id = lo.w_id AND pl.d_id = lo.d_id AND pl.o_id = lo.o_id
JOIN customers c ON c.c_w_id = lo.w_id AND c.c_d_id = lo.d_id AND c.c_id = lo.c_id
JOIN items it ON it.i_id = pl.i_id
""")(lambda t: reads.popular_items(t.popular_requests, t.districts, t.orders, t.order_lines,
                                   t.items, t.customers))

_PCT = """
, found AS (SELECT seq, w_id, d_id, last_l, count(*) AS n_found FROM lo GROUP BY 1, 2, 3, 4),
hits AS (SELECT {distinct} lo.seq, lo.w_id, lo.d_id, lo.last_l, lo.o_id, pl.i_id
         FROM lo JOIN pl ON pl.w_id = lo.w_id AND pl.d_id = lo.d_id AND pl.o_id = lo.o_id),
per AS (SELECT seq, i_id, count(*) AS n_orders FROM hits GROUP BY 1, 2)
SELECT f.seq, f.w_id, f.d_id, f.last_l, per.i_id, it.i_name, per.n_orders, f.n_found,
  CAST(round_even(CAST(per.n_orders AS DOUBLE) * 100.0 / {by}, 2) AS DECIMAL(6,2)) AS pct
FROM per JOIN found f ON f.seq = per.seq
JOIN items it ON it.i_id = per.i_id
"""

register("popular_items_pct", ", " + _POPULAR_MAX + ", " + _LAST_L + _PCT.format(distinct="DISTINCT", by="f.n_found"))(
    lambda t: reads.popular_items_pct(t.popular_requests, t.districts, t.orders, t.order_lines, t.items))

register("popular_items_ranked", ", " + _POPULAR_MAX + ", " + _LAST_L + ", pct AS (SELECT * FROM ("
         + _PCT.format(distinct="DISTINCT", by="f.n_found").strip().removeprefix(",").replace("found AS (", "WITH found AS (", 1) + """))
SELECT *, row_number() OVER (PARTITION BY seq ORDER BY n_orders DESC, i_id) AS rank FROM pct
""")(lambda t: ordered.popular_items_ranked(reads.popular_items_pct(t.popular_requests, t.districts, t.orders, t.order_lines, t.items)))

# The requested number of orders as denominator, every popular line counted.
register("popular_items_pct_of_l", ", " + _POPULAR_MAX + ", " + _LAST_L + _PCT.format(distinct="", by="f.last_l"))(
    lambda t: reads.popular_items_pct(t.popular_requests, t.districts, t.orders, t.order_lines, t.items,
                                      denominator="L", count="lines"))

# Every line of positive quantity of the last orders.
register("popular_items_all_lines", ", pl AS (SELECT ol_w_id AS w_id, ol_d_id AS d_id, ol_o_id AS o_id, ol_i_id AS i_id, ol_quantity "
         "FROM order_lines WHERE ol_quantity > 0), " + _LAST_L + """
SELECT lo.seq, lo.w_id, lo.d_id, lo.last_l, lo.o_id, lo.o_entry_d, c.c_first, c.c_middle, c.c_last,
  pl.i_id, it.i_name, pl.ol_quantity
FROM lo JOIN pl ON pl.w_id = lo.w_id AND pl.d_id = lo.d_id AND pl.o_id = lo.o_id
JOIN customers c ON c.c_w_id = lo.w_id AND c.c_d_id = lo.d_id AND c.c_id = lo.c_id
JOIN items it ON it.i_id = pl.i_id
""")(lambda t: reads.popular_items(t.popular_requests, t.districts, t.orders, t.order_lines, t.items, t.customers, mode="all"))

# ------------------------------------------------------------------ T-R

_ORDER_ITEMS = """
, oi AS (
  SELECT DISTINCT o.o_w_id AS w_id, o.o_d_id AS d_id, o.o_c_id AS c_id, o.o_id, ol.ol_i_id AS i_id
  FROM w_orders o JOIN order_lines ol
    ON ol.ol_w_id = o.o_w_id AND ol.ol_d_id = o.o_d_id AND ol.ol_o_id = o.o_id),
ov AS (
  SELECT a.w_id, a.d_id, a.c_id, a.o_id, b.w_id AS r_w_id, b.d_id AS r_d_id, b.c_id AS r_c_id,
    b.o_id AS r_o_id, count(DISTINCT a.i_id) AS overlap
  FROM oi a JOIN related_requests r ON r.w_id = a.w_id AND r.d_id = a.d_id AND r.c_id = a.c_id
  JOIN oi b ON a.i_id = b.i_id AND a.w_id <> b.w_id
  GROUP BY a.w_id, a.d_id, a.c_id, a.o_id, b.w_id, b.d_id, b.c_id, b.o_id)
"""

_RELATED_SQL = _ORDER_ITEMS + """
SELECT DISTINCT w_id, d_id, c_id, r_w_id, r_d_id, r_c_id FROM ov WHERE overlap >= 2
"""

register("related_customers", _RELATED_SQL)(
    lambda t: reads.related_customers(t.orders, t.order_lines, t.related_requests))

# Items in more than 20 orders are heavy here, so both ways are taken on small data too.
register("related_customers_weighted", _RELATED_SQL)(
    lambda t: overlap.related_customers(t.orders, t.order_lines, t.related_requests, light_most=20))

register("related_customers_overlap", _RELATED_SQL)(
    lambda t: reads.related_customers_overlap(t.orders, t.order_lines, t.related_requests))

register("order_overlap_size", _ORDER_ITEMS + """
SELECT w_id, d_id, c_id, o_id, r_w_id, r_d_id, r_c_id, r_o_id, overlap FROM ov WHERE overlap >= 2
""")(lambda t: reads.order_overlaps(t.orders, t.order_lines, t.related_requests))

register("item_pairs", """
, oi AS (
  SELECT DISTINCT o.o_w_id AS w_id, o.o_d_id AS d_id, o.o_c_id AS c_id, o.o_id, ol.ol_i_id AS i_id
  FROM w_orders o JOIN order_lines ol
    ON ol.ol_w_id = o.o_w_id AND ol.ol_d_id = o.o_d_id AND ol.ol_o_id = o.o_id)
SELECT DISTINCT a.w_id, a.d_id, a.c_id, a.i_id AS i1_id, b.i_id AS i2_id
FROM oi a JOIN oi b ON a.w_id = b.w_id AND a.d_id = b.d_id AND a.c_id = b.c_id AND a.o_id = b.o_id
WHERE a.i_id < b.i_id
""")(lambda t: reads.item_pairs(reads.order_item_arrays(t.orders, t.order_lines)))

register("orders_containing_items", """
, oi AS (
  SELECT DISTINCT o.o_w_id AS w_id, o.o_d_id AS d_id, o.o_c_id AS c_id, o.o_id, ol.ol_i_id AS i_id
  FROM w_orders o JOIN order_lines ol
    ON ol.ol_w_id = o.o_w_id AND ol.ol_d_id = o.o_d_id AND ol.ol_o_id = o.o_id)
SELECT w_id, d_id, c_id, o_id, i_id FROM oi
WHERE i_id IN (SELECT i_id FROM new_order_line_requests)
""")(lambda t: reads.orders_containing_items(reads.order_items(t.orders, t.order_lines),
                                             t.new_order_line_requests))

_UNION_SRC = """
, u AS (
  SELECT ol_w_id AS w_id, ol_i_id AS i_id, 'base' AS source FROM order_lines
  UNION ALL
  SELECT r.w_id, l.i_id, 'request' AS source
  FROM new_order_line_requests l JOIN new_order_requests r ON r.seq = l.seq)
"""


def _union_items(t):
    base = t.order_lines.select(F.col("ol_w_id").alias("w_id"), F.col("ol_i_id").alias("i_id"),
                                F.lit("base").alias("source"))
    req = (t.new_order_line_requests.join(t.new_order_requests.select("seq", "w_id"), "seq")
           .select("w_id", "i_id", F.lit("request").alias("source")))
    return base.unionByName(req)


register("union_all_items", _UNION_SRC + "SELECT w_id, i_id, source FROM u", split=True)(_union_items)
register("union_distinct_items", _UNION_SRC + "SELECT DISTINCT w_id, i_id FROM u", split=True)(
    lambda t: _union_items(t).select("w_id", "i_id").distinct())
