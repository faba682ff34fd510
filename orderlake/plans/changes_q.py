"""Registered write-transaction queries (T-N, T-P, T-D) and their oracles."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F

from ..operators import audit, changes, derived, upkeep
from .derived_q import _db_state_sql
from ..session import cut_lineage, scratch_table_path
from ..sources import txlog, versions
from ..streaming import streams
from .ingest_q import script_requests, slices
from .registry import register

# ------------------------------------------------------------------ Payment

register("payment_customers", """
, pay AS (SELECT w_id, d_id, c_id, sum(amount) AS paid, count(*) AS n
          FROM payment_requests GROUP BY w_id, d_id, c_id)
SELECT c.* EXCLUDE (c_balance, c_ytd_payment, c_payment_cnt),
  CAST(c.c_balance - coalesce(p.paid, 0) AS DECIMAL(12,2)) AS c_balance,
  CAST(c.c_ytd_payment + coalesce(p.paid, 0) AS DECIMAL(14,2)) AS c_ytd_payment,
  CAST(c.c_payment_cnt + coalesce(p.n, 0) AS INTEGER) AS c_payment_cnt
FROM customers c LEFT JOIN pay p ON p.w_id = c.c_w_id AND p.d_id = c.c_d_id AND p.c_id = c.c_id
""")(lambda t: changes.payment_customers(t.customers, t.payment_requests))

register("payment_districts", """
, pay AS (SELECT w_id, d_id, sum(amount) AS paid FROM payment_requests GROUP BY w_id, d_id)
SELECT d.* EXCLUDE (d_ytd), CAST(d.d_ytd + coalesce(p.paid, 0) AS DECIMAL(12,2)) AS d_ytd
FROM districts d LEFT JOIN pay p ON p.w_id = d.d_w_id AND p.d_id = d.d_id
""")(lambda t: changes.payment_districts(t.districts, t.payment_requests))

register("payment_warehouses", """
, pay AS (SELECT w_id, sum(amount) AS paid FROM payment_requests GROUP BY w_id)
SELECT w.* EXCLUDE (w_ytd), CAST(w.w_ytd + coalesce(p.paid, 0) AS DECIMAL(12,2)) AS w_ytd
FROM warehouses w LEFT JOIN pay p ON p.w_id = w.w_id
""")(lambda t: changes.payment_warehouses(t.warehouses, t.payment_requests))

register("payment_receipts", """
SELECT p.seq, p.w_id, p.d_id, p.c_id, p.amount, c.c_first, c.c_middle, c.c_last, c.c_credit, c.c_discount,
  CAST(c.c_balance - sum(p.amount) OVER (PARTITION BY p.w_id, p.d_id, p.c_id ORDER BY p.seq
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS balance_after,
  concat_ws(', ', w.w_street_1, w.w_street_2, w.w_city, w.w_state, w.w_zip) AS w_address,
  concat_ws(', ', d.d_street_1, d.d_street_2, d.d_city, d.d_state, d.d_zip) AS d_address
FROM payment_requests p
JOIN customers c ON c.c_w_id = p.w_id AND c.c_d_id = p.d_id AND c.c_id = p.c_id
JOIN districts d ON d.d_w_id = p.w_id AND d.d_id = p.d_id
JOIN warehouses w ON w.w_id = p.w_id
""")(lambda t: changes.payment_receipts(t.payment_requests, t.customers, t.districts, t.warehouses))

# ----------------------------------------------------------------- Delivery

_DELIVERED = """
, und AS (
  SELECT o_w_id AS w_id, o_d_id AS d_id, o_id, o_c_id AS c_id,
    row_number() OVER (PARTITION BY o_w_id, o_d_id ORDER BY o_id) AS k
  FROM w_orders WHERE o_carrier_id IS NULL),
rq AS (
  SELECT seq, w_id, carrier_id, delivery_d, row_number() OVER (PARTITION BY w_id ORDER BY seq) AS k
  FROM delivery_requests),
delivered AS (
  SELECT rq.seq, und.w_id, und.d_id, und.o_id, und.c_id, rq.carrier_id, rq.delivery_d
  FROM und JOIN rq ON rq.w_id = und.w_id AND rq.k = und.k)
"""


def _delivered(t):
    return changes.delivered_orders(t.orders, t.delivery_requests)


register("oldest_undelivered", """
SELECT o_w_id AS w_id, o_d_id AS d_id, min(o_id) AS o_id, arg_min(o_c_id, o_id) AS c_id
FROM w_orders WHERE o_carrier_id IS NULL GROUP BY o_w_id, o_d_id
""")(lambda t: changes.oldest_undelivered(t.orders))

register("deliver_orders", _DELIVERED + """
SELECT o.* EXCLUDE (o_carrier_id), coalesce(dl.carrier_id, o.o_carrier_id) AS o_carrier_id
FROM w_orders o LEFT JOIN delivered dl ON dl.w_id = o.o_w_id AND dl.d_id = o.o_d_id AND dl.o_id = o.o_id
""")(lambda t: changes.deliver_orders(t.orders, _delivered(t)))

register("deliver_lines", _DELIVERED + """
SELECT ol.* EXCLUDE (ol_delivery_d), coalesce(dl.delivery_d, ol.ol_delivery_d) AS ol_delivery_d
FROM order_lines ol
LEFT JOIN delivered dl ON dl.w_id = ol.ol_w_id AND dl.d_id = ol.ol_d_id AND dl.o_id = ol.ol_o_id
""")(lambda t: changes.deliver_lines(t.order_lines, _delivered(t)))

register("deliver_customers", _DELIVERED + """
, amt AS (SELECT ol_w_id, ol_d_id, ol_o_id, CAST(sum(ol_amount) AS DECIMAL(18,2)) AS amount
          FROM order_lines GROUP BY 1, 2, 3),
dc AS (SELECT dl.w_id, dl.d_id, dl.c_id, sum(coalesce(a.amount, 0)) AS amt, count(*) AS n
       FROM delivered dl
       LEFT JOIN amt a ON a.ol_w_id = dl.w_id AND a.ol_d_id = dl.d_id AND a.ol_o_id = dl.o_id
       GROUP BY 1, 2, 3)
SELECT c.* EXCLUDE (c_balance, c_delivery_cnt),
  CAST(c.c_balance + coalesce(dc.amt, 0) AS DECIMAL(12,2)) AS c_balance,
  CAST(c.c_delivery_cnt + coalesce(dc.n, 0) AS INTEGER) AS c_delivery_cnt
FROM customers c LEFT JOIN dc ON dc.w_id = c.c_w_id AND dc.d_id = c.c_d_id AND dc.c_id = c.c_id
""")(lambda t: changes.deliver_customers(t.customers, t.order_lines, _delivered(t)))

register("deliver_remaining_queue", _DELIVERED + """
SELECT o.o_w_id, o.o_d_id, o.o_id, o.o_c_id FROM w_orders o
WHERE o.o_carrier_id IS NULL
  AND NOT EXISTS (SELECT 1 FROM delivered dl
                  WHERE dl.w_id = o.o_w_id AND dl.d_id = o.o_d_id AND dl.o_id = o.o_id)
""")(lambda t: changes.deliver_remaining_queue(t.orders, _delivered(t)))

# Deliveries without a time are stamped with the time of the run.
register("deliver_now", _DELIVERED + """
SELECT ol.ol_w_id, ol.ol_d_id, ol.ol_o_id, ol.ol_number, dl.o_id IS NOT NULL AS just_now
FROM order_lines ol LEFT JOIN delivered dl ON dl.w_id = ol.ol_w_id AND dl.d_id = ol.ol_d_id AND dl.o_id = ol.ol_o_id
""")(lambda t: _deliver_now(t))


def _deliver_now(t):
    began = F.lit(datetime.datetime.now(datetime.UTC).replace(tzinfo=None) - datetime.timedelta(days=1)).cast("timestamp_ntz")
    rq = t.delivery_requests.withColumn("delivery_d", F.lit(None).cast("timestamp_ntz"))
    lines = changes.deliver_lines(t.order_lines, changes.delivered_orders(t.orders, rq))
    return lines.select("ol_w_id", "ol_d_id", "ol_o_id", "ol_number", F.coalesce(F.col("ol_delivery_d") >= began, F.lit(False)).alias("just_now"))


# Deliveries to every second warehouse, on tables stored by warehouse: the other partitions stay as they are.
_SOME_DELIVERED = _DELIVERED.replace("FROM delivery_requests)", "FROM delivery_requests WHERE w_id % 2 = 0)")


def _stored_delivery(t, name, partition, change):
    path = scratch_table_path(t.spark, f"stored-{name}-{uuid.uuid4().hex[:12]}")
    versions.write_partitioned(t.base(name), path, [partition])
    dl = cut_lineage(changes.delivered_orders(t.orders, t.delivery_requests.where("w_id % 2 = 0")), "delivered")
    versions.rewrite_touched(t.spark, path, dl.select(F.col("w_id").alias(partition)), [partition], lambda old: change(old, dl))
    return t.spark.read.parquet(path).select(*t.base(name).columns)


register("deliver_stored_orders", _SOME_DELIVERED + """
SELECT o.* EXCLUDE (o_carrier_id), coalesce(dl.carrier_id, o.o_carrier_id) AS o_carrier_id
FROM w_orders o LEFT JOIN delivered dl ON dl.w_id = o.o_w_id AND dl.d_id = o.o_d_id AND dl.o_id = o.o_id
""")(lambda t: _stored_delivery(t, "orders", "o_w_id", changes.deliver_orders))

register("deliver_stored_customers", _SOME_DELIVERED + """
, amt AS (SELECT ol_w_id, ol_d_id, ol_o_id, CAST(sum(ol_amount) AS DECIMAL(18,2)) AS amount FROM order_lines GROUP BY 1, 2, 3),
dc AS (SELECT dl.w_id, dl.d_id, dl.c_id, sum(coalesce(a.amount, 0)) AS amt, count(*) AS n
       FROM delivered dl LEFT JOIN amt a ON a.ol_w_id = dl.w_id AND a.ol_d_id = dl.d_id AND a.ol_o_id = dl.o_id GROUP BY 1, 2, 3)
SELECT c.* EXCLUDE (c_balance, c_delivery_cnt), CAST(c.c_balance + coalesce(dc.amt, 0) AS DECIMAL(12,2)) AS c_balance,
  CAST(c.c_delivery_cnt + coalesce(dc.n, 0) AS INTEGER) AS c_delivery_cnt
FROM customers c LEFT JOIN dc ON dc.w_id = c.c_w_id AND dc.d_id = c.c_d_id AND dc.c_id = c.c_id
""")(lambda t: _stored_delivery(t, "customers", "c_w_id", lambda old, dl: changes.deliver_customers(old, t.order_lines, dl)))

# ---------------------------------------------------------------- New-Order

_NEW_ORDER = """
, chk AS (
  SELECT l.seq, l.line_no, l.i_id, l.supply_w_id, l.quantity, r.w_id, r.d_id, r.c_id,
    it.i_name, it.i_price, s.s_quantity AS q0
  FROM new_order_line_requests l
  JOIN new_order_requests r ON r.seq = l.seq
  JOIN items it ON it.i_id = l.i_id
  JOIN stocks s ON s.s_w_id = l.supply_w_id AND s.s_i_id = l.i_id),
per AS (
  SELECT seq, count(*) AS n_lines, min(CASE WHEN supply_w_id = w_id THEN 1 ELSE 0 END) AS all_local,
    sum(quantity) AS total_quantity
  FROM chk GROUP BY seq),
hdr AS (
  SELECT r.seq, r.w_id AS o_w_id, r.d_id AS o_d_id,
    CAST(d.d_next_o_id + row_number() OVER (PARTITION BY r.w_id, r.d_id ORDER BY r.seq) - 1 AS INTEGER) AS o_id,
    r.c_id AS o_c_id, CAST(NULL AS INTEGER) AS o_carrier_id,
    CAST(coalesce(per.n_lines, 0) AS INTEGER) AS o_ol_cnt,
    CAST(coalesce(per.all_local, 1) AS INTEGER) AS o_all_local,
    r.entry_d AS o_entry_d,
    CAST(coalesce(per.total_quantity, 0) AS BIGINT) AS total_quantity
  FROM new_order_requests r
  JOIN districts d ON d.d_w_id = r.w_id AND d.d_id = r.d_id
  LEFT JOIN per ON per.seq = r.seq),
nl AS (
  SELECT c.w_id AS ol_w_id, c.d_id AS ol_d_id, h.o_id AS ol_o_id, c.line_no AS ol_number,
    c.i_id AS ol_i_id, CAST(NULL AS TIMESTAMP) AS ol_delivery_d,
    CAST(c.quantity * c.i_price AS DECIMAL(12,2)) AS ol_amount,
    c.supply_w_id AS ol_supply_w_id, c.quantity AS ol_quantity,
    'S_DIST_' || CAST(c.d_id AS VARCHAR) AS ol_dist_info
  FROM chk c JOIN hdr h ON h.seq = c.seq)
"""


def _headers(t):
    return changes.new_order_headers(t.new_order_requests, t.new_order_line_requests, t.districts,
                                     t.items, t.stocks)


def _new_lines(t):
    return changes.new_order_lines(_headers(t), t.new_order_line_requests, t.new_order_requests,
                                   t.items, t.stocks)


def _headers_and_lines(t):
    """Both, from checked lines and headers that are written once."""
    rq, lines = t.new_order_requests, t.new_order_line_requests
    checked = cut_lineage(changes.new_order_checked_lines(lines, rq, t.items, t.stocks), "new-order-checked")
    h = cut_lineage(changes.new_order_headers(rq, lines, t.districts, t.items, t.stocks, checked=checked), "new-orders")
    return h, changes.new_order_lines(h, lines, rq, t.items, t.stocks, checked=checked)


register("new_order_headers", _NEW_ORDER + "SELECT * FROM hdr", split=True)(_headers)
register("new_order_lines", _NEW_ORDER + "SELECT * FROM nl", split=True)(lambda t: _headers_and_lines(t)[1])

register("new_order_stock", _NEW_ORDER + """
, su AS (SELECT supply_w_id AS s_w_id, i_id AS s_i_id, sum(quantity) AS used, count(*) AS n,
           sum(CASE WHEN supply_w_id <> w_id THEN 1 ELSE 0 END) AS remote
         FROM chk GROUP BY 1, 2),
st AS (SELECT s.*, coalesce(su.used, 0) AS used, coalesce(su.n, 0) AS n, coalesce(su.remote, 0) AS remote
       FROM stocks s LEFT JOIN su ON su.s_w_id = s.s_w_id AND su.s_i_id = s.s_i_id)
SELECT st.* EXCLUDE (s_quantity, s_ytd, s_order_cnt, s_remote_cnt, used, n, remote),
  CAST(s_quantity - used + 100 * CASE WHEN 10 - (s_quantity - used) > 0
       THEN (10 - (s_quantity - used) + 99) // 100 ELSE 0 END AS INTEGER) AS s_quantity,
  CAST(s_ytd + used AS DECIMAL(12,2)) AS s_ytd,
  CAST(s_order_cnt + n AS INTEGER) AS s_order_cnt,
  CAST(s_remote_cnt + remote AS INTEGER) AS s_remote_cnt
FROM st
""", split=True)(lambda t: changes.new_order_stock(t.stocks, t.new_order_line_requests, t.new_order_requests, t.items))

register("new_order_stock_trace", _NEW_ORDER + """
SELECT seq, line_no, supply_w_id AS s_w_id, i_id AS s_i_id, quantity,
  CAST(q0 - run + 100 * CASE WHEN 10 - (q0 - run) > 0 THEN (10 - (q0 - run) + 99) // 100 ELSE 0 END
       AS INTEGER) AS s_quantity_after
FROM (SELECT *, sum(quantity) OVER (PARTITION BY supply_w_id, i_id ORDER BY seq, line_no
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM chk) x
""", split=True)(lambda t: changes.new_order_stock_trace(t.new_order_line_requests, t.new_order_requests,
                                             t.items, t.stocks))

# Quantities up to 350, among them returns, on stocks from 0 to 22: line by line in SQL.
_ODD_LINES = """
, odd_lines AS (SELECT seq, line_no, i_id, supply_w_id, CASE (seq + line_no) % 4 WHEN 0 THEN quantity * 7 WHEN 1 THEN -quantity ELSE quantity END AS quantity
                FROM new_order_line_requests),
odd AS (
  SELECT l.*, s.s_quantity % 23 AS q0, row_number() OVER (PARTITION BY l.supply_w_id, l.i_id ORDER BY l.seq, l.line_no) AS i
  FROM odd_lines l JOIN new_order_requests r ON r.seq = l.seq JOIN items it ON it.i_id = l.i_id
  JOIN stocks s ON s.s_w_id = l.supply_w_id AND s.s_i_id = l.i_id),
trace AS (
  WITH RECURSIVE f AS (
    SELECT *, q0 - quantity + CASE WHEN q0 - quantity < 10 THEN 100 ELSE 0 END AS q FROM odd WHERE i = 1
    UNION ALL
    SELECT o.*, f.q - o.quantity + CASE WHEN f.q - o.quantity < 10 THEN 100 ELSE 0 END
    FROM f JOIN odd o ON o.supply_w_id = f.supply_w_id AND o.i_id = f.i_id AND o.i = f.i + 1)
  SELECT * FROM f)
"""


def _odd_lines(t):
    kind = (F.col("seq") + F.col("line_no")) % 4
    quantity = F.when(kind == 0, F.col("quantity") * 7).when(kind == 1, -F.col("quantity")).otherwise(F.col("quantity")).cast("int")
    return t.new_order_line_requests.withColumn("quantity", quantity)


def _low_stocks(t):
    return t.stocks.withColumn("s_quantity", F.col("s_quantity") % 23)


register("new_order_stock_trace_any", _ODD_LINES + """
SELECT seq, line_no, supply_w_id AS s_w_id, i_id AS s_i_id, CAST(quantity AS INTEGER) AS quantity, CAST(q AS INTEGER) AS s_quantity_after FROM trace
""", split=True)(lambda t: changes.new_order_stock_trace(_odd_lines(t), t.new_order_requests, t.items, _low_stocks(t)))

register("new_order_stock_any", _ODD_LINES + """
, last AS (SELECT supply_w_id, i_id, arg_max(q, i) AS q FROM trace GROUP BY 1, 2)
SELECT s.s_w_id, s.s_i_id, CAST(coalesce(last.q, s.s_quantity % 23) AS INTEGER) AS s_quantity
FROM stocks s LEFT JOIN last ON last.supply_w_id = s.s_w_id AND last.i_id = s.s_i_id
""", split=True)(lambda t: changes.new_order_stock(_low_stocks(t), _odd_lines(t), t.new_order_requests, t.items)
                .select("s_w_id", "s_i_id", "s_quantity"))

register("new_order_districts", """
, n AS (SELECT w_id, d_id, count(*) AS n FROM new_order_requests GROUP BY w_id, d_id)
SELECT d.* EXCLUDE (d_next_o_id), CAST(d.d_next_o_id + coalesce(n.n, 0) AS INTEGER) AS d_next_o_id
FROM districts d LEFT JOIN n ON n.w_id = d.d_w_id AND n.d_id = d.d_id
""", split=True)(lambda t: changes.new_order_districts(t.districts, t.new_order_requests))

register("new_order_totals", _NEW_ORDER + """
, amt AS (SELECT ol_w_id, ol_d_id, ol_o_id, CAST(sum(ol_amount) AS DECIMAL(18,2)) AS amount
          FROM nl GROUP BY 1, 2, 3)
SELECT h.seq, h.o_w_id, h.o_d_id, h.o_id, h.o_c_id,
  coalesce(a.amount, CAST(0 AS DECIMAL(18,2))) AS amount,
  CAST(round_even(coalesce(a.amount, CAST(0 AS DECIMAL(18,2)))
       * CAST(1 + w.w_tax + d.d_tax AS DECIMAL(6,4))
       * CAST(1 - c.c_discount AS DECIMAL(6,4)), 2) AS DECIMAL(18,2)) AS total_amount
FROM hdr h
LEFT JOIN amt a ON a.ol_w_id = h.o_w_id AND a.ol_d_id = h.o_d_id AND a.ol_o_id = h.o_id
JOIN warehouses w ON w.w_id = h.o_w_id
JOIN districts d ON d.d_w_id = h.o_w_id AND d.d_id = h.o_d_id
JOIN customers c ON c.c_w_id = h.o_w_id AND c.c_d_id = h.o_d_id AND c.c_id = h.o_c_id
""", split=True)(lambda t: changes.new_order_totals(*_headers_and_lines(t), t.warehouses, t.districts, t.customers))

register("new_order_popular_lines", _NEW_ORDER + """
SELECT h.seq, nl.ol_w_id, nl.ol_d_id, nl.ol_o_id, nl.ol_number, nl.ol_i_id, it.i_name, nl.ol_quantity
FROM nl
JOIN hdr h ON h.o_w_id = nl.ol_w_id AND h.o_d_id = nl.ol_d_id AND h.o_id = nl.ol_o_id
JOIN items it ON it.i_id = nl.ol_i_id
WHERE nl.ol_quantity = (SELECT max(y.ol_quantity) FROM nl y
                        WHERE y.ol_w_id = nl.ol_w_id AND y.ol_d_id = nl.ol_d_id AND y.ol_o_id = nl.ol_o_id)
""", split=True)(lambda t: changes.new_order_popular_lines(*_headers_and_lines(t), t.items))

def _insert_with_conflicts(t):
    """Every new order twice (the second one later and different) and every
    present order once more: only the first new ones get in."""
    h = _headers(t).select("seq", *t.orders.columns)
    again = h.withColumn("seq", F.col("seq") + 10**12).withColumn("o_ol_cnt", F.col("o_ol_cnt") + 1)
    present = t.orders.select(F.lit(-1).cast("long").alias("seq"), "*").withColumn("o_carrier_id", F.lit(99))
    rows = h.unionByName(again).unionByName(present.select(*h.columns))
    return changes.insert_if_absent(t.orders, rows, ["o_w_id", "o_d_id", "o_id"], ["seq"])


register("insert_if_absent", _NEW_ORDER + """
SELECT * FROM w_orders
UNION ALL
SELECT h.o_w_id, h.o_d_id, h.o_id, h.o_c_id, h.o_carrier_id, h.o_ol_cnt, h.o_all_local, h.o_entry_d
FROM hdr h
WHERE NOT EXISTS (SELECT 1 FROM w_orders o
                  WHERE o.o_w_id = h.o_w_id AND o.o_d_id = h.o_d_id AND o.o_id = h.o_id)
""", split=True)(lambda t: _insert_with_conflicts(t))

# Every 17th requested line names an item that isn't there: such lines are
# rejected, the rest of their orders goes ahead.
register("new_order_rejects", """
, l AS (SELECT seq, line_no, CASE WHEN (seq + line_no) % 17 = 0 THEN i_id + 10000000 ELSE i_id END AS i_id, supply_w_id, quantity
        FROM new_order_line_requests)
SELECT l.seq, l.line_no, l.i_id, l.supply_w_id, l.quantity FROM l
WHERE NOT EXISTS (SELECT 1 FROM items i WHERE i.i_id = l.i_id)
   OR NOT EXISTS (SELECT 1 FROM stocks s WHERE s.s_w_id = l.supply_w_id AND s.s_i_id = l.i_id)
""", split=True)(lambda t: _rejected_lines(t))


def _rejected_lines(t):
    faulty = F.when((F.col("seq") + F.col("line_no")) % 17 == 0, F.col("i_id") + 10_000_000).otherwise(F.col("i_id"))
    lines = t.new_order_line_requests.withColumn("i_id", faulty)
    return (changes.new_order_checked_lines(lines, t.new_order_requests, t.items, t.stocks).filter(~F.col("accepted"))
            .select("seq", "line_no", "i_id", "supply_w_id", "quantity"))


# Derived tables stored once and kept up by the deltas of a batch (operators/upkeep.py); the SQL builds them anew.


def _stored(t, name):
    """The derived table of the base tables, stored; its path."""
    path = scratch_table_path(t.spark, f"stored-{name}-{uuid.uuid4().hex[:12]}")
    rows = {"customer_order_items": lambda: upkeep.customer_order_items(t.orders, t.order_lines), "undelivered_orders": lambda: derived.undelivered_orders(t.orders),
            "orders_by_customer": lambda: derived.orders_by_customer(t.orders, t.customers)}[name]()
    upkeep.store(rows, path, upkeep.PARTITION[name])
    return path


def _kept_up(t, name, *deltas):
    path = _stored(t, name)
    for d in deltas:
        upkeep.apply(t.spark, path, d, upkeep.PARTITION[name])
    return upkeep.read(t.spark, path)


def _new_orders(t):
    """The new orders as rows of ``orders``, written once."""
    return cut_lineage(_headers(t).select(*t.orders.columns), "new-orders")


def _delivered_delta(t, new):
    """The change of the orders, new ones included, by the Delivery requests."""
    after = t.orders.unionByName(new)
    return upkeep.delivery_delta(after, cut_lineage(changes.delivered_orders(after, t.delivery_requests), "delivered"))


register("upkeep_customer_order_items", _NEW_ORDER + """
SELECT DISTINCT o.o_w_id AS w_id, o.o_d_id AS d_id, o.o_c_id AS c_id, o.o_id, ol.ol_i_id AS i_id
FROM (SELECT o_w_id, o_d_id, o_c_id, o_id FROM w_orders UNION ALL SELECT o_w_id, o_d_id, o_c_id, o_id FROM hdr) o
JOIN (SELECT ol_w_id, ol_d_id, ol_o_id, ol_i_id FROM order_lines UNION ALL SELECT ol_w_id, ol_d_id, ol_o_id, ol_i_id FROM nl) ol
  ON ol.ol_w_id = o.o_w_id AND ol.ol_d_id = o.o_d_id AND ol.ol_o_id = o.o_id
""", split=True)(lambda t: _kept_up(t, "customer_order_items", upkeep.customer_order_items_delta(
    t.orders, upkeep.came(_new_orders(t)), t.order_lines, upkeep.came(_new_lines(t)))))

# Every third line of an order is taken back: its item stays while another line has it.
register("upkeep_returned_lines", """
SELECT DISTINCT o.o_w_id AS w_id, o.o_d_id AS d_id, o.o_c_id AS c_id, o.o_id, ol.ol_i_id AS i_id
FROM w_orders o JOIN order_lines ol ON ol.ol_w_id = o.o_w_id AND ol.ol_d_id = o.o_d_id AND ol.ol_o_id = o.o_id
WHERE ol.ol_number % 3 <> 0
""")(lambda t: _kept_up(t, "customer_order_items", upkeep.customer_order_items_delta(
    t.orders, None, t.order_lines, upkeep.went(t.order_lines.where("ol_number % 3 = 0")))))

register("upkeep_undelivered_orders", _NEW_ORDER + """
SELECT o_w_id, o_d_id, o_id, o_c_id FROM w_orders WHERE o_carrier_id IS NULL
UNION ALL SELECT o_w_id, o_d_id, o_id, o_c_id FROM hdr
""", split=True)(lambda t: _kept_up(t, "undelivered_orders", upkeep.undelivered_delta(upkeep.came(_new_orders(t)))))

register("upkeep_orders_by_customer", _NEW_ORDER + """
SELECT c.c_w_id, c.c_d_id, c.c_id, o.o_id, o.o_entry_d, o.o_carrier_id, o.o_ol_cnt, c.c_first, c.c_middle, c.c_last
FROM (SELECT o_w_id, o_d_id, o_c_id, o_id, o_entry_d, o_carrier_id, o_ol_cnt FROM w_orders
      UNION ALL SELECT o_w_id, o_d_id, o_c_id, o_id, o_entry_d, o_carrier_id, o_ol_cnt FROM hdr) o
JOIN customers c ON c.c_w_id = o.o_w_id AND c.c_d_id = o.o_d_id AND c.c_id = o.o_c_id
""", split=True)(lambda t: _kept_up(t, "orders_by_customer", upkeep.orders_by_customer_delta(upkeep.came(_new_orders(t)), t.customers)))

_AFTER_DELIVERY = _NEW_ORDER + """
, all_orders AS (SELECT o_w_id, o_d_id, o_id, o_c_id, o_entry_d, o_carrier_id, o_ol_cnt FROM w_orders
                 UNION ALL SELECT o_w_id, o_d_id, o_id, o_c_id, o_entry_d, o_carrier_id, o_ol_cnt FROM hdr),
und AS (SELECT *, row_number() OVER (PARTITION BY o_w_id, o_d_id ORDER BY o_id) AS k FROM all_orders WHERE o_carrier_id IS NULL),
rq AS (SELECT w_id, carrier_id, row_number() OVER (PARTITION BY w_id ORDER BY seq) AS k FROM delivery_requests),
now AS (
  SELECT o.* EXCLUDE (o_carrier_id), coalesce(o.o_carrier_id, rq.carrier_id) AS o_carrier_id
  FROM all_orders o
  LEFT JOIN und ON und.o_w_id = o.o_w_id AND und.o_d_id = o.o_d_id AND und.o_id = o.o_id
  LEFT JOIN rq ON rq.w_id = und.o_w_id AND rq.k = und.k)
"""

register("upkeep_undelivered_after_delivery", _AFTER_DELIVERY + "SELECT o_w_id, o_d_id, o_id, o_c_id FROM now WHERE o_carrier_id IS NULL",
         split=True)(lambda t: _after_delivery(t, "undelivered_orders", upkeep.undelivered_delta))

register("upkeep_carriers_by_customer", _AFTER_DELIVERY + """
SELECT c.c_w_id, c.c_d_id, c.c_id, o.o_id, o.o_entry_d, o.o_carrier_id, o.o_ol_cnt, c.c_first, c.c_middle, c.c_last
FROM now o JOIN customers c ON c.c_w_id = o.o_w_id AND c.c_d_id = o.o_d_id AND c.c_id = o.o_c_id
""", split=True)(lambda t: _after_delivery(t, "orders_by_customer", lambda d: upkeep.orders_by_customer_delta(d, t.customers)))


def _after_delivery(t, name, delta):
    """A batch of new orders, then one of deliveries: the carrier of an order is copied to where the order is stored."""
    new = _new_orders(t)
    return _kept_up(t, name, delta(upkeep.came(new)), delta(_delivered_delta(t, new)))


# ------------------------------------------------------------- whole batch


def _batch_state(t):
    new = changes.apply_batch({n: t.base(n) for n in ("warehouses", "districts", "customers", "orders",
                                                       "order_lines", "items", "stocks")},
                              t.payment_requests, t.new_order_requests, t.new_order_line_requests,
                              t.delivery_requests)
    return audit.db_state(new["warehouses"], new["districts"], new["customers"], new["orders"],
                          new["order_lines"], new["stocks"])


_BATCH_SQL = """
, pay_c AS (SELECT w_id, d_id, c_id, sum(amount) AS paid, count(*) AS n FROM payment_requests GROUP BY 1, 2, 3),
pay_d AS (SELECT w_id, d_id, sum(amount) AS paid FROM payment_requests GROUP BY 1, 2),
pay_w AS (SELECT w_id, sum(amount) AS paid FROM payment_requests GROUP BY 1),
n_new AS (SELECT w_id, d_id, count(*) AS n FROM new_order_requests GROUP BY 1, 2),
wh2 AS (SELECT w.w_ytd + coalesce(p.paid, 0) AS w_ytd FROM warehouses w LEFT JOIN pay_w p ON p.w_id = w.w_id),
di2 AS (SELECT d.d_ytd + coalesce(p.paid, 0) AS d_ytd, d.d_next_o_id + coalesce(n.n, 0) AS d_next_o_id
        FROM districts d LEFT JOIN pay_d p ON p.w_id = d.d_w_id AND p.d_id = d.d_id
        LEFT JOIN n_new n ON n.w_id = d.d_w_id AND n.d_id = d.d_id),
ord2 AS (SELECT o_w_id, o_d_id, o_id, o_c_id, o_carrier_id, o_ol_cnt FROM w_orders
         UNION ALL SELECT o_w_id, o_d_id, o_id, o_c_id, o_carrier_id, o_ol_cnt FROM hdr),
lines2 AS (SELECT ol_w_id, ol_d_id, ol_o_id, ol_amount, ol_quantity FROM order_lines
           UNION ALL SELECT ol_w_id, ol_d_id, ol_o_id, ol_amount, ol_quantity FROM nl),
@DELIVERED@ord3 AS (SELECT o.o_id, o.o_ol_cnt FROM ord2 o),
amt AS (SELECT dl.w_id, dl.d_id, dl.c_id, sum(l.ol_amount) AS amount
        FROM delivered dl JOIN lines2 l ON l.ol_w_id = dl.w_id AND l.ol_d_id = dl.d_id AND l.ol_o_id = dl.o_id
        GROUP BY 1, 2, 3),
ndel AS (SELECT w_id, d_id, c_id, count(*) AS n FROM delivered GROUP BY 1, 2, 3),
cu2 AS (SELECT c.c_balance - coalesce(p.paid, 0) + coalesce(a.amount, 0) AS c_balance,
          c.c_ytd_payment + coalesce(p.paid, 0) AS c_ytd_payment,
          c.c_payment_cnt + coalesce(p.n, 0) AS c_payment_cnt,
          c.c_delivery_cnt + coalesce(nd.n, 0) AS c_delivery_cnt
        FROM customers c
        LEFT JOIN pay_c p ON p.w_id = c.c_w_id AND p.d_id = c.c_d_id AND p.c_id = c.c_id
        LEFT JOIN amt a ON a.w_id = c.c_w_id AND a.d_id = c.c_d_id AND a.c_id = c.c_id
        LEFT JOIN ndel nd ON nd.w_id = c.c_w_id AND nd.d_id = c.c_d_id AND nd.c_id = c.c_id),
su AS (SELECT supply_w_id AS s_w_id, i_id AS s_i_id, sum(quantity) AS used, count(*) AS n,
         sum(CASE WHEN supply_w_id <> w_id THEN 1 ELSE 0 END) AS remote FROM chk GROUP BY 1, 2),
st2 AS (SELECT s.s_quantity - coalesce(su.used, 0) + 100 * CASE WHEN 10 - (s.s_quantity - coalesce(su.used, 0)) > 0
                 THEN (10 - (s.s_quantity - coalesce(su.used, 0)) + 99) // 100 ELSE 0 END AS s_quantity,
          s.s_ytd + coalesce(su.used, 0) AS s_ytd, s.s_order_cnt + coalesce(su.n, 0) AS s_order_cnt,
          s.s_remote_cnt + coalesce(su.remote, 0) AS s_remote_cnt
        FROM stocks s LEFT JOIN su ON su.s_w_id = s.s_w_id AND su.s_i_id = s.s_i_id)
"""

_BATCH_DELIVERED = """und AS (SELECT o_w_id AS w_id, o_d_id AS d_id, o_id, o_c_id AS c_id,
          row_number() OVER (PARTITION BY o_w_id, o_d_id ORDER BY o_id) AS k
        FROM ord2 WHERE o_carrier_id IS NULL),
rq AS (SELECT w_id, carrier_id, row_number() OVER (PARTITION BY w_id ORDER BY seq) AS k FROM delivery_requests),
delivered AS (SELECT und.w_id, und.d_id, und.o_id, und.c_id, rq.carrier_id
              FROM und JOIN rq ON rq.w_id = und.w_id AND rq.k = und.k),
"""

# Deliveries and new orders of each district line by line: a delivery takes an order if one waits.
_REPLAY = """
step_events AS (
  SELECT r.w_id, r.d_id, r.seq % 20 AS client, (r.seq // 20) % 2 AS part, r.seq AS k1, 'N' AS code, NULL::INTEGER AS carrier_id FROM new_order_requests r
  UNION ALL SELECT b.w_id, g.d_id, b.client, b.part, b.k1, 'D', b.carrier_id FROM script_deliveries b CROSS JOIN range(1, 11) g(d_id)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY w_id, d_id ORDER BY client, part, k1, code) AS i FROM step_events),
waiting AS (SELECT o_w_id AS w_id, o_d_id AS d_id, count(*) AS n FROM w_orders WHERE o_carrier_id IS NULL GROUP BY 1, 2),
line_by_line AS (
  WITH RECURSIVE s AS (
    SELECT d.d_w_id AS w_id, d.d_id, 0::BIGINT AS i, coalesce(w.n, 0)::BIGINT AS queued, 0::BIGINT AS taken, NULL::BIGINT AS k,
           NULL::BIGINT AS client, NULL::VARCHAR AS code, NULL::INTEGER AS carrier_id
    FROM districts d LEFT JOIN waiting w ON w.w_id = d.d_w_id AND w.d_id = d.d_id
    UNION ALL
    SELECT s.w_id, s.d_id, e.i,
           CASE WHEN e.code = 'N' THEN s.queued + 1 WHEN s.queued > 0 THEN s.queued - 1 ELSE 0 END,
           CASE WHEN e.code = 'D' AND s.queued > 0 THEN s.taken + 1 ELSE s.taken END,
           CASE WHEN e.code = 'D' AND s.queued > 0 THEN s.taken + 1 END, e.client, e.code, e.carrier_id
    FROM s JOIN numbered e ON e.w_id = s.w_id AND e.d_id = s.d_id AND e.i = s.i + 1)
  SELECT * FROM s WHERE code = 'D'),
queue AS (
  SELECT w_id, d_id, o_id, c_id, row_number() OVER (PARTITION BY w_id, d_id ORDER BY o_id) AS k
  FROM (SELECT o_w_id AS w_id, o_d_id AS d_id, o_id, o_c_id AS c_id FROM w_orders WHERE o_carrier_id IS NULL
        UNION ALL SELECT o_w_id, o_d_id, o_id, o_c_id FROM hdr)),
attempts AS (
  SELECT l.client, l.w_id, l.d_id, l.carrier_id, q.o_id, q.c_id
  FROM line_by_line l LEFT JOIN queue q ON q.w_id = l.w_id AND q.d_id = l.d_id AND q.k = l.k),
delivered AS (SELECT * FROM attempts WHERE o_id IS NOT NULL),
"""

_FEW_DELIVERIES = """
, script_deliveries AS (
  SELECT w_id, w_id % 20 AS client, (seq // 20) % 2 AS part, seq AS k1, carrier_id FROM delivery_requests),
"""

_BUSY_DELIVERIES = """
, script_deliveries AS (
  SELECT c.c_w_id AS w_id, e.event_id % 20 AS client, (e.event_id // 20) % 2 AS part, e.event_id AS k1, CAST(e.event_id % 10 + 1 AS INTEGER) AS carrier_id
  FROM events e JOIN customers c ON c.c_id = e.user_id WHERE e.event_type = 'click'),
"""

register("db_state_after_batch", _NEW_ORDER + _BATCH_SQL.replace("@DELIVERED@", _BATCH_DELIVERED) + _db_state_sql(
    "wh2", "di2", "cu2", "ord3", "lines2", "st2"), split=True)(_batch_state)


def _log_batch_state(t, lines=txlog.script_lines):
    """The scripts' records applied in the order of their lines."""
    req = script_requests(t, lines)
    new = changes.apply_batch({n: t.base(n) for n in ("warehouses", "districts", "customers", "orders",
                                                       "order_lines", "items", "stocks")},
                              req["payments"], req["new_orders"], req["new_lines"], req["deliveries"], in_order=True)
    return audit.db_state(new["warehouses"], new["districts"], new["customers"], new["orders"],
                          new["order_lines"], new["stocks"])


# New orders are numbered in the order the client scripts issue them: by client
# (seq % 20), then by file ((seq // 20) % 2), then seq.
_LOG_NEW_ORDER = _NEW_ORDER.replace(
    "row_number() OVER (PARTITION BY r.w_id, r.d_id ORDER BY r.seq)",
    "row_number() OVER (PARTITION BY r.w_id, r.d_id ORDER BY r.seq % 20, (r.seq // 20) % 2, r.seq)")


def _replay_state_sql(deliveries: str) -> str:
    batch = _BATCH_SQL.strip().removeprefix(",").replace("@DELIVERED@", "")
    return _LOG_NEW_ORDER + deliveries + _REPLAY + batch + _db_state_sql("wh2", "di2", "cu2", "ord3", "lines2", "st2")


register("db_state_after_script_batch", _replay_state_sql(_FEW_DELIVERIES), split=True)(_log_batch_state)
register("db_state_after_busy_scripts", _replay_state_sql(_BUSY_DELIVERIES), split=True)(lambda t: _log_batch_state(t, txlog.busy_lines))

register("script_deliveries", _LOG_NEW_ORDER + _BUSY_DELIVERIES + _REPLAY.strip().removesuffix(",") + """
SELECT CAST(client AS INTEGER) AS client, CAST(w_id AS INTEGER) AS w_id, CAST(d_id AS INTEGER) AS d_id, carrier_id, o_id, c_id FROM attempts
""", split=True)(lambda t: _script_deliveries(t))


def _script_deliveries(t):
    """What each D record of the busy scripts finds in each district."""
    req = script_requests(t, txlog.busy_lines)
    h = cut_lineage(changes.new_order_headers(req["new_orders"], req["new_lines"], t.districts, t.items, t.stocks), "new-orders")
    found = changes.delivery_replay(t.orders, req["deliveries"], h, t.districts)
    return found.select(F.shiftright("seq", 45).cast("int").alias("client"), "w_id", "d_id", "carrier_id", "o_id", "c_id")

# ------------------------------------------------------------- as a stream


def _streamed(t, which):
    """Four slices of the requests arrive, and the stream is run again after each."""
    lines = (t.new_order_line_requests.groupBy("seq")
             .agg(F.sort_array(F.collect_list(F.struct("line_no", "i_id", "supply_w_id", "quantity"))).alias("lines")))  # some dozen lines an order
    rows = t.new_order_requests.join(lines, "seq", "left").withColumn("lines", F.coalesce("lines", F.array().cast(lines.schema["lines"].dataType)))
    place, out = scratch_table_path(t.spark, f"stream-new-orders-{uuid.uuid4().hex[:12]}"), None
    for feed in slices(t, rows, F.col("seq")):
        out = streams.stream_new_orders(t.spark, feed, t.districts, t.items, t.stocks, location=place)
    return out[which]


register("stream_new_orders", _NEW_ORDER + "SELECT * FROM hdr", split=True)(lambda t: _streamed(t, 0))

register("stream_new_order_stock", _NEW_ORDER + """
SELECT s.s_w_id, s.s_i_id, CAST(s.s_quantity - u.used + 100 * CASE WHEN 10 - (s.s_quantity - u.used) > 0
       THEN (10 - (s.s_quantity - u.used) + 99) // 100 ELSE 0 END AS INTEGER) AS s_quantity
FROM (SELECT supply_w_id, i_id, sum(quantity) AS used FROM chk GROUP BY 1, 2) u
JOIN stocks s ON s.s_w_id = u.supply_w_id AND s.s_i_id = u.i_id
""", split=True)(lambda t: _streamed(t, 1))
