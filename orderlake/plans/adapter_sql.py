"""SQL twin of ``orderlake.sources.testdata`` (FIXTURES.md section 3).

Used only as the CTE prefix of the DuckDB oracle queries; the Spark side
builds the same tables with the DataFrame API.
"""

_DIST = "\n".join(
    f"    'S-' || CAST(w.w_id AS VARCHAR) || '-' || CAST(i.i_id AS VARCHAR) || '-{k:02d}' AS s_dist_{k:02d},"
    for k in range(1, 11)
)

# Orders that arrive as New-Order requests.
_HELD_BACK = " WHERE o_orderkey % 10 <> 0"

ADAPTER_SQL = f"""
WITH
warehouses AS (
  SELECT CAST(n_nationkey AS INTEGER) AS w_id, n_name AS w_name,
    n_name || ' Road' AS w_street_1,
    'Unit ' || CAST(n_nationkey AS VARCHAR) AS w_street_2,
    n_name AS w_city, upper(substr(n_name, 1, 2)) AS w_state,
    lpad(CAST(n_nationkey AS VARCHAR), 9, '0') AS w_zip,
    CAST((n_nationkey % 20) * 0.01 AS DECIMAL(4,4)) AS w_tax,
    CAST(300000 AS DECIMAL(12,2)) AS w_ytd
  FROM nation),
customers AS (
  SELECT CAST(c_nationkey AS INTEGER) AS c_w_id,
    CAST(c_custkey % 10 + 1 AS INTEGER) AS c_d_id,
    c_custkey AS c_id,
    c_mktsegment AS c_first, 'OE' AS c_middle, c_name AS c_last,
    c_name || ' St' AS c_street_1, '' AS c_street_2,
    c_mktsegment AS c_city, upper(substr(c_mktsegment, 1, 2)) AS c_state,
    lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS c_zip,
    lpad(CAST(c_custkey AS VARCHAR), 16, '0') AS c_phone,
    TIMESTAMP '2023-01-01 00:00:00' AS c_since,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'BC' ELSE 'GC' END AS c_credit,
    CAST(50000 AS DECIMAL(12,2)) AS c_credit_lim,
    CAST((c_custkey % 50) * 0.01 AS DECIMAL(5,4)) AS c_discount,
    CAST(c_acctbal AS DECIMAL(12,2)) AS c_balance,
    CAST(0 AS DECIMAL(14,2)) AS c_ytd_payment,
    CAST(0 AS INTEGER) AS c_payment_cnt,
    CAST(0 AS INTEGER) AS c_delivery_cnt,
    c_mktsegment AS c_data
  FROM customer),
orders_keyed_all AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate,
    c.c_w_id AS o_w_id, c.c_d_id AS o_d_id
  FROM orders o JOIN customers c ON o.o_custkey = c.c_id),
base_orders_numbered AS (
  SELECT o_w_id, o_d_id,
    CAST(row_number() OVER (PARTITION BY o_w_id, o_d_id ORDER BY o_orderkey) AS INTEGER) AS o_id,
    o_custkey AS o_c_id,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderkey % 10 + 1 AS INTEGER) END AS o_carrier_id,
    o_orderdate AS o_entry_d, o_orderkey
  FROM orders_keyed_all WHERE o_orderkey % 10 <> 0),
order_lines_keyed AS (
  SELECT b.o_w_id AS ol_w_id, b.o_d_id AS ol_d_id, b.o_id AS ol_o_id,
    CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey,
         l.l_suppkey, l.l_quantity, l.l_extendedprice) AS INTEGER) AS ol_number,
    l.l_partkey AS ol_i_id,
    CASE WHEN b.o_carrier_id IS NULL THEN NULL ELSE l.l_shipdate END AS ol_delivery_d,
    CAST(l.l_extendedprice AS DECIMAL(12,2)) AS ol_amount,
    CAST(s.s_nationkey AS INTEGER) AS ol_supply_w_id,
    CAST(l.l_quantity AS INTEGER) AS ol_quantity,
    'S_DIST_' || CAST(b.o_d_id AS VARCHAR) AS ol_dist_info,
    l.l_orderkey AS ol_orderkey
  FROM lineitem l
  JOIN base_orders_numbered b ON l.l_orderkey = b.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey),
w_orders_keyed AS (
  SELECT b.o_w_id, b.o_d_id, b.o_id, b.o_c_id, b.o_carrier_id,
    CAST(coalesce(x.n_lines, 0) AS INTEGER) AS o_ol_cnt,
    CAST(CASE WHEN coalesce(x.n_remote, 0) > 0 THEN 0 ELSE 1 END AS INTEGER) AS o_all_local,
    b.o_entry_d, b.o_orderkey
  FROM base_orders_numbered b
  LEFT JOIN (SELECT ol_orderkey, count(*) AS n_lines,
               sum(CASE WHEN ol_supply_w_id <> ol_w_id THEN 1 ELSE 0 END) AS n_remote
             FROM order_lines_keyed GROUP BY ol_orderkey) x
    ON b.o_orderkey = x.ol_orderkey),
w_orders AS (
  SELECT o_w_id, o_d_id, o_id, o_c_id, o_carrier_id, o_ol_cnt, o_all_local, o_entry_d
  FROM w_orders_keyed),
order_lines AS (
  SELECT ol_w_id, ol_d_id, ol_o_id, ol_number, ol_i_id, ol_delivery_d, ol_amount,
    ol_supply_w_id, ol_quantity, ol_dist_info
  FROM order_lines_keyed),
districts AS (
  SELECT w.w_id AS d_w_id, CAST(g.d_id AS INTEGER) AS d_id,
    'D' || CAST(g.d_id AS VARCHAR) AS d_name,
    w.w_name || ' Road' AS d_street_1,
    'Unit ' || CAST(w.w_id AS VARCHAR) || '-' || CAST(g.d_id AS VARCHAR) AS d_street_2,
    w.w_name AS d_city, upper(substr(w.w_name, 1, 2)) AS d_state,
    lpad(CAST(w.w_id AS VARCHAR) || '-' || CAST(g.d_id AS VARCHAR), 9, '0') AS d_zip,
    CAST(((w.w_id * 10 + g.d_id) % 20) * 0.01 AS DECIMAL(4,4)) AS d_tax,
    CAST(30000 AS DECIMAL(12,2)) AS d_ytd,
    CAST(coalesce(m.max_o_id, 0) + 1 AS INTEGER) AS d_next_o_id
  FROM warehouses w
  CROSS JOIN range(1, 11) g(d_id)
  LEFT JOIN (SELECT o_w_id, o_d_id, max(o_id) AS max_o_id
             FROM base_orders_numbered GROUP BY o_w_id, o_d_id) m
    ON m.o_w_id = w.w_id AND m.o_d_id = g.d_id),
items AS (
  SELECT p_partkey AS i_id, p_name AS i_name,
    CAST(p_retailprice AS DECIMAL(12,2)) AS i_price,
    CAST(p_size AS INTEGER) AS i_im_id, p_brand AS i_data
  FROM part),
stocks AS (
  SELECT w.w_id AS s_w_id, i.i_id AS s_i_id,
    CAST(10 + (w.w_id * 31 + i.i_id * 17) % 91 AS INTEGER) AS s_quantity,
    CAST(0 AS DECIMAL(12,2)) AS s_ytd,
    CAST(0 AS INTEGER) AS s_order_cnt,
    CAST(0 AS INTEGER) AS s_remote_cnt,
{_DIST}
    i.i_data AS s_data
  FROM warehouses w CROSS JOIN items i),
payment_requests AS (
  SELECT e.event_id AS seq, c.c_w_id AS w_id, c.c_d_id AS d_id, c.c_id,
    CAST(e.value AS DECIMAL(12,2)) AS amount, e.ts
  FROM events e JOIN customers c ON e.user_id = c.c_id
  WHERE e.event_type = 'purchase'),
new_order_requests AS (
  SELECT o_orderkey AS seq, o_w_id AS w_id, o_d_id AS d_id, o_custkey AS c_id,
    o_orderdate AS entry_d
  FROM orders_keyed_all WHERE o_orderkey % 10 = 0),
new_order_line_requests AS (
  SELECT l.l_orderkey AS seq,
    CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey,
         l.l_suppkey, l.l_quantity, l.l_extendedprice) AS INTEGER) AS line_no,
    l.l_partkey AS i_id,
    CAST(s.s_nationkey AS INTEGER) AS supply_w_id,
    CAST(l.l_quantity AS INTEGER) AS quantity
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE l.l_orderkey IN (SELECT seq FROM new_order_requests)),
delivery_requests AS (
  SELECT w_id * 10 + j AS seq, w_id, CAST((w_id + j) % 10 + 1 AS INTEGER) AS carrier_id,
    TIMESTAMP '2024-02-01 00:00:00' AS delivery_d
  FROM warehouses JOIN (VALUES (0), (1), (2)) v(j) ON v.j <= w_id % 3),
customer_requests AS (
  SELECT c_id AS seq, c_w_id AS w_id, c_d_id AS d_id, c_id FROM customers),
related_requests AS (SELECT * FROM customer_requests WHERE c_id % 100 = 0),
stock_level_requests AS (
  SELECT (d_w_id * 20 + d_id) * 2 + j AS seq, d_w_id AS w_id, d_id, CAST(40 AS INTEGER) AS threshold, CAST(20 AS INTEGER) AS last_l
  FROM districts JOIN (VALUES (0), (1)) v(j) ON v.j <= (d_w_id + d_id) % 2),
popular_requests AS (
  SELECT (d_w_id * 20 + d_id) * 2 + j AS seq, d_w_id AS w_id, d_id, CAST(20 AS INTEGER) AS last_l
  FROM districts JOIN (VALUES (0), (1)) v(j) ON v.j <= (d_w_id + d_id) % 2),
transaction_events AS (
  SELECT CAST(user_id % 20 AS INTEGER) AS client, event_id AS seq, ts,
    event_type AS txn_type, value AS latency_ms
  FROM events)
"""


def with_adapter(body: str, split: bool = False) -> str:
    """Prefix an oracle query body with the adapter CTEs; ``split`` holds the
    orders that arrive as requests back from the base tables.

    ``body`` may start with ``, name AS (...)`` to add more CTEs, followed by
    the final SELECT.
    """
    body = body.strip()
    adapter = ADAPTER_SQL if split else ADAPTER_SQL.replace(_HELD_BACK, "")
    if body.startswith(","):
        return adapter + body
    return adapter + "\n" + body
