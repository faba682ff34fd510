"""Registered derived-table and audit queries and their oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit, changes, derived, fingerprints, ordered, upkeep
from ..sources.schema import BASE_SCHEMAS
from .registry import register

# ------------------------------------------------------------- derived tables

register("customers_denormalized", """
SELECT c.c_w_id, c.c_d_id, c.c_id, c.c_first, c.c_middle, c.c_last, c.c_street_1, c.c_street_2,
  c.c_city, c.c_state, c.c_zip, c.c_phone, c.c_since, c.c_credit, c.c_credit_lim, c.c_discount,
  c.c_balance, c.c_ytd_payment, c.c_payment_cnt, c.c_delivery_cnt,
  w.w_name AS c_w_name, d.d_name AS c_d_name
FROM customers c
JOIN districts d ON d.d_w_id = c.c_w_id AND d.d_id = c.c_d_id
JOIN warehouses w ON w.w_id = c.c_w_id
""")(lambda t: derived.customers_denormalized(t.customers, t.districts, t.warehouses))

register("customer_profile_struct", """
SELECT c_w_id, c_d_id, c_id, c_first AS name_first, c_last AS name_last, c_city AS addr_city,
  concat_ws(' ', c_first, c_middle, c_last) AS full_name,
  concat_ws(', ', c_street_1, c_street_2, c_city, c_state, c_zip) AS address_line
FROM customers
""")(lambda t: derived.customer_profiles(t.customers))

register("orders_by_customer", """
SELECT c.c_w_id, c.c_d_id, c.c_id, o.o_id, o.o_entry_d, o.o_carrier_id, o.o_ol_cnt,
  c.c_first, c.c_middle, c.c_last
FROM w_orders o JOIN customers c ON c.c_w_id = o.o_w_id AND c.c_d_id = o.o_d_id AND c.c_id = o.o_c_id
""")(lambda t: derived.orders_by_customer(t.orders, t.customers))

register("undelivered_orders", """
SELECT o_w_id, o_d_id, o_id, o_c_id FROM w_orders WHERE o_carrier_id IS NULL
""")(lambda t: derived.undelivered_orders(t.orders))

register("customer_order_items", """
SELECT DISTINCT o.o_w_id AS w_id, o.o_d_id AS d_id, o.o_c_id AS c_id, o.o_id, ol.ol_i_id AS i_id
FROM w_orders o JOIN order_lines ol ON ol.ol_w_id = o.o_w_id AND ol.ol_d_id = o.o_d_id AND ol.ol_o_id = o.o_id
""")(lambda t: derived.customer_order_items(t.orders, t.order_lines))

register("popular_items_snapshot", """
, pl AS (
  SELECT ol_w_id AS w_id, ol_d_id AS d_id, ol_o_id AS o_id, ol_i_id AS i_id, ol_quantity
  FROM (SELECT *, dense_rank() OVER (PARTITION BY ol_w_id, ol_d_id, ol_o_id ORDER BY ol_quantity DESC) AS rk
        FROM order_lines) x
  WHERE rk = 1)
SELECT pl.w_id, pl.d_id, pl.o_id, o.o_entry_d, o.o_c_id AS c_id, c.c_first, c.c_middle, c.c_last,
  pl.i_id, it.i_name, pl.ol_quantity
FROM pl
JOIN w_orders o ON o.o_w_id = pl.w_id AND o.o_d_id = pl.d_id AND o.o_id = pl.o_id
JOIN customers c ON c.c_w_id = pl.w_id AND c.c_d_id = pl.d_id AND c.c_id = o.o_c_id
JOIN items it ON it.i_id = pl.i_id
""")(lambda t: derived.popular_items_snapshot(t.orders, t.order_lines, t.items, t.customers))

register("popular_items_snapshot_min", """
, pl AS (
  SELECT ol_w_id AS w_id, ol_d_id AS d_id, ol_o_id AS o_id, ol_i_id AS i_id, ol_quantity
  FROM (SELECT *, dense_rank() OVER (PARTITION BY ol_w_id, ol_d_id, ol_o_id ORDER BY ol_quantity) AS rk
        FROM order_lines) x
  WHERE rk = 1)
SELECT pl.w_id, pl.d_id, pl.o_id, o.o_entry_d, o.o_c_id AS c_id, c.c_first, c.c_middle, c.c_last,
  pl.i_id, it.i_name, pl.ol_quantity
FROM pl
JOIN w_orders o ON o.o_w_id = pl.w_id AND o.o_d_id = pl.d_id AND o.o_id = pl.o_id
JOIN customers c ON c.c_w_id = pl.w_id AND c.c_d_id = pl.d_id AND c.c_id = o.o_c_id
JOIN items it ON it.i_id = pl.i_id
""")(lambda t: derived.popular_items_snapshot(t.orders, t.order_lines, t.items, t.customers, mode="min"))

register("top_balance_table", """
SELECT c.c_w_id, c.c_d_id, c.c_id, c.c_balance, c.c_first, c.c_middle, c.c_last, w.w_name, d.d_name
FROM customers c
JOIN districts d ON d.d_w_id = c.c_w_id AND d.d_id = c.c_d_id
JOIN warehouses w ON w.w_id = c.c_w_id
WHERE c.c_balance IS NOT NULL
""")(lambda t: derived.top_balance_table(t.customers, t.districts, t.warehouses))

register("order_lines_nested", """
SELECT ol_w_id, ol_d_id, ol_o_id, count(*) AS n_lines,
  array_to_string(list_sort(list(CAST(ol_i_id AS VARCHAR))), ',') AS item_list
FROM order_lines GROUP BY ol_w_id, ol_d_id, ol_o_id
""")(lambda t: derived.order_lines_nested(t.order_lines))

register("order_item_sets", """
SELECT ol_w_id, ol_d_id, ol_o_id, CAST(count(DISTINCT ol_i_id) AS INTEGER) AS n_items,
  array_to_string(list_sort(list(DISTINCT ol_i_id)), ',') AS item_set
FROM order_lines GROUP BY ol_w_id, ol_d_id, ol_o_id
""")(lambda t: derived.order_item_sets(t.order_lines))

register("order_amounts", """
SELECT ol_w_id AS w_id, ol_d_id AS d_id, ol_o_id AS o_id, CAST(sum(ol_amount) AS DECIMAL(18,2)) AS amount,
  count(*) AS n_lines
FROM order_lines GROUP BY ol_w_id, ol_d_id, ol_o_id
""")(lambda t: derived.order_amounts(t.order_lines))

# ------------------------------------------------------------------- audits

def _db_state_sql(w="warehouses", d="districts", c="customers", o="w_orders", ol="order_lines",
                  s="stocks"):
    return f"""
SELECT
  (SELECT CAST(sum(w_ytd) AS DECIMAL(38,2)) FROM {w}) AS sum_w_ytd,
  (SELECT CAST(sum(d_ytd) AS DECIMAL(38,2)) FROM {d}) AS sum_d_ytd,
  (SELECT CAST(sum(d_next_o_id) AS BIGINT) FROM {d}) AS sum_d_next_o_id,
  (SELECT CAST(sum(c_balance) AS DECIMAL(38,2)) FROM {c}) AS sum_c_balance,
  (SELECT CAST(sum(c_ytd_payment) AS DECIMAL(38,2)) FROM {c}) AS sum_c_ytd_payment,
  (SELECT CAST(sum(c_payment_cnt) AS BIGINT) FROM {c}) AS sum_c_payment_cnt,
  (SELECT CAST(sum(c_delivery_cnt) AS BIGINT) FROM {c}) AS sum_c_delivery_cnt,
  (SELECT CAST(max(o_id) AS BIGINT) FROM {o}) AS max_o_id,
  (SELECT CAST(sum(o_ol_cnt) AS BIGINT) FROM {o}) AS sum_o_ol_cnt,
  (SELECT CAST(sum(ol_amount) AS DECIMAL(38,2)) FROM {ol}) AS sum_ol_amount,
  (SELECT CAST(sum(ol_quantity) AS BIGINT) FROM {ol}) AS sum_ol_quantity,
  (SELECT CAST(sum(s_quantity) AS BIGINT) FROM {s}) AS sum_s_quantity,
  (SELECT CAST(sum(s_ytd) AS DECIMAL(38,2)) FROM {s}) AS sum_s_ytd,
  (SELECT CAST(sum(s_order_cnt) AS BIGINT) FROM {s}) AS sum_s_order_cnt,
  (SELECT CAST(sum(s_remote_cnt) AS BIGINT) FROM {s}) AS sum_s_remote_cnt
"""


_DB_STATE = _db_state_sql()


def _state_tables(t):
    return (t.warehouses, t.districts, t.customers, t.orders, t.order_lines, t.stocks)


register("db_state", _DB_STATE)(lambda t: audit.db_state(*_state_tables(t)))

register("db_state_long", ", s AS (" + _DB_STATE + """)
SELECT CAST(line AS INTEGER) AS line, metric, CAST(value AS DECIMAL(38,2)) AS value FROM (
  SELECT 1 AS line, 'sum_w_ytd' AS metric, CAST(sum_w_ytd AS DECIMAL(38,2)) AS value FROM s
  UNION ALL SELECT 2, 'sum_d_ytd', sum_d_ytd FROM s
  UNION ALL SELECT 3, 'sum_d_next_o_id', sum_d_next_o_id FROM s
  UNION ALL SELECT 4, 'sum_c_balance', sum_c_balance FROM s
  UNION ALL SELECT 5, 'sum_c_ytd_payment', sum_c_ytd_payment FROM s
  UNION ALL SELECT 6, 'sum_c_payment_cnt', sum_c_payment_cnt FROM s
  UNION ALL SELECT 7, 'sum_c_delivery_cnt', sum_c_delivery_cnt FROM s
  UNION ALL SELECT 8, 'max_o_id', max_o_id FROM s
  UNION ALL SELECT 9, 'sum_o_ol_cnt', sum_o_ol_cnt FROM s
  UNION ALL SELECT 10, 'sum_ol_amount', sum_ol_amount FROM s
  UNION ALL SELECT 11, 'sum_ol_quantity', sum_ol_quantity FROM s
  UNION ALL SELECT 12, 'sum_s_quantity', sum_s_quantity FROM s
  UNION ALL SELECT 13, 'sum_s_ytd', sum_s_ytd FROM s
  UNION ALL SELECT 14, 'sum_s_order_cnt', sum_s_order_cnt FROM s
  UNION ALL SELECT 15, 'sum_s_remote_cnt', sum_s_remote_cnt FROM s) x
""")(lambda t: audit.db_state_long(*_state_tables(t)))


def _base(t):
    return {n: t.base(n) for n in ("warehouses", "districts", "customers", "orders", "items",
                                   "order_lines", "stocks")}


def _pk_sql():
    from ..sources.schema import PRIMARY_KEYS
    sql_name = {"orders": "w_orders"}
    parts = []
    for name, keys in PRIMARY_KEYS.items():
        k = ", ".join(keys)
        parts.append(
            f"SELECT '{name}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, "
            f"CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS n_dup_keys "
            f"FROM (SELECT {k}, count(*) AS n FROM {sql_name.get(name, name)} GROUP BY {k}) g")
    return "\nUNION ALL\n".join(parts)


def _fk_sql():
    from ..sources.schema import FOREIGN_KEYS
    sql_name = {"orders": "w_orders"}
    parts = []
    for child, ccols, parent, pcols in FOREIGN_KEYS:
        cond = " AND ".join(f"p.{b} = c.{a}" for a, b in zip(ccols, pcols))
        parts.append(
            f"SELECT '{child}' AS child, '{','.join(ccols)}' AS child_cols, '{parent}' AS parent, "
            f"CAST(count(*) AS BIGINT) AS n_orphans FROM {sql_name.get(child, child)} c "
            f"WHERE NOT EXISTS (SELECT 1 FROM {sql_name.get(parent, parent)} p WHERE {cond})")
    return "\nUNION ALL\n".join(parts)


def _len_sql():
    from ..sources.schema import LENGTH_LIMITS
    parts = []
    for name, limits in LENGTH_LIMITS.items():
        for c, n in limits:
            parts.append(
                f"SELECT '{name}' AS table_name, '{c}' AS column_name, CAST({n} AS INTEGER) AS max_length, "
                f"CAST(count(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS n_too_long FROM {name}")
    return "\nUNION ALL\n".join(parts)


register("audit_pk", _pk_sql())(lambda t: audit.audit_primary_keys(_base(t)))
register("audit_fk", _fk_sql())(lambda t: audit.audit_foreign_keys(_base(t)))
register("audit_lengths", _len_sql())(lambda t: audit.audit_lengths(_base(t)))

def _precision_sql():
    from ..sources.schema import BASE_SCHEMAS
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, '{f.name}' AS column_name, '{f.dataType.precision},{f.dataType.scale}' AS declared, "
        f"'{f.dataType.precision},{f.dataType.scale}' AS actual, "
        f"CAST(count(*) FILTER (WHERE abs({f.name}) >= {10 ** (f.dataType.precision - f.dataType.scale)}) AS BIGINT) AS n_out_of_range "
        f"FROM {'w_orders' if name == 'orders' else name}"
        for name, schema in BASE_SCHEMAS.items() for f in schema if f.dataType.typeName() == "decimal")


register("audit_precision", _precision_sql())(lambda t: audit.audit_precision(_base(t)))

register("audit_check_carrier", """
SELECT CAST(count(*) FILTER (WHERE NOT (o_carrier_id BETWEEN 1 AND 10)) AS BIGINT) AS n_violations,
  CAST(count(*) FILTER (WHERE o_carrier_id IS NULL) AS BIGINT) AS n_null_carrier,
  CAST(count(*) AS BIGINT) AS n_rows
FROM w_orders
""")(lambda t: audit.audit_check_carrier(t.orders))


def _reconcile(t):
    return audit.row_count_reconcile([
        ("warehouses", t.raw("nation"), t.warehouses),
        ("customers", t.raw("customer"), t.customers),
        ("items", t.raw("part"), t.items),
        ("orders", t.raw("orders"), t.orders.unionByName(
            t.new_order_requests.selectExpr("w_id AS o_w_id", "d_id AS o_d_id", "CAST(seq AS INT) AS o_id",
                                            "c_id AS o_c_id", "CAST(NULL AS INT) AS o_carrier_id",
                                            "0 AS o_ol_cnt", "1 AS o_all_local", "entry_d AS o_entry_d"))),
        ("order_lines", t.raw("lineitem"), t.order_lines.select("ol_w_id").unionByName(
            t.new_order_line_requests.selectExpr("supply_w_id AS ol_w_id"))),
    ])


register("row_count_reconcile", """
SELECT table_name, raw_rows, processed_rows, raw_rows - processed_rows AS diff FROM (
  SELECT 'warehouses' AS table_name, (SELECT count(*) FROM nation) AS raw_rows,
    (SELECT count(*) FROM warehouses) AS processed_rows
  UNION ALL SELECT 'customers', (SELECT count(*) FROM customer), (SELECT count(*) FROM customers)
  UNION ALL SELECT 'items', (SELECT count(*) FROM part), (SELECT count(*) FROM items)
  UNION ALL SELECT 'orders', (SELECT count(*) FROM orders),
    (SELECT count(*) FROM w_orders) + (SELECT count(*) FROM new_order_requests)
  UNION ALL SELECT 'order_lines', (SELECT count(*) FROM lineitem),
    (SELECT count(*) FROM order_lines) + (SELECT count(*) FROM new_order_line_requests)) x
""", split=True)(_reconcile)

# ------------------------------------------------------ content fingerprints

#: Table -> what its fingerprints are kept by.
_PARTS = {"warehouses": "w_id", "districts": "d_w_id", "customers": "c_w_id", "orders": "o_w_id", "items": "i_id % 16", "order_lines": "ol_w_id", "stocks": "s_w_id"}


def _prints(t, name, table=None):
    return fingerprints.fingerprints((t.base(name) if table is None else table).select(*BASE_SCHEMAS[name].fieldNames()), name, F.expr(_PARTS[name]))


def _prints_sql(name: str, source: str) -> str:
    def own(f):
        """A decimal without digits before the point is written with its 0, as Spark does."""
        d = f.dataType
        return f"CAST({f.name} AS DECIMAL({d.precision + 1},{d.scale}))" if d.typeName() == "decimal" and d.precision == d.scale else f.name

    text = ", ".join(rf"coalesce(replace(replace(CAST({c} AS VARCHAR), '\', '\\'), '|', '\p'), '\N')" for c in map(own, BASE_SCHEMAS[name]))
    return (f"SELECT '{name}' AS table_name, CAST({_PARTS[name]} AS VARCHAR) AS part, count(*) AS n_rows, "
            f"CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 15) AS BIGINT)) % 1152921504606846976 AS BIGINT) AS hash FROM {source} GROUP BY ALL")


register("audit_fingerprints", "\nUNION ALL\n".join(_prints_sql(n, "w_orders" if n == "orders" else n) for n in _PARTS))(
    lambda t: reduce(DataFrame.unionByName, [_prints(t, n) for n in _PARTS]))

# In every fifth warehouse one order has another line count: as many rows, other content.
register("audit_altered_partitions", """
SELECT 'orders' AS table_name, CAST(o_w_id AS VARCHAR) AS part, count(*) AS left_rows, count(*) AS right_rows
FROM w_orders GROUP BY o_w_id HAVING o_w_id % 5 = 0 AND count(*) FILTER (WHERE o_d_id = 1 AND o_id = 1) > 0
""")(lambda t: fingerprints.differing(_prints(t, "orders"), _prints(t, "orders", t.orders.withColumn("o_ol_cnt", F.when(
    F.expr("o_w_id % 5 = 0 and o_d_id = 1 and o_id = 1"), F.col("o_ol_cnt") + 1).otherwise(F.col("o_ol_cnt"))))))


def _prints_after_delivery(t):
    """The orders' fingerprints carried on by the change of a batch of deliveries."""
    change = upkeep.delivery_delta(t.orders, changes.delivered_orders(t.orders, t.delivery_requests))
    return fingerprints.merged(_prints(t, "orders"), fingerprints.fingerprints(
        change.select(*BASE_SCHEMAS["orders"].fieldNames(), upkeep.WEIGHT), "orders", F.expr(_PARTS["orders"]), F.col(upkeep.WEIGHT)))


register("audit_fingerprints_after_delivery", """
, und AS (SELECT *, row_number() OVER (PARTITION BY o_w_id, o_d_id ORDER BY o_id) AS k FROM w_orders WHERE o_carrier_id IS NULL),
rq AS (SELECT w_id, carrier_id, row_number() OVER (PARTITION BY w_id ORDER BY seq) AS k FROM delivery_requests),
now AS (
  SELECT o.* EXCLUDE (o_carrier_id), coalesce(o.o_carrier_id, rq.carrier_id) AS o_carrier_id
  FROM w_orders o LEFT JOIN und ON und.o_w_id = o.o_w_id AND und.o_d_id = o.o_d_id AND und.o_id = o.o_id
  LEFT JOIN rq ON rq.w_id = und.o_w_id AND rq.k = und.k)
""" + _prints_sql("orders", "now"))(_prints_after_delivery)

# ------------------------------------------------------------ ordered results

register("customer_order_items_sorted", """
SELECT *, row_number() OVER (ORDER BY w_id, d_id, c_id, o_id, i_id) AS position
FROM (SELECT DISTINCT o.o_w_id AS w_id, o.o_d_id AS d_id, o.o_c_id AS c_id, o.o_id, ol.ol_i_id AS i_id
      FROM w_orders o JOIN order_lines ol ON ol.ol_w_id = o.o_w_id AND ol.ol_d_id = o.o_d_id AND ol.ol_o_id = o.o_id) x
""")(lambda t: ordered.customer_order_items_sorted(derived.customer_order_items(t.orders, t.order_lines)))
