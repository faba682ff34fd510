"""Registered ingest, transaction-log, scalar, metrics and streaming queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.scalar import epoch_ms_between
from ..operators import metrics, overlap, reads
from ..session import cut_lineage, drop_folder, folder_exists, scratch_table_path
from ..sources import catalog, csv_io, txlog
from ..sources.schema import BASE_SCHEMAS, ORDER, ORDER_LINE
from ..sources.testdata import CLIENTS
from ..streaming import streams
from .registry import register

_SCRIPTS: dict[tuple, str] = {}


def _scratch(t, name):
    return scratch_table_path(t.spark, f"{name}-{uuid.uuid4().hex[:12]}")


# --------------------------------------------------------------- CSV ingest


def _measure(field, sql: bool) -> str:
    """What is summed of a column: its numbers, the lengths of its texts, its times in seconds."""
    kind, c = field.dataType.simpleString(), field.name
    if kind == "string":
        return f"length({c})"
    if kind == "timestamp_ntz":
        return f"epoch_us({c}) // 1000000" if sql else f"timestampdiff(SECOND, timestamp_ntz '1970-01-01', {c})"
    return c


def _ingest(t):
    """All seven tables written as CSV without a header and read back: rows,
    values and sums of every column. The files of a table, compressed, are deleted once
    they are summed up: only one table at a time takes disk as CSV."""
    out = None
    for name, schema in BASE_SCHEMAS.items():
        rows, path = t.base(name).select(*schema.fieldNames()), _scratch(t, f"ingest-{name}")
        try:
            csv_io.write_csv(rows, path, header=False, compression="gzip")
            df = csv_io.read_csv(t.spark, path, schema, header=False)
            per = [F.struct(F.lit(f.name).alias("column_name"), F.count(f.name).alias("n_values"),
                            F.sum(F.expr(_measure(f, False)).cast("decimal(24,4)")).cast("decimal(34,4)").alias("total")) for f in schema]
            part = (df.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*per).alias("c"))
                      .select(F.lit(name).alias("table_name"), "n_rows", F.explode("c").alias("c")).select("table_name", "n_rows", "c.*"))
            part = cut_lineage(part, f"ingested-{name}")
        finally:
            drop_folder(t.spark, path)
        out = part if out is None else out.unionByName(part)
    return out


_INGEST_SQL = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, '{f.name}' AS column_name, count({f.name}) AS n_values, "
    f"CAST(sum(CAST({_measure(f, True)} AS DECIMAL(24,4))) AS DECIMAL(34,4)) AS total FROM {'w_orders' if name == 'orders' else name}"
    for name, schema in BASE_SCHEMAS.items() for f in schema)

register("ingest_base_tables", _INGEST_SQL)(_ingest)


def _csv_round_trip(t):
    path = _scratch(t, "csv-round-trip")
    csv_io.write_csv(t.order_lines.select(*ORDER_LINE.fieldNames()), path, header=True)
    return csv_io.read_csv(t.spark, path, ORDER_LINE, header=True)


register("csv_round_trip", "SELECT * FROM order_lines")(_csv_round_trip)


def _null_token(t):
    path = _scratch(t, "null-token")
    csv_io.write_csv(t.orders.select(*ORDER.fieldNames()), path, header=False, null_token="null")
    return csv_io.read_csv(t.spark, path, ORDER, header=False, null_token="null")


register("null_token_load", "SELECT * FROM w_orders")(_null_token)


def _delimited(t):
    """Tab-separated, with \\N for NULL."""
    path = _scratch(t, "delimited")
    csv_io.write_csv(t.orders.select(*ORDER.fieldNames()), path, null_token="\\N", sep="\t")
    return csv_io.read_csv(t.spark, path, ORDER, null_token="\\N", sep="\t")


register("delimited_load", "SELECT * FROM w_orders")(_delimited)


def _all_strings(t):
    """Every column read as text."""
    path = _scratch(t, "all-strings")
    csv_io.write_csv(t.items, path)
    return csv_io.read_csv(t.spark, path, ", ".join(f"{c} STRING" for c in t.items.columns))


register("all_string_scan", "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("i_id", "i_name", "i_price", "i_im_id", "i_data"))
         + " FROM items")(_all_strings)


def _catalog_load(t):
    """Catalog tables created, loaded from columns in another order, dropped (their files stay) and created again over them."""
    place, db = _scratch(t, "catalog"), f"load_{uuid.uuid4().hex[:12]}"
    catalog.create_base_tables(t.spark, place, db)
    catalog.load_table(t.orders.select(*reversed(t.orders.columns)), db, "orders")
    catalog.drop_tables(t.spark, db)
    catalog.create_base_tables(t.spark, place, db)
    return t.spark.table(f"{db}.orders")


register("catalog_load", "SELECT * FROM w_orders")(_catalog_load)


def _colocated(t, buckets=8):
    """Orders and order lines loaded into bucketed tables and joined bucket by bucket."""
    place, db = _scratch(t, "colocated"), f"buckets_{uuid.uuid4().hex[:12]}"
    catalog.create_base_tables(t.spark, place, db, bucketed=True, buckets=buckets)
    for name in ("orders", "order_lines"):
        catalog.load_table(t.base(name), db, name, buckets=buckets)
    return catalog.colocated_order_lines(t.spark, db)


register("order_lines_colocated", """
SELECT o.o_w_id, o.o_d_id, o.o_id, o.o_c_id, CAST(sum(ol.ol_amount) AS DECIMAL(18,2)) AS amount, count(*) AS n_lines
FROM w_orders o JOIN order_lines ol ON ol.ol_w_id = o.o_w_id AND ol.ol_d_id = o.o_d_id AND ol.ol_o_id = o.o_id
GROUP BY 1, 2, 3, 4
""")(_colocated)


def _clustering(t, buckets=8):
    """Rows of each bucket file that stand before one with a smaller key."""
    place, db = _scratch(t, "clustered"), f"clustered_{uuid.uuid4().hex[:12]}"
    catalog.create_base_tables(t.spark, place, db, bucketed=True, buckets=buckets)
    out = None
    for name in ("customers", "orders", "order_lines"):
        catalog.load_table(t.base(name), db, name, buckets=buckets)
        part = catalog.clustering_faults(t.spark, db, name)
        out = part if out is None else out.unionByName(part)
    return out


register("clustering_order", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_order FROM {s}"
    for n, s in (("customers", "customers"), ("orders", "w_orders"), ("order_lines", "order_lines"))))(_clustering)


def _csv_rejects(t):
    """Orders as CSV, of which some lines have a text for a number or end early."""
    path = _scratch(t, "csv-rejects")
    c = [F.coalesce(F.col(f).cast("string"), F.lit("null")) for f in ORDER.fieldNames()]
    line = (F.when(F.col("o_c_id") % 7 == 0, F.concat_ws(",", *c[:2], F.lit("x"), *c[3:]))
             .when(F.col("o_c_id") % 7 == 1, F.concat_ws(",", *c[:4])).otherwise(F.concat_ws(",", *c)))
    t.orders.select(line.alias("value")).write.mode("overwrite").text(path)
    rows, rejects = csv_io.read_csv_checked(t.spark, path, ORDER)
    return (rows.agg(F.lit("row").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum(F.col("o_id").cast("long")).alias("total"))
            .unionByName(rejects.groupBy(F.when(F.size(F.split("line", ",")) == 4, "short").otherwise("value").alias("kind"))
                         .agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.split("line", ",")[1]).cast("long")).alias("total"))))


register("csv_rejects", """
SELECT 'row' AS kind, count(*) AS n, CAST(sum(o_id) AS BIGINT) AS total FROM w_orders WHERE o_c_id % 7 > 1
UNION ALL
SELECT CASE WHEN o_c_id % 7 = 1 THEN 'short' ELSE 'value' END, count(*), CAST(sum(length(CAST(o_d_id AS VARCHAR))) AS BIGINT)
FROM w_orders WHERE o_c_id % 7 <= 1 GROUP BY 1
""")(_csv_rejects)

# ---------------------------------------------------------- transaction log


def _script_dir(t, lines=txlog.script_lines):
    """The folder of the client scripts that ``lines`` derives from the tables; written once an application."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, t.split, lines.__name__)
    d = _SCRIPTS.get(key)
    if d is None or not folder_exists(t.spark, d):
        d = txlog.write_scripts(t, _scratch(t, "scripts"), lines(t))
        _SCRIPTS[key] = d
    return d


def _parsed(t):
    lines = txlog.read_script_lines(t.spark, _script_dir(t))
    return txlog.transactions(txlog.parse_scripts(lines))



_TX_SQL = """
, m AS (SELECT seq, count(*) AS m FROM new_order_line_requests GROUP BY seq),
tx AS (
  SELECT CAST(r.seq % 20 AS INTEGER) AS client, 'N' AS txn_type, r.w_id, r.d_id, r.c_id,
    CAST(NULL AS DECIMAL(12,2)) AS amount, CAST(NULL AS INTEGER) AS carrier_id,
    CAST(NULL AS INTEGER) AS threshold, CAST(NULL AS INTEGER) AS last_l,
    CAST(coalesce(m.m, 0) AS INTEGER) AS n_items
  FROM new_order_requests r LEFT JOIN m ON m.seq = r.seq
  UNION ALL SELECT CAST(seq % 20 AS INTEGER), 'P', w_id, d_id, c_id, amount, NULL, NULL, NULL, NULL
  FROM payment_requests
  UNION ALL SELECT CAST(w_id % 20 AS INTEGER), 'D', w_id, NULL, NULL, NULL, carrier_id, NULL, NULL, NULL
  FROM delivery_requests
  UNION ALL SELECT CAST(c_id % 20 AS INTEGER), 'O', w_id, d_id, c_id, NULL, NULL, NULL, NULL, NULL
  FROM customer_requests
  UNION ALL SELECT CAST(c_id % 20 AS INTEGER), 'R', w_id, d_id, c_id, NULL, NULL, NULL, NULL, NULL
  FROM related_requests
  UNION ALL SELECT CAST((w_id * 10 + d_id) % 20 AS INTEGER), 'S', w_id, d_id, NULL, NULL, NULL, threshold,
    last_l, NULL FROM stock_level_requests
  UNION ALL SELECT CAST((w_id * 10 + d_id) % 20 AS INTEGER), 'I', w_id, d_id, NULL, NULL, NULL, NULL,
    last_l, NULL FROM popular_requests
  UNION ALL SELECT CAST(w_id % 20 AS INTEGER), 'T', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM warehouses)
"""

register("parse_transaction_log", _TX_SQL + "SELECT * FROM tx")(
    lambda t: _parsed(t)[0].select("client", "txn_type", "w_id", "d_id", "c_id", "amount", "carrier_id",
                                   "threshold", "last_l", "n_items"))

_MIX_SQL = _TX_SQL + "SELECT txn_type, count(*) AS n_txn FROM tx GROUP BY txn_type"

register("transaction_mix", _MIX_SQL)(
    lambda t: _parsed(t)[0].groupBy("txn_type").agg(F.count(F.lit(1)).alias("n_txn")))

def _named_scripts(t):
    """Scripts as numbered files (0.txt, 1.txt, ...): the client is the file's stem (X11)."""
    place = txlog.name_by_client(t.spark, txlog.write_scripts(t, _scratch(t, "scripts")), _scratch(t, "named-scripts"))
    valid, _ = txlog.transactions(txlog.parse_scripts(txlog.read_script_lines(t.spark, f"{place}/*/*.txt")))
    return valid.groupBy("client", "txn_type").agg(F.count(F.lit(1)).alias("n_txn"))


register("named_script_mix", _TX_SQL + "SELECT client, txn_type, count(*) AS n_txn FROM tx GROUP BY client, txn_type")(_named_scripts)

register("transaction_log_rejects", """
SELECT CAST(event_id % 20 AS INTEGER) AS client,
  reason, count(*) AS n
FROM events JOIN (VALUES (0, 'short_record'), (1, 'bad_number'), (2, 'unknown_type'), (3, 'incomplete_order'), (4, 'orphan_line'),
                         (5, 'incomplete_order'), (5, 'bad_number')) f(fault, reason) ON f.fault = event_id % 6
WHERE event_type = 'error' GROUP BY 1, 2
""")(lambda t: _parsed(t)[1].groupBy("client", "reason").agg(F.count(F.lit(1)).alias("n")))



_REQUESTS: dict[tuple, dict] = {}


def script_requests(t, lines=txlog.script_lines) -> dict:
    """Requests of all types as the client scripts hold them. Scripts are parsed and written once an application; those who read
    one type read its rows only."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, t.split, lines.__name__)
    if key not in _REQUESTS or not folder_exists(t.spark, _SCRIPTS[key]):
        parsed = cut_lineage(txlog.parse_scripts(txlog.read_script_lines(t.spark, _script_dir(t, lines))), "script-lines")
        valid = cut_lineage(txlog.transactions(parsed)[0], "script-valid")
        _REQUESTS[key] = {k: cut_lineage(v, f"script-{k}") for k, v in txlog.request_tables(valid, parsed).items()}
    return _REQUESTS[key]


register("script_order_status", """
, last AS (SELECT o_w_id AS w_id, o_d_id AS d_id, o_c_id AS c_id, max(o_id) AS o_id FROM w_orders GROUP BY 1, 2, 3)
SELECT CAST(r.c_id % 20 AS INTEGER) AS client, r.w_id, r.d_id, r.c_id, l.o_id, ol.ol_number, ol.ol_i_id, ol.ol_quantity, ol.ol_amount
FROM customer_requests r JOIN last l ON l.w_id = r.w_id AND l.d_id = r.d_id AND l.c_id = r.c_id
LEFT JOIN order_lines ol ON ol.ol_w_id = l.w_id AND ol.ol_d_id = l.d_id AND ol.ol_o_id = l.o_id
""")(lambda t: _script_order_status(t))


def _script_order_status(t):
    r = script_requests(t)["order_status"]
    answer = reads.order_status(r, t.customers, t.orders, t.order_lines)
    return (r.select("client", "w_id", "d_id", "c_id").join(answer, ["w_id", "d_id", "c_id"])
            .select("client", "w_id", "d_id", "c_id", "o_id", "ol_number", "ol_i_id", "ol_quantity", "ol_amount"))


register("script_stock_level", """
, keys AS (SELECT DISTINCT r.w_id, r.d_id, r.threshold, r.last_l, d.d_next_o_id
           FROM stock_level_requests r JOIN districts d ON d.d_w_id = r.w_id AND d.d_id = r.d_id),
low AS (SELECT k.w_id, k.d_id, k.threshold, k.last_l, count(DISTINCT ol.ol_i_id) AS n
        FROM keys k JOIN order_lines ol ON ol.ol_w_id = k.w_id AND ol.ol_d_id = k.d_id
          AND ol.ol_o_id >= k.d_next_o_id - k.last_l AND ol.ol_o_id < k.d_next_o_id
        JOIN stocks s ON s.s_w_id = k.w_id AND s.s_i_id = ol.ol_i_id WHERE s.s_quantity < k.threshold GROUP BY 1, 2, 3, 4)
SELECT CAST((r.w_id * 10 + r.d_id) % 20 AS INTEGER) AS client, r.w_id, r.d_id, r.threshold, r.last_l, CAST(coalesce(low.n, 0) AS BIGINT) AS low_stock_count
FROM stock_level_requests r LEFT JOIN low USING (w_id, d_id, threshold, last_l)
""")(lambda t: reads.stock_level(script_requests(t)["stock_level"], t.districts, t.order_lines, t.stocks).drop("seq"))

register("script_popular_items", """
, pl AS (SELECT x.ol_w_id AS w_id, x.ol_d_id AS d_id, x.ol_o_id AS o_id, x.ol_i_id AS i_id, x.ol_quantity FROM order_lines x
         WHERE x.ol_quantity = (SELECT max(y.ol_quantity) FROM order_lines y
                                WHERE y.ol_w_id = x.ol_w_id AND y.ol_d_id = x.ol_d_id AND y.ol_o_id = x.ol_o_id))
SELECT CAST((r.w_id * 10 + r.d_id) % 20 AS INTEGER) AS client, r.w_id, r.d_id, r.last_l, o.o_id, o.o_entry_d, c.c_first, c.c_middle, c.c_last,
  pl.i_id, it.i_name, pl.ol_quantity
FROM popular_requests r JOIN districts d ON d.d_w_id = r.w_id AND d.d_id = r.d_id
JOIN w_orders o ON o.o_w_id = r.w_id AND o.o_d_id = r.d_id AND o.o_id >= d.d_next_o_id - r.last_l AND o.o_id < d.d_next_o_id
JOIN pl ON pl.w_id = o.o_w_id AND pl.d_id = o.o_d_id AND pl.o_id = o.o_id
JOIN customers c ON c.c_w_id = o.o_w_id AND c.c_d_id = o.o_d_id AND c.c_id = o.o_c_id
JOIN items it ON it.i_id = pl.i_id
""")(lambda t: reads.popular_items(script_requests(t)["popular_items"], t.districts, t.orders, t.order_lines,
                                               t.items, t.customers).drop("seq"))

register("script_related_customers", """
, oi AS (SELECT DISTINCT o.o_w_id AS w_id, o.o_d_id AS d_id, o.o_c_id AS c_id, o.o_id, ol.ol_i_id AS i_id
         FROM w_orders o JOIN order_lines ol ON ol.ol_w_id = o.o_w_id AND ol.ol_d_id = o.o_d_id AND ol.ol_o_id = o.o_id),
ov AS (SELECT a.w_id, a.d_id, a.c_id, b.w_id AS r_w_id, b.d_id AS r_d_id, b.c_id AS r_c_id, count(DISTINCT a.i_id) AS n
       FROM oi a JOIN related_requests r ON r.w_id = a.w_id AND r.d_id = a.d_id AND r.c_id = a.c_id
       JOIN oi b ON a.i_id = b.i_id AND a.w_id <> b.w_id GROUP BY a.w_id, a.d_id, a.c_id, a.o_id, b.w_id, b.d_id, b.c_id, b.o_id)
SELECT DISTINCT w_id, d_id, c_id, r_w_id, r_d_id, r_c_id FROM ov WHERE n >= 2
""")(lambda t: overlap.related_customers(t.orders, t.order_lines, script_requests(t)["related_customers"]))

register("script_top_balance", """
, top AS (SELECT c_w_id, c_d_id, c_id, c_balance,
            CAST(row_number() OVER (ORDER BY c_balance DESC NULLS LAST, c_w_id, c_d_id, c_id) AS INTEGER) AS rank FROM customers)
SELECT CAST(w.w_id % 20 AS INTEGER) AS client, t.rank, t.c_w_id, t.c_d_id, t.c_id, t.c_balance
FROM warehouses w JOIN top t ON t.rank <= 10
""")(lambda t: _script_top_balance(t))


def _script_top_balance(t):
    """Each T record gets the ten rows."""
    top = reads.top_balance(t.customers, t.districts, t.warehouses).select("rank", "c_w_id", "c_d_id", "c_id", "c_balance")
    asked = script_requests(t)["top_balance"].select("client", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("rank"))
    return asked.join(F.broadcast(top), "rank").select("client", "rank", "c_w_id", "c_d_id", "c_id", "c_balance")  # ten rows


# ------------------------------------------------------------------ scalars

register("safe_int_parse", """
SELECT c_id, c_last AS raw_name, TRY_CAST(split_part(c_last, '#', 2) AS INTEGER) AS name_number,
  TRY_CAST(c_first AS INTEGER) AS segment_number
FROM customers
""")(lambda t: t.customers.select(
    "c_id", F.col("c_last").alias("raw_name"),
    F.split_part(F.col("c_last"), F.lit("#"), F.lit(2)).try_cast("int").alias("name_number"),
    F.col("c_first").try_cast("int").alias("segment_number")))


def _report(t):
    top = reads.top_balance(t.customers, t.districts, t.warehouses)
    s = top.select(
        "rank",
        F.col("c_w_id").cast("string").alias("c_w_id"), F.col("c_d_id").cast("string").alias("c_d_id"),
        F.col("c_id").cast("string").alias("c_id"), "customer_name",
        F.format_string("%.2f", F.col("c_balance").cast("double")).alias("c_balance"), "w_name", "d_name")
    return s.unpivot(["rank"], ["c_w_id", "c_d_id", "c_id", "customer_name", "c_balance", "w_name", "d_name"],
                     "field", "value")


register("report_long_form", """
, top AS (
  SELECT c_w_id, c_d_id, c_id, c_first, c_middle, c_last, c_balance FROM customers
  ORDER BY c_balance DESC NULLS LAST, c_w_id, c_d_id, c_id LIMIT 10),
r AS (
  SELECT CAST(row_number() OVER (ORDER BY t.c_balance DESC NULLS LAST, t.c_w_id, t.c_d_id, t.c_id) AS INTEGER) AS rank,
    t.*, w.w_name, d.d_name
  FROM top t
  LEFT JOIN districts d ON d.d_w_id = t.c_w_id AND d.d_id = t.c_d_id
  LEFT JOIN warehouses w ON w.w_id = t.c_w_id)
SELECT rank, 'c_w_id' AS field, CAST(c_w_id AS VARCHAR) AS value FROM r
UNION ALL SELECT rank, 'c_d_id', CAST(c_d_id AS VARCHAR) FROM r
UNION ALL SELECT rank, 'c_id', CAST(c_id AS VARCHAR) FROM r
UNION ALL SELECT rank, 'customer_name', concat_ws(' ', c_first, c_middle, c_last) FROM r
UNION ALL SELECT rank, 'c_balance', printf('%.2f', c_balance) FROM r
UNION ALL SELECT rank, 'w_name', w_name FROM r
UNION ALL SELECT rank, 'd_name', d_name FROM r
""")(_report)


def _scalar_decimal(t):
    d = t.districts.select(F.col("d_w_id").alias("ol_w_id"), F.col("d_id").alias("ol_d_id"), "d_tax")
    j = t.order_lines.select("ol_w_id", "ol_d_id", "ol_o_id", "ol_number", "ol_amount").join(
        d, ["ol_w_id", "ol_d_id"], "inner")
    x = F.col("ol_amount") * (F.lit(1) + F.col("d_tax")).cast("decimal(6,4)")
    return j.select("ol_w_id", "ol_d_id", "ol_o_id", "ol_number",
                    x.cast("decimal(18,6)").alias("with_tax"),
                    F.bround(x, 1).cast("decimal(18,1)").alias("half_even"),
                    F.round(x, 1).cast("decimal(18,1)").alias("half_up"),
                    (F.col("ol_amount") - F.col("ol_amount") * F.col("d_tax")).cast("decimal(18,6)").alias("net"))


register("scalar_decimal", """
SELECT ol.ol_w_id, ol.ol_d_id, ol.ol_o_id, ol.ol_number,
  CAST(ol.ol_amount * CAST(1 + d.d_tax AS DECIMAL(6,4)) AS DECIMAL(18,6)) AS with_tax,
  CAST(round_even(ol.ol_amount * CAST(1 + d.d_tax AS DECIMAL(6,4)), 1) AS DECIMAL(18,1)) AS half_even,
  CAST(round(ol.ol_amount * CAST(1 + d.d_tax AS DECIMAL(6,4)), 1) AS DECIMAL(18,1)) AS half_up,
  CAST(ol.ol_amount - ol.ol_amount * d.d_tax AS DECIMAL(18,6)) AS net
FROM order_lines ol JOIN districts d ON d.d_w_id = ol.ol_w_id AND d.d_id = ol.ol_d_id
""")(_scalar_decimal)


def _scalar_datetime(t):
    o = t.orders.select(F.col("o_w_id").alias("ol_w_id"), F.col("o_d_id").alias("ol_d_id"),
                        F.col("o_id").alias("ol_o_id"), "o_entry_d")
    j = (t.order_lines.filter(F.col("ol_delivery_d").isNotNull())
         .select("ol_w_id", "ol_d_id", "ol_o_id", "ol_number", "ol_delivery_d")
         .join(o, ["ol_w_id", "ol_d_id", "ol_o_id"], "inner"))
    return j.select("ol_w_id", "ol_d_id", "ol_o_id", "ol_number",
                    F.date_format("o_entry_d", "yyyy-MM-dd HH:mm:ss").alias("entry_text"),
                    F.date_format("ol_delivery_d", "yyyy-MM-dd HH:mm:ss").alias("delivery_text"),
                    epoch_ms_between("o_entry_d", "ol_delivery_d").alias("ms_to_delivery"))


register("scalar_datetime", """
SELECT ol.ol_w_id, ol.ol_d_id, ol.ol_o_id, ol.ol_number,
  strftime(o.o_entry_d, '%Y-%m-%d %H:%M:%S') AS entry_text,
  strftime(ol.ol_delivery_d, '%Y-%m-%d %H:%M:%S') AS delivery_text,
  epoch_ms(ol.ol_delivery_d) - epoch_ms(o.o_entry_d) AS ms_to_delivery
FROM order_lines ol
JOIN w_orders o ON o.o_w_id = ol.ol_w_id AND o.o_d_id = ol.ol_d_id AND o.o_id = ol.ol_o_id
WHERE ol.ol_delivery_d IS NOT NULL
""")(_scalar_datetime)

# ------------------------------------------------------------------ metrics

register("client_latency_stats", """
SELECT client, count(*) AS n_txn,
  CAST(CAST((sum(CAST(round(latency_ms * 1000000) AS BIGINT)) * 2 + count(*) * 100) // (200 * count(*)) AS DECIMAL(20,0)) * CAST(0.0001 AS DECIMAL(4,4)) AS DECIMAL(18,4)) AS mean_ms,
  CAST(round(quantile_cont(latency_ms, 0.5), 4) AS DECIMAL(18,4)) AS median_ms,
  CAST(round(quantile_cont(latency_ms, 0.95), 4) AS DECIMAL(18,4)) AS p95_ms,
  CAST(round(quantile_cont(latency_ms, 0.99), 4) AS DECIMAL(18,4)) AS p99_ms
FROM transaction_events GROUP BY client
""")(lambda t: metrics.client_latency_stats(t.transaction_events))

register("client_latency_stats_exclusive", """
, r AS (
  SELECT client, latency_ms AS v,
    row_number() OVER (PARTITION BY client ORDER BY latency_ms) AS rk,
    count(*) OVER (PARTITION BY client) AS n
  FROM transaction_events),
k AS (
  SELECT DISTINCT client, n,
    least(greatest(95 * (n + 1) // 100, 1), n - 1) AS j95,
    least(greatest(99 * (n + 1) // 100, 1), n - 1) AS j99
  FROM r),
x AS (
  SELECT k.client, k.n, k.j95, k.j99,
    95 * (k.n + 1) - 100 * k.j95 AS d95, 99 * (k.n + 1) - 100 * k.j99 AS d99,
    max(CASE WHEN r.rk = k.j95 THEN r.v END) AS a95, max(CASE WHEN r.rk = k.j95 + 1 THEN r.v END) AS b95,
    max(CASE WHEN r.rk = k.j99 THEN r.v END) AS a99, max(CASE WHEN r.rk = k.j99 + 1 THEN r.v END) AS b99,
    sum(CAST(round(r.v * 1000000) AS BIGINT)) AS s, median(r.v) AS med
  FROM k JOIN r ON r.client = k.client
  GROUP BY k.client, k.n, k.j95, k.j99)
SELECT client, n AS n_txn,
  CAST(CAST((s * 2 + n * 100) // (200 * n) AS DECIMAL(20,0)) * CAST(0.0001 AS DECIMAL(4,4)) AS DECIMAL(18,4)) AS mean_ms,
  CAST(round(med, 4) AS DECIMAL(18,4)) AS median_ms,
  CAST(round((a95 * (100 - d95) + b95 * d95) / 100, 4) AS DECIMAL(18,4)) AS p95_ms,
  CAST(round((a99 * (100 - d99) + b99 * d99) / 100, 4) AS DECIMAL(18,4)) AS p99_ms
FROM x
""")(lambda t: metrics.client_latency_stats_exclusive(t.transaction_events))

def _summary_from_metrics_file(t):
    """M3 as the reference runs it: per-client metric rows are appended to a
    CSV file with a header (S11), the file is scanned again with a schema
    (S13) and summarised (A11)."""
    path = _scratch(t, "client-metrics")
    per_client = metrics.client_throughput(t.transaction_events)
    for half in (F.col("client") < CLIENTS // 2, F.col("client") >= CLIENTS // 2):  # each run of clients appends its own
        csv_io.write_csv(per_client.filter(half), path, header=True, null_token=None, mode="append")
    back = csv_io.read_csv(t.spark, path, per_client.schema, header=True, null_token=None)
    return metrics.throughput_summary(back)


_THROUGHPUT_SQL = """
, g AS (
  SELECT client, count(*) AS n_txn,
    CAST(CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DECIMAL(20,0)) * CAST(0.000001 AS DECIMAL(6,6))
         AS DECIMAL(20,6)) AS elapsed_s,
    CAST(CAST(sum(CAST(round(latency_ms * 1000000) AS BIGINT)) AS DECIMAL(20,0)) * CAST(0.000000001 AS DECIMAL(9,9)) AS DECIMAL(29,9)) AS latency_s,
    sum(CAST(round(latency_ms * 1000000) AS BIGINT)) AS nanos
  FROM transaction_events GROUP BY client),
tp AS (
  SELECT client, n_txn, elapsed_s, latency_s,
    CAST(round(n_txn / CAST(elapsed_s AS DOUBLE), 4) AS DECIMAL(18,4)) AS txn_per_s,
    CAST(round(n_txn / CAST(latency_s AS DOUBLE), 4) AS DECIMAL(18,4)) AS txn_per_latency_s,
    CAST(CAST((nanos * 2 + n_txn * 100) // (200 * n_txn) AS DECIMAL(20,0)) * CAST(0.0001 AS DECIMAL(4,4)) AS DECIMAL(18,4)) AS mean_ms
  FROM g)
"""

register("client_throughput", _THROUGHPUT_SQL + "SELECT * FROM tp")(
    lambda t: metrics.client_throughput(t.transaction_events))

register("throughput_summary", _THROUGHPUT_SQL + """
SELECT count(*) AS n_clients, min(txn_per_s) AS min_txn_per_s, max(txn_per_s) AS max_txn_per_s,
  CAST(CAST((sum(CAST(txn_per_s * 10000 AS BIGINT)) * 1 * 2 + count(*)) // (2 * count(*)) AS DECIMAL(20,0)) * CAST(0.0001 AS DECIMAL(4,4)) AS DECIMAL(18,4)) AS avg_txn_per_s
FROM tp
""")(lambda t: _summary_from_metrics_file(t))

# ------------------------------------------------------------------ streams

register("stream_transaction_counts", _MIX_SQL)(
    lambda t: streams.stream_transaction_counts(t.spark, _script_dir(t)))

register("stream_payment_totals", """
SELECT w_id, d_id, c_id, CAST(sum(amount) AS DECIMAL(18,2)) AS paid, count(*) AS n_payments
FROM payment_requests GROUP BY w_id, d_id, c_id
""")(lambda t: streams.stream_payment_totals(t.spark, t.sf_dir, t.customers))

def slices(t, rows, by, n=4, newest_first=False):
    """``rows`` as files that arrive one slice (of equal widths of ``by``) after the other: the folder, after each slice."""
    path = f"{_scratch(t, 'feed')}/events.parquet"
    lowest, highest = rows.agg(F.min(by), F.max(by)).first()
    if lowest is None:
        rows.write.parquet(path)
        yield path
        return
    part = F.floor((by - lowest) / ((highest - lowest) // n + 1))
    for k in range(n):
        rows.where(part == (n - 1 - k if newest_first else k)).write.mode("append").parquet(path)
        yield path


def arriving(t, rows, by, newest_first=False):
    """The folder when all slices have arrived."""
    return list(slices(t, rows, by, newest_first=newest_first))[-1]


def _late_events(t):
    """The events, of which the newest arrive first."""
    from os.path import dirname
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz '1970-01-01', ts)")
    return dirname(arriving(t, t.raw("events"), seconds, newest_first=True))


register("stream_window_latency", """
SELECT date_trunc('day', ts) AS window_start, client, count(*) AS n_txn,
  CAST(CAST((sum(CAST(round(latency_ms * 1000000) AS BIGINT)) * 2 + count(*) * 100) // (200 * count(*)) AS DECIMAL(20,0)) * CAST(0.0001 AS DECIMAL(4,4)) AS DECIMAL(18,4)) AS mean_ms, max(latency_ms) AS max_latency_ms
FROM transaction_events GROUP BY 1, 2
""")(lambda t: streams.stream_window_latency(t.spark, _late_events(t), files_per_batch=1))

register("stream_window_quantiles", """
, v AS (SELECT date_trunc('day', ts) AS window_start, client, CAST(round(latency_ms * 1000000) AS BIGINT) AS ns FROM transaction_events),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start, client ORDER BY ns) AS rk, count(*) OVER (PARTITION BY window_start, client) AS n FROM v),
x AS (
  SELECT window_start, client, n AS n_txn, min(CASE WHEN rk * 100 >= n * 50 THEN ns END) AS a, min(CASE WHEN rk * 100 >= n * 95 THEN ns END) AS b,
    min(CASE WHEN rk * 100 >= n * 99 THEN ns END) AS c
  FROM r GROUP BY 1, 2, 3)
SELECT window_start, client, n_txn, """ + ", ".join(
    f"(({c} >> greatest(0, length(bin({c})) - 8)) << greatest(0, length(bin({c})) - 8)) + ((1::BIGINT << greatest(0, length(bin({c})) - 8)) - 1) // 2 AS p{q}_ns"
    for c, q in (("a", 50), ("b", 95), ("c", 99))) + " FROM x")(
    lambda t: streams.stream_window_quantiles(t.spark, _late_events(t), files_per_batch=1))

register("stream_top_balance", """
, pay AS (SELECT w_id, d_id, c_id, sum(amount) AS paid FROM payment_requests GROUP BY 1, 2, 3),
cu AS (SELECT c.c_w_id, c.c_d_id, c.c_id, c.c_first, c.c_middle, c.c_last,
         CAST(c.c_balance - coalesce(p.paid, 0) AS DECIMAL(12,2)) AS c_balance
       FROM customers c LEFT JOIN pay p ON p.w_id = c.c_w_id AND p.d_id = c.c_d_id AND p.c_id = c.c_id),
top AS (SELECT * FROM cu ORDER BY c_balance DESC NULLS LAST, c_w_id, c_d_id, c_id LIMIT 10)
SELECT CAST(row_number() OVER (ORDER BY t.c_balance DESC NULLS LAST, t.c_w_id, t.c_d_id, t.c_id) AS INTEGER) AS rank,
  t.c_w_id, t.c_d_id, t.c_id, t.c_first, t.c_middle, t.c_last,
  concat_ws(' ', t.c_first, t.c_middle, t.c_last) AS customer_name, t.c_balance, w.w_name, d.d_name
FROM top t
LEFT JOIN districts d ON d.d_w_id = t.c_w_id AND d.d_id = t.c_d_id
LEFT JOIN warehouses w ON w.w_id = t.c_w_id
""")(lambda t: _stream_top_balance(t))


def _stream_top_balance(t):
    from os.path import dirname
    feed = dirname(arriving(t, t.raw("events"), F.col("event_id")))
    return streams.stream_top_balance(t.spark, feed, t.customers, t.districts, t.warehouses, files_per_batch=1)

