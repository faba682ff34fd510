"""Explicit schemas of the seven wholesale base tables.

Raw files are header-less CSV with columns in the order below; the schema is
always passed to the reader, never inferred.
"""

from pyspark.sql import types as T

_I = T.IntegerType()
_L = T.LongType()
_S = T.StringType()
_TS = T.TimestampNTZType()


def _dec(p, s):
    return T.DecimalType(p, s)


def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


WAREHOUSE = _schema(
    ("w_id", _I), ("w_name", _S), ("w_street_1", _S), ("w_street_2", _S),
    ("w_city", _S), ("w_state", _S), ("w_zip", _S), ("w_tax", _dec(4, 4)),
    ("w_ytd", _dec(12, 2)),
)

DISTRICT = _schema(
    ("d_w_id", _I), ("d_id", _I), ("d_name", _S), ("d_street_1", _S),
    ("d_street_2", _S), ("d_city", _S), ("d_state", _S), ("d_zip", _S),
    ("d_tax", _dec(4, 4)), ("d_ytd", _dec(12, 2)), ("d_next_o_id", _I),
)

CUSTOMER = _schema(
    ("c_w_id", _I), ("c_d_id", _I), ("c_id", _L), ("c_first", _S),
    ("c_middle", _S), ("c_last", _S), ("c_street_1", _S), ("c_street_2", _S),
    ("c_city", _S), ("c_state", _S), ("c_zip", _S), ("c_phone", _S),
    ("c_since", _TS), ("c_credit", _S), ("c_credit_lim", _dec(12, 2)),
    ("c_discount", _dec(5, 4)), ("c_balance", _dec(12, 2)),
    ("c_ytd_payment", _dec(14, 2)), ("c_payment_cnt", _I),
    ("c_delivery_cnt", _I), ("c_data", _S),
)

ORDER = _schema(
    ("o_w_id", _I), ("o_d_id", _I), ("o_id", _I), ("o_c_id", _L),
    ("o_carrier_id", _I), ("o_ol_cnt", _I), ("o_all_local", _I),
    ("o_entry_d", _TS),
)

ITEM = _schema(
    ("i_id", _L), ("i_name", _S), ("i_price", _dec(12, 2)), ("i_im_id", _I),
    ("i_data", _S),
)

ORDER_LINE = _schema(
    ("ol_w_id", _I), ("ol_d_id", _I), ("ol_o_id", _I), ("ol_number", _I),
    ("ol_i_id", _L), ("ol_delivery_d", _TS), ("ol_amount", _dec(12, 2)),
    ("ol_supply_w_id", _I), ("ol_quantity", _I), ("ol_dist_info", _S),
)

STOCK = _schema(
    ("s_w_id", _I), ("s_i_id", _L), ("s_quantity", _I), ("s_ytd", _dec(12, 2)),
    ("s_order_cnt", _I), ("s_remote_cnt", _I),
    *[(f"s_dist_{k:02d}", _S) for k in range(1, 11)],
    ("s_data", _S),
)

BASE_SCHEMAS = {
    "warehouses": WAREHOUSE,
    "districts": DISTRICT,
    "customers": CUSTOMER,
    "orders": ORDER,
    "items": ITEM,
    "order_lines": ORDER_LINE,
    "stocks": STOCK,
}

# Primary keys of the base tables.
PRIMARY_KEYS = {
    "warehouses": ["w_id"],
    "districts": ["d_w_id", "d_id"],
    "customers": ["c_w_id", "c_d_id", "c_id"],
    "orders": ["o_w_id", "o_d_id", "o_id"],
    "items": ["i_id"],
    "order_lines": ["ol_w_id", "ol_d_id", "ol_o_id", "ol_number"],
    "stocks": ["s_w_id", "s_i_id"],
}

# Foreign keys: (child, child columns, parent, parent columns).
FOREIGN_KEYS = [
    ("districts", ["d_w_id"], "warehouses", ["w_id"]),
    ("customers", ["c_w_id", "c_d_id"], "districts", ["d_w_id", "d_id"]),
    ("orders", ["o_w_id", "o_d_id", "o_c_id"], "customers", ["c_w_id", "c_d_id", "c_id"]),
    ("order_lines", ["ol_w_id", "ol_d_id", "ol_o_id"], "orders", ["o_w_id", "o_d_id", "o_id"]),
    ("order_lines", ["ol_i_id"], "items", ["i_id"]),
    ("stocks", ["s_i_id"], "items", ["i_id"]),
    ("stocks", ["s_w_id"], "warehouses", ["w_id"]),
]

# Declared string lengths of the relational schema
# (column, max length).
LENGTH_LIMITS = {
    "warehouses": [("w_name", 10), ("w_street_1", 20), ("w_street_2", 20), ("w_city", 20),
                   ("w_state", 2), ("w_zip", 9)],
    "districts": [("d_name", 10), ("d_street_1", 20), ("d_street_2", 20), ("d_city", 20),
                  ("d_state", 2), ("d_zip", 9)],
    "customers": [("c_first", 16), ("c_middle", 2), ("c_last", 16), ("c_street_1", 20),
                  ("c_street_2", 20), ("c_city", 20), ("c_state", 2), ("c_zip", 9),
                  ("c_phone", 16), ("c_credit", 2), ("c_data", 500)],
    "items": [("i_name", 24), ("i_data", 50)],
    "order_lines": [("ol_dist_info", 24)],
    "stocks": [*[(f"s_dist_{k:02d}", 24) for k in range(1, 11)], ("s_data", 50)],
}
