"""Adapter: the driver's TPC-H-like parquet tables -> the wholesale tables.

Every expression here has a twin in ``orderlake.plans.oracle.ADAPTER_SQL``;
both follow FIXTURES.md section 3. Orders whose key is a multiple of 10 are
held back as New-Order requests; the base tables are built from the rest.
All tables are lazy DataFrames; nothing is collected.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators.skew import dealt, sequence_numbers
from ..session import folder_exists, scratch_table_path, shuffles_dropped

# Fixed values of the adapter (FIXTURES.md section 3).
DISTRICTS_PER_WAREHOUSE = 10
WAREHOUSE_YTD = "300000"
DISTRICT_YTD = "30000"
CREDIT_LIMIT = "50000"
CUSTOMER_SINCE = "2023-01-01 00:00:00"
DELIVERY_TS = "2024-02-01 00:00:00"
NEW_ORDER_EVERY = 10
STOCK_LEVEL_T = 40
LAST_L = 20
CLIENTS = 20
WAREHOUSES = 25
#: Suppliers up to which each task gets them all; more are joined by key.
FEW_SUPPLIERS = 1_000_000


def ts_ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _dec(c, p, s):
    return c.cast(f"decimal({p},{s})")


def _addr(prefix: str, key_cols, name_col):
    """Address columns derived from a name and a key (adapter-only values)."""
    key = F.concat_ws("-", *[F.col(k).cast("string") for k in key_cols])
    return [
        F.concat(F.col(name_col), F.lit(" Road")).alias(f"{prefix}_street_1"),
        F.concat(F.lit("Unit "), key).alias(f"{prefix}_street_2"),
        F.col(name_col).alias(f"{prefix}_city"),
        F.upper(F.substring(F.col(name_col), 1, 2)).alias(f"{prefix}_state"),
        F.lpad(key, 9, "0").alias(f"{prefix}_zip"),
    ]


class Tables:
    """The seven base tables plus the request tables of one data set."""

    def __init__(self, spark: SparkSession, sf_dir: str, split: bool = False):
        self.split = split  # hold back the orders that arrive as New-Order requests
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- base tables ---------------------------------------------------
    @cached_property
    def warehouses(self) -> DataFrame:
        n = self.raw("nation")
        return n.select(
            F.col("n_nationkey").cast("int").alias("w_id"),
            F.col("n_name").alias("w_name"),
            *_addr("w", ["n_nationkey"], "n_name"),
            _dec((F.col("n_nationkey") % 20) * F.lit(0.01).cast("decimal(2,2)"), 4, 4).alias("w_tax"),
            _dec(F.lit(WAREHOUSE_YTD), 12, 2).alias("w_ytd"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        c = self.raw("customer")
        key = F.col("c_custkey")
        return c.select(
            F.col("c_nationkey").cast("int").alias("c_w_id"),
            (key % DISTRICTS_PER_WAREHOUSE + 1).cast("int").alias("c_d_id"),
            key.alias("c_id"),
            F.col("c_mktsegment").alias("c_first"),
            F.lit("OE").alias("c_middle"),
            F.col("c_name").alias("c_last"),
            F.concat(F.col("c_name"), F.lit(" St")).alias("c_street_1"),
            F.lit("").alias("c_street_2"),
            F.col("c_mktsegment").alias("c_city"),
            F.upper(F.substring("c_mktsegment", 1, 2)).alias("c_state"),
            F.lpad(key.cast("string"), 9, "0").alias("c_zip"),
            F.lpad(key.cast("string"), 16, "0").alias("c_phone"),
            ts_ntz(CUSTOMER_SINCE).alias("c_since"),
            F.when(F.col("c_mktsegment") == "BUILDING", "BC").otherwise("GC").alias("c_credit"),
            _dec(F.lit(CREDIT_LIMIT), 12, 2).alias("c_credit_lim"),
            _dec((key % 50) * F.lit(0.01).cast("decimal(2,2)"), 5, 4).alias("c_discount"),
            _dec(F.col("c_acctbal"), 12, 2).alias("c_balance"),
            _dec(F.lit(0), 14, 2).alias("c_ytd_payment"),
            F.lit(0).cast("int").alias("c_payment_cnt"),
            F.lit(0).cast("int").alias("c_delivery_cnt"),
            F.col("c_mktsegment").alias("c_data"),
        )

    @cached_property
    def _orders_keyed(self) -> DataFrame:
        """All driver orders with their district; base and request orders."""
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        c = self.customers.select("c_id", "c_w_id", "c_d_id")
        return o.join(c, o.o_custkey == c.c_id, "inner").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
            F.col("c_w_id").alias("o_w_id"), F.col("c_d_id").alias("o_d_id"))

    @cached_property
    def _base_orders_numbered(self) -> DataFrame:
        o = self._orders_keyed
        if self.split:
            o = o.filter(F.col("o_orderkey") % NEW_ORDER_EVERY != 0)
        # Order numbers per district by order key; range-split so a busy
        # district is numbered by many tasks.
        o = sequence_numbers(o, ["o_w_id", "o_d_id"], ["o_orderkey"], "__rn")
        return o.select(
            "o_w_id", "o_d_id",
            F.col("__rn").cast("int").alias("o_id"),
            F.col("o_custkey").alias("o_c_id"),
            F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("int"))
             .otherwise((F.col("o_orderkey") % 10 + 1).cast("int")).alias("o_carrier_id"),
            F.col("o_orderdate").alias("o_entry_d"),
            "o_orderkey",
        )

    @cached_property
    def order_lines_keyed(self) -> DataFrame:
        """Order lines plus the driver's order key (join helper)."""
        li = self.raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_shipdate")
        s = self.raw("supplier").select("s_suppkey", "s_nationkey")
        o = self._base_orders_numbered.select("o_orderkey", "o_w_id", "o_d_id", "o_id", "o_carrier_id")
        w = W.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
        # Suppliers first: after the join by order the lines lie as the window needs them and aren't shuffled again.
        s = F.broadcast(s) if s.count() <= FEW_SUPPLIERS else s
        j = (li.join(s, li.l_suppkey == s.s_suppkey, "inner")
               .join(o, li.l_orderkey == o.o_orderkey, "inner"))
        return j.select(
            F.col("o_w_id").alias("ol_w_id"),
            F.col("o_d_id").alias("ol_d_id"),
            F.col("o_id").alias("ol_o_id"),
            F.row_number().over(w).cast("int").alias("ol_number"),
            F.col("l_partkey").alias("ol_i_id"),
            F.when(F.col("o_carrier_id").isNull(), F.lit(None).cast("timestamp_ntz"))
             .otherwise(F.col("l_shipdate")).alias("ol_delivery_d"),
            _dec(F.col("l_extendedprice"), 12, 2).alias("ol_amount"),
            F.col("s_nationkey").cast("int").alias("ol_supply_w_id"),
            F.col("l_quantity").cast("int").alias("ol_quantity"),
            F.concat(F.lit("S_DIST_"), F.col("o_d_id").cast("string")).alias("ol_dist_info"),
            F.col("l_orderkey").alias("ol_orderkey"),
        )

    @cached_property
    def order_lines(self) -> DataFrame:
        return self.order_lines_keyed.drop("ol_orderkey")

    @cached_property
    def orders_keyed(self) -> DataFrame:
        lines = (self.order_lines_keyed
                 .groupBy("ol_orderkey")
                 .agg(F.count(F.lit(1)).cast("int").alias("n_lines"),
                      F.sum(F.when(F.col("ol_supply_w_id") != F.col("ol_w_id"), 1).otherwise(0))
                       .alias("n_remote")))
        o = self._base_orders_numbered
        j = o.join(lines, o.o_orderkey == lines.ol_orderkey, "left")
        return j.select(
            "o_w_id", "o_d_id", "o_id", "o_c_id", "o_carrier_id",
            F.coalesce(F.col("n_lines"), F.lit(0)).cast("int").alias("o_ol_cnt"),
            F.when(F.coalesce(F.col("n_remote"), F.lit(0)) > 0, 0).otherwise(1).cast("int").alias("o_all_local"),
            "o_entry_d", "o_orderkey",
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.orders_keyed.drop("o_orderkey")

    @cached_property
    def districts(self) -> DataFrame:
        wh = self.warehouses
        d = wh.select(
            F.col("w_id").alias("d_w_id"),
            F.explode(F.sequence(F.lit(1), F.lit(DISTRICTS_PER_WAREHOUSE))).alias("d_id"),
            "w_name")
        mx = (self._base_orders_numbered.groupBy("o_w_id", "o_d_id")
              .agg(F.max("o_id").alias("max_o_id")))
        j = d.join(mx, (d.d_w_id == mx.o_w_id) & (d.d_id == mx.o_d_id), "left")
        return j.select(
            "d_w_id", "d_id",
            F.concat(F.lit("D"), F.col("d_id").cast("string")).alias("d_name"),
            *_addr("d", ["d_w_id", "d_id"], "w_name"),
            _dec(((F.col("d_w_id") * 10 + F.col("d_id")) % 20) * F.lit(0.01).cast("decimal(2,2)"), 4, 4)
             .alias("d_tax"),
            _dec(F.lit(DISTRICT_YTD), 12, 2).alias("d_ytd"),
            (F.coalesce(F.col("max_o_id"), F.lit(0)) + 1).cast("int").alias("d_next_o_id"),
        )

    @cached_property
    def items(self) -> DataFrame:
        p = self.raw("part")
        return p.select(
            F.col("p_partkey").alias("i_id"),
            F.col("p_name").alias("i_name"),
            _dec(F.col("p_retailprice"), 12, 2).alias("i_price"),
            F.col("p_size").cast("int").alias("i_im_id"),
            F.col("p_brand").alias("i_data"),
        )

    @cached_property
    def stocks(self) -> DataFrame:
        # One stock row per (warehouse, item). The warehouse list is a scalar
        # subquery over the nation dimension (25 rows, a fixed bound), turned
        # into rows by a generator: no join, no cartesian product operator.
        w_ids = self.warehouses.select(F.sort_array(F.collect_list("w_id"))).scalar()
        # Files of items are small and become 25 times as many rows: the items are dealt to tasks first.
        it = dealt(self.items.select("i_id", "i_data"), ["i_id"], WAREHOUSES)
        s = it.select(F.explode(w_ids).alias("s_w_id"), F.col("i_id").alias("s_i_id"), "i_data")
        dist = [
            F.concat_ws("-", F.lit("S"), F.col("s_w_id").cast("string"), F.col("s_i_id").cast("string"),
                        F.lit(f"{k:02d}")).alias(f"s_dist_{k:02d}")
            for k in range(1, 11)
        ]
        return s.select(
            "s_w_id", "s_i_id",
            (F.lit(10) + (F.col("s_w_id") * 31 + F.col("s_i_id") * 17) % 91).cast("int").alias("s_quantity"),
            _dec(F.lit(0), 12, 2).alias("s_ytd"),
            F.lit(0).cast("int").alias("s_order_cnt"),
            F.lit(0).cast("int").alias("s_remote_cnt"),
            *dist,
            F.col("i_data").alias("s_data"),
        )

    # ---- request tables --------------------------------------------------
    @cached_property
    def payment_requests(self) -> DataFrame:
        e = self.raw("events").filter(F.col("event_type") == "purchase")
        c = self.customers.select("c_id", "c_w_id", "c_d_id")
        j = e.join(c, e.user_id == c.c_id, "inner")
        return j.select(
            F.col("event_id").alias("seq"),
            F.col("c_w_id").alias("w_id"), F.col("c_d_id").alias("d_id"), "c_id",
            _dec(F.col("value"), 12, 2).alias("amount"),
            "ts",
        )

    @cached_property
    def new_order_requests(self) -> DataFrame:
        o = self._orders_keyed.filter(F.col("o_orderkey") % NEW_ORDER_EVERY == 0)
        return o.select(
            F.col("o_orderkey").alias("seq"),
            F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"),
            F.col("o_custkey").alias("c_id"),
            F.col("o_orderdate").alias("entry_d"),
        )

    @cached_property
    def new_order_line_requests(self) -> DataFrame:
        r = self.new_order_requests.select("seq")
        li = self.raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
        s = self.raw("supplier").select("s_suppkey", "s_nationkey")
        w = W.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
        j = (li.join(r, li.l_orderkey == r.seq, "left_semi")
               .join(s, li.l_suppkey == s.s_suppkey, "inner"))
        return j.select(
            F.col("l_orderkey").alias("seq"),
            F.row_number().over(w).cast("int").alias("line_no"),
            F.col("l_partkey").alias("i_id"),
            F.col("s_nationkey").cast("int").alias("supply_w_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
        )

    @cached_property
    def delivery_requests(self) -> DataFrame:
        """One to three requests per warehouse."""
        w = self.warehouses.select("w_id", F.explode(F.sequence(F.lit(0), F.col("w_id") % 3)).alias("j"))
        return w.select(
            (F.col("w_id") * 10 + F.col("j")).alias("seq"),
            "w_id",
            ((F.col("w_id") + F.col("j")) % 10 + 1).cast("int").alias("carrier_id"),
            ts_ntz(DELIVERY_TS).alias("delivery_d"),
        )

    @cached_property
    def customer_requests(self) -> DataFrame:
        """Order-Status requests: every customer."""
        return self.customers.select(
            F.col("c_id").alias("seq"), F.col("c_w_id").alias("w_id"), F.col("c_d_id").alias("d_id"), "c_id")

    @cached_property
    def related_requests(self) -> DataFrame:
        """Related-Customer searches: every customer whose id is divisible by 100, against all."""
        return self.customer_requests.filter(F.col("c_id") % 100 == 0)

    def _asked(self) -> DataFrame:
        """Every district once, every second one twice: clients repeat requests."""
        return (self.districts.select("d_w_id", "d_id", F.explode(F.sequence(F.lit(0), (F.col("d_w_id") + F.col("d_id")) % 2)).alias("j"))
                .withColumn("seq", (F.col("d_w_id") * 20 + F.col("d_id")) * 2 + F.col("j")))

    @cached_property
    def stock_level_requests(self) -> DataFrame:
        return self._asked().select(
            "seq", F.col("d_w_id").alias("w_id"), "d_id",
            F.lit(STOCK_LEVEL_T).cast("int").alias("threshold"),
            F.lit(LAST_L).cast("int").alias("last_l"))

    @cached_property
    def popular_requests(self) -> DataFrame:
        return self._asked().select(
            "seq", F.col("d_w_id").alias("w_id"), "d_id", F.lit(LAST_L).cast("int").alias("last_l"))

    @cached_property
    def transaction_events(self) -> DataFrame:
        """Client transaction records derived from events (one per event)."""
        e = self.raw("events")
        return e.select(
            (F.col("user_id") % CLIENTS).cast("int").alias("client"),
            F.col("event_id").alias("seq"),
            "ts",
            F.col("event_type").alias("txn_type"),
            F.col("value").alias("latency_ms"),
        )

    def base(self, name: str) -> DataFrame:
        return getattr(self, name)


class StoredTables(Tables):
    """The tables, of which those that take joins, numbering or products to derive are written once, at their
    first use, to the shared checkpoint folder: a data set is loaded once and then queried. The numbered orders and the lines
    with their order's key are among them, as other tables are derived from both."""

    def __init__(self, spark: SparkSession, sf_dir: str, split: bool = False):
        super().__init__(spark, sf_dir, split)
        self.folder = scratch_table_path(spark, f"tables-{uuid.uuid4().hex[:12]}")
        self.written = False

    def lost(self) -> bool:
        """Whether someone has cleared the checkpoint folder meanwhile."""
        return self.written and not folder_exists(self.spark, self.folder)


def _stored(name: str) -> cached_property:
    def get(self) -> DataFrame:
        path = f"{self.folder}/{name.lstrip('_')}"
        with shuffles_dropped(self.spark):
            getattr(Tables, name).func(self).write.mode("overwrite").option("compression", "zstd").parquet(path)
        self.written = True
        return self.spark.read.parquet(path)
    out = cached_property(get)
    out.__set_name__(StoredTables, name)
    return out


for _name in ("_base_orders_numbered", "order_lines_keyed", "orders", "districts", "stocks", "payment_requests", "new_order_requests", "new_order_line_requests"):
    setattr(StoredTables, _name, _stored(_name))
