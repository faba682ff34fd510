"""Denormalised tables and per-order shapes (the data-preparation job).

Each function is a pure DataFrame transformation of the base tables.
Dimension joins (warehouses, districts) are left to Spark's size checks:
the static broadcast threshold and AQE's runtime conversion pick a broadcast
only when the measured side is small, else a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalar import address_struct, full_name, name_struct


def customers_denormalized(customers: DataFrame, districts: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Customers with warehouse and district names copied in (B1)."""
    d = districts.select("d_w_id", "d_id", "d_name")
    w = warehouses.select("w_id", "w_name")
    j = (customers
         .join(d, (customers.c_w_id == d.d_w_id) & (customers.c_d_id == d.d_id), "inner")
         .join(w, customers.c_w_id == w.w_id, "inner"))
    return j.select(
        "c_w_id", "c_d_id", "c_id", "c_first", "c_middle", "c_last",
        "c_street_1", "c_street_2", "c_city", "c_state", "c_zip", "c_phone", "c_since",
        "c_credit", "c_credit_lim", "c_discount", "c_balance", "c_ytd_payment",
        "c_payment_cnt", "c_delivery_cnt",
        F.col("w_name").alias("c_w_name"), F.col("d_name").alias("c_d_name"))


def customer_profiles(customers: DataFrame) -> DataFrame:
    """Name and address as structs, then read back by field."""
    s = customers.select(
        "c_w_id", "c_d_id", "c_id",
        name_struct("c").alias("c_name"),
        address_struct("c").alias("c_address"))
    return s.select(
        "c_w_id", "c_d_id", "c_id",
        F.col("c_name.first").alias("name_first"),
        F.col("c_name.last").alias("name_last"),
        F.col("c_address.city").alias("addr_city"),
        full_name("c_name.first", "c_name.middle", "c_name.last").alias("full_name"),
        F.concat_ws(", ", "c_address.street_1", "c_address.street_2", "c_address.city",
                    "c_address.state", "c_address.zip").alias("address_line"))


def orders_by_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders keyed by customer, newest first within a customer (B2)."""
    c = customers.select("c_w_id", "c_d_id", "c_id", "c_first", "c_middle", "c_last")
    j = orders.join(c, (orders.o_w_id == c.c_w_id) & (orders.o_d_id == c.c_d_id) &
                    (orders.o_c_id == c.c_id), "inner")
    return j.select("c_w_id", "c_d_id", "c_id", "o_id", "o_entry_d", "o_carrier_id",
                    "o_ol_cnt", "c_first", "c_middle", "c_last")


def undelivered_orders(orders: DataFrame) -> DataFrame:
    """Queue of orders without a carrier."""
    return (orders.filter(F.col("o_carrier_id").isNull())
                  .select("o_w_id", "o_d_id", "o_id", "o_c_id"))


def customer_order_items(orders: DataFrame, order_lines: DataFrame) -> DataFrame:
    """One row per (customer, order, item)."""
    ol = order_lines.select(F.col("ol_w_id").alias("w_id"), F.col("ol_d_id").alias("d_id"),
                            F.col("ol_o_id").alias("o_id"), F.col("ol_i_id").alias("i_id"))
    o = orders.select(F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"),
                      "o_id", F.col("o_c_id").alias("c_id"))
    return o.join(ol, on=["w_id", "d_id", "o_id"], how="inner") \
            .select("w_id", "d_id", "c_id", "o_id", "i_id").distinct()


def popular_lines(order_lines: DataFrame, mode: str = "max") -> DataFrame:
    """Lines of each order with its most (``max``) or least (``min``) quantity,
    ties kept; ``all`` keeps every line with quantity > 0 (A15, W1, F11).

    Partitioned by the order key: one group is one order, a bounded size.
    """
    if mode == "all":
        return order_lines.filter(F.col("ol_quantity") > 0)
    wo = W.partitionBy("ol_w_id", "ol_d_id", "ol_o_id")
    agg = F.max if mode == "max" else F.min
    return (order_lines.withColumn("__best", agg("ol_quantity").over(wo))
                       .filter(F.col("ol_quantity") == F.col("__best")).drop("__best"))


def ranked_lines(order_lines: DataFrame, mode: str = "max") -> DataFrame:
    """Lines with dense rank 1 of quantity in their order (W1, F11):
    descending for ``max`` (most ordered first), ascending for ``min``."""
    q = F.col("ol_quantity").desc() if mode == "max" else F.col("ol_quantity").asc()
    w = W.partitionBy("ol_w_id", "ol_d_id", "ol_o_id").orderBy(q)
    return (order_lines.withColumn("__rank", F.dense_rank().over(w))
                       .filter(F.col("__rank") == 1).drop("__rank"))


def popular_items_snapshot(orders: DataFrame, order_lines: DataFrame, items: DataFrame,
                           customers: DataFrame, mode: str = "max") -> DataFrame:
    """Popular lines of every order with item and customer names."""
    pl = ranked_lines(order_lines, mode).select(
        F.col("ol_w_id").alias("w_id"), F.col("ol_d_id").alias("d_id"),
        F.col("ol_o_id").alias("o_id"), F.col("ol_i_id").alias("i_id"), "ol_quantity")
    o = orders.select(F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"), "o_id",
                      F.col("o_c_id").alias("c_id"), "o_entry_d")
    c = customers.select(F.col("c_w_id").alias("w_id"), F.col("c_d_id").alias("d_id"),
                         F.col("c_id"), "c_first", "c_middle", "c_last")
    it = items.select("i_id", "i_name")
    return (pl.join(o, ["w_id", "d_id", "o_id"]).join(c, ["w_id", "d_id", "c_id"])
              .join(it, "i_id")
              .select("w_id", "d_id", "o_id", "o_entry_d", "c_id", "c_first", "c_middle", "c_last",
                      "i_id", "i_name", "ol_quantity"))


def top_balance_table(customers: DataFrame, districts: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Customers with a balance plus their warehouse and district names."""
    c = customers.filter(F.col("c_balance").isNotNull()).select(
        "c_w_id", "c_d_id", "c_id", "c_balance", "c_first", "c_middle", "c_last")
    d = districts.select("d_w_id", "d_id", "d_name")
    w = warehouses.select("w_id", "w_name")
    j = (c.join(d, (c.c_w_id == d.d_w_id) & (c.c_d_id == d.d_id), "inner")
          .join(w, c.c_w_id == w.w_id, "inner"))
    return j.select("c_w_id", "c_d_id", "c_id", "c_balance", "c_first", "c_middle", "c_last",
                    "w_name", "d_name")


def order_lines_nested(order_lines: DataFrame) -> DataFrame:
    """Items of each order as a sorted list (A17); an order has few lines."""
    return (order_lines.groupBy("ol_w_id", "ol_d_id", "ol_o_id")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.array_join(F.array_sort(F.collect_list(F.col("ol_i_id").cast("string"))), ",")
                  .alias("item_list")))


def order_item_sets(order_lines: DataFrame) -> DataFrame:
    """Distinct items of each order."""
    return (order_lines.groupBy("ol_w_id", "ol_d_id", "ol_o_id")
            .agg(F.size(F.collect_set("ol_i_id")).alias("n_items"),
                 F.array_join(F.transform(F.array_sort(F.collect_set("ol_i_id")), lambda x: x.cast("string")), ",")
                  .alias("item_set")))


def order_amounts(order_lines: DataFrame) -> DataFrame:
    """Total amount of each order (A9), map-side partial sums."""
    return (order_lines.groupBy(F.col("ol_w_id").alias("w_id"), F.col("ol_d_id").alias("d_id"),
                                F.col("ol_o_id").alias("o_id"))
            .agg(F.sum("ol_amount").cast("decimal(18,2)").alias("amount"),
                 F.count(F.lit(1)).alias("n_lines")))
