"""Stored derived tables kept up by deltas.

A change of a base table is a frame of its rows with a weight: +1 for a row that
comes, -1 for one that goes (an update is one of each). Filters and projections keep
weights, joins multiply them; a join changes by ``dA x B`` and ``(A + dA) x dB``. So the delta of a
derived table costs as much as the change and what it meets, not the table.

A derived table is stored with the number of ways each row comes about (``n``), which a
DISTINCT projection needs: a row goes when the last one does. ``apply`` adds a delta
and rewrites only the partitions it touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.versions import write_partitioned, write_touched_partitions

WEIGHT = "weight"


def came(rows: DataFrame) -> DataFrame:
    return rows.withColumn(WEIGHT, F.lit(1).cast("long"))


def went(rows: DataFrame) -> DataFrame:
    return rows.withColumn(WEIGHT, F.lit(-1).cast("long"))


def replaced(before: DataFrame, after: DataFrame) -> DataFrame:
    return went(before).unionByName(came(after))


def joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join of two weighted frames."""
    r = right.withColumnRenamed(WEIGHT, "__weight")
    return left.join(r, list(keys)).withColumn(WEIGHT, F.col(WEIGHT) * F.col("__weight")).drop("__weight")


def join_delta(left: DataFrame, d_left: DataFrame | None, right: DataFrame, d_right: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """The delta of ``left`` x ``right`` (tables before the change, without weights) for their deltas; None: unchanged."""
    parts = []
    if d_left is not None:
        parts.append(joined(d_left, came(right), keys))
    if d_right is not None:
        after = came(left) if d_left is None else came(left).unionByName(d_left)
        parts.append(joined(after, d_right, keys))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def store(rows: DataFrame, path: str, partition: Sequence[str]) -> None:
    """The first version: distinct rows with the number of their occurrences."""
    write_partitioned(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), path, list(partition))


def read(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).where("n > 0").drop("n")


def apply(spark, path: str, delta: DataFrame, partition: Sequence[str]) -> DataFrame:
    """Add ``delta`` (the stored columns and a weight) to the table at ``path``; the partitions that it touched.

    Changes that cancel out touch nothing. A partition left without rows keeps those that went with n = 0, which ``read``
    leaves out, until it is written again. The new rows are written aside first,
    so a batch that fails on the way leaves the table as it was.
    """
    partition, cols = list(partition), [c for c in delta.columns if c != WEIGHT]
    net = cut_lineage(delta.groupBy(*cols).agg(F.sum(WEIGHT).alias("n")).where("n <> 0"), "upkeep-delta")
    touched = net.select(*partition).distinct()
    old = spark.read.parquet(path).where("n > 0").join(touched, partition, "left_semi").select(*cols, "n")
    new = old.unionByName(net.select(*cols, "n")).groupBy(*cols).agg(F.sum("n").alias("n")).where("n >= 0")
    write_touched_partitions(cut_lineage(new, "upkeep-rows"), path, partition)
    return touched


# --- the derived tables

#: Stored table -> the column that it is partitioned by.
PARTITION = {"customer_order_items": ["w_id"], "undelivered_orders": ["o_w_id"], "orders_by_customer": ["c_w_id"]}


def _order_keys(orders: DataFrame) -> DataFrame:
    extra = [WEIGHT] if WEIGHT in orders.columns else []
    return orders.select(F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"), F.col("o_c_id").alias("c_id"), "o_id", *extra)


def _line_items(lines: DataFrame) -> DataFrame:
    extra = [WEIGHT] if WEIGHT in lines.columns else []
    return lines.select(F.col("ol_w_id").alias("w_id"), F.col("ol_d_id").alias("d_id"), F.col("ol_o_id").alias("o_id"), F.col("ol_i_id").alias("i_id"), *extra)


def customer_order_items(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Every line as (w_id, d_id, c_id, o_id, i_id), repeats kept: what ``store`` counts."""
    return _order_keys(orders).join(_line_items(lines), ["w_id", "d_id", "o_id"]).select("w_id", "d_id", "c_id", "o_id", "i_id")


def customer_order_items_delta(orders: DataFrame, d_orders: DataFrame | None, lines: DataFrame, d_lines: DataFrame | None) -> DataFrame:
    d = join_delta(_order_keys(orders), None if d_orders is None else _order_keys(d_orders),
                   _line_items(lines), None if d_lines is None else _line_items(d_lines), ["w_id", "d_id", "o_id"])
    return d.select("w_id", "d_id", "c_id", "o_id", "i_id", WEIGHT)


def undelivered_delta(d_orders: DataFrame) -> DataFrame:
    return d_orders.where("o_carrier_id is null").select("o_w_id", "o_d_id", "o_id", "o_c_id", WEIGHT)


def orders_by_customer_delta(d_orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers' names don't change, so only the orders' delta is joined."""
    names = customers.select("c_w_id", "c_d_id", "c_id", "c_first", "c_middle", "c_last")
    o = d_orders.select(F.col("o_w_id").alias("c_w_id"), F.col("o_d_id").alias("c_d_id"), F.col("o_c_id").alias("c_id"), "o_id", "o_entry_d", "o_carrier_id",
                        "o_ol_cnt", WEIGHT)
    return o.join(names, ["c_w_id", "c_d_id", "c_id"]).select(
        "c_w_id", "c_d_id", "c_id", "o_id", "o_entry_d", "o_carrier_id", "o_ol_cnt", "c_first", "c_middle", "c_last", WEIGHT)


def delivery_delta(orders: DataFrame, delivered: DataFrame) -> DataFrame:
    """The change of ``orders`` when ``delivered`` get their carrier: each of them goes and comes again."""
    d = delivered.select(F.col("w_id").alias("o_w_id"), F.col("d_id").alias("o_d_id"), "o_id", F.col("carrier_id").alias("__carrier"))
    met = orders.join(d, ["o_w_id", "o_d_id", "o_id"]).select(*orders.columns, "__carrier")
    return replaced(met.select(*orders.columns), met.withColumn("o_carrier_id", F.col("__carrier")).select(*orders.columns))
