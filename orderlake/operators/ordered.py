"""Results in order.

A distributed result has no order of its own; here it gets one that can be stored and compared.
Rows go to ranges of the sort keys by sampled bounds, each range is sorted by
one task and written as one file, so the files read in the order of their names are the sorted
table. A row's position is the number of rows in the ranges before its own plus its
place in it: only the counts of the ranges meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage


def with_positions(df: DataFrame, order: Sequence[Column | str], out: str = "position") -> DataFrame:
    """``df`` sorted by ``order``, with each row's position from 1 on. Ties go by the remaining columns, so
    only equal rows are left to chance. Stored sorted, one file a range."""
    keys = [F.col(c) if isinstance(c, str) else c for c in order] + [F.col(c) for c in df.columns]
    placed = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumns({"__part": F.spark_partition_id(), "__nth": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    stored = cut_lineage(placed, "sorted")
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)  # a row a range
    parts = stored.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return stored.join(parts, "__part").select(*df.columns, (F.col("__before") + F.col("__nth") + 1).alias(out))


def with_ranks(df: DataFrame, groups: Sequence[str], order: Sequence[Column | str], out: str = "rank") -> DataFrame:
    """``df`` with each row's place in its group, from 1 on, in ``order``. A group may be of any size: rows are put in one order over
    all groups, and count from the first of their own."""
    placed = with_positions(df, [*groups, *order], "__position")
    first = placed.groupBy(*groups).agg(F.min("__position").alias("__first"))
    return placed.join(first, list(groups)).select(*df.columns, (F.col("__position") - F.col("__first") + 1).alias(out))


def customer_order_items_sorted(customer_order_items: DataFrame) -> DataFrame:
    """The customer-order-item table in the order of its keys (O1)."""
    return with_positions(customer_order_items, ["w_id", "d_id", "c_id", "o_id", "i_id"])


def popular_items_ranked(popular: DataFrame) -> DataFrame:
    """Popular items of each request, the most frequent first (O6): ``reads.popular_items_pct`` with a rank; ties by item."""
    return with_ranks(popular, ["seq"], [F.col("n_orders").desc(), "i_id"])
