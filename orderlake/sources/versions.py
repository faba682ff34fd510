"""Writing new table versions without rewriting untouched data.

A table stored partitioned by warehouse only needs the partitions a batch
touched rewritten: ``write_touched_partitions`` overwrites exactly the
partition values present in the frame it is given (dynamic partition
overwrite) and leaves every other partition as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import cut_lineage


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """First version of a table, partitioned (e.g. stocks by s_w_id)."""
    df.write.mode("overwrite").partitionBy(*partition_cols).parquet(path)


def touched_rows(new_version: DataFrame, delta_keys: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Rows of the new version that lie in partitions the delta touched
    (semi join on the distinct partition values of the delta)."""
    parts = delta_keys.select(*partition_cols).distinct()
    return new_version.join(parts, partition_cols, "left_semi")


def write_touched_partitions(rows: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Overwrite only the partitions whose values occur in ``rows``."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_cols).parquet(path))


def rewrite_touched(spark: SparkSession, path: str, touched: DataFrame, partition_cols: list[str], change: Callable[[DataFrame], DataFrame]) -> None:
    """Replace the partitions of the table at ``path`` whose values are in ``touched`` by ``change`` of
    their rows; the others are neither read nor written. The new rows are written aside first, so a
    change that fails on the way leaves the table as it was. ``change`` must leave rows in each partition."""
    schema = spark.read.parquet(path).schema
    parts = cut_lineage(touched.select(*partition_cols).distinct(), "touched")
    old = spark.read.parquet(path).join(parts, partition_cols, "left_semi").select(*schema.names)
    write_touched_partitions(cut_lineage(change(old).select(*schema.names), "new-version"), path, partition_cols)
