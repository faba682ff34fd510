"""Content fingerprints of tables.

A row's hash is a number of 60 bits; a table's fingerprint is the number of its rows and the sum of
their hashes modulo 2^60. It doesn't depend on the order of rows, counts repeated ones, and changes
with a batch by the hashes of the rows that come and go: no table is read again. Kept for each
partition of a table, two fingerprints tell which partitions differ, where row counts see nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .upkeep import WEIGHT

MODULUS = 1 << 60
#: How a NULL is written; values that hold the separator or a backslash are escaped, so no two rows are written alike.
NULL = "\\N"


def row_hash(columns: Sequence[str]) -> Column:
    """60 bits of the MD5 of a row's values as text."""
    text = lambda c: F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\p"))
    row = F.concat_ws("|", *[F.coalesce(text(c), F.lit(NULL)) for c in columns])
    return F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(38,0)")


def fingerprints(table: DataFrame, name: str, partition: Column, weight: Column | None = None) -> DataFrame:
    """(table_name, part, n_rows, hash): a row for each value of ``partition``. ``weight``: +1 or -1 of a change's rows."""
    columns = [c for c in table.columns if c != WEIGHT]
    times = F.lit(1) if weight is None else weight
    rows = table.select(partition.cast("string").alias("part"), row_hash(columns).alias("h"), times.cast("long").alias("w"))
    return (rows.groupBy("part").agg(F.sum("w").alias("n_rows"), F.pmod(F.sum(F.col("h") * F.col("w")), F.lit(MODULUS).cast("decimal(38,0)")).cast("long").alias("hash"))
            .select(F.lit(name).alias("table_name"), "part", "n_rows", "hash"))


def merged(*prints: DataFrame) -> DataFrame:
    """Fingerprints added up: of a table before a change and of the change, that of the table after it. Partitions without rows go."""
    both = reduce(DataFrame.unionByName, prints)
    total = F.pmod(F.sum(F.col("hash").cast("decimal(38,0)")), F.lit(MODULUS).cast("decimal(38,0)")).cast("long")
    return both.groupBy("table_name", "part").agg(F.sum("n_rows").alias("n_rows"), total.alias("hash")).where("n_rows <> 0 or hash <> 0")


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(table_name, part, left_rows, right_rows): partitions whose content isn't the same; 0 rows where there is none."""
    a = left.select("table_name", "part", F.col("n_rows").alias("left_rows"), F.col("hash").alias("__l"))
    b = right.select("table_name", "part", F.col("n_rows").alias("right_rows"), F.col("hash").alias("__r"))
    j = a.join(b, ["table_name", "part"], "full")
    same = F.col("__l").eqNullSafe(F.col("__r")) & F.col("left_rows").eqNullSafe(F.col("right_rows"))
    return j.where(~same).select("table_name", "part", F.coalesce("left_rows", F.lit(0)).alias("left_rows"), F.coalesce("right_rows", F.lit(0)).alias("right_rows"))
