"""Defaults that bound what a task holds."""

from pyspark.sql import functions as F

from orderlake.session import apply_defaults


def test_shuffle_tasks_stay_small(spark):
    """A task reads some MB of a shuffle, not a share of it by the number of cores."""
    key, parts = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"
    before, before_parts = spark.conf.get(key, None), spark.conf.get(parts)
    spark.conf.unset(key)
    spark.conf.set(parts, "64")
    try:
        apply_defaults(spark)
        rows = spark.range(0, 3_000_000, 1, 4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")).repartition("id")
        sizes = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.sum(F.length("h")).alias("n")).collect()]
        assert len(sizes) > 8 and max(sizes) < 32 << 20
    finally:
        spark.conf.set(parts, before_parts)
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
