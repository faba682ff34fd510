"""Catalog tables for the seven base tables (S6, S14, S15; layout of 1.3).

Tables are parquet data source tables at an explicit location (a shared
folder, never a machine-local default). With ``bucketed=True`` each table is
bucketed and sorted on its full key, so the order/line/customer joins on
those keys read matching buckets without a shuffle; bucketing on the full
key (not on the district) keeps one busy district from becoming one busy
bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .schema import BASE_SCHEMAS

# Bucket keys per table (full primary key, or the key used by
# the joins that read the table).
BUCKET_KEYS = {
    "customers": ["c_w_id", "c_d_id", "c_id"],
    "orders": ["o_w_id", "o_d_id", "o_id"],
    "order_lines": ["ol_w_id", "ol_d_id", "ol_o_id"],
    "stocks": ["s_w_id", "s_i_id"],
}


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_base_tables(spark: SparkSession, location: str, database: str = "orderlake",
                       bucketed: bool = False, buckets: int = 64) -> list[str]:
    """CREATE TABLE IF NOT EXISTS for the seven base tables."""
    loc = location.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{loc}'")
    names = []
    for name, schema in BASE_SCHEMAS.items():
        clause = ""
        if bucketed and name in BUCKET_KEYS:
            keys = ", ".join(BUCKET_KEYS[name])
            clause = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS"
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({_ddl(schema)}) USING parquet"
                  f"{clause} LOCATION '{loc}/{name}'")
        names.append(f"{database}.{name}")
    return names


def drop_tables(spark: SparkSession, database: str = "orderlake") -> int:
    """DROP TABLE IF EXISTS for every table of the database."""
    n = 0
    for t in spark.catalog.listTables(database):
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{t.name}`")
        n += 1
    return n


def load_table(df: DataFrame, database: str, name: str, overwrite: bool = False, buckets: int | None = None) -> None:
    """Bulk load (S6): columns are put in the table's order by name, then
    inserted (insertInto is positional). With the table's number of ``buckets`` the rows
    are dealt as it deals them first, so each bucket is one sorted file."""
    df = df.select(*BASE_SCHEMAS[name].fieldNames())
    if buckets and name in BUCKET_KEYS:
        df = df.repartition(buckets, *BUCKET_KEYS[name]).sortWithinPartitions(*BUCKET_KEYS[name])
    df.write.insertInto(f"`{database}`.`{name}`", overwrite=overwrite)


def colocated_order_lines(spark: SparkSession, database: str) -> DataFrame:
    """Orders with their lines summed up (J4, J18), from tables bucketed on the order key: each task reads a bucket of either, nothing is shuffled."""
    o, ol = spark.table(f"`{database}`.orders"), spark.table(f"`{database}`.order_lines")
    per = ol.groupBy("ol_w_id", "ol_d_id", "ol_o_id").agg(F.sum("ol_amount").cast("decimal(18,2)").alias("amount"), F.count(F.lit(1)).alias("n_lines"))
    j = o.join(per, (o.o_w_id == per.ol_w_id) & (o.o_d_id == per.ol_d_id) & (o.o_id == per.ol_o_id))
    return j.select("o_w_id", "o_d_id", "o_id", "o_c_id", "amount", "n_lines")


def clustering_faults(spark: SparkSession, database: str, name: str) -> DataFrame:
    """(table_name, n_rows, n_out_of_order): rows of a bucketed table whose key is smaller than that of the row before
    it in its file (O5). Each row is compared with its neighbour in the piece of a file that a task reads."""
    key = F.struct(*BUCKET_KEYS[name])
    rows = spark.table(f"`{database}`.`{name}`").select(
        key.alias("key"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"))
    before = F.lag("key").over(W.partitionBy("file", "block").orderBy("pos"))
    return rows.withColumn("before", before).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("before") > F.col("key")).alias("n_out_of_order")).select(
        F.lit(name).alias("table_name"), "n_rows", "n_out_of_order")
