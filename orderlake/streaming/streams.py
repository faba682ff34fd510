"""Structured Streaming versions of the client feed.

Each stream reads files as they arrive, runs with ``trigger(availableNow)``
(process what is there, then stop) and keeps its checkpoint and its result
under ``location``: a later call with the same location goes on where the
last one stopped. Without a location a new folder under the shared checkpoint
folder is taken. Every micro-batch writes a folder named by its batch id, so a
replayed batch overwrites what it wrote; results are read over all batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import changes
from ..operators.metrics import mean_e4, nanos
from ..operators.reads import top_balance
from ..session import cut_lineage, folder_exists, scratch_table_path
from ..sources import txlog

EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")


def _place(spark: SparkSession, name: str, location: str | None) -> str:
    return location or scratch_table_path(spark, f"stream-{name}-{uuid.uuid4().hex[:12]}")


def _run(df: DataFrame, base: str, sink, mode: str = "append") -> None:
    """Process what has arrived since the last run at ``base``."""
    q = (df.writeStream.outputMode(mode).foreachBatch(sink)
           .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()


def _written(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches at ``path`` with their ``batch``; none if nothing has arrived yet."""
    if folder_exists(spark, path):
        return spark.read.schema(f"{schema}, batch LONG").parquet(path)
    return spark.createDataFrame([], f"{schema}, batch LONG")


class Versions:
    """Tables that a stream keeps at ``base``, a version for each batch. Batch n reads the version
    before it and writes its own, so a replayed batch does the same again; older versions than these two go."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str, batch: int) -> str:
        return f"{self.base}/{name}/version={batch}"

    def numbers(self, name: str) -> list[int]:
        """Versions that were written to the end."""
        p, fs = self._fs(f"{self.base}/{name}/version=*/_SUCCESS")
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in fs.globStatus(p) or [])

    def read(self, name: str, before: int | None = None) -> DataFrame:
        """The newest version, or the newest before a batch."""
        return self.spark.read.parquet(self._path(name, max(n for n in self.numbers(name) if before is None or n < before)))

    def write(self, name: str, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(self._path(name, batch))
        for n in [n for n in self.numbers(name) if n < batch][:-1]:
            p, fs = self._fs(self._path(name, n))
            fs.delete(p, True)


def _updates(df: DataFrame, keys: list[str], name: str, location: str | None) -> DataFrame:
    """Run an aggregate in update mode: each batch writes only the groups it
    changed; the latest row of a group counts."""
    spark = df.sparkSession
    base = _place(spark, name, location)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    _run(df, base, sink, "update")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    rest = [c for c in df.columns if c not in keys]
    return (_written(spark, f"{base}/out", fields).groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*").select(*df.columns))


def events_stream(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """The events table as it grows: one file or a folder of any number of files."""
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(f"{sf_dir.rstrip('/')}/events.parquet*")


def stream_transaction_counts(spark: SparkSession, script_dir: str, location: str | None = None) -> DataFrame:
    """Valid transactions per type as script files arrive.

    A file is never cut across micro-batches, so each batch is parsed by the
    same rules as a batch job, with item lines and rejects.
    """
    base = _place(spark, "txn-counts", location)
    lines = spark.readStream.text(script_dir).select(
        F.col("value").alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        valid, _ = txlog.transactions(txlog.parse_scripts(txlog.with_client(batch.withColumn("pos", F.monotonically_increasing_id()))))
        (valid.groupBy("txn_type").agg(F.count(F.lit(1)).alias("n_txn"))
              .write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}"))

    _run(lines, base, sink)
    return _written(spark, f"{base}/out", "txn_type STRING, n_txn LONG").groupBy("txn_type").agg(F.sum("n_txn").alias("n_txn"))


def stream_payment_totals(spark: SparkSession, sf_dir: str, customers: DataFrame, location: str | None = None,
                          files_per_batch: int | None = None) -> DataFrame:
    """Running payment totals per customer from the event feed (R2).

    Stream-static join with the customer table gives each payment its
    warehouse and district; totals are kept per customer in state, and a batch
    writes the customers it touched.
    """
    e = events_stream(spark, sf_dir, files_per_batch).filter(F.col("event_type") == "purchase")
    c = customers.select("c_id", "c_w_id", "c_d_id")
    j = e.join(c, e.user_id == c.c_id, "inner")
    agg = (j.groupBy(F.col("c_w_id").alias("w_id"), F.col("c_d_id").alias("d_id"), "c_id")
            .agg(F.sum(F.col("value").cast("decimal(12,2)")).cast("decimal(18,2)").alias("paid"),
                 F.count(F.lit(1)).alias("n_payments")))
    return _updates(agg, ["w_id", "d_id", "c_id"], "payments", location)


EPOCH = "1970-01-01 00:00:00"
#: Bits of a latency that its code keeps: codes are at most 2^-BITS of the value away from it.
BITS = 8


def window_start(ts: str, seconds: int):
    """Start of the window of a wall-clock time, whatever the session time zone."""
    epoch = F.lit(EPOCH).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, F.col(ts))
    width = F.lit(seconds * 1_000_000)
    return F.timestamp_add("MICROSECOND", (micros - F.pmod(micros, width)), epoch)


def value_code(value: str):
    """A whole number by its length and its leading BITS bits, in the order of the values."""
    n = f"abs({value})"
    shift = f"greatest(0, length(bin({n})) - {BITS})"
    return F.expr(f"(CASE WHEN {value} < 0 THEN -1 ELSE 1 END) * ({shift} * {1 << BITS} + shiftright({n}, {shift}))").cast("long")


def code_middle(code: str):
    """The middle of the numbers of a code."""
    n = f"abs({code})"
    shift = f"CAST({n} div {1 << BITS} AS INT)"
    return F.expr(f"(CASE WHEN {code} < 0 THEN -1 ELSE 1 END) * (shiftleft({n} % {1 << BITS}, {shift}) + (shiftleft(1L, {shift}) - 1) div 2)")


PARTIAL = "window_start TIMESTAMP_NTZ, client INT, code LONG, n LONG, nanos LONG, top DOUBLE"


def window_partials(spark: SparkSession, sf_dir: str, clients: int, location: str | None, files_per_batch: int | None, seconds: int) -> DataFrame:
    """(window_start, client, code, n, nanos, top) of all events that have arrived, in whatever order.

    Each batch writes what it holds of each window, as counts by code of the latency, sums
    and maxima; these are merged when they are read. A window stays open for
    good: there is no watermark, and no state but the written partials.
    """
    base = _place(spark, "windows", location)

    def sink(batch: DataFrame, batch_id: int) -> None:
        e = batch.select(window_start("ts", seconds).alias("window_start"), (F.col("user_id") % clients).cast("int").alias("client"),
                         nanos("value").alias("nanos"), "value")
        (e.withColumn("code", value_code("nanos")).groupBy("window_start", "client", "code")
          .agg(F.count(F.lit(1)).alias("n"), F.sum("nanos").alias("nanos"), F.max("value").alias("top"))
          .write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}"))

    _run(events_stream(spark, sf_dir, files_per_batch), base, sink)
    return (_written(spark, f"{base}/out", PARTIAL).groupBy("window_start", "client", "code")
            .agg(F.sum("n").alias("n"), F.sum("nanos").alias("nanos"), F.max("top").alias("top")))


def stream_window_latency(spark: SparkSession, sf_dir: str, clients: int = 20, location: str | None = None,
                          files_per_batch: int | None = None, seconds: int = 86_400) -> DataFrame:
    """Per-day, per-client transaction count and latency (R3), late files included. Event time is ``ts`` (wall clock)."""
    p = window_partials(spark, sf_dir, clients, location, files_per_batch, seconds)
    return (p.groupBy("window_start", "client").agg(F.sum("n").alias("n_txn"), F.sum("nanos").alias("nanos"), F.max("top").alias("max_latency_ms"))
            .select("window_start", "client", "n_txn", mean_e4("nanos", "n_txn").alias("mean_ms"), "max_latency_ms"))


def stream_window_quantiles(spark: SparkSession, sf_dir: str, percents: tuple[int, ...] = (50, 95, 99), clients: int = 20, location: str | None = None,
                            files_per_batch: int | None = None, seconds: int = 86_400) -> DataFrame:
    """Per-day, per-client quantiles of the latency in nanoseconds (p50_ns, ...), late files included.

    The p-th percentile is the value of rank ceil(n p / 100). The rank is exact; the value is the middle of its
    code, at most 2^-8 of it away (exact below 256 ns). A window has at most some thousand codes, however many
    events it holds.
    """
    p = window_partials(spark, sf_dir, clients, location, files_per_batch, seconds)
    whole = W.partitionBy("window_start", "client")
    c = p.withColumns({"upto": F.sum("n").over(whole.orderBy("code").rowsBetween(W.unboundedPreceding, 0)), "n_txn": F.sum("n").over(whole)})
    at = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("n_txn") * q, F.col("code"))).alias(f"p{q}")
    return (c.groupBy("window_start", "client").agg(F.max("n_txn").alias("n_txn"), *[at(q) for q in percents])
            .select("window_start", "client", "n_txn", *[code_middle(f"p{q}").alias(f"p{q}_ns") for q in percents]))


BALANCE = ["c_w_id", "c_d_id", "c_id", "c_first", "c_middle", "c_last", "c_balance"]


def _best(customers: DataFrame, keep: int, floor=None) -> DataFrame:
    """The ``keep`` highest balances of each warehouse with the highest of the rest as ``floor`` (null: there is no rest);
    ``floor``: what is known of others that aren't in ``customers``."""
    order = [F.col("c_balance").desc_nulls_last(), "c_d_id", "c_id"]
    few = customers.withColumn("__rank", F.row_number().over(W.partitionBy("c_w_id").orderBy(*order))).where(F.col("__rank") <= keep + 1)
    next_best = F.max(F.when(F.col("__rank") == keep + 1, F.col("c_balance"))).over(W.partitionBy("c_w_id"))
    known = next_best if floor is None else F.greatest(next_best, F.max(floor).over(W.partitionBy("c_w_id")))
    return few.withColumn("floor", known).where(F.col("__rank") <= keep).select(*BALANCE, "floor")


def stream_top_balance(spark: SparkSession, sf_dir: str, customers: DataFrame, districts: DataFrame,
                       warehouses: DataFrame, k: int = 10, location: str | None = None, files_per_batch: int | None = None,
                       spare: int = 4) -> DataFrame:
    """Top balances kept current as payments arrive.

    For each warehouse the ``spare`` * k highest balances are kept, and a floor that no
    other customer's balance is above. Payments lower balances, so a batch changes
    the kept rows only. While k kept balances of a warehouse lie above its
    floor, its top k is among them; where they don't any more, that
    warehouse alone is read again, with the payments of all batches so far. A
    customer whose balance rises (a payment below 0) is looked up and joins the kept.
    """
    base = _place(spark, "top-balance", location)
    kept = Versions(spark, base)
    rows = customers.select(*BALANCE)
    if not kept.numbers("top"):
        kept.write("top", _best(rows, spare * k), -1)

    def now(who: DataFrame) -> DataFrame:
        """Customers with their balances after all payments up to now."""
        paid = _written(spark, f"{base}/out", "c_id LONG, paid DECIMAL(18,2)").groupBy("c_id").agg(F.sum("paid").alias("__paid"))
        return changes.apply_delta(who, paid, ["c_id"], {"c_balance": (F.col("c_balance") - F.coalesce(F.col("__paid"), F.lit(0))).cast("decimal(12,2)")})

    def sink(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy(F.col("user_id").alias("c_id")).agg(F.sum(F.col("value").cast("decimal(12,2)")).cast("decimal(18,2)").alias("paid"))
              .write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}"))
        paid = spark.read.parquet(f"{base}/out/batch={batch_id}")
        top = kept.read("top", before=batch_id)
        new = changes.apply_delta(top, paid.withColumnRenamed("paid", "__paid"), ["c_id"], {
            "c_balance": (F.col("c_balance") - F.coalesce(F.col("__paid"), F.lit(0))).cast("decimal(12,2)")})
        risen = paid.where("paid < 0").join(top, "c_id", "left_anti").select("c_id")
        if risen.limit(1).count():
            found = now(rows.join(risen, "c_id", "left_semi")).withColumn("floor", F.lit(None).cast("decimal(12,2)"))
            new = _best(new.unionByName(found), spare * k, F.col("floor"))
        new = cut_lineage(new, "top-balances")
        dry = (new.groupBy("c_w_id").agg(F.max("floor").alias("floor"), F.count_if(F.col("c_balance") > F.col("floor")).alias("above"))
               .where((F.col("floor").isNotNull()) & (F.col("above") < k)).select("c_w_id"))
        if dry.limit(1).count():
            again = _best(now(rows.join(dry, "c_w_id", "left_semi")), spare * k)
            new = new.join(dry, "c_w_id", "left_anti").unionByName(again)
        kept.write("top", new, batch_id)

    _run(events_stream(spark, sf_dir, files_per_batch).filter(F.col("event_type") == "purchase"), base, sink)
    return top_balance(kept.read("top"), districts, warehouses, k)


ORDERS_SCHEMA = ("seq BIGINT, w_id INT, d_id INT, c_id BIGINT, entry_d TIMESTAMP_NTZ, "
                 "lines ARRAY<STRUCT<line_no: INT, i_id: BIGINT, supply_w_id: INT, quantity: INT>>")


def stream_new_orders(spark: SparkSession, feed: str, districts: DataFrame, items: DataFrame, stocks: DataFrame, location: str | None = None,
                      files_per_batch: int | None = None) -> tuple[DataFrame, DataFrame]:
    """New orders as they arrive (R1, W3, W4): (the numbered orders, the touched stocks).

    Each row of ``feed`` (parquet files) is a request with its lines. Two tables are kept from batch to batch: the next
    order number of each district and the quantity of each stock that was touched. A batch is
    numbered and its stocks are folded by the operators of the batch job, which split
    busy districts and items over tasks; a keyed state would hold each in one task. A batch
    starts from the version before it, so a replay gives the same.
    """
    base = _place(spark, "new-orders", location)
    kept = Versions(spark, base)
    if not kept.numbers("districts"):
        kept.write("districts", districts.select("d_w_id", "d_id", "d_next_o_id"), -1)
        kept.write("stocks", spark.createDataFrame([], "s_w_id INT, s_i_id LONG, s_quantity INT"), -1)

    def sink(batch: DataFrame, batch_id: int) -> None:
        lines = batch.select("seq", F.inline("lines"))
        requests = batch.drop("lines")
        before, changed = kept.read("districts", before=batch_id), kept.read("stocks", before=batch_id)
        current = stocks.select("s_w_id", "s_i_id", F.col("s_quantity").alias("__first")).join(changed, ["s_w_id", "s_i_id"], "left").select(
            "s_w_id", "s_i_id", F.coalesce("s_quantity", "__first").alias("s_quantity"))
        checked = cut_lineage(changes.new_order_checked_lines(lines, requests, items, current), "new-order-checked")
        (changes.new_order_headers(requests, lines, before, items, current, checked=checked)
         .write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}"))
        new = changes.stock_changes(checked).select("s_w_id", "s_i_id", F.col("quantity").alias("s_quantity"))
        kept.write("stocks", changed.join(new, ["s_w_id", "s_i_id"], "left_anti").unionByName(new), batch_id)
        kept.write("districts", changes.new_order_districts(before, requests), batch_id)

    r = spark.readStream.schema(ORDERS_SCHEMA)
    _run((r.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else r).parquet(feed), base, sink)
    numbered = _written(spark, f"{base}/out", "seq LONG, o_w_id INT, o_d_id INT, o_id INT, o_c_id LONG, o_carrier_id INT, o_ol_cnt INT, o_all_local INT, "
                                              "o_entry_d TIMESTAMP_NTZ, total_quantity LONG").drop("batch")
    return numbered, kept.read("stocks")
