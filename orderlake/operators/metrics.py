"""Client latency and throughput statistics.

Per-client quantiles are computed from a value histogram: rows are first
combined to (client, latency, count) inside each task, so a client with a
third of all transactions ships one row per distinct latency, not one per
transaction. Cumulative counts over the histogram are range-split on the
latency, and a quantile is read as "the least latency whose cumulative
count reaches rank r" by a grouped aggregate: no task holds all values of
a client.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .skew import running_totals


#: Rows of the histogram that a range of latencies holds, about.
RANGE_ROWS = 20_000


def _r4(c):
    return F.round(c, 4).cast("decimal(18,4)")


def nanos(c):
    """A latency in ms as an integer number of its millionths (nanoseconds)."""
    return F.round(F.col(c) * F.lit(1000000)).cast("long")


def mean_e4(total: str, n: str, scale: int = 6):
    """Mean of values whose exact sum is ``total`` / 10**scale, rounded half
    up to four decimals with integer arithmetic only (``div``), so the result
    does not depend on the order of a floating-point sum."""
    f = 10 ** (scale - 4)
    q = F.expr(f"(CAST({total} AS DECIMAL(38,0)) * 2 + {n} * {f}) div ({n} * {2 * f})")
    return F.when(F.col(n) > 0, (q.cast("decimal(20,0)") * F.lit(0.0001).cast("decimal(4,4)"))
                  ).cast("decimal(18,4)")


def latency_histogram(events: DataFrame) -> DataFrame:
    return events.groupBy("client", "latency_ms").agg(F.count(F.lit(1)).alias("freq"),
                                                      F.sum(nanos("latency_ms")).alias("nanos"))


def cumulative_histogram(events: DataFrame) -> DataFrame:
    """(client, latency_ms, freq, nanos, cum): cumulative count per client in
    latency order. Split into ranges at quantiles of the histogram's latencies, as many as its
    rows ask for, so a busy client is spread over many tasks whatever its values are and however many."""
    h = cut_lineage(latency_histogram(events), "latency-histogram")
    ranges = -(-h.count() // RANGE_ROWS)
    cuts = sorted(set(h.approxQuantile("latency_ms", [k / ranges for k in range(1, ranges)], 0.25 / ranges))) if ranges > 1 else []
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("latency_ms"))) if cuts else F.lit(0)
    h = h.withColumn("__c", above)
    return running_totals(h, ["client"], ["latency_ms"], {"cum": F.col("freq")}, range_col="__c", width=1)


def _value_at(rank_col: str):
    """x_r, the r-th smallest value: the least latency whose cumulative
    count reaches r (aggregate over the cumulative histogram)."""
    return F.min(F.when(F.col("cum") >= F.col(rank_col), F.col("latency_ms")))


def client_latency_stats(events: DataFrame) -> DataFrame:
    """Count, mean, median and linear p50/p95/p99 per client.

    Linear interpolation between closest ranks: for p (in percent) the
    position is h = (n - 1) * p / 100, with lo = floor(h) and
    frac = h - lo computed in integers; the value is
    x_(lo+1) + frac * (x_(lo+2) - x_(lo+1)). Ranks are read from the
    cumulative histogram, so no task holds a client's values.
    """
    cum = cumulative_histogram(events)
    tot = cum.groupBy("client").agg(F.sum("freq").alias("n"), F.sum("nanos").alias("s"))
    cols = []
    for p in (50, 95, 99):
        h100 = (F.col("n") - 1) * F.lit(p)
        lo = F.floor(h100 / F.lit(100)).cast("long")
        cols += [(lo + 1).alias(f"a{p}"), F.least(lo + 2, F.col("n")).alias(f"b{p}"),
                 (h100 - lo * 100).alias(f"f{p}")]
    ranks = tot.select("client", "n", "s", *cols)
    j = cum.join(ranks, "client", "inner")
    keys = ["client", "n", "s"] + [f"f{p}" for p in (50, 95, 99)]
    g = j.groupBy(*keys).agg(*[_value_at(f"{x}{p}").alias(f"x{x}{p}") for p in (50, 95, 99) for x in "ab"])

    def lin(p):
        a, b = F.col(f"xa{p}"), F.col(f"xb{p}")
        return _r4(a + (b - a) * F.col(f"f{p}") / F.lit(100))

    return g.select("client", F.col("n").cast("long").alias("n_txn"), mean_e4("s", "n").alias("mean_ms"),
                    lin(50).alias("median_ms"), lin(95).alias("p95_ms"), lin(99).alias("p99_ms"))


def _exclusive_ranks(n, i):
    """Rank j (clamped to 1..n-1) and weight delta of the exclusive method for
    the i-th of 100 quantiles over n sorted values."""
    m = n + F.lit(1)
    j = F.floor(F.lit(i) * m / F.lit(100)).cast("long")
    j = F.least(F.greatest(j, F.lit(1)), n - 1)
    delta = F.lit(i) * m - j * F.lit(100)
    return j, delta


def client_latency_stats_exclusive(events: DataFrame) -> DataFrame:
    """Mean, median and exclusive-method p95/p99 per client.

    p_i = (x_j * (100 - delta) + x_(j+1) * delta) / 100 with
    j = floor(i * (n + 1) / 100) clamped to [1, n - 1] and
    delta = i * (n + 1) - 100 * j; x_r is the r-th smallest value. x_r is read
    from the cumulative histogram as the least value whose cumulative count
    reaches r. Needs n >= 2; clients with fewer values get NULL quantiles.
    """
    cum = cumulative_histogram(events)
    tot = cum.groupBy("client").agg(F.sum("freq").alias("n"),
                                  F.sum("nanos").alias("s"))
    j95, d95 = _exclusive_ranks(F.col("n"), 95)
    j99, d99 = _exclusive_ranks(F.col("n"), 99)
    ranks = tot.select("client", "n", "s",
                       ((F.col("n") + 1) / 2).cast("long").alias("ma"),
                       (F.col("n") / 2).cast("long").alias("__half"),
                       j95.alias("j95"), d95.alias("d95"), j99.alias("j99"), d99.alias("d99"))
    ranks = ranks.withColumn("mb", F.col("__half") + 1).drop("__half")

    at = _value_at

    j = cum.join(ranks, "client", "inner")
    g = j.groupBy("client", "n", "s", "d95", "d99").agg(
        at("ma").alias("xa"),
        F.min(F.when(F.col("cum") >= F.col("mb"), F.col("latency_ms"))).alias("xb"),
        at("j95").alias("x95a"),
        F.min(F.when(F.col("cum") >= F.col("j95") + 1, F.col("latency_ms"))).alias("x95b"),
        at("j99").alias("x99a"),
        F.min(F.when(F.col("cum") >= F.col("j99") + 1, F.col("latency_ms"))).alias("x99b"))
    ok = F.col("n") >= 2

    def interp(a, b, d):
        return F.when(ok, (F.col(a) * (F.lit(100) - F.col(d)) + F.col(b) * F.col(d)) / F.lit(100))

    # statistics.median: the middle value, or the mean of the two middle ones.
    return g.select("client", F.col("n").cast("long").alias("n_txn"),
                    mean_e4("s", "n").alias("mean_ms"),
                    _r4((F.col("xa") + F.col("xb")) / 2).alias("median_ms"),
                    _r4(interp("x95a", "x95b", "d95")).alias("p95_ms"),
                    _r4(interp("x99a", "x99b", "d99")).alias("p99_ms"))


def client_throughput(events: DataFrame) -> DataFrame:
    """Per client: transactions, wall-clock elapsed time, summed latency,
    throughput by each, mean latency (A14, V12)."""
    g = events.groupBy("client").agg(
        F.count(F.lit(1)).alias("n_txn"),
        F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")).alias("elapsed_us"),
        F.sum(nanos("latency_ms")).alias("nanos"))
    # Exact decimals: elapsed in microseconds -> seconds (6 places), summed
    # latency in nanoseconds -> seconds (9 places).
    elapsed = (F.col("elapsed_us").cast("decimal(20,0)") * F.lit(0.000001).cast("decimal(6,6)")).cast("decimal(20,6)")
    lat = (F.col("nanos").cast("decimal(20,0)") * F.lit(0.000000001).cast("decimal(9,9)")).cast("decimal(29,9)")
    return g.select("client", "n_txn", elapsed.alias("elapsed_s"), lat.alias("latency_s"),
                    _r4(F.try_divide(F.col("n_txn"), elapsed.cast("double"))).alias("txn_per_s"),
                    _r4(F.try_divide(F.col("n_txn"), lat.cast("double"))).alias("txn_per_latency_s"),
                    mean_e4("nanos", "n_txn").alias("mean_ms"))


def throughput_summary(per_client: DataFrame) -> DataFrame:
    """Min / max / mean client throughput."""
    return per_client.agg(
        F.count(F.lit(1)).alias("n_clients"),
        F.min("txn_per_s").cast("decimal(18,4)").alias("min_txn_per_s"),
        F.max("txn_per_s").cast("decimal(18,4)").alias("max_txn_per_s"),
        F.sum((F.col("txn_per_s") * F.lit(10000)).cast("long")).alias("__s4"),
    ).select("n_clients", "min_txn_per_s", "max_txn_per_s",
             mean_e4("__s4", "n_clients", scale=4).alias("avg_txn_per_s"))
