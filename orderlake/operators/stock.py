"""Stock quantities after each order line, for lines of any quantity.

The rule for one line of quantity x is ``q -= x; if q < FLOOR: q += REFILL``,
once: a quantity above the refill leaves the stock below the floor, or negative. The
result of a run of lines on a stock q is q - (sum of x) + REFILL * k(q), where k, the number
of refills, falls as q grows. So a run is a step function of the stock it starts
from, and runs compose: lines into ranges, ranges into blocks, blocks into the whole key. The
stock at the start of each block, range and line follows downwards again. No
step holds more than ``WIDTH`` entries of one key, but the last, which holds one for each block
(``WIDTH`` squared order places).

Where stocks start at the floor or above and quantities lie between 0 and the
refill, ``functions.scalar.refilled_stock`` gives the same from a plain sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import STOCK_FLOOR, STOCK_REFILL

#: Places of the ordering key in a range, and ranges in a block.
WIDTH = 1024

#: used: sum of quantities; steps: from a stock of ``start`` on (up to the next step's) there are ``refills``.
RUN_TYPE = "struct<used: bigint, steps: array<struct<start: bigint, refills: bigint>>>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _line_run(x: Column) -> Column:
    """The run of one line: one refill below FLOOR + x, none from there on."""
    step = lambda start, refills: F.struct(start.cast("bigint").alias("start"), F.lit(refills).cast("bigint").alias("refills"))
    return F.struct(x.cast("bigint").alias("used"), F.array(step(F.lit(-(1 << 62)), 1), step(x + STOCK_FLOOR, 0)).alias("steps")).cast(RUN_TYPE)


def _nothing(lowest: Column) -> Column:
    """The run of no line, for stocks from ``lowest`` on."""
    step = F.struct(lowest.cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("refills"))
    return F.struct(F.lit(0).cast("bigint").alias("used"), F.array(step).alias("steps")).cast(RUN_TYPE)


def _after(first: Column, second: Column, highest: Column) -> Column:
    """``first``, then ``second``, for stocks up to ``highest``. Each step of the first covers a stretch of
    stocks; the second's steps cut it where the stock that the first leaves reaches their starts."""
    steps = first["steps"]

    def cut(p: Column, i: Column) -> Column:
        shift = first["used"] - STOCK_REFILL * p["refills"]  # a stock q leaves the first as q - shift
        end = F.coalesce(F.get(steps, i + 1)["start"], highest + 1)
        parts = F.transform(second["steps"], lambda s, j: F.struct(
            F.when(j == 0, p["start"]).otherwise(F.greatest(p["start"], s["start"] + shift)).alias("start"),
            F.least(end, F.coalesce(F.get(second["steps"], j + 1)["start"] + shift, end)).alias("end"),
            (p["refills"] + s["refills"]).alias("refills")))
        return F.filter(parts, lambda s: s["start"] < s["end"])

    def merged(all_parts: Column) -> Column:
        kept = F.filter(all_parts, lambda s, i: (i == 0) | (F.get(all_parts, i - 1)["refills"] != s["refills"]))
        return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["refills"].alias("refills")))

    return F.struct((first["used"] + second["used"]).alias("used"), _let(F.flatten(F.transform(steps, cut)), merged).alias("steps")).cast(RUN_TYPE)


def _apply(run: Column, q: Column) -> Column:
    """The stock that ``run`` leaves of ``q``."""
    refills = F.element_at(F.filter(run["steps"], lambda s, i: (i == 0) | (s["start"] <= q)), -1)["refills"]
    return q - run["used"] + STOCK_REFILL * refills


def _composed(runs: Column, lowest: Column, highest: Column) -> Column:
    return F.aggregate(runs, _nothing(lowest), lambda acc, r: _after(acc, r, highest))


def _starts(runs: Column, q: Column) -> Column:
    """The stock before each of ``runs`` (and after the last), in order."""
    return F.aggregate(runs, F.array(q.cast("bigint")).cast("array<bigint>"),
                       lambda acc, r: F.concat(acc, F.array(_apply(r, F.element_at(acc, -1)))).cast("array<bigint>"))


def _blocks(lines: DataFrame, keys: list[str], order_cols: list[str], quantity: str, start: str, width: int):
    """Ranges and blocks of lines with their runs (the up-sweep)."""
    place = F.struct(*order_cols, F.col(quantity).cast("bigint").alias("x"))
    r0 = F.floor(F.col(order_cols[0]) / F.lit(width)).cast("bigint")
    ranges = (lines.withColumns({"__r0": r0, "__r1": F.floor(r0 / F.lit(width)).cast("bigint")}).groupBy(*keys, "__r1", "__r0")
              .agg(F.array_sort(F.collect_list(place)).alias("__lines"), F.min(F.col(start).cast("bigint")).alias("__q0"),
                   F.sum(F.greatest(F.lit(0), -F.col(quantity))).alias("__returned")))
    # The lowest stock that can occur before each range: w -> least(FLOOR, w + REFILL - x), whose value is a running sum less its highest value.
    rise = F.aggregate("__lines", F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(None).cast("bigint").alias("top")),
                       lambda a, line: F.struct((a["sum"] + STOCK_REFILL - line["x"]).alias("sum"),
                                                F.greatest(a["top"], a["sum"] + STOCK_REFILL - line["x"]).alias("top")))
    earlier = W.partitionBy(*keys).orderBy("__r0").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.withColumn("__rise", rise).withColumn("__sum", F.coalesce(F.sum("__rise.sum").over(earlier), F.lit(0)))
    ranges = ranges.withColumn("__top", F.max(F.col("__sum") + F.col("__rise.top")).over(earlier))
    floor = F.lit(STOCK_FLOOR).cast("bigint")
    ranges = ranges.withColumns({
        "__lowest": F.least(F.least(floor, "__q0") + F.col("__sum"), floor + F.col("__sum") - F.col("__top")),
        "__highest": F.greatest("__q0", F.lit(STOCK_FLOOR + STOCK_REFILL - 1)) + F.sum("__returned").over(W.partitionBy(*keys))})
    line_runs = F.transform("__lines", lambda line: _line_run(line["x"]))
    ranges = ranges.withColumn("__run", _composed(line_runs, F.col("__lowest"), F.col("__highest"))).drop("__rise", "__sum", "__top", "__returned")
    blocks = (ranges.groupBy(*keys, "__r1").agg(
        F.array_sort(F.collect_list(F.struct("__r0", "__run"))).alias("__ranges"), F.min_by("__lowest", "__r0").alias("__lowest"),
        F.max("__highest").alias("__highest"), F.min("__q0").alias("__q0")))
    runs = F.transform("__ranges", lambda r: r["__run"])
    blocks = blocks.withColumn("__run", _composed(runs, F.col("__lowest"), F.col("__highest")))
    whole = blocks.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__r1", "__run"))).alias("__blocks"), F.min("__q0").alias("__q0"))
    return ranges, blocks, whole


def final_stock(lines: DataFrame, keys: Sequence[str], order_cols: Sequence[str], quantity: str = "quantity", start: str = "q0",
                out: str = "s_quantity", width: int = WIDTH) -> DataFrame:
    """(keys, ``out``): the stock after all lines of each key. ``start`` holds the key's stock before them, the same in all its lines."""
    _, _, whole = _blocks(lines, list(keys), list(order_cols), quantity, start, width)
    runs = F.transform("__blocks", lambda b: b["__run"])
    last = F.aggregate(runs, F.col("__q0"), lambda q, r: _apply(r, q))
    return whole.select(*keys, last.cast("int").alias(out))


def stock_trace(lines: DataFrame, keys: Sequence[str], order_cols: Sequence[str], quantity: str = "quantity", start: str = "q0",
                out: str = "s_quantity_after", width: int = WIDTH) -> DataFrame:
    """(keys, order columns, quantity, ``out``): the stock after each line, in the order of ``order_cols``.
    The first of these must be a whole number, not below 0."""
    keys, order_cols = list(keys), list(order_cols)
    ranges, blocks, whole = _blocks(lines, keys, order_cols, quantity, start, width)

    def down(df: DataFrame, entries: str, number: str) -> DataFrame:
        starts = _starts(F.transform(entries, lambda e: e["__run"]), F.col("__q"))
        at = F.explode(F.arrays_zip(F.transform(entries, lambda e: e[number]).alias("n"), F.slice(starts, 1, F.size(entries)).alias("q"))).alias("e")
        return df.select(*keys, at).select(*keys, F.col("e.n").alias(number), F.col("e.q").alias("__q"))

    per_block = down(whole.withColumn("__q", F.col("__q0")), "__blocks", "__r1")
    per_range = down(blocks.drop("__q0").join(per_block, [*keys, "__r1"]), "__ranges", "__r0")
    joined = ranges.join(per_range, [*keys, "__r0"])
    after = _starts(F.transform("__lines", lambda line: _line_run(line["x"])), F.col("__q"))
    at = F.explode(F.arrays_zip(F.col("__lines").alias("line"), F.slice(after, 2, F.size("__lines")).alias("q"))).alias("e")
    return joined.select(*keys, at).select(*keys, *[F.col(f"e.line.{c}").alias(c) for c in order_cols], F.col("e.line.x").cast("int").alias(quantity),
                                           F.col("e.q").cast("int").alias(out))
