"""Skew-safe building blocks.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; if
one key holds a third of the rows, that task sorts a third of the data. The
helpers here split each group into ranges of its numeric ordering key, so a
hot group is spread over many tasks, and only the small per-range totals are
combined per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import cut_lineage

# Default width of one range of the ordering key. A group contributes one
# small total row per range, and each range is sorted by one task.
DEFAULT_RANGE_WIDTH = 1 << 16


#: Rows that a task makes of its share when few rows become many.
ROWS_A_TASK = 200_000


def dealt(df: DataFrame, keys: Sequence[str], times: int) -> DataFrame:
    """The rows dealt by ``keys`` to as many tasks as ``times`` as many rows need (counted first), for a step that makes
    that many of each: tasks follow the rows that come out, not the files that were read."""
    return df.repartition(max(1, -(-df.count() * times // ROWS_A_TASK)), *keys)


#: Ranges whose totals are summed up by one task at a time.
RANGES_TOGETHER = 1 << 16


def sums_before(totals: DataFrame, keys: Sequence[str], rng: str, sums: dict[str, str]) -> DataFrame:
    """``keys``, ``rng`` and, for each column of ``sums``, its sum over the ranges before this one of the same keys.

    The ranges of a key are summed up in stretches of RANGES_TOGETHER numbers, the
    stretches' totals then by a window of their own: a key whose ordering values are far apart may have a range for
    each of its rows, and still no window holds more than a stretch.
    """
    stretch = F.floor(F.col(rng) / F.lit(RANGES_TOGETHER)).cast("long")
    t = totals.withColumn("__stretch", stretch)
    inside = W.partitionBy(*keys, "__stretch").orderBy(rng).rowsBetween(W.unboundedPreceding, -1)
    before = W.partitionBy(*keys).orderBy("__stretch").rowsBetween(W.unboundedPreceding, -1)
    near = t.select(*keys, rng, "__stretch", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"__near_{o}") for c, o in sums.items()])
    far = t.groupBy(*keys, "__stretch").agg(*[F.sum(c).alias(c) for c in sums]).select(
        *keys, "__stretch", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__far_{o}") for c, o in sums.items()])
    return near.join(far, [*keys, "__stretch"]).select(*keys, rng, *[(F.col(f"__near_{o}") + F.col(f"__far_{o}")).alias(o) for o in sums.values()])


def running_totals(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                   values: dict, range_col: str | None = None,
                   width: int = DEFAULT_RANGE_WIDTH, inclusive: bool = True) -> DataFrame:
    """Add running sums per group in the order of ``order_cols``.

    ``values`` maps an output column name to a numeric column expression; the
    output is its running sum over rows of the same ``keys`` ordered by
    ``order_cols`` (rows up to and including the current one, or strictly
    before it when ``inclusive`` is False). ``range_col`` (default: the first
    order column) must be a non-negative integer that is non-decreasing in
    that order.

    Plan: rows are cut into ranges ``floor(range_col / width)``; (1) a grouped
    aggregate gives one total per (group, range) with partial aggregation
    before the shuffle; (2) windows over those totals give each range's
    offset (``sums_before``); (3) a window per (group, range) gives the local running sum; the
    offset is joined back on (group, range). No step holds a whole group.
    """
    keys = list(keys)
    order_cols = list(order_cols)
    rc = range_col or order_cols[0]
    names = list(values)
    tmp = {n: f"__v_{i}" for i, n in enumerate(names)}
    rng = "__range"
    d = df.withColumn(rng, F.floor(F.col(rc) / F.lit(width)).cast("long"))
    for n in names:
        d = d.withColumn(tmp[n], values[n])

    totals = d.groupBy(*keys, rng).agg(*[F.sum(tmp[n]).alias(f"__t_{tmp[n]}") for n in names])
    offsets = sums_before(totals, keys, rng, {f"__t_{tmp[n]}": f"__o_{tmp[n]}" for n in names})

    frame = (W.unboundedPreceding, 0) if inclusive else (W.unboundedPreceding, -1)
    wl = W.partitionBy(*keys, rng).orderBy(*order_cols).rowsBetween(*frame)
    local = d.select(
        *df.columns, rng,
        *[F.coalesce(F.sum(tmp[n]).over(wl), F.lit(0)).alias(f"__l_{tmp[n]}") for n in names])
    j = local.join(offsets, on=[*keys, rng], how="inner")
    return j.select(*df.columns,
                    *[(F.col(f"__o_{tmp[n]}") + F.col(f"__l_{tmp[n]}")).alias(n) for n in names])


def sequence_numbers(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                     out: str = "rn", range_col: str | None = None,
                     width: int = DEFAULT_RANGE_WIDTH) -> DataFrame:
    """``row_number()`` per group without sending a group to one task."""
    r = running_totals(df, keys, order_cols, {out: F.lit(1).cast("long")},
                       range_col=range_col, width=width)
    return r.withColumn(out, F.col(out).cast("long"))


def running_lows(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value, range_col: str | None = None,
                 width: int = DEFAULT_RANGE_WIDTH) -> DataFrame:
    """Add ``run`` (the running sum of ``value`` up to and including the row), ``low`` (the least
    running sum so far, 0 before the first row counted in) and ``low_before`` (the same without the row).

    Sums and their least values go together over ranges: a range that starts at a sum of s has its
    least value at s plus its own. So each (key, range) is scanned by itself, its
    total and least value are carried on by a window over the ranges, and no step holds a
    whole group. ``range_col`` as in ``running_totals``.
    """
    keys, order_cols = list(keys), list(order_cols)
    rng = "__range"
    d = df.withColumns({rng: F.floor(F.col(range_col or order_cols[0]) / F.lit(width)).cast("long"), "__v": value})
    here = W.partitionBy(*keys, rng).orderBy(*order_cols)
    upto, before = here.rowsBetween(W.unboundedPreceding, 0), here.rowsBetween(W.unboundedPreceding, -1)
    local = d.withColumn("__l", F.sum("__v").over(upto))
    local = local.withColumns({"__low": F.min("__l").over(upto), "__low_before": F.min("__l").over(before)})
    earlier = W.partitionBy(*keys).orderBy(rng).rowsBetween(W.unboundedPreceding, -1)
    ranges = local.groupBy(*keys, rng).agg(F.sum("__v").alias("__t"), F.min("__l").alias("__least"))
    ranges = ranges.withColumn("__start", F.coalesce(F.sum("__t").over(earlier), F.lit(0)))
    ranges = ranges.select(*keys, rng, "__start", F.least(F.lit(0), F.min(F.col("__start") + F.col("__least")).over(earlier)).alias("__carried"))
    low = lambda c: F.least("__carried", F.col("__start") + F.col(c))  # noqa: E731 (least ignores NULL)
    return local.join(ranges, [*keys, rng]).select(*df.columns, (F.col("__start") + F.col("__l")).alias("run"), low("__low").alias("low"),
                                                   low("__low_before").alias("low_before"))


#: Ranges that an interval is cut into at least (and twice as many at most).
INTERVAL_PARTS = 64


def interval_join(rows: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, low: str, high: str) -> DataFrame:
    """Rows with ``keys`` alike and ``at`` between ``low`` and ``high`` (whole numbers, not below 0), each with its interval.

    An interval of any length is cut into at most 2 * INTERVAL_PARTS + 1 ranges of 2^level numbers,
    with the least level that allows it; a row has its range's number on each level
    in use. The join is on (keys, level, range), and what lies beyond the ends drops out.
    So a request costs the same whether it asks for a hundred orders or a million, and a
    range holds 1/64 of an interval at most. Columns other than the keys must differ.
    """
    keys = list(keys)
    length = F.col(high) - F.col(low) + 1
    level = F.greatest(F.lit(0), F.ceil(F.log2(length / F.lit(INTERVAL_PARTS)))).cast("int")
    cut = intervals.where(F.col(low) <= F.col(high)).withColumn("__level", level)
    first, last = F.expr(f"shiftright(CAST({low} AS BIGINT), __level)"), F.expr(f"shiftright(CAST({high} AS BIGINT), __level)")
    asked = cut.withColumn("__range", F.explode(F.sequence(first, last)))
    levels = cut.select(F.sort_array(F.collect_set("__level"))).scalar()  # 58 levels at most
    placed = rows.withColumn("__level", F.explode(levels)).withColumn("__range", F.expr(f"shiftright(CAST({at} AS BIGINT), __level)"))
    met = asked.join(placed, [*keys, "__level", "__range"]).where(F.col(at).between(F.col(low), F.col(high)))
    return met.drop("__level", "__range")


#: Keys with more than one cell that are broadcast; counted first, beyond it they are joined by a shuffle.
FEW_KEYS = 100_000


def grid_join(left: DataFrame, right: DataFrame, keys: Sequence[str], cell_rows: int = 1_000) -> DataFrame:
    """Inner equi-join whose work per task is bounded by its output.

    For each key the rows of both sides are counted; with m and n rows the key
    gets a grid of ceil(m / cell_rows) rows and ceil(n / cell_rows) columns. A
    left row falls into one grid row by its hash and is copied to all columns, a
    right row the other way round, and the join is on (keys, grid row, column).
    Every matching pair meets in exactly one cell, so the result is the plain
    join's; a key with millions of rows on both sides is spread over its output.
    Keys of one cell, the usual case, are not copied. Only the others are
    looked up, in a broadcast table as long as they are few: so a hot key's rows
    are dealt where they are, before any shuffle. Both sides are read twice and should be
    stored. Columns other than the keys must differ between the sides.
    """
    keys = list(keys)
    count = lambda df, name: df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(cell_rows)).cast("int").alias(name))
    grid = cut_lineage(count(left, "__rows").join(count(right, "__cols"), keys, "inner").where("__rows > 1 or __cols > 1"), "join-grid")
    n = grid.count()
    if not n:
        return left.join(right, keys, "inner")
    grid = F.broadcast(grid) if n <= FEW_KEYS else grid

    def deal(df: DataFrame, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        g = df.join(grid, keys, "left")
        cells = lambda c: F.coalesce(F.col(c), F.lit(1))
        place = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), cells(own_n)).cast("int")
        return (g.withColumn(own, place).withColumn(other, F.explode(F.sequence(F.lit(0), cells(other_n) - 1)))
                .drop("__rows", "__cols"))

    a = deal(left, "__r", "__rows", "__c", "__cols")
    b = deal(right, "__c", "__cols", "__r", "__rows")
    return a.join(b, [*keys, "__r", "__c"], "inner").drop("__r", "__c")
