"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stock refill rule of New-Order (a stock that would fall below
# the floor is topped up by the refill amount).
STOCK_FLOOR = 10
STOCK_REFILL = 100


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c, precision: int = 18) -> Column:
    """Round half-even to cents and fix the decimal type."""
    return F.bround(col(c), 2).cast(f"decimal({precision},2)")


def full_name(first, middle, last) -> Column:
    return F.concat_ws(" ", col(first), col(middle), col(last))


def address_line(prefix: str) -> Column:
    return F.concat_ws(", ", *[F.col(f"{prefix}_{p}") for p in
                               ("street_1", "street_2", "city", "state", "zip")])


def name_struct(prefix: str = "c") -> Column:
    return F.struct(F.col(f"{prefix}_first").alias("first"),
                    F.col(f"{prefix}_middle").alias("middle"),
                    F.col(f"{prefix}_last").alias("last"))


def address_struct(prefix: str) -> Column:
    return F.struct(*[F.col(f"{prefix}_{p}").alias(p) for p in
                      ("street_1", "street_2", "city", "state", "zip")])


def refilled_stock(q0, consumed) -> Column:
    """Closed form of the sequential stock fold.

    Applying ``q -= x; if q < FLOOR: q += REFILL`` for a sequence whose
    quantities sum to ``consumed`` leaves ``q0 - consumed + REFILL * k`` where
    k is the least number of refills that keeps the stock at or above the
    floor (valid for q0 >= FLOOR and 0 <= x <= REFILL).
    """
    v = col(q0) - col(consumed)
    need = F.lit(STOCK_FLOOR) - v
    k = F.when(need > 0, F.floor((need + F.lit(STOCK_REFILL - 1)) / F.lit(STOCK_REFILL))).otherwise(F.lit(0))
    return (v + F.lit(STOCK_REFILL) * k).cast("int")


def epoch_ms_between(start, end) -> Column:
    """Whole milliseconds from ``start`` to ``end`` (time-zone independent)."""
    return F.timestamp_diff("MILLISECOND", col(start), col(end)).cast("long")
