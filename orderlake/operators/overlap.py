"""Related customers by heavy and light items (J7, J16, J19, U3, T-R).

Two orders are related if they share two items. How often an item is bought decides how it is met:

* the ``HEAVY`` most frequent items, where they are in more than ``LIGHT_MOST`` orders, are bits of a mask. Orders with the same
  heavy items have the same mask; distinct masks are compared by AND and popcount, the asked ones in
  blocks against all. Pairs of heavy items are never listed, however many
  customers bought both;
* all other items have posting lists. Orders that share one are met through it; the light items that they
  share are counted there, the heavy ones by their masks.

Both ways end in joins whose cells are bounded by their output (``skew.grid_join``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import derived
from .skew import grid_join

#: Bits of a mask, in two words of 64.
HEAVY = 128
#: An item in at most so many orders is light, however few items there are.
LIGHT_MOST = 1_000
#: Asked masks that are compared at a time.
MASK_BLOCK = 1_024

ORDER = ["w_id", "d_id", "c_id", "o_id"]
CUSTOMER = ["w_id", "d_id", "c_id"]


def heavy_items(order_items: DataFrame, light_most: int = LIGHT_MOST) -> DataFrame:
    """(i_id, bit): at most HEAVY rows."""
    frequent = (order_items.groupBy("i_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > light_most)
                .orderBy(F.desc("n"), "i_id").limit(HEAVY))
    rows = frequent.agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "i_id"))).alias("x"))  # HEAVY rows
    return rows.select(F.posexplode("x").alias("bit", "r")).select("r.i_id", "bit")


def with_masks(order_items: DataFrame, heavy: DataFrame) -> DataFrame:
    """(w_id, d_id, c_id, o_id, low, high, light): a row an order: the mask of its heavy items and the array of its light ones."""
    j = order_items.join(F.broadcast(heavy), "i_id", "left")  # at most HEAVY rows
    word = lambda least: F.coalesce(F.bit_or(F.when(F.col("bit").between(least, least + 63), F.expr(f"shiftleft(1L, CAST(bit - {least} AS INT))"))), F.lit(0).cast("long"))
    return j.groupBy(*ORDER).agg(word(0).alias("low"), word(64).alias("high"), F.collect_list(F.when(F.col("bit").isNull(), F.col("i_id"))).alias("light"))


def _shared(a: str, b: str):
    return F.bit_count(F.col(f"{a}low").bitwiseAND(F.col(f"{b}low"))) + F.bit_count(F.col(f"{a}high").bitwiseAND(F.col(f"{b}high")))


def _by_masks(asked: DataFrame, everyone: DataFrame) -> DataFrame:
    """Customers with orders that share two heavy items."""
    several = F.bit_count("low") + F.bit_count("high") >= 2
    mine = cut_lineage(asked.where(several).select(*CUSTOMER, "low", "high").distinct(), "asked-masks")
    theirs = cut_lineage(everyone.where(several).select(*[F.col(c).alias(f"r_{c}") for c in CUSTOMER], F.col("low").alias("r_low"), F.col("high").alias("r_high")).distinct(),
                         "all-masks")
    masks = cut_lineage(mine.select("low", "high").distinct().withColumn("block", F.monotonically_increasing_id()), "masks")
    n = masks.count()
    blocks = -(-n // MASK_BLOCK)
    every = cut_lineage(theirs.select("r_low", "r_high").distinct(), "masks")
    pairs = None
    for b in range(blocks):
        own = masks.where(F.pmod(F.xxhash64("block"), F.lit(blocks)) == b).select(F.collect_list(F.struct("low", "high"))).scalar()  # about MASK_BLOCK masks
        met = every.select("r_low", "r_high", F.inline(own)).where(_shared("", "r_") >= 2)
        pairs = met if pairs is None else pairs.unionByName(met)
    if pairs is None:
        pairs = every.select("r_low", "r_high", F.col("r_low").alias("low"), F.col("r_high").alias("high")).limit(0)
    met = cut_lineage(pairs.join(mine, ["low", "high"]).select(*CUSTOMER, "r_low", "r_high"), "mask-matches")
    return grid_join(met, theirs, ["r_low", "r_high"]).select(*CUSTOMER, *[f"r_{c}" for c in CUSTOMER])


def _by_postings(asked: DataFrame, everyone: DataFrame) -> DataFrame:
    """Customers with orders that share a light item and one more of either kind."""
    mine = cut_lineage(asked.select(*ORDER, "low", "high", F.explode("light").alias("i_id")), "asked-postings")
    theirs = everyone.select(*[F.col(c).alias(f"r_{c}") for c in [*ORDER, "low", "high"]], F.explode("light").alias("i_id"))
    theirs = cut_lineage(theirs.join(mine.select("i_id").distinct(), "i_id", "left_semi"), "postings")
    keys = [*ORDER, *[f"r_{c}" for c in ORDER]]
    met = grid_join(mine, theirs, ["i_id"]).where(F.col("w_id") != F.col("r_w_id")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("light"), F.first(_shared("", "r_")).alias("heavy"))
    return met.where("light + heavy >= 2").select(*CUSTOMER, *[f"r_{c}" for c in CUSTOMER])


def related_customers(orders: DataFrame, order_lines: DataFrame, requests: DataFrame | None = None, light_most: int = LIGHT_MOST) -> DataFrame:
    """Customers of other warehouses with an order sharing at least two distinct items with an order of the requested customer:
    the rows of ``reads.related_customers``."""
    items = cut_lineage(derived.customer_order_items(orders, order_lines), "order-items")
    everyone = cut_lineage(with_masks(items, heavy_items(items, light_most)), "order-masks")
    asked = everyone if requests is None else cut_lineage(everyone.join(requests.select(*CUSTOMER).distinct(), CUSTOMER, "left_semi"), "asked-orders")
    both = _by_masks(asked, everyone).unionByName(_by_postings(asked, everyone))
    return both.where(F.col("w_id") != F.col("r_w_id")).distinct()
