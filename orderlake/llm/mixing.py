"""Mixing sources to target weights by hierarchical budgeting.

A tree domain -> language -> source hangs under one token budget. Each node
hands its budget to its children in proportion to their weights; what a child
can't use (it can give at most ``max_epochs`` times its tokens) goes to its
siblings first, and only what a whole subtree can't use reaches the siblings
of its ancestors. A leaf then gives whole epochs of its documents and, of the
next epoch, a token-prefix in an order seeded by (seed, epoch).

Everything is DataFrame operations. Budgets are settled on one row per leaf;
a leaf's running token count is taken in two steps (sums of ranges of the
seeded order, then within a range), so no task holds a whole leaf.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

TOKEN = r"[^\x20\x09-\x0D]+"
LEAF = ["domain", "lang", "source"]


def weight_of(column: str, weights: Mapping[str, int], default: int) -> Column:
    w = F.lit(default)
    for k, v in weights.items():
        w = F.when(F.col(column) == k, v).otherwise(w)
    return w.cast("long")


def share_out(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Split each parent's ``parent_budget`` among its children.

    ``children`` has a row for each child with ``cap`` (the most it can use),
    ``w`` and ``parent_budget``. In the order of cap / w, a child is full if its
    proportional share of what the fuller ones left is at least its cap; the
    others share what is left by weight, rounded down. Adds ``budget``.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("w"), child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    d = lambda c: F.col(c).cast("double")
    x = (children.withColumn("rest", F.col("parent_budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("w_rest", F.sum("w").over(onward))
         .withColumn("full", d("cap") * d("w_rest") <= d("rest") * d("w"))
         .withColumn("first_open", F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("w"), child, "rest", "w_rest")))
                     .over(Window.partitionBy(*parent))))
    part = F.floor(F.col("first_open.rest").cast("double") * d("w") / F.col("first_open.w_rest").cast("double"))
    return x.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(F.least(part, F.col("cap")))).drop("rest", "w_rest", "full", "first_open")


def leaf_budgets(leaves: DataFrame, budget_num: int, budget_den: int, max_epochs: int,
                 domain_weights: Mapping[str, int], lang_weights: Mapping[str, int], source_weights: Mapping[str, int],
                 default_weight: int = 1) -> DataFrame:
    """``leaves``: domain, lang, source, tokens (one row each). Adds ``budget``."""
    s = leaves.withColumn("cap", F.col("tokens") * max_epochs).withColumn("w", weight_of("source", source_weights, default_weight))
    lang = (s.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
            .withColumn("w", weight_of("lang", lang_weights, default_weight)))
    dom = (lang.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
           .withColumn("w", weight_of("domain", domain_weights, default_weight)))
    # one row per domain
    total = F.floor(F.sum("tokens").over(Window.partitionBy("root")) * budget_num / budget_den).cast("long")
    dom = share_out(dom.withColumn("root", F.lit(0)).withColumn("parent_budget", total), ["root"], "domain")
    lang = share_out(lang.join(dom.select("domain", F.col("budget").alias("parent_budget")), "domain"), ["domain"], "lang")
    s = share_out(s.join(lang.select("domain", "lang", F.col("budget").alias("parent_budget")), ["domain", "lang"]),
                  ["domain", "lang"], "source")
    return s.select(*LEAF, "tokens", F.col("budget").cast("long").alias("budget"))


def mix(docs: DataFrame, domain: Column, budget_num: int = 3, budget_den: int = 4, max_epochs: int = 3, seed: int = 17,
        domain_weights: Mapping[str, int] | None = None, lang_weights: Mapping[str, int] | None = None,
        source_weights: Mapping[str, int] | None = None, default_weight: int = 1, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, leaf_tokens, leaf_budget, copies), a row per document.

    ``domain`` is an expression over ``docs``; weights are whole numbers of 1
    or more. copies: how often the document enters the mix, 0 to max_epochs.
    In the partly used epoch a leaf's documents stand in the order of
    md5(seed:epoch:doc_id), and one is taken if at least half of it lies in the
    token-prefix. Null domain, language or source is a node named '(none)';
    null and empty texts have no tokens and are never taken; repeated rows
    count each; an empty table gives no rows.
    """
    name = lambda c: F.coalesce(c.cast("string"), F.lit("(none)"))
    rows = cut_lineage(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), name(domain).alias("domain"), name(F.col("lang")).alias("lang"), name(F.col("source")).alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(TOKEN)), F.lit(0)).cast("long").alias("n_tokens")), "mix-rows")
    leaves = rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"))
    budgets = cut_lineage(
        leaf_budgets(leaves, budget_num, budget_den, max_epochs, domain_weights or {}, lang_weights or {}, source_weights or {}, default_weight)
        .withColumnRenamed("tokens", "leaf_tokens").withColumnRenamed("budget", "leaf_budget")
        .withColumn("epochs", F.when(F.col("leaf_tokens") > 0, F.floor(F.col("leaf_budget") / F.col("leaf_tokens"))).otherwise(0).cast("long")),
        "mix-budgets")
    # a third of all rows may be of one leaf: the join can be split, and the order below is cut into ranges
    x = (rows.join(budgets, LEAF)
         .withColumn("at", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
         .withColumn("range", F.substring("at", 1, 3)))
    ranges = (x.groupBy(*LEAF, "range").agg(F.sum("n_tokens").alias("t"))  # at most 4,096 rows a leaf
              .withColumn("range_first", F.coalesce(F.sum("t").over(
                  Window.partitionBy(*LEAF).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("t"))
    within = Window.partitionBy(*LEAF, "range").orderBy("at", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    x = (x.join(ranges, [*LEAF, "range"])
         .withColumn("before", F.col("range_first") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
         .withColumn("left", F.col("leaf_budget") - F.col("epochs") * F.col("leaf_tokens")))
    taken = F.when((F.col("n_tokens") > 0) & (2 * (F.col("left") - F.col("before")) >= F.col("n_tokens")), 1).otherwise(0)
    return x.select("doc_id", *LEAF, "n_tokens", "leaf_tokens", "leaf_budget",
                    F.when(F.col("n_tokens") > 0, F.col("epochs") + taken).otherwise(0).cast("long").alias("copies"))
