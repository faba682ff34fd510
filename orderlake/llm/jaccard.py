"""Jaccard join of documents on word n-grams by vertical partitioning.

All n-grams have one global order (rarest first, then by hash), which is cut
into fragments. A document's set is stored by fragment; the overlap of a pair
is counted in each fragment by itself and summed.

Which pairs to count: a document can only link if enough of its n-grams occur
elsewhere at all, and linked pairs share an n-gram among the first ones of
both (prefixes). Documents with equal sets are one node. Since the answer is
the group of each document, a group of near copies needn't be compared pair by
pair: each round every node is compared with a few pivots of n-grams it shares,
and n-grams whose nodes are all in one component are done. What is left
between components at the end is compared in full, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import blocks as B
from .common import id_text
from .components import components
from .lm import numbered

#: Where the global order is cut: number of documents (from, below), and into how many equal hash ranges.
FRAGMENTS = ((2, 3, 4), (3, 4, 2), (4, 8, 1), (8, 1 << 62, 1))


def fragment_of(df: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Fragment of each n-gram; grows with (df, gram)."""
    out, at = np.zeros(len(df), dtype=np.int64), 0
    for lo, hi, ways in FRAGMENTS:
        inside = (df >= lo) & (df < hi)
        out[inside] = at + (gram[inside] >> np.uint64(60)).astype(np.int64) * ways // 16
        at += ways
    return out


def shingles(row: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document number, hash) of every n-gram of a block's documents; fewer than n words are one whole."""
    words, lengths = B.block_words(row)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    end = np.cumsum(lengths)
    h = B.mix(words)
    m = max(len(words) - n + 1, 0)
    full = np.flatnonzero(np.arange(m) + n <= end[doc[:m]]) if m else np.empty(0, dtype=np.int64)
    g = h[full]
    for k in range(1, n):
        g = B.join_hash(g, h[full + k])
    docs, grams = [doc[full]], [g]
    few = np.flatnonzero((lengths > 0) & (lengths < n))
    whole = B.mix(lengths[few].astype(np.uint64))
    for k in range(n - 1):
        has = lengths[few] > k
        whole[has] = B.join_hash(whole[has], h[(end[few] - lengths[few])[has] + k])
    docs.append(few)
    grams.append(whole)
    return np.concatenate(docs), np.concatenate(grams)


def distinct_pairs(doc: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct n-grams; of the distinct (document, n-gram) by document: document, number of the n-gram."""
    keys, number = numbered(gram)
    code = np.unique(doc.astype(np.int64) * max(len(keys), 1) + number)
    return keys, code // max(len(keys), 1), code % max(len(keys), 1)


def least_overlap(n, num: int, den: int):
    """Least overlap of a set of n with any linked one: ceil(n * num / den)."""
    return -(-n * num // den)


def shingle_sets(docs: DataFrame, n: int, num: int, den: int, block_words: int) -> DataFrame:
    """A row per document: doc_id, n_shingles, node (equal sets, equal nodes; null for
    documents that can't link), and on one row a block of each node its prefix and
    its n-grams by fragment."""
    blocks = B.make_blocks(docs.withColumn("role", F.lit(0)), block_words)
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    buckets, bits = B.n_buckets(total), B.key_bits(total)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in B.block_rows(batches):
            doc, gram = shingles(row, n)
            keys, _, number = distinct_pairs(doc, B.shorten(gram, bits))
            yield B.send_rows(n, row["block"], keys, [np.bincount(number, minlength=len(keys))], buckets, bits)

    totals = B.total_up(blocks.select("block", "lengths", "n_words", "vocab", "words").mapInArrow(send, B.ROWS_SCHEMA), "jaccard-totals")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in B.block_rows(batches):
            doc, gram = shingles(row, n)
            keys, d, number = distinct_pairs(doc, B.shorten(gram, bits))
            df = B.totals_of(row, n, 0)
            count = len(row["lengths"])
            size = np.bincount(d, minlength=count)
            shared = np.bincount(d, weights=df[number] > 1, minlength=count).astype(np.int64)
            alive = (size > 0) & (shared >= least_overlap(size, num, den))
            keep = alive[d]
            d, number = d[keep], number[keep]
            node = np.zeros(count, dtype=np.uint64)
            np.add.at(node, d, B.mix(keys[number]))
            node = B.mix(node + B.mix(size.astype(np.uint64)))
            common = df[number] > 1
            d, g, f = d[common], keys[number[common]], df[number[common]]
            order = np.lexsort((g, f, d))
            d, g, f = d[order], g[order], f[order]
            frag = fragment_of(f, g)
            at = np.searchsorted(d, np.arange(count + 1)).tolist()
            seen, prefixes, places, pieces, sizes = set(), [], [], [], []
            for k in range(count):
                s, e = at[k], at[k + 1]
                if not alive[k] or int(node[k]) in seen:
                    prefixes.append(None), places.append(None), pieces.append(None), sizes.append(None)
                    continue
                seen.add(int(node[k]))
                alone = int(size[k]) - (e - s)
                # the first n - least + 1 of the global order, of which n-grams that occur once can't be shared
                reach = max(0, int(size[k] - least_overlap(size[k], num, den)) + 1 - alone)
                prefixes.append(g[s:s + reach].view(np.int64))
                places.append(np.arange(alone, alone + len(g[s:s + reach]), dtype=np.int32))
                own = [np.sort(g[s:e][frag[s:e] == x]) for x in range(sum(w for _, _, w in FRAGMENTS))]
                pieces.append([B.squeeze(np.diff(x >> np.uint64(64 - bits), prepend=np.uint64(0))) if len(x) else b"" for x in own])
                sizes.append([len(x) for x in own])
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(size, pa.int64()), pa.array(node.view(np.int64), pa.int64(), mask=~alive),
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32())), pa.array(pieces, pa.list_(pa.binary())),
                 pa.array(sizes, pa.list_(pa.int32()))], names=["doc_id", "n_shingles", "node", "prefix", "places", "pieces", "sizes"])

    return cut_lineage(B.with_totals(blocks, totals).mapInArrow(
        build, "doc_id long, n_shingles long, node long, prefix array<long>, places array<int>, pieces array<binary>, sizes array<int>"), "jaccard-sets")


def narrowed(rows: DataFrame, key: str, keys: DataFrame, most: int = 200_000) -> DataFrame:
    """Rows whose key is among the distinct ``keys``: by broadcast if there are at
    most ``most`` of them (counted first), else by a shuffled semi-join."""
    keys = cut_lineage(keys.distinct(), "keys")
    return rows.join(F.broadcast(keys) if keys.count() <= most else keys, key, "left_semi")


def count_overlaps(pairs: DataFrame, pieces: DataFrame) -> DataFrame:
    """(a, b, overlap): partial overlaps of each fragment, summed per pair.
    ``pieces``: node, fragment, size, piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for x, y, m, n in zip(*(batch.column(c).to_pylist() for c in ("piece_a", "piece_b", "size_a", "size_b"))):
                got.append(len(np.intersect1d(B.read_keys(x, m), B.read_keys(y, n), assume_unique=True)) if x is not y and x != y else m)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(got, pa.int64())], names=["a", "b", "part"])

    of = lambda s: pieces.select(F.col("node").alias(s), "fragment", F.col("size").alias(f"size_{s}"), F.col("piece").alias(f"piece_{s}"))
    return (pairs.select("a", "b").join(of("a"), "a").join(of("b"), ["b", "fragment"])
            .select("a", "b", "piece_a", "piece_b", "size_a", "size_b").mapInArrow(run, "a long, b long, part long")
            .groupBy("a", "b").agg(F.sum("part").alias("overlap")))


def linked(pairs: DataFrame, pieces: DataFrame, num: int, den: int) -> DataFrame:
    """The components (c_a, c_b) of the pairs (a, b, n_a, n_b, c_a, c_b) whose overlap
    reaches num / den of the union."""
    pairs = cut_lineage(pairs, "jaccard-pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    o = count_overlaps(pairs, narrowed(pieces, "node", nodes))
    return (pairs.join(o, ["a", "b"]).where(den * F.col("overlap") >= num * (F.col("n_a") + F.col("n_b") - F.col("overlap")))
            .select("c_a", "c_b").distinct())


def may_link(num: int, den: int):
    """Filters on sizes, and on the places of a shared n-gram: at most what follows
    it in both can overlap, and the overlap must reach num / (num + den) of both sizes."""
    need = F.ceil((F.col("n_a") + F.col("n_b")) * num / (num + den))
    rest = 1 + F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) - 1
    return ((den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b")) & (rest >= need))


def jaccard_groups(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, pivot_rounds: int = 8, pivots: int = 4, block_words: int = 1_000_000,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), a row per row of ``docs``.

    Documents link when den * intersection >= num * union of their n-gram sets;
    component_id is the smallest id reached by links. Texts of fewer than n words
    are one n-gram; null and empty texts have none and link with nothing.
    Repeated rows are linked copies; a null id has a null component; an empty
    table gives no rows; further columns are ignored. Ids are whole numbers.
    """
    t = id_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    sets = shingle_sets(t, n, num, den, block_words)
    # rows of the prefixes: node, n, alone, gram, at; only n-grams of two nodes or more matter
    rows = (sets.where("size(prefix) > 0")
            .select("node", F.col("n_shingles").alias("n"), F.col("places")[0].alias("alone"), F.explode(F.arrays_zip("prefix", "places")).alias("p"))
            .select("node", "n", "alone", F.col("p.prefix").alias("gram"), F.col("p.places").alias("at")).distinct())
    rows = cut_lineage(rows, "jaccard-prefixes")
    several = rows.groupBy("gram").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("gram")
    rows = cut_lineage(rows.join(several, "gram"), "jaccard-rows")
    start = rows.count()
    labels = None
    if start:
        of = sets.where("pieces is not null").select("node", "pieces", "sizes")
        pieces = cut_lineage(narrowed(of, "node", rows.select("node")).dropDuplicates(["node"])
                             .select("node", F.posexplode(F.arrays_zip("pieces", "sizes")).alias("fragment", "p"))
                             .select("node", "fragment", F.col("p.sizes").alias("size"), F.col("p.pieces").alias("piece")).where("size > 0"), "jaccard-pieces")
        labels = cut_lineage(rows.select("node", F.col("node").alias("c")).distinct(), "jaccard-labels")
    for turn in range(pivot_rounds + 1):
        if not start:
            break
        here = rows.join(labels, "node")
        by = here.groupBy("gram", "c").agg(F.count(F.lit(1)).alias("m")).groupBy("gram").agg(
            F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("same"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
        by = cut_lineage(by.select("gram", ((F.col("m") * F.col("m") - F.col("same")) / 2).alias("pairs")), "jaccard-open")
        left = by.agg(F.sum("pairs")).first()[0]
        if not left:
            break
        here = here.join(by.select("gram"), "gram")
        # pairs that only share an n-gram cost a comparison of sizes and places each, so many of them may be left
        last = turn == pivot_rounds or turn > 0 and left <= max(20 * start, 10_000_000) or left <= start
        if last:  # all that is left between components
            x, y = (here.select("gram", *[F.col(c).alias(f"{k}_{s}") for c, k in (("node", "node"), ("n", "n"), ("at", "at"), ("c", "c"))]) for s in "ab")
            pairs = (x.join(y, "gram").where("node_a < node_b and c_a <> c_b").where(may_link(num, den))
                     .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "n_a", "n_b", "c_a", "c_b").distinct())
        else:
            # each node with the pivots that most of its n-grams name; pivots are the nodes with the fewest
            # n-grams of their own, as the text that others were copied from; each round the next ones
            order = F.row_number().over(Window.partitionBy("gram").orderBy(F.col("alone") / F.col("n"), F.xxhash64("node"), "node"))
            pivot = (here.withColumn("r", order).where(F.col("r") <= pivots * (turn + 1)).where(F.col("r") > pivots * turn)
                     .select("gram", F.struct("node", "n", "at", "c").alias("v")))
            pairs = (here.join(pivot, "gram").where("c <> v.c")
                     .select(F.col("node").alias("a"), F.col("v.node").alias("b"), F.col("n").alias("n_a"), F.col("v.n").alias("n_b"),
                             F.col("at").alias("at_a"), F.col("v.at").alias("at_b"), F.col("c").alias("c_a"), F.col("v.c").alias("c_b"))
                     .where(may_link(num, den)).groupBy("a", "b", "n_a", "n_b", "c_a", "c_b").agg(F.count(F.lit(1)).alias("times"))
                     .withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("times"), "b")))
                     .where(F.col("r") <= pivots).drop("r", "times"))
        # components are joined to larger ones, so each round handles its own links only
        to = components(linked(pairs, pieces, num, den), "c_a", "c_b").select(F.col("node").alias("c"), "component")
        labels = cut_lineage(labels.join(to, "c", "left").select("node", F.coalesce("component", "c").alias("c")), "jaccard-labels")
        if last:
            break
    named = sets.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    if labels is not None:
        named = named.join(labels, "node", "left").withColumn("c", F.coalesce("c", "node"))
        named = named.select("node", "c", "first").join(named.groupBy("c").agg(F.min("first").alias("component_id")), "c").select("node", "component_id")
    else:
        named = named.select("node", F.col("first").alias("component_id"))
    named = cut_lineage(named, "jaccard-named")
    return (sets.select("doc_id", "n_shingles", "node").join(named, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
