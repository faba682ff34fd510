"""Ranked lexical search by presence masks.

Documents are kept as postings over the terms of the asked items. In a block of
documents, each term of an item is a bitmap over the documents; the bitmaps
side by side give each document the mask of the item's terms that it holds.
Documents of one mask form a group, whose score is at most the sum of its terms'
largest contributions in the block. Groups are scored in the order of that sum,
until it is below the k-th best score found: no later group can reach the result.
Blocks give k rows an item at most; a ranking of those is the answer.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import id_text, text_slices

#: Bytes of UTF-8: what separates terms becomes a blank, A-Z become a-z, all else stays.
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

#: Cells of an item's presence table (terms x documents) in memory at a time.
MAX_CELLS = 16_000_000


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


@dataclass(frozen=True)
class Items:
    """A block of items: their number, their distinct terms as numbers, and how often each stands there."""
    vocabulary: dict[bytes, int]
    numbers: list[int]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]


def postings(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n, terms, tfs): a row per document, its terms of the vocabulary and how often each occurs; n: all its terms with repeats."""
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value.get
        for batch in batches:
            for start, texts in text_slices(batch):
                lengths, terms, tfs = [], [], []
                for text in texts:
                    own = terms_of(text)
                    found = Counter(map(find, own))
                    found.pop(None, None)
                    lengths.append(len(own))
                    terms.append(list(found))
                    tfs.append(list(found.values()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(texts)), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                     pa.array(tfs, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, terms array<int>, tfs array<long>")


class Block:
    """Postings of some documents, term by term; documents are numbered in the order of their ids."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, n_docs: int):
        order = np.lexsort((doc, term))
        self.doc, self.value, self.n_docs = doc[order], value[order], n_docs
        self.present, self.start = np.unique(term[order], return_index=True)
        self.end = np.append(self.start[1:], len(order))
        self.key = term[order].astype(np.int64) * n_docs + self.doc
        self.largest = np.maximum.reduceat(self.value, self.start) if len(order) else self.value

    def best(self, terms: np.ndarray, repeats: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k documents of highest score above 0 (ties: smallest number) and their scores."""
        at = np.searchsorted(self.present, terms)
        here = (at < len(self.present)) & (self.present[np.minimum(at, len(self.present) - 1)] == terms) if len(self.present) else np.zeros(len(terms), bool)
        terms, repeats, at = terms[here], repeats[here], at[here]
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(terms):
            return docs, scores
        bits = np.zeros((len(terms), self.n_docs), np.uint8)
        for row, p in enumerate(at):
            bits[row, self.doc[self.start[p]:self.end[p]]] = 1
        masks = np.ascontiguousarray(np.packbits(bits, axis=0, bitorder="little").T)
        if masks.shape[1] <= 8:
            masks = np.pad(masks, ((0, 0), (0, 8 - masks.shape[1]))).view(np.uint64)[:, 0]
        else:
            masks = masks.view(np.dtype((np.void, masks.shape[1])))[:, 0]
        _, first, group = np.unique(masks, return_index=True, return_inverse=True)
        by_group = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=len(first)))
        limits = (self.largest[at] * repeats).astype(np.float64) @ bits[:, first].astype(np.float64)
        limits = limits * (1 + 1e-9)  # sums of rounded numbers: never below the exact one
        turn, take = np.argsort(-limits, kind="stable"), 64
        turn = turn[limits[turn] > 0]
        while len(turn):
            if len(docs) == k and limits[turn[0]] < scores[-1]:
                break
            sizes = ends[turn] - np.where(turn > 0, ends[turn - 1], 0)
            cut = int(np.searchsorted(np.cumsum(sizes), take)) + 1
            chosen = np.concatenate([by_group[(ends[g - 1] if g else 0):ends[g]] for g in turn[:cut]])
            row, col = np.nonzero(bits[:, chosen].T)
            worth = np.zeros((len(chosen), len(terms)), np.int64)
            worth[row, col] = self.value[np.searchsorted(self.key, terms[col].astype(np.int64) * self.n_docs + chosen[row])] * repeats[col]
            docs, scores = np.append(docs, chosen), np.append(scores, worth.sum(axis=1))
            keep = np.lexsort((docs, -scores))
            keep = keep[scores[keep] > 0][:k]
            docs, scores, turn, take = docs[keep], scores[keep], turn[cut:], take * 2
        return docs, scores


def best_in_blocks(stored: DataFrame, items: Items, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): up to k rows of an item from each block of documents."""
    shared = stored.sparkSession.sparkContext.broadcast((items, weights))
    widest = max((len(t) for t in items.terms), default=1) or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = shared.value
        step = max(64, MAX_CELLS // widest)
        for whole in batches:
            ids = whole.column("doc_id")
            whole = whole.take(pa.compute.array_sort_indices(ids, order="ascending"))
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                terms, tfs = batch.column("terms"), batch.column("tfs").flatten().to_numpy(zero_copy_only=False)
                sizes = np.diff(terms.offsets.to_numpy(zero_copy_only=False))
                terms = terms.flatten().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(batch.num_rows), sizes)
                m = np.array([75 + 25 * n * n_docs // n_terms for n in batch.column("n").to_pylist()], np.int64)
                worth = weight[terms] * (1_000_000_000 * tfs // (1000 * tfs + 12 * m[doc]))
                some = worth > 0
                block = Block(doc[some], terms[some], worth[some], batch.num_rows)
                item, found, score = [], [], []
                for number, own, repeats in zip(asked.numbers, asked.terms, asked.repeats):
                    d, s = block.best(own, repeats, k)
                    item.append(np.full(len(d), number, np.int64))
                    found.append(d)
                    score.append(s)
                if item:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(item)), batch.column("doc_id").take(pa.array(np.concatenate(found))),
                                                      pa.array(np.concatenate(score))], names=["item", "doc_id", "score"])

    return stored.mapInArrow(run, f"item long, doc_id {stored.schema['doc_id'].dataType.simpleString()}, score long")


def item_blocks(asked: DataFrame, block_chars: int) -> tuple[DataFrame, int]:
    """``asked`` with a number for each row (``item``) and its ``block``, and the number of
    blocks: each holds about ``block_chars`` characters, twice as many at most if it has more than one item."""
    size = F.length("text") + 1
    n_items, chars = asked.agg(F.count(F.lit(1)), F.sum(size)).first()
    blocks = max(1, math.ceil((chars or 0) / block_chars))
    numbered = cut_lineage(asked.withColumn("item", F.monotonically_increasing_id()), "ranked-items")
    while True:
        dealt = numbered.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
        over = dealt.groupBy("block").agg(F.sum(size).alias("chars"), F.count(F.lit(1)).alias("n")).where((F.col("chars") > 2 * block_chars) & (F.col("n") > 1))
        if blocks == 1 and (chars or 0) <= 2 * block_chars or not over.limit(1).count():
            return dealt, blocks
        blocks *= 2


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", block_chars: int = 200_000) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its ``k`` documents of highest score above 0, equal scores by ascending id.

    Terms are the maximal runs of ASCII letters and digits and of everything
    beyond ASCII, only A-Z lower-cased. With N documents that hold a term, L terms in
    all and n in a document: m = 75 + (25*n*N) div L, a term's weight is
    floor(1000 ln((2N+2)/(2df+1))) and it adds weight * ((10^9 tf) div (1000 tf + 12 m))
    for each of its places in the item.

    Null texts have no terms; items without a found term give no row; items that
    repeat (id and text) count once, equal ids with different texts are items of
    their own under the same id. Repeated documents are documents each; null ids
    come last among equal scores. Empty tables give no rows; further columns are ignored.
    Items are answered in blocks of ``block_chars`` characters, so that what is sent to all
    tasks is bounded; each block reads the documents once.
    """
    docs = id_text(docs, id_col, text_col)
    asked = id_text(items, item_col, item_text_col).distinct()
    dealt, blocks = item_blocks(asked, block_chars)
    answers = None
    for b in range(blocks):
        own = dealt.where(F.col("block") == b)
        rows = [(r["item"], Counter(terms_of(r["text"]))) for r in own.select("item", "text").orderBy("item").collect()]
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, found in rows for t in found}))}
        block = Items(vocabulary, [i for i, _ in rows], [np.array([vocabulary[t] for t in found], np.int32) for _, found in rows],
                      [np.array(list(found.values()), np.int64) for _, found in rows])
        stored = cut_lineage(postings(docs, block), "ranked-postings")
        n_docs, n_terms = stored.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = {r["term"]: r["df"] for r in stored.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64)
        hits = best_in_blocks(stored.where(F.size("terms") > 0), block, weights, n_docs, max(n_terms, 1), k)
        order = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        named = ranked.join(own.select("item", F.col("doc_id").alias("item_id")), "item").select("item_id", "rank", "doc_id", "score")
        answers = named if answers is None else answers.unionByName(named)
    return answers
