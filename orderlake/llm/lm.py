"""Language-model scoring by deleted interpolation.

Maximum-likelihood estimates of trigram, bigram and unigram, and a uniform
one, are mixed from the highest order down: P3 = l * f3 + (1 - l) * P2, and so
on; the weight l depends on the bucket of the context's frequency. Weights
are learned by expectation-maximisation on held-out counts: n-grams are
counted in a part of the training documents, and the events of the deleted
part are tabulated by their estimates under these counts. Scores then use the
counts of all training documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import fold, id_text

ORDERS = (1, 2, 3)
#: Hashes that stand for the end and the start of a text.
END, START = 0x5EED0000000000E1, 0x5EED0000000000B5
KEPT, DELETED, UNSEEN = 0, 1, 2
BUCKETS = 24
#: Estimates are tabulated in steps of 1 / STEPS decades for EM.
STEPS, DECADES = 4, 13


def sequence(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: tokens of all texts, each with its end; number of the text, and
    whether a token is the first of its text."""
    words, lengths = B.block_words(row)
    n = lengths + 1
    last = np.cumsum(n) - 1
    tokens = np.full(int(n.sum()), END, dtype=np.uint64)
    inside = np.ones(len(tokens), dtype=bool)
    inside[last] = False
    tokens[inside] = words
    first = np.zeros(len(tokens), dtype=bool)
    first[last - n + 1] = True
    return tokens, np.repeat(np.arange(len(n)), n), first


def grams(tokens: np.ndarray, first: np.ndarray, bits: int) -> dict[int, np.ndarray]:
    """Hash of the n-gram that ends at each token, with starts before a text."""
    def back(first_k: np.ndarray, k: int) -> np.ndarray:
        x = np.r_[np.full(k, START, dtype=np.uint64), tokens[:len(tokens) - k]] if len(tokens) >= k else np.full(len(tokens), START, dtype=np.uint64)
        return np.where(first_k, np.uint64(START), x)

    second = np.r_[False, first[:-1]] | first if len(first) else first
    b1, b2 = back(first, 1), back(second, 2)
    two = B.join_hash(b1, tokens)
    return {1: B.mix(tokens), 2: B.shorten(two, bits), 3: B.shorten(B.join_hash(B.join_hash(b2, b1), tokens), bits)}


def numbered(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and the number of the key at each place."""
    order = np.argsort(h)
    s = h[order]
    new = np.r_[True, s[1:] != s[:-1]] if len(s) else np.empty(0, dtype=bool)
    number = np.empty(len(h), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return s[new], number


def bucket_of(x: np.ndarray) -> np.ndarray:
    """0: never seen; 1, 2, 3-4, 5-8, ...: by doubling frequency."""
    return np.minimum(np.where(x > 0, 1 + np.ceil(np.log2(np.maximum(x, 1))), 0), BUCKETS - 1).astype(np.int64)


@dataclass(frozen=True)
class Model:
    train_tokens: int
    types: int
    train_docs: int
    l3: tuple[float, ...] = ()
    l2: tuple[float, ...] = ()
    l1: float = 0.5


def estimates(row: dict, bits: int, which: int, n_tokens: int, n_docs: int) -> tuple:
    """(doc, c1, f3, x3, f2, x2, f1) of every token of a block under the counts ``which``."""
    tokens, doc, first = sequence(row)
    c = {o: B.totals_of(row, o, which)[numbered(h)[1]] for o, h in grams(tokens, first, bits).items()}
    # the context of a token is the gram that ends before it; a text starts as often as there are texts
    before = lambda a: np.where(first, n_docs, np.r_[0, a[:-1]] if len(a) else a)
    x3, x2 = before(c[2]), before(c[1])
    f3, f2 = c[3] / np.maximum(x3, 1), c[2] / np.maximum(x2, 1)
    return doc, c[1], np.minimum(f3, 1.0), x3, np.minimum(f2, 1.0), x2, c[1] / max(n_tokens, 1)


def mixture(f3, b3, f2, b2, f1, model: Model) -> np.ndarray:
    p1 = model.l1 * f1 + (1 - model.l1) / (model.types + 1)
    l2, l3 = np.array(model.l2)[b2], np.array(model.l3)[b3]
    return l3 * f3 + (1 - l3) * (l2 * f2 + (1 - l2) * p1)


def learn_weights(table: np.ndarray, counts: np.ndarray, model: Model, rounds: int = 60) -> Model:
    """EM over tabulated held-out events: columns b3, f3, b2, f2, f1 (estimates as steps, 0 for none)."""
    value = lambda s: np.where(s > 0, 10.0 ** ((s - 1) / STEPS - DECADES), 0.0)
    b3, b2 = table[:, 0], table[:, 2]
    f3, f2, f1 = value(table[:, 1]), value(table[:, 3]), value(table[:, 4])
    l3, l2, l1 = np.full(BUCKETS, 0.5), np.full(BUCKETS, 0.5), 0.5
    l3[0] = l2[0] = 0.0
    flat = 1 / (model.types + 1)
    n3 = np.maximum(np.bincount(b3, weights=counts, minlength=BUCKETS), 1e-9)
    for _ in range(rounds):
        p1 = l1 * f1 + (1 - l1) * flat
        p2 = l2[b2] * f2 + (1 - l2[b2]) * p1
        p3 = l3[b3] * f3 + (1 - l3[b3]) * p2
        r3 = counts * l3[b3] * f3 / p3
        down = counts - r3
        r2 = down * l2[b2] * f2 / p2
        lower = down - r2
        l3 = np.bincount(b3, weights=r3, minlength=BUCKETS) / n3
        l2 = np.bincount(b2, weights=r2, minlength=BUCKETS) / np.maximum(np.bincount(b2, weights=down, minlength=BUCKETS), 1e-9)
        l1 = float((lower * l1 * f1 / p1).sum() / max(lower.sum(), 1e-9))
    # no weight takes all, so every text keeps a probability above 0; buckets without events take the nearest lower one's
    for l, b in ((l3, b3), (l2, b2)):
        seen = np.bincount(b, weights=counts, minlength=BUCKETS) > 0
        for k in range(1, BUCKETS):
            if not seen[k]:
                l[k] = l[k - 1]
    clip = lambda l: tuple(np.minimum(l, 1 - 1e-6).tolist())
    return Model(model.train_tokens, model.types, model.train_docs, clip(l3), clip(l2), float(min(max(l1, 1e-6), 1 - 1e-6)))


def score_documents(docs: DataFrame, held_out_fold: int = 1, deleted_fold: int = 4, folds: int = 5, block_words: int = 1_000_000,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per row of ``docs``.

    Documents of ``held_out_fold`` (crc32 of the id, modulo ``folds``) train
    nothing; those of ``deleted_fold`` give the held-out counts of EM. Null texts
    count as empty: one token, the end. Repeated rows count and score each; without
    any training document every token has the uniform estimate; an empty table
    gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    t = id_text(docs, id_col, text_col).withColumn("fold", fold(F.col("doc_id"), folds))
    role = F.when(F.col("fold") == held_out_fold, UNSEEN).when(F.col("fold") == deleted_fold, DELETED).otherwise(KEPT)
    blocks = B.make_blocks(t.select("doc_id", "text", role.alias("role")), block_words)
    size = {r["role"]: (r["w"] + r["d"], r["d"]) for r in blocks.groupBy("role").agg(F.sum("n_words").alias("w"), F.sum(F.size("lengths")).alias("d")).collect()}
    total = sum(n for n, _ in size.values())
    buckets, bits = B.n_buckets(total), B.key_bits(total)
    kept, deleted = size.get(KEPT, (0, 0)), size.get(DELETED, (0, 0))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in B.block_rows(batches):
            tokens, _, first = sequence(row)
            for o, h in grams(tokens, first, bits).items():
                keys, number = numbered(h)
                n = np.bincount(number, minlength=len(keys))
                counts = [n if row["role"] == r else np.zeros(len(keys), dtype=np.int64) for r in (KEPT, DELETED)]
                yield B.send_rows(o, row["block"], keys, counts, buckets, bits if o > 1 else 64)

    sent = blocks.select("block", "role", "lengths", "n_words", "vocab", "words").mapInArrow(send, B.ROWS_SCHEMA)
    # totals: 0 of the kept documents, 1 of the deleted ones
    totals = B.total_up(sent, "lm-totals")
    types = totals.where("ord = 1").agg(F.sum("types")).first()[0] or 0
    model = Model(kept[0] + deleted[0], types, kept[1] + deleted[1], (0.0,) * BUCKETS, (0.0,) * BUCKETS, 0.5)
    def tabulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = lambda f: np.where(f > 0, np.clip(np.rint((np.log10(np.maximum(f, 1e-300)) + DECADES) * STEPS), 0, None) + 1, 0).astype(np.int64)
        for row in B.block_rows(batches):
            _, _, f3, x3, f2, x2, f1 = estimates(row, bits, 0, kept[0], kept[1])
            key = bucket_of(x3)
            for col in (step(f3), bucket_of(x2), step(f2), step(f1)):
                key = key * 256 + col
            u, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(n, pa.int64())], names=["event", "n"])

    if kept[0] and deleted[0]:
        # the steps and buckets bound the number of rows, whatever the corpus
        own = F.col("block").startswith(f"{DELETED}-")
        events = B.with_totals(blocks.where(own), totals.where(own)).mapInArrow(tabulate, "event long, n long").groupBy("event").agg(F.sum("n").alias("n")).toPandas()
        e = events["event"].to_numpy()
        table = np.stack([e >> s & 255 for s in (32, 24, 16, 8, 0)], axis=1)
        model = learn_weights(table, events["n"].to_numpy().astype(float), model)
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        base_all = np.log10(m.train_tokens + 0.5 * (m.types + 1))
        for row in B.block_rows(batches):
            doc, c1, f3, x3, f2, x2, f1 = estimates_all(row, bits, m)
            n = len(row["lengths"])
            p = np.log10(mixture(f3, bucket_of(x3), f2, bucket_of(x2), f1, m))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], kind), pa.array(np.full(n, row["role"] == UNSEEN)), pa.array(np.array(row["lengths"], dtype=np.int64) + 1),
                 pa.array(np.bincount(doc, weights=c1 > 0, minlength=n).astype(np.int64)), pa.array(np.full(n, m.train_tokens, dtype=np.int64)),
                 pa.array(np.bincount(doc, weights=np.log10(c1 + 0.5) - base_all, minlength=n)), pa.array(np.bincount(doc, weights=p, minlength=n))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = pa.int64() if t.schema["doc_id"].dataType.simpleString() == "bigint" else None
    return B.with_totals(blocks, totals).mapInArrow(score, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, "
                                    "train_tokens long, base_score double, score double")


def estimates_all(row: dict, bits: int, m: Model) -> tuple:
    """Estimates under the counts of all training documents: kept and deleted."""
    both = {**row, "back": [{**r, "totals": [None, None, B.squeeze(B.smallest(
        B.unsqueeze(r["totals"][0], r["n"]).astype(np.int64) + B.unsqueeze(r["totals"][1], r["n"]).astype(np.int64)))]} for r in row["back"] or []]}
    return estimates(both, bits, 2, m.train_tokens, m.train_docs)
