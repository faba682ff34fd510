"""Toxicity by compression distance.

Two zstandard dictionaries are trained, on windows of ordinary and of toxic
labelled text: the ordinary one holds the windows of most ordinary documents;
the toxic one holds the same and, behind them, the windows that toxic
documents have far more often than ordinary ones. A window is a run of
letters. Both compress it; its contrast is the share of the ordinary length
that the toxic dictionary saves. A document is scored by how many of its
windows pass thresholds of contrast, calibrated on labelled documents that
trained no dictionary.

Letters are written as codes of four fixed random bytes: only whole letters
can match, and a short word is long enough for zstandard to refer to.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WorkerCache, fold, give_back, id_text, text_slices

_WINDOW = re.compile(r"[^\W\d_]{1,64}")
#: Behind and before each window, and in both dictionaries: so even a short block is worth compressing.
FILLER = b"\n" * 16
BINS = 20


@functools.lru_cache(maxsize=65_536)
def letter_code(letter: str) -> bytes:
    return hashlib.blake2b(letter.encode("utf-8", "surrogatepass"), digest_size=4, person=b"letter").digest()


def window_code(window: str) -> bytes:
    return b"".join(map(letter_code, f" {window} "))


def windows_of(text: str) -> list[str]:
    """Runs of letters in lower case; a run of over 64 letters is several windows."""
    return _WINDOW.findall(text.lower())


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    thresholds: tuple[int, ...] = ()  # numbers of bins
    center: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()
    prior: float = 0.0


class Contrast:
    """Contrast of windows, as bins 0 to BINS, with a bounded cache."""

    def __init__(self, model: Model, cache_windows: int = 400_000):
        params = zstandard.ZstdCompressionParameters(
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0,
            strategy=zstandard.STRATEGY_BTULTRA, min_match=4, target_length=64, window_log=20, hash_log=17, chain_log=18, search_log=4)
        self.both = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                                              compression_params=params) for d in (model.ordinary, model.toxic)]
        self.cache_windows = cache_windows
        self.cache: dict[str, int] = {}
        self.nothing = int(self.lengths(0, [FILLER[:4] + FILLER[:12]])[0])

    def lengths(self, which: int, blocks: list[bytes]) -> np.ndarray:
        """Compressed length of each block, in one call."""
        size = np.array([len(b) for b in blocks], dtype="<u8")
        at = np.stack([np.cumsum(size) - size, size], axis=1).astype("<u8")
        out = self.both[which].multi_compress_to_buffer(zstandard.BufferWithSegments(b"".join(blocks), at.tobytes()), threads=1)
        return np.array([len(x) for x in out], dtype=np.int64)

    def bins(self, windows: list[list[str]]) -> list[list[int]]:
        """Bin of every window of each text."""
        if len(self.cache) > self.cache_windows:
            self.cache.clear()
        new = sorted({w for own in windows for w in own}.difference(self.cache))
        for k in range(0, len(new), 20_000):
            part = new[k:k + 20_000]
            blocks = [FILLER[:4] + window_code(w) + FILLER[:12] for w in part]
            a, b = self.lengths(0, blocks), self.lengths(1, blocks)
            saved = np.where(a - b >= 3, (a - b) / np.maximum(a - self.nothing, 1), 0.0)
            self.cache.update(zip(part, np.minimum(saved * BINS, BINS).astype(int).tolist()))
        return [list(map(self.cache.__getitem__, own)) for own in windows]


def dictionaries(ordinary: list[str], toxic: list[str]) -> Model:
    """From windows with the most telling first; those lie last, nearest to the text.
    In the ordinary dictionary, bytes that match nothing stand for the toxic part,
    so distances, and with them lengths, are alike in both."""
    common = b"".join(map(window_code, reversed(ordinary)))
    own = b"".join(map(window_code, reversed(toxic)))
    blank = hashlib.shake_256(b"blank").digest(len(own))
    return Model(common + blank + FILLER, common + own + FILLER)


def features(hist: np.ndarray, top: np.ndarray, thresholds: tuple[int, ...]) -> np.ndarray:
    """hist: windows in each bin; top: the three highest bins of distinct windows."""
    above = np.cumsum(hist[:, ::-1], axis=1)[:, ::-1]
    n = np.maximum(above[:, 0], 1)
    cols = [top[:, 0] / BINS, top[:, 1] / BINS, top[:, 2] / BINS]
    for t in thresholds:
        cols += [np.log1p(above[:, t]), 100 * np.minimum(above[:, t] / n, 0.1)]
    return np.stack(cols, axis=1)


def summary(own: list[str], bins: list[int]) -> tuple[list[int], list[int]]:
    hist = np.bincount(np.array(bins, dtype=np.int64), minlength=BINS + 1).tolist() if bins else [0] * (BINS + 1)
    high = sorted((b for b in dict(zip(own, bins)).values()), reverse=True)[:3] if sum(hist[1:]) else []
    return hist, high + [0] * (3 - len(high))


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights (the last for a constant), by Newton's method with a unit ridge."""
    mu, sd = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mu) / sd, np.ones(len(x))]
    ridge = np.r_[np.ones(x.shape[1]), 1e-6]
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (p - y) + ridge * w)
    return mu, sd, w


def window_counts(labelled: DataFrame) -> DataFrame:
    """(window, n_toxic, n_ordinary): documents with the window, by label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("toxic").to_pylist()
            for start, texts in text_slices(batch, max_chars=8_000_000):
                both = Counter(), Counter()
                for t, y in zip(texts, label[start:]):
                    both[y].update(set(windows_of(t)))
                names = list(both[0].keys() | both[1].keys())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([both[1][w] for w in names], pa.int64()),
                                                  pa.array([both[0][w] for w in names], pa.int64())], names=["window", "n_toxic", "n_ordinary"])

    return (labelled.mapInArrow(run, "window string, n_toxic long, n_ordinary long")
            .groupBy("window").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_ordinary").alias("n_ordinary")))


def train(docs: DataFrame, labels: DataFrame, dictionary_folds: Iterator[int] = (1, 2, 3), calibration_folds: Iterator[int] = (4,),
          max_labels: int = 40_000, ordinary_windows: int = 3_000, toxic_windows: int = 400) -> Model:
    """Dictionaries and thresholds from labelled documents of the given folds
    (crc32 of the id, modulo 5).

    ``max_labels`` bounds the labelled rows used (in the order of a hash of the
    id), so they can be broadcast; ``ordinary_windows`` and ``toxic_windows``
    bound the dictionaries. Null labels are left out; of several labels of one
    document the highest counts.
    """
    t = id_text(docs)
    known = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
             .withColumn("fold", fold(F.col("doc_id"), 5)).where(F.col("fold").isin([*dictionary_folds, *calibration_folds]))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels))
    labelled = t.join(F.broadcast(known), "doc_id")  # at most max_labels rows
    dealt = labelled.where(F.col("fold").isin([*dictionary_folds])).select("toxic", "text")
    n = {y: c for y, c in known.where(F.col("fold").isin([*dictionary_folds])).groupBy("toxic").count().collect()}
    prior = n.get(1, 0) / max(sum(n.values()), 1)
    if not n.get(1) or not n.get(0):
        return Model(FILLER, FILLER, prior=prior)
    counts = window_counts(dealt)
    total = n[0] + n[1]
    share = (F.col("n_toxic") + F.col("n_ordinary")) / total
    surprise = (F.col("n_toxic") - n[1] * share) / F.sqrt(n[1] * share * (1 - share) * n[0] / total + 1e-9)
    odds = ((F.col("n_toxic") + 0.5) / n[1]) / ((F.col("n_ordinary") + 0.5) / n[0])
    rows = counts.withColumn("s", surprise).withColumn("common", F.col("n_ordinary") + F.col("n_toxic"))
    telling = (F.col("s") >= 5) & (F.col("n_toxic") >= 3) & (odds >= 8)
    # two bounded lists in one pass: the most telling and the most common windows
    kept = (rows.where(telling).orderBy(F.desc("s"), "window").limit(toxic_windows).select("window", F.lit(1).alias("kind"), F.col("s").alias("by"))
            .union(rows.where(~telling).orderBy(F.desc("n_ordinary"), "window").limit(ordinary_windows)
                   .select("window", F.lit(0).alias("kind"), F.col("n_ordinary").cast("double").alias("by")))).collect()
    listed = {k: [r["window"] for r in sorted(kept, key=lambda r: (-r["by"], r["window"])) if r["kind"] == k] for k in (0, 1)}
    model = dictionaries(listed[0], listed[1])
    rows = (summaries(labelled.where(F.col("fold").isin([*calibration_folds])), model, ["toxic"])).collect()  # at most max_labels rows
    y = np.array([r["toxic"] for r in rows])
    if not len(rows) or y.min() == y.max():
        return Model(model.ordinary, model.toxic, prior=prior)
    hist, top = np.array([r["hist"] for r in rows]), np.array([r["top"] for r in rows])
    # contrast that 1, 0.3 and 0.1 % of the windows of ordinary documents reach
    tail = np.cumsum(hist[y == 0].sum(axis=0)[::-1])[::-1] / max(hist[y == 0].sum(), 1)
    thresholds = tuple(max(1, next((b for b in range(BINS + 1) if tail[b] <= share), BINS)) for share in (0.01, 0.003, 0.001))
    mu, sd, w = fit_logistic(features(hist, top, thresholds), y.astype(float))
    return Model(model.ordinary, model.toxic, thresholds, tuple(mu), tuple(sd), tuple(w), prior)


_CONTRASTS = WorkerCache()


def _contrast(model: Model) -> Contrast:
    return _CONTRASTS.get_or_make(hashlib.sha256(model.ordinary + model.toxic).digest(), lambda: Contrast(model))


def summaries(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns, hist and top of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _contrast(shared.value)
        for batch in batches:
            for start, texts in text_slices(batch):
                own = [windows_of(t) for t in texts]
                got = [summary(o, b) for o, b in zip(own, con.bins(own))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(start, len(texts)) for c in keep), pa.array([h for h, _ in got], pa.list_(pa.int64())),
                                                  pa.array([t for _, t in got], pa.list_(pa.int64()))], names=[*keep, "hist", "top"])

    d = docs.select(*keep, "text")
    kinds = ", ".join(f"{c} {d.schema[c].dataType.simpleString()}" for c in keep)
    return d.mapInArrow(run, f"{kinds}, hist array<long>, top array<long>")


def probabilities(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of label 1, windows, and windows over the highest threshold of each text."""
    con = _contrast(model)
    own = [windows_of(t) for t in texts]
    got = [summary(o, b) for o, b in zip(own, con.bins(own))]
    hist, top = np.array([h for h, _ in got]), np.array([t for _, t in got])
    if not model.weights:
        return np.full(len(texts), model.prior), hist.sum(axis=1), np.zeros(len(texts), dtype=np.int64)
    x = (features(hist, top, model.thresholds) - np.array(model.center)) / np.array(model.scale)
    p = 1 / (1 + np.exp(-np.clip(x @ np.array(model.weights[:-1]) + model.weights[-1], -30, 30)))
    return p, hist.sum(axis=1), hist[:, model.thresholds[-1]:].sum(axis=1)


def drop_toxic(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns as they are, but those that score ``least`` or more
    (null texts count as empty). One scan, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_text = None
        for batch in batches:
            at_text = batch.schema.get_field_index(text_col) if at_text is None else at_text
            texts = pa.RecordBatch.from_arrays([batch.column(at_text).fill_null("")], names=["text"])
            for start, part in text_slices(texts):
                keep = probabilities(part, shared.value)[0] < least
                yield batch.slice(start, len(part)).filter(pa.array(keep))
        give_back()

    return docs.mapInArrow(run, docs.schema)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted, n_windows, n_above), a row per row of ``docs``.

    score: probability of label 1; n_above: windows over the highest threshold.
    Null texts count as empty: no windows, the score of a text without contrast.
    A model without both labels gives every text the share of label 1. Repeated
    rows score alike; an empty table gives no rows; further columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch):
                p, windows, above = probabilities(texts, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(texts)), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32)),
                     pa.array(windows, pa.int64()), pa.array(above, pa.int64())], names=["doc_id", "score", "predicted", "n_windows", "n_above"])

    t = id_text(docs, id_col, text_col)
    return t.mapInArrow(run, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, score double, predicted int, n_windows long, n_above long")
