"""Document fingerprints by content-defined chunking.

A gear hash rolls over the UTF-8 bytes; where chosen bits of it are zero, a
chunk may end. Chunking is normalised: up to the usual size more bits must be
zero than after it, so sizes gather around it, between a least and a most.
An edit moves only the borders near it. A fingerprint is the set of chunk
digests with their lengths; containment is the shared length over that of the
smaller set.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, text_slices

#: The gear hash: 32 bits, so a border depends on the last 32 bytes alone.
GEAR = np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=4, person=b"gear").digest() for b in range(256)), dtype="<u4").copy()


@dataclass(frozen=True)
class Sizes:
    """Chunk sizes in bytes; strict and loose: zero bits asked for before and after the usual size."""

    least: int = 16
    usual: int = 48
    most: int = 192
    strict: int = 7
    loose: int = 4


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Hash at every byte: the sum of GEAR[byte] << (distance back), in 32 bits,
    by doubling the window five times."""
    h = GEAR[data]
    for m in (1, 2, 4, 8, 16):
        if len(h) > m:
            h[m:] += h[:-m] << np.uint32(m)
    return h


def chunk_ends(data: bytes, h: np.ndarray, sizes: Sizes) -> list[int]:
    """Ends of the chunks of one text; ``h`` are its bytes' hashes."""
    n = len(data)
    loose = np.flatnonzero(h >> np.uint32(32 - sizes.loose) == 0)
    strict = loose[h[loose] >> np.uint32(32 - sizes.strict) == 0].tolist()
    loose = loose.tolist()
    ends, at = [], 0
    while n - at > sizes.least:
        turn, last = at + sizes.usual, min(at + sizes.most, n)
        k = bisect.bisect_left(strict, at + sizes.least - 1)
        if k < len(strict) and strict[k] + 1 <= min(turn, n):
            at = strict[k] + 1
        else:
            k = bisect.bisect_left(loose, turn)
            at = loose[k] + 1 if k < len(loose) and loose[k] + 1 <= last else last
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def fingerprint(text: str, sizes: Sizes = Sizes()) -> dict[int, int]:
    """Digest -> length of the distinct chunks of a text, in the order of digests."""
    data = text.encode("utf-8", "surrogatepass")
    # the window starts anew with each text
    ends = chunk_ends(data, gear_hashes(np.frombuffer(data, dtype=np.uint8)), sizes)
    out, at = {}, 0
    digest = xxhash.xxh3_64_intdigest
    for e in ends:
        out[digest(data[at:e]) >> 16] = e - at
        at = e
    return dict(sorted(out.items()))


def as_text(fp: dict[int, int]) -> str:
    return ",".join(["%012x:%d" % x for x in fp.items()])


def from_text(s: str) -> dict[int, int]:
    return {int(x[:12], 16): int(x[13:]) for x in s.split(",")} if s else {}


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Shared length over the smaller set's length; two empty sets are alike (1),
    an empty and another one not (0)."""
    if not a or not b:
        return float(not a and not b)
    few, many = (a, b) if len(a) <= len(b) else (b, a)
    shared = sum([n for d, n in few.items() if d in many])
    return shared / min(sum(a.values()), sum(b.values()))


def fingerprint_documents(docs: DataFrame, sizes: Sizes = Sizes(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chunks, fingerprint), a row per row of ``docs``, in one scan.

    Null and empty texts have no chunks and the empty fingerprint; repeated rows
    give repeated rows; an empty table gives no rows; further columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch):
                fps = [fingerprint(t, sizes) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, len(texts)), pa.array([len(f) for f in fps], pa.int64()),
                                                  pa.array([as_text(f) for f in fps], pa.string())], names=["doc_id", "n_chunks", "fingerprint"])

    t = id_text(docs, id_col, text_col)
    return t.mapInArrow(run, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, n_chunks long, fingerprint string")


def bounds_up_to(bounds: list[int], value, strictly: bool = False):
    """How many of the sorted ``bounds`` are at most ``value`` (strictly: below it): first among every s-th
    of them, then among the s that follow, so some hundred comparisons do for ten thousand bounds."""
    s = max(1, math.isqrt(len(bounds)))
    below = (lambda b: b < value) if strictly else (lambda b: b <= value)
    longs = lambda v: F.array(*[F.lit(x).cast("long") for x in v])
    block = F.size(F.filter(longs(bounds[::s]), below))
    rest = F.get(F.array(*[longs(bounds[k:k + s]) for k in range(0, len(bounds), s)]), block - 1)
    return F.when(block > 0, (block - 1) * s + F.size(F.filter(rest, below))).otherwise(0).cast("long")


def in_ranges(t: DataFrame, n_ranges: int) -> DataFrame:
    """Deal (doc_id, text) out by ranges of ids, each also with the first
    document of the following range (own = false; the table's first one for the
    last range), so that every own document finds its successor in its range.

    Ranges lie between quantiles of the ids, whatever their values are; an id in more rows
    than a range is cut by a hash of the text, which is also the order of its rows. Null ids
    come first. One text a range is copied.
    """
    spark = t.sparkSession
    least = -(1 << 63)
    i = F.coalesce(F.col("doc_id"), F.lit(least).cast("long"))
    points = [k / n_ranges for k in range(1, n_ranges)]
    found = t.agg(F.percentile_approx(i, points, max(10_000, 4 * n_ranges)).alias("q")).first()["q"] if points else None
    bounds = sorted(found or [])
    x = t.withColumn("tie", F.xxhash64("text"))
    if bounds:
        upto, below = bounds_up_to(bounds, i), bounds_up_to(bounds, i, strictly=True)
        share = F.col("tie") / F.lit(2.0 ** 64) + F.lit(0.5)
        x = x.withColumns({"upto": upto, "below": below})
        many = F.col("upto") - F.col("below")
        cut = F.col("below") + 1 + F.least(F.floor(share * many), many - 1)
        x = x.withColumn("range", F.when(many > 1, cut).otherwise(F.col("upto")).cast("long"))
    else:
        x = x.withColumn("range", F.lit(0).cast("long"))
    x = x.select("range", "doc_id", "tie", "text")
    starts = sorted((tuple(r) for r in x.groupBy("range").agg(F.min(F.struct("doc_id", "tie")).alias("f")).select("range", "f.doc_id", "f.tie").collect()))
    to = [(r, i, k, starts[j - 1][0]) for j, (r, i, k) in enumerate(starts)]  # a row a range
    lend = F.broadcast(spark.createDataFrame(to, "range long, first_id long, first_tie long, lend_to long"))
    own = F.struct(F.col("range"), F.lit(True).alias("own"))
    lent = F.struct(F.col("lend_to").alias("range"), F.lit(False).alias("own"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("tie") == F.col("first_tie"))
    return (x.join(lend, "range").withColumn("to", F.explode(F.when(is_first, F.array(own, lent)).otherwise(F.array(own))))
            .select("to.range", "to.own", "doc_id", "tie", "text")
            .repartition("range").sortWithinPartitions("range", F.desc("own"), "doc_id", "tie"))


def compare_with_edits(docs: DataFrame, sizes: Sizes = Sizes(), id_col: str = "doc_id", text_col: str = "text",
                       n_ranges: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next), a row per row of ``docs``.

    The edited text has the last floor(n_chars / 2) code points replaced by as
    many first ones of the next document (or all it has), in ascending order of
    (doc_id, hash of the text), the first one following the last. near_*: the
    containment of the fingerprints. Null and empty texts have the empty
    fingerprint; repeated rows follow each other; a table of one row is its own
    successor; an empty table gives no rows; further columns are ignored.
    """
    t = id_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    n = n_ranges or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def edited_row(doc: tuple, nxt: tuple) -> tuple:
        _, _, i, text, fp = doc
        half = len(text) // 2
        new = text[:len(text) - half] + nxt[3][:half]
        new_fp = fingerprint(new, sizes)
        return (i, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), as_text(fp), as_text(new_fp),
                containment(fp, new_fp), containment(fp, nxt[4]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, out, size = None, [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for batch in batches:
            ranges, owns, ids = (batch.column(c).to_pylist() for c in ("range", "own", "doc_id"))
            for start, texts in text_slices(batch):
                for k, text in enumerate(texts, start):
                    now = (ranges[k], owns[k], ids[k], text, fingerprint(text, sizes))
                    # a lent row ends its range; what it lent is the successor of the last own row
                    if before is not None and before[0] == now[0] and before[1]:
                        out.append(edited_row(before, now))
                        size += len(before[3])
                    before = now
                    if size > 1_000_000:
                        yield flush()
                        out, size = [], 0
        if out:
            yield flush()

    return in_ranges(t, n).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                           "edited_fingerprint string, near_edited double, near_next double")
