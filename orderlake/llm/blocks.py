"""Blocks of tokenised documents, and counts of n-grams exchanged between them.

Counting every n-gram of a large corpus by a row each would shuffle far more
than the text. Here documents are packed into blocks of about a million
words; a block sends each distinct n-gram once, as a 64-bit hash, to the
bucket that owns its part of the hash range, and gets back totals in the same
order. A very common n-gram is one entry a block, so no bucket is hot; the
number of buckets follows the number of words. The keys a block sends to a
bucket are sorted, so they travel as differences.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import WorkerCache, give_back, text_slices

BLOCK_SCHEMA = ("block string, doc_ids array<{kind}>, role int, lengths array<int>, n_words long, vocab binary, words binary")
ROWS_SCHEMA = "ord int, bucket int, block string, n int, keys binary, counts array<binary>"
TOTALS_SCHEMA = "ord int, block string, bucket int, n int, types long, totals array<binary>"


class _Numbers(dict):
    """Numbers words in the order in which they first come."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


class _Open:
    """A block that is being filled; all its documents have one role, which its name begins with."""

    def __init__(self, role: int):
        self.role, self.numbers, self.parts, self.ids, self.lengths, self.total = role, _Numbers(), [], [], [], 0

    def add(self, doc_id: int | None, text: str) -> None:
        w = text.encode("utf-8", "surrogatepass").lower().split()
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, w), dtype="<u4", count=len(w)))
        self.ids.append(doc_id)
        self.lengths.append(len(w))
        self.total += len(w)

    def close(self, id_type: pa.DataType) -> pa.RecordBatch:
        vocab = np.fromiter(map(xxhash.xxh3_64_intdigest, self.numbers), dtype="<u8", count=len(self.numbers))
        return pa.RecordBatch.from_arrays(
            [pa.array([f"{self.role}-{uuid.uuid4().hex}"]), pa.array([self.ids], pa.list_(id_type)), pa.array([self.role], pa.int32()),
             pa.array([self.lengths], pa.list_(pa.int32())), pa.array([self.total], pa.int64()), pa.array([vocab.tobytes()], pa.binary()),
             pa.array([squeeze(smallest(np.concatenate(self.parts)))], pa.binary())],
            names=["block", "doc_ids", "role", "lengths", "n_words", "vocab", "words"])


def squeeze(a: np.ndarray) -> bytes:
    """An integer array, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return bytes([a.itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(data: bytes, n: int) -> np.ndarray:
    size = data[0]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=np.uint8) if n else np.empty(0, dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(f"<u{size}").reshape(n)


def smallest(a: np.ndarray) -> np.ndarray:
    most = int(a.max()) if len(a) else 0
    return a.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8")


def make_blocks(docs: DataFrame, block_words: int = 1_000_000) -> DataFrame:
    """``docs``: doc_id, text, role (a small number; a block holds one role). Words are runs of other than space and
    \\t-\\r, A-Z in lower case; a text is split whole, whatever its length."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        WorkerCache.release()
        open_: dict[int, _Open] = {}
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            ids, roles = batch.column("doc_id").to_pylist(), batch.column("role").to_pylist()
            for start, texts in text_slices(batch):
                for k, text in enumerate(texts, start):
                    o = open_.setdefault(roles[k], _Open(roles[k]))
                    o.add(ids[k], text)
                    if o.total >= block_words:
                        yield o.close(id_type)
                        del open_[roles[k]]
        for o in open_.values():
            yield o.close(id_type)
        open_.clear()
        give_back()

    return cut_lineage(docs.select("doc_id", "text", "role").mapInArrow(run, BLOCK_SCHEMA.format(kind=kind)), "blocks")


def block_words(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words of each document) of a block."""
    vocab = np.frombuffer(row["vocab"], dtype="<u8")
    return vocab[unsqueeze(row["words"], row["n_words"])] if row["n_words"] else np.empty(0, dtype="<u8"), np.array(row["lengths"], dtype=np.int64)


def mix(h: np.ndarray) -> np.ndarray:
    """Stir the bits of 64-bit hashes (multiplications with odd constants and shifts)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def join_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a sequence made longer by one."""
    return mix(a * np.uint64(0x2545F4914F6CDD1D) + b)


def n_buckets(n_entries: int, per_bucket: int = 1_500_000) -> int:
    return max(1, -(-n_entries // per_bucket))


def key_bits(n_entries: int) -> int:
    """Bits kept of a key: 24 more than would number the entries, so a false
    match has a chance below 1 in 16 million for any entry."""
    return min(64, max(32, int(n_entries).bit_length() + 24))


def shorten(h: np.ndarray, bits: int) -> np.ndarray:
    return h >> np.uint64(64 - bits) << np.uint64(64 - bits) if bits < 64 else h


def send_rows(order: int, block: str, keys: np.ndarray, counts: list[np.ndarray], buckets: int, bits: int) -> pa.RecordBatch:
    """A row for each bucket; ``keys`` are sorted and distinct."""
    width = (1 << 64) // buckets + 1
    cut = np.searchsorted(keys, np.array([min(b * width, (1 << 64) - 1) for b in range(1, buckets)], dtype=np.uint64)).tolist()
    cols: list[list] = [[], [], [], [], [], []]
    for b, (s, e) in enumerate(zip([0, *cut], [*cut, len(keys)])):
        if e > s:
            k = keys[s:e] >> np.uint64(64 - bits)
            for c, v in zip(cols, (order, b, block, e - s, squeeze(np.diff(k, prepend=np.uint64(0)).astype("<u8")), [squeeze(smallest(x[s:e])) for x in counts])):
                c.append(v)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.list_(pa.binary())))],
                                      names=["ord", "bucket", "block", "n", "keys", "counts"])


def read_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unsqueeze(data, n), dtype=np.uint64)


def total_up(rows: DataFrame, name: str) -> DataFrame:
    """Totals of each key over all blocks, sent back in each block's order. types:
    distinct keys of the bucket whose summed counts aren't all zero (on one of its rows)."""
    def totals(group: list[dict]) -> pa.RecordBatch:
        keys = np.concatenate([read_keys(r["keys"], r["n"]) for r in group])
        order = np.argsort(keys)
        new = np.r_[True, np.diff(keys[order]) != 0]
        number = np.empty(len(keys), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        sums = [np.bincount(number, weights=np.concatenate([unsqueeze(r["counts"][c], r["n"]) for r in group])).astype(np.int64)
                for c in range(len(group[0]["counts"]))]
        types, at, back = int((sum(sums) > 0).sum()), 0, []
        for r in group:
            own = number[at:at + r["n"]]
            back.append([squeeze(smallest(s[own])) for s in sums])
            at += r["n"]
        return pa.RecordBatch.from_arrays(
            [pa.array([r["ord"] for r in group], pa.int32()), pa.array([r["block"] for r in group], pa.string()), pa.array([r["bucket"] for r in group], pa.int32()),
             pa.array([r["n"] for r in group], pa.int32()), pa.array([types] + [0] * (len(group) - 1), pa.int64()), pa.array(back, pa.list_(pa.binary()))],
            names=["ord", "block", "bucket", "n", "types", "totals"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                if group and (group[0]["ord"], group[0]["bucket"]) != (r["ord"], r["bucket"]):
                    yield totals(group)
                    group = []
                group.append(r)
        if group:
            yield totals(group)

    return cut_lineage(rows.repartition("ord", "bucket").sortWithinPartitions("ord", "bucket").mapInArrow(run, TOTALS_SCHEMA), name)


def with_totals(blocks: DataFrame, totals: DataFrame) -> DataFrame:
    """Each block with the totals of its keys: ``back``, an array by (ord, bucket)."""
    t = totals.groupBy("block").agg(F.collect_list(F.struct("ord", "bucket", "n", "totals")).alias("back"))
    return blocks.join(t, "block", "left")


def totals_of(row: dict, order: int, which: int) -> np.ndarray:
    """Totals of a block's keys of one order, in the order of the keys."""
    parts = sorted(((r["bucket"], r) for r in row["back"] or [] if r["ord"] == order), key=lambda x: x[0])
    return np.concatenate([unsqueeze(r["totals"][which], r["n"]).astype(np.int64) for _, r in parts]) if parts else np.empty(0, dtype=np.int64)


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]
