"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(mod))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), null texts as empty ones, so further columns can't clash."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def text_slices(batch: pa.RecordBatch, column: str = "text", max_chars: int = 2_000_000):
    """Row ranges of an Arrow batch with about ``max_chars`` characters each: a
    task holds a few megabytes of text at a time, however long documents are
    (one document is never cut)."""
    texts = batch.column(column).to_pylist()
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > max_chars:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, texts[start:]


def give_back() -> None:
    """Memory that is free goes back to the system; allocators keep it else, and workers live as long as their executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):  # another C library
            ctypes.CDLL("libc.so.6").malloc_trim(0)


class WorkerCache(dict):
    """What an operator keeps in a Python worker between tasks, by model. Workers serve one stage after another: when an operator
    starts, what the others have kept goes, so a worker never holds the caches of several."""

    _all: list[WorkerCache] = []

    def __init__(self) -> None:
        super().__init__()
        WorkerCache._all.append(self)

    @staticmethod
    def release() -> None:
        """Empty all caches, and give back the memory that they and earlier batches held: for operators that keep none."""
        for cache in WorkerCache._all:
            cache.clear()
        give_back()

    def get_or_make(self, key, make):
        if key not in self:
            WorkerCache.release()
            self[key] = make()
        return self[key]
