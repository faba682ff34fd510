"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``2**ring_bits`` places. Every shard owns ``vnodes`` places
(hashes of its number); a document's place comes from the hash of its id and
it belongs to the first virtual node clockwise. No shard may hold more than
``(1 + epsilon)`` times the mean bytes: what doesn't fit goes on clockwise to
the next virtual node whose shard has room. So sizes are near equal, and a
changed number of shards moves little beyond what the new shard takes.

Documents of one place move together. The loads of the places are summed in
Spark; the walk over the ring needs only these sums, at most ``2**ring_bits``
rows (a fixed bound, whatever the number of documents), and the resulting map
place -> shard is joined back by broadcast under the same bound.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import id_text

#: Added to the UTF-8 bytes of each text: the stored id.
ROW_BYTES = 8


def ring(n_shards: int, vnodes: int, ring_bits: int) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, clockwise."""
    def place(s: int, v: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"shard {s} node {v}".encode(), digest_size=8).digest(), "big") >> (64 - ring_bits)
    return sorted((place(s, v), s) for s in range(n_shards) for v in range(vnodes))


def place_loads(loads: list[tuple[int, int]], n_shards: int, vnodes: int = 64, ring_bits: int = 15,
                epsilon: float = 0.002) -> dict[int, int]:
    """Shard of each place, from (place, bytes). Larger places choose first (ties:
    the lower place), so late ones, which find few shards with room, are small.
    If a place fits nowhere (it alone exceeds what any shard has left), the
    emptiest shard takes it."""
    nodes = ring(n_shards, vnodes, ring_bits)
    places = [p for p, _ in nodes]
    capacity = (1 + epsilon) * sum(b for _, b in loads) / n_shards
    used, out = [0] * n_shards, {}
    for p, b in sorted(loads, key=lambda x: (-x[1], x[0])):
        k, tried = bisect.bisect_left(places, p), set()
        while len(tried) < n_shards:
            s = nodes[k % len(nodes)][1]
            if s not in tried and used[s] + b <= capacity:
                break
            tried.add(s)
            k += 1
        else:
            s = min(range(n_shards), key=lambda x: (used[x], x))
        used[s] += b
        out[p] = s
    return out


def assign_shards(docs: DataFrame, n_shards: int = 24, vnodes: int = 64, ring_bits: int = 15, epsilon: float = 0.002,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), a row for each row of ``docs``.

    size: UTF-8 bytes of the text plus 8; slot: 0, 1, ... within the shard, by
    place, then id. Null and empty texts weigh 8 bytes and have checksum 0; null
    ids share one place; repeated rows get slots of their own, rows that share
    an id share a shard; an empty table gives no rows; further columns of
    ``docs`` are ignored. Balance is limited by the largest single place: an id
    repeated in more rows than a shard's share stays whole.
    """
    t = id_text(docs, id_col, text_col)
    slim = cut_lineage(t.select(
        "doc_id", (F.octet_length("text") + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - ring_bits).cast("int").alias("place"),
    ), "shard-rows")
    # at most 2**ring_bits rows
    loads = [tuple(r) for r in slim.groupBy("place").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()]
    shard_of = place_loads([(p, b) for p, b, _ in loads], n_shards, vnodes, ring_bits, epsilon)
    first, filled = [], [0] * n_shards
    for p, _, n in sorted(loads):
        first.append((p, shard_of[p], filled[shard_of[p]]))
        filled[shard_of[p]] += n
    where = slim.sparkSession.createDataFrame(first, "place int, shard int, first long")
    rank = F.row_number().over(Window.partitionBy("place").orderBy("doc_id", "text_crc32", "size"))
    return (slim.withColumn("rank", rank).join(F.broadcast(where), "place")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("rank") - 1).alias("slot")))
