"""Near-duplicate embeddings by a robust-pruned flat graph.

Vectors are dealt to overlapping shards around cluster centres. Each shard builds a flat
graph by insertion: batch after batch of vectors searches the graph that is there,
and is joined to what it finds, pruned so that no neighbour is much closer to
another neighbour; a second round goes over the whole. The adjacency lists of all shards are
united per vector and sent back.

Every vector then searches the united graph greedily, from the medoids of its shards
and its own neighbours, and goes on expanding as long as vectors in range turn up. Where the
lists lead out of the shards that it has visited, the search is continued there: the vector
is sent to the shards of the neighbours that it would expand, as a guest, round by
round until nothing leads further. What is reached is verified in double precision.

A pair with common shards is counted in the first of them only, so links are summed up per
vector where they are found and a large group sends a row a vector, not a row a pair.
Recall is audited against brute force for a stated set of vectors, by the number of their links, so a
large group can't hide small ones; while it is too low, the search keeps more and visits more
shards, and at last all pairs of vectors are compared.

Equal vectors are one node with a number of copies. A shard larger than ``max_cell`` is cut into
blocks, and each pair of blocks is a cell of its own, so tasks stay small and no pair of a shard is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import components


@dataclass(frozen=True)
class Search:
    """radius: cosine of a link; beam: nearest vectors that a search keeps; slack: vectors so far below the radius are expanded
    too; entries: medoids to begin with; probes: shards beyond its own that a vector visits for its nearest vectors' neighbours;
    degree: neighbours after pruning; alpha: how much closer a neighbour's neighbour must be to be left out."""
    radius: float
    beam: int = 24
    slack: float = 0.05
    entries: int = 8
    probes: int = 4
    degree: int = 16
    alpha: float = 1.2


def unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centers(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means of a sample, from seeds spread by their distance to earlier ones."""
    rng = np.random.default_rng(3)
    seeds = [int(rng.integers(len(x)))]
    far = 1 - x @ x[seeds[0]]
    while len(seeds) < min(k, len(x)):
        w = np.maximum(far, 0) + 1e-12
        seeds.append(int(rng.choice(len(x), p=w / w.sum())))
        far = np.minimum(far, 1 - x @ x[seeds[-1]])
    c = x[seeds]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 1e-9, total / np.maximum(norm, 1e-9), c)
    return c


def dots(x: np.ndarray, i: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Cosines of x[i] and q[r], some at a time."""
    return np.concatenate([np.einsum("ij,ij->i", x[i[k:k + 200_000]], q[r[k:k + 200_000]]) for k in range(0, len(i), 200_000)]) if len(i) else np.zeros(0)


def padded(row: np.ndarray, value: np.ndarray, rows: int, fill) -> np.ndarray:
    """Values of sorted ``row`` numbers as a matrix."""
    count = np.bincount(row, minlength=rows)
    out = np.full((rows, max(1, int(count.max(initial=0)))), fill, dtype=value.dtype)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)] = value
    return out


def beam_search(x: np.ndarray, lists: np.ndarray, q: np.ndarray, entry: np.ndarray, s: Search, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each of the queries ``q``: which vectors of ``x`` it reaches in range, as a table of truth values, and its
    nearest ones reached, best first (-1: none).

    ``lists``: neighbours, ``entry``: where each query begins (-1: none); ``own``: the query's own
    number, which it doesn't find. All queries go side by side: in a round each expands some of its best
    vectors not yet expanded, and some of those in range.
    """
    m, n = len(q), len(x)
    seen, done, near, wide = (np.zeros((m, n), dtype=bool) for _ in range(4))
    ids, sims = np.full((m, s.beam), -1, dtype=np.int64), np.full((m, s.beam), -2.0)
    if own is not None:
        seen[np.arange(m), own] = done[np.arange(m), own] = True

    def meet(r: np.ndarray, i: np.ndarray) -> None:
        nonlocal ids, sims
        hit = np.zeros((m, n), dtype=bool)
        hit[r, i] = True
        r, i = np.nonzero(hit & ~seen)
        seen[r, i] = True
        c = dots(x, i, q, r)
        near[r, i], wide[r, i] = c >= s.radius, c >= s.radius - s.slack
        good = c > sims[r, -1]  # better than the worst of the nearest so far
        more, value = padded(r[good], i[good], m, -1), padded(r[good], c[good], m, -2.0)
        ids, sims = np.concatenate([ids, more], axis=1), np.concatenate([sims, value], axis=1)
        best = np.argsort(-sims, axis=1, kind="stable")[:, :s.beam]
        ids, sims = np.take_along_axis(ids, best, axis=1), np.take_along_axis(sims, best, axis=1)

    r, e = np.nonzero(entry >= 0)
    meet(r, entry[r, e])
    while True:
        row = np.arange(m)[:, None]
        fresh = (ids >= 0) & ~done[row, ids]
        fresh &= np.cumsum(fresh, axis=1) <= 4
        r, e = np.nonzero(fresh)
        i = ids[r, e]
        r2, i2 = np.nonzero(wide & ~done)
        if len(r2):
            nth = np.arange(len(r2)) - np.searchsorted(r2, r2)
            r, i = np.r_[r, r2[nth < 64]], np.r_[i, i2[nth < 64]]
        if not len(r):
            return near, ids
        done[r, i] = True
        to = lists[i]
        k, e = np.nonzero(to >= 0)
        meet(r[k], to[k, e])


def robust_prune(x: np.ndarray, q: np.ndarray, pools: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Of each query's pool (numbers in ``x``, -1 for none), up to ``degree`` neighbours: the nearest
    left is taken, and those that it is ``alpha`` times closer to than the query itself drop out."""
    out = np.full((len(pools), degree), -1, dtype=np.int64)
    for k in range(0, len(pools), 256):
        pool = pools[k:k + 256]
        v = x[pool]
        dist = np.where(pool >= 0, 1 - np.einsum("ncd,nd->nc", v, q[k:k + 256]), np.inf)
        order = np.argsort(dist, axis=1, kind="stable")
        pool, dist, v = np.take_along_axis(pool, order, axis=1), np.take_along_axis(dist, order, axis=1), np.take_along_axis(v, order[:, :, None], axis=1)
        left, rows = np.isfinite(dist), np.arange(len(pool))
        for d in range(degree):
            has = left.any(axis=1)
            if not has.any():
                break
            first = left.argmax(axis=1)
            out[k:k + 256][has, d] = pool[rows, first][has]
            left &= ~(alpha * (1 - np.einsum("ncd,nd->nc", v, v[rows, first])) <= dist)
            left[rows, first] = False
    return out


def medoids(x: np.ndarray, count: int) -> np.ndarray:
    """The vector nearest to the mean, then each time the one farthest from those chosen."""
    out = [int((x @ x.mean(axis=0)).argmax())]
    near = x @ x[out[0]]
    while len(out) < min(count, len(x)):
        out.append(int(near.argmin()))
        near = np.maximum(near, x @ x[out[-1]])
    return np.array(out)


def both_ways(x: np.ndarray, lists: np.ndarray, s: Search) -> np.ndarray:
    """Lists with the way back; those of more than twice the degree are pruned again."""
    n = len(lists)
    a, d = np.nonzero(lists >= 0)
    code = np.unique(np.r_[a * n + lists[a, d], lists[a, d] * n + a])
    out = padded(code // n, code % n, n, -1)
    if out.shape[1] > 2 * s.degree:
        long = np.flatnonzero((out >= 0).sum(axis=1) > 2 * s.degree)
        kept = robust_prune(x, x[long], out[long], 2 * s.degree, s.alpha)
        out = out[:, :2 * s.degree]
        out[long] = kept
    return out


def build_graph(x: np.ndarray, s: Search) -> np.ndarray:
    """Neighbours of each vector of a cell, both ways, by insertion in a random order."""
    n = len(x)
    if n < 2:
        return np.full((n, 1), -1, dtype=np.int64)
    order = np.random.default_rng(5).permutation(n)
    y, s = x[order], replace(s, radius=2.0, slack=0.0)  # no range: only the nearest are looked for
    a = min(n, 2 * s.degree)
    pools = np.tile(np.arange(a), (a, 1))
    pools[np.arange(a), np.arange(a)] = -1
    lists = both_ways(y[:a], robust_prune(y[:a], y[:a], pools, s.degree, s.alpha), s)
    while a < n:
        b = min(n, a + max(16, a // 2))
        first = np.tile(medoids(y[:a], s.entries), (b - a, 1))
        _, found = beam_search(y[:a], lists, y[a:b], first, s)
        new = robust_prune(y[:a], y[a:b], found, s.degree, s.alpha)
        wide = max(lists.shape[1], new.shape[1])
        lists = np.concatenate([np.pad(t, ((0, 0), (0, wide - t.shape[1])), constant_values=-1) for t in (lists, new)])
        lists = both_ways(y[:b], lists, s)
        a = b
    # once more for all: those of one batch find each other through the vectors that both are joined to
    _, found = beam_search(y, lists, y, np.concatenate([np.tile(medoids(y, s.entries), (n, 1)), lists], axis=1), s, own=np.arange(n))
    lists = both_ways(y, robust_prune(y, y, np.concatenate([found, lists], axis=1), s.degree, s.alpha), s)
    out = np.empty_like(lists)
    out[order] = np.where(lists >= 0, order[lists], -1)
    return out


def groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[list[dict]]:
    """Rows of a sorted partition, cell by cell."""
    group: list[dict] = []
    for batch in batches:
        for r in batch.to_pylist():
            if group and any(group[0][k] != r[k] for k in key):
                yield group
                group = []
            group.append(r)
    if group:
        yield group


def by_cell(rows: DataFrame, key: list[str], fn: Callable, schema: str) -> DataFrame:
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(lambda b: (out for g in groups(b, key) for out in fn(g)), schema)


def deal(nodes: DataFrame, centers: np.ndarray, overlap: int, offset: int) -> DataFrame:
    """(node, copies, embedding, shards): the shards of each vector's nearest centres, nearest first."""
    shared = nodes.sparkSession.sparkContext.broadcast(centers)
    kind = nodes.schema["embedding"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            if batch.num_rows:
                near = np.argsort(-(unit(batch.column("embedding").to_pylist()) @ c.T), axis=1, kind="stable")[:, :min(overlap, len(c))] + offset
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.tolist(), pa.list_(pa.int32()))], names=["node", "copies", "embedding", "shards"])

    return nodes.select("node", "copies", "embedding").mapInArrow(run, f"node long, copies long, embedding {kind}, shards array<int>")


def into_blocks(dealt: DataFrame, max_cell: int) -> DataFrame:
    """(shard, own, n, node, copies, embedding, shards): a row for each shard of a vector; n: blocks that the shard is cut into, own: the vector's."""
    half = max(1, max_cell // 2)
    rows = dealt.withColumn("shard", F.explode("shards"))
    sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("size"))  # a row for each shard
    n = F.when(F.col("size") <= max_cell, 1).otherwise(F.ceil(F.col("size") / half)).cast("int")
    return rows.join(sizes.select("shard", n.alias("n")), "shard").withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))


def into_cells(blocks: DataFrame) -> DataFrame:
    """A cell for each pair of a shard's blocks, or for its only one."""
    other = F.when(F.col("n") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda k: k != F.col("own")))
    x = blocks.withColumn("other", F.explode(other))
    return x.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other")


CELL = ["shard", "lo", "hi"]


class Cell:
    """Vectors of a cell, by number."""

    def __init__(self, rows: list[dict]):
        self.ids = np.array([r["node"] for r in rows])
        self.x = unit([r["embedding"] for r in rows])
        self.copies = np.array([r["copies"] for r in rows])
        self.shard, self.n = rows[0]["shard"], rows[0]["n"]
        self.own = np.array([r["own"] for r in rows])
        width = max(len(r["shards"]) for r in rows)
        self.shards = np.array([r["shards"] + [-(1 << 30) - 1] * (width - len(r["shards"])) for r in rows], dtype=np.int64)
        self.order = np.argsort(self.ids)

    def numbers(self, nodes: list[list[int]]) -> np.ndarray:
        """Lists of nodes as a table of numbers, -1 where a node isn't here."""
        row = np.repeat(np.arange(len(nodes)), [len(v) for v in nodes])
        want = np.array([v for own in nodes for v in own], dtype=np.int64)
        at = np.minimum(np.searchsorted(self.ids, want, sorter=self.order), len(self.ids) - 1)
        at = self.order[at]
        here = self.ids[at] == want
        return padded(row[here], at[here], len(nodes), -1)

    def counted(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs that count here: this is the first shard of those common to both, and the cell the one for pairs of their block."""
        first = np.empty(len(a), dtype=bool)
        for k in range(0, len(a), 100_000):
            x, y = self.shards[a[k:k + 100_000]], self.shards[b[k:k + 100_000]]
            common = np.where((x[:, :, None] == y[:, None, :]).any(axis=2) & (x > -(1 << 30)), x, np.iinfo(np.int64).max)
            first[k:k + 100_000] = common.min(axis=1) == self.shard
        if self.n > 1:
            lo, hi = self.own.min(), self.own.max()
            after = (self.own[a] + 1) % self.n
            first &= (self.own[a] != self.own[b]) | (np.minimum(self.own[a], after) == lo) & (np.maximum(self.own[a], after) == hi)
        return first

    def summed(self, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per vector: copies of the vectors linked here, and the smallest node that links in the cell lead to."""
        a, b = np.nonzero(near | near.T)
        mine = self.counted(a, b)
        more = np.bincount(a[mine], weights=self.copies[b[mine]], minlength=len(self.ids)).astype(np.int64)
        label = self.ids.copy()
        while True:
            new = label.copy()
            np.minimum.at(new, a, label[b])
            if (new == label).all():
                return more, label
            label = new


FOUND = "node long, more long, label long, shard int, entries array<long>"


def found_rows(cell: Cell, more: np.ndarray, label: np.ndarray, onward: list[tuple[int, int, list[int]]]) -> pa.RecordBatch:
    """A row a vector with what it has found, and a row for each shard that it goes on to."""
    n, go = len(cell.ids), len(onward)
    return pa.RecordBatch.from_arrays([
        pa.array([*cell.ids.tolist(), *(o[0] for o in onward)], pa.int64()), pa.array([*more.tolist(), *[None] * go], pa.int64()),
        pa.array([*label.tolist(), *[None] * go], pa.int64()), pa.array([*[None] * n, *(o[1] for o in onward)], pa.int32()),
        pa.array([*[None] * n, *(o[2] for o in onward)], pa.list_(pa.int64()))], names=["node", "more", "label", "shard", "entries"])


def ways_out(query: np.ndarray, visited: list[list[int]], near: np.ndarray, top: np.ndarray, lists: list[list[dict]], probes: int) -> list[tuple[int, int, list[int]]]:
    """(query, shard, entries): shards not visited yet to which lists of a query's vectors in range lead, and of its nearest those with most ways."""
    out = []
    for k, q in enumerate(query.tolist()):
        gone = set(visited[k])
        ways: dict[int, set[int]] = {}
        for i in np.flatnonzero(near[k]).tolist():
            for v in lists[i]:
                if v["home"] not in gone:
                    ways.setdefault(v["home"], set()).add(v["node"])
        votes: dict[int, set[int]] = {}
        for i in top[k].tolist() if probes else []:
            for v in lists[i] if i >= 0 else []:
                if v["home"] not in gone and v["home"] not in ways:
                    votes.setdefault(v["home"], set()).add(v["node"])
        for home in sorted(votes, key=lambda h: (-len(votes[h]), h))[:probes]:
            ways[home] = votes[home]
        out += [(q, home, sorted(nodes)[:16]) for home, nodes in ways.items()]
    return out


def search_graph(dealt: DataFrame, s: Search, max_cell: int) -> tuple[DataFrame, DataFrame]:
    """((node, more), (a, b)): what each node is linked to, counted with copies; links that have the same components as all that were found."""
    spark = dealt.sparkSession
    blocks = cut_lineage(into_blocks(dealt, max_cell), "graph-members")
    cells = into_cells(blocks)

    def build(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        cell = Cell(rows)
        lists = build_graph(cell.x, s)
        near = [[{"node": int(cell.ids[j]), "home": int(cell.shards[j, 0])} for j in own[own >= 0]] for own in lists]
        yield pa.RecordBatch.from_arrays([pa.array(cell.ids), pa.array(near, pa.list_(pa.struct([("node", pa.int64()), ("home", pa.int32())])))], names=["node", "near"])

    united = cut_lineage(by_cell(cells, CELL, build, "node long, near array<struct<node: long, home: int>>").groupBy("node")
                         .agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph-lists")

    def local(cell: Cell, rows: list[dict]) -> tuple[list[list[dict]], np.ndarray]:
        full = [r["near"] or [] for r in rows]
        return full, cell.numbers([[v["node"] for v in own] for own in full])

    def search(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        cell = Cell(rows)
        full, lists = local(cell, rows)
        n = len(rows)
        begin = np.concatenate([np.tile(medoids(cell.x, s.entries), (n, 1)), lists], axis=1)
        near, top = beam_search(cell.x, lists, cell.x, begin, s, own=np.arange(n))
        more, label = cell.summed(near)
        home = cell.shards[:, 0] == cell.shard  # the home shard sends a vector to others
        go = np.flatnonzero(home)
        yield found_rows(cell, more, label, ways_out(cell.ids[go], cell.shards[go].tolist(), near[go], top[go, :4], full, s.probes))

    found = cut_lineage(by_cell(cells.join(united, "node", "left"), CELL, search, FOUND), "graph-found")
    counts = found.where("more is not null").groupBy("node").agg(F.sum("more").alias("more"))
    edges = found.where("label <> node").select(F.col("node").alias("a"), F.col("label").alias("b"))

    def visit(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        members, guests = [r for r in rows if r["entries"] is None], [r for r in rows if r["entries"] is not None]
        if not members:
            return
        cell = Cell(members)
        full, lists = local(cell, members)
        inside = {int(i) for i in cell.ids}
        first = medoids(cell.x, s.entries)
        for k in range(0, len(guests), 512):
            some = [g for g in guests[k:k + 512] if g["node"] not in inside]
            if not some:
                continue
            begin = np.concatenate([np.tile(first, (len(some), 1)), cell.numbers([g["entries"] for g in some])], axis=1)
            near, _ = beam_search(cell.x, lists, unit([g["embedding"] for g in some]), begin, s)
            query = np.array([g["node"] for g in some])
            home = [{*g["own_shards"]} for g in some]
            r, i = np.nonzero(near)
            apart = np.array([home[a].isdisjoint(cell.shards[b].tolist()) for a, b in zip(r.tolist(), i.tolist())], dtype=bool)
            r, i = r[apart], i[apart]
            onward = ways_out(query, [g["shards"] for g in some], near, np.full((len(some), 1), -1), full, 0)
            yield pa.RecordBatch.from_arrays([
                pa.array([*query[r].tolist(), *(o[0] for o in onward)], pa.int64()), pa.array([*cell.ids[i].tolist(), *[None] * len(onward)], pa.int64()),
                pa.array([*[None] * len(r), *(o[1] for o in onward)], pa.int32()), pa.array([*[None] * len(r), *(o[2] for o in onward)], pa.list_(pa.int64()))],
                names=["a", "b", "shard", "entries"])

    # guests: vectors on their way to shards that they haven't visited; (node, visited) grows round by round
    way = found.where("shard is not null").groupBy("node", "shard").agg(F.slice(F.array_distinct(F.flatten(F.collect_list("entries"))), 1, 16).alias("entries"))
    way = cut_lineage(way, "graph-ways")
    visited = dealt.select("node", F.col("shards").alias("visited"))
    pairs = None
    while way.limit(1).count():
        gone = cut_lineage(visited.join(way.groupBy("node").agg(F.collect_set("shard").alias("new")), "node", "left")
                           .select("node", F.array_union("visited", F.coalesce("new", F.array().cast("array<int>"))).alias("visited")), "graph-visited")
        about = dealt.select("node", "embedding", F.col("shards").alias("own_shards")).join(gone, "node")
        crowd = way.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / 4_096).cast("int").alias("slices"))
        sizes = blocks.select("shard", "n").distinct().join(crowd, "shard")
        guests = (way.join(about, "node").join(sizes, "shard")
                  .select("shard", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("own"), F.pmod(F.xxhash64("node"), F.col("slices")).cast("int").alias("slice"),
                          "node", "embedding", F.col("visited").alias("shards"), "entries", "own_shards"))
        hosts = (blocks.join(crowd, "shard").join(united, "node", "left")
                 .select("shard", "own", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "node", "embedding", "copies", "n", "shards", "near"))
        met = cut_lineage(by_cell(hosts.unionByName(guests, allowMissingColumns=True), ["shard", "own", "slice"], visit,
                                  "a long, b long, shard int, entries array<long>"), "graph-visits")
        new = met.where("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = new if pairs is None else pairs.unionByName(new)
        visited = gone
        onward = met.where("shard is not null").groupBy(F.col("a").alias("node"), "shard").agg(
            F.slice(F.array_distinct(F.flatten(F.collect_list("entries"))), 1, 16).alias("entries"))
        onward = onward.join(visited, "node").where(~F.array_contains("visited", F.col("shard"))).drop("visited")
        way = cut_lineage(onward, "graph-ways")
    if pairs is not None:
        pairs = cut_lineage(pairs.distinct(), "graph-pairs")
        copies = dealt.select(F.col("node").alias("b"), "copies")
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(copies, "b")
        counts = counts.unionByName(both.groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("more"))).groupBy("node").agg(F.sum("more").alias("more"))
        edges = edges.unionByName(pairs)
    return cut_lineage(counts, "graph-counts"), cut_lineage(edges.distinct(), "graph-links")


def all_pairs(dealt: DataFrame, radius: float, max_cell: int) -> tuple[DataFrame, DataFrame]:
    """The same of all pairs, cell by cell, from vectors in one shard each."""
    def compare(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        cell = Cell(rows)
        near = cell.x @ cell.x.T >= radius
        np.fill_diagonal(near, False)
        yield found_rows(cell, *cell.summed(near), [])

    found = cut_lineage(by_cell(into_cells(into_blocks(dealt, max_cell)), CELL, compare, FOUND), "graph-found")
    return found.groupBy("node").agg(F.sum("more").alias("more")), found.where("label <> node").select(F.col("node").alias("a"), F.col("label").alias("b"))


def audit(nodes: DataFrame, counts: DataFrame, radius: float, most: int) -> float:
    """Share of true links that were found, of the first ``most`` nodes in the order of
    a hash: the mean over the nodes of 1, 2 to 3, 4 to 7, ... true links each, of which
    the lowest counts; 1 if there are no links. Found links are verified, so counts tell."""
    worst = 1.0
    queries = nodes.orderBy(F.xxhash64("node"), "node").limit(most).select("node", "embedding", F.size("embedding").alias("d")).collect()
    by_length: dict[int, list] = {}
    for r in queries:
        by_length.setdefault(r["d"], []).append(r)
    shared = nodes.sparkSession.sparkContext.broadcast({d: (np.array([r["node"] for r in own]), unit([r["embedding"] for r in own])) for d, own in by_length.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, copies, own = batch.column("embedding").to_pylist(), batch.column("copies").to_numpy(), batch.column("node").to_numpy()
            size = np.array([len(v) for v in vectors])
            for d, (ids, q) in shared.value.items():
                at = np.flatnonzero(size == d)
                if len(at):
                    near = (unit([vectors[k] for k in at]) @ q.T >= radius) & (own[at][:, None] != ids[None])
                    total = (near * copies[at][:, None]).sum(axis=0)
                    has = total > 0
                    yield pa.RecordBatch.from_arrays([pa.array(ids[has]), pa.array(total[has])], names=["node", "true"])

    true = nodes.select("node", "copies", "embedding").mapInArrow(run, "node long, true long").groupBy("node").agg(F.sum("true").alias("n"))
    share = true.join(counts, "node", "left").select("n", (F.coalesce("more", F.lit(0)) / F.col("n")).alias("share"))
    got = share.groupBy(F.length(F.bin("n"))).agg(F.avg("share").alias("share")).agg(F.min("share")).first()[0]
    return worst if got is None else got


def near_duplicates(vectors: DataFrame, radius: float = 0.9, shard_size: int = 300, sample: int = 20_000, max_centers: int = 4_096, overlap: int = 3,
                    beam: int = 24, degree: int = 16, alpha: float = 1.2, slack: float = 0.05, entries: int = 8, probes: int = 2,
                    max_cell: int = 1_500, audit_most: int = 1_000, min_recall: float = 0.95, tries: int = 3,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept, audit_recall), a row per row of ``vectors``.

    Vectors link at a cosine of ``radius`` or more. Null, empty and zero vectors
    and those with a null or non-finite component link with nothing, and no vector
    links with one of another length. Equal rows are linked copies; an empty table
    gives no rows; further columns are ignored. Centres are fitted for each length in more than ``max_cell`` rows, on a sample of
    ``sample`` vectors (in the order of a hash), at most ``max_centers``; a rarer length is one shard. Every
    vector is indexed, in ``overlap`` shards, and searched. While the audit is below ``min_recall``, ``beam`` and ``probes`` are
    doubled, and after ``tries`` all pairs are compared.
    """
    spark = vectors.sparkSession
    given = vectors.schema[vector_col].dataType.simpleString()
    kind = given if given in ("array<float>", "array<double>") else "array<double>"
    v = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast(kind).alias("embedding"))
    infinite = F.lit(float("inf"))
    fine = ((F.size("embedding") > 0) & ~F.exists("embedding", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == infinite))
            & F.exists("embedding", lambda e: e != 0) & F.col("vec_id").isNotNull())
    v = v.withColumn("h1", F.when(fine, F.xxhash64("embedding"))).withColumn("h2", F.when(fine, F.xxhash64(F.lit(1), F.col("embedding"))))
    v = cut_lineage(v, "vectors")
    nodes = cut_lineage(v.where("h1 is not null").groupBy("h1", "h2")
                        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding")), "graph-nodes")
    length = F.size("embedding")
    large = nodes.groupBy(length.alias("d")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_cell).orderBy("d").collect()  # lengths with shards of their own
    dealt, offset = nodes.where(~length.isin([r["d"] for r in large])).select("node", "copies", "embedding", F.array(-length).alias("shards")), 0
    for r in large:
        own = nodes.where(length == r["d"])
        picked = own.orderBy(F.xxhash64("node"), "node").limit(sample).select("embedding").collect()
        centers = fit_centers(unit([x["embedding"] for x in picked]), min(max_centers, -(-r["n"] // shard_size)))
        dealt = dealt.unionByName(deal(own, centers, overlap, offset))
        offset += len(centers)
    dealt = cut_lineage(dealt, "graph-dealt")
    counts, edges, recall = None, None, 0.0
    for t in range(tries):
        counts, edges = search_graph(dealt, Search(radius, beam << t, slack, entries, probes << t, degree, alpha), max_cell)
        recall = audit(nodes, counts, radius, audit_most)
        if recall >= min_recall:
            break
    if recall < min_recall:
        counts, edges = all_pairs(nodes.select("node", "copies", "embedding", F.array(-length).alias("shards")), radius, max_cell)
        recall = audit(nodes, counts, radius, audit_most)
    labels = components(edges)
    node = (nodes.select("h1", "h2", "node", "copies").join(counts, "node", "left").join(labels, "node", "left")
            .select("h1", "h2", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("links"), F.coalesce("component", "node").alias("c")))
    node = cut_lineage(node, "graph-result")
    return (v.select("vec_id", "h1", "h2").join(node, ["h1", "h2"], "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))).withColumn("audit_recall", F.lit(float(recall))))
