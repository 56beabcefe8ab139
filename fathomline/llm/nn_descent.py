"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Equal vectors are one node, which holds the smallest ids of its rows. Nodes are dealt into shards by a hash, some SHARD
nodes each, and every shard has a graph of its own, so a task holds a bounded part of the table, whatever its size. Random
hyperplanes, fitted on a bounded sample, cut the nodes of a shard into leaves of bounded size several times over; the
nearest within a leaf give the first graph. Then each round joins neighbours of neighbours: every node brings its
neighbours, and a bounded sample of the nodes it is a neighbour of, together; pairs of them of which one is a new
neighbour, and that are nearer than the farthest neighbour so far, are proposed, and each node keeps the nearest. Rounds
end when few neighbours are new.

A query is sent to every shard. Its search starts at its own node and at nodes spread over the shard, and again and again
expands the nearest nodes not expanded yet, until none of its beam is left; what shards found is ranked together. Recall
is measured against brute force on a sample of the queries, and the beam doubled until it is reached; then all queries are
searched with it. So recall holds on tables of any size, at a price that grows with queries times shards, and nothing but
queries and what they found is dealt out again. A beam of all nodes that still misses it gives way to brute force in blocks.

Null vectors, zero vectors, and vectors with null or non-finite components take no part. Vectors are near only to those
of their own length: the lengths of at most LEAF nodes are compared whole, each other length has an index of its own.
Of rows with one id the smallest vector counts; rows without an id take no part. Any number of rows may share a vector;
columns beside the two that are named are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut

#: Neighbours of a node, and nodes that it is a neighbour of, that a round brings together; share of new neighbours
#: below which rounds end, and rounds at most.
NEIGHBOURS, REVERSE, DELTA, ROUNDS = 24, 8, 0.05, 6
#: Trees of hyperplanes; nodes of a leaf at most; sampled vectors that a tree is fitted on.
TREES, LEAF, SAMPLE = 8, 2048, 16_384
#: Nodes of a query that its searches of all shards have to expand at first; parts of a beam that are expanded at once.
BEAM, STEPS = 256, 2
#: Share of the nearest that a search has to find for ASKED sampled queries, by brute force.
RECALL, ASKED = 0.95, 64
#: Nodes of a shard, on average; nodes that a search starts at in each, beside the query's own; nodes that it hands on more
#: than are asked for.
SHARD, STARTS, MORE = 1 << 14, 1 << 10, 5
#: Queries that are sent to a shard at once; of arrays within a task: distances of queries to nodes, distances that are
#: measured at once, pairs that are joined at once.
QUERIES_AT_ONCE, DENSE, MEASURED, JOINED = 1 << 13, 1 << 21, 1 << 17, 1 << 19
#: Nodes and queries of a block of brute force.
NODES, QUERIES = 1 << 15, 1 << 11
#: Parts into which the ids of one vector are split before the smallest are taken.
SPLIT = 256


def usable(vector: Column) -> Column:
    """Whether a vector has components, all finite, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def taking_part(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vector): the smallest usable vector of each id, in double precision."""
    good = rows.select(F.col(vec_id).alias("id"), F.transform(vector, lambda x: x.cast("double") + F.lit(0.0)).alias("vector"))
    return good.where(F.col("id").isNotNull() & usable(F.col("vector"))).groupBy("id").agg(F.min("vector").alias("vector"))


def nodes(good: DataFrame, keep: int) -> DataFrame:
    """(node, vector, ids): distinct vectors, the smallest ids of each (keep at most), of which node is the first.

    Each task, and each part of a vector's ids, hands on no more than it keeps, so a very common vector is no burden.
    """
    for keys in (["vector", F.pmod(F.xxhash64("id"), F.lit(SPLIT))], ["vector"]):
        least = Window.partitionBy(*keys).orderBy("id")
        good = good.withColumn("n", F.row_number().over(least)).where(F.col("n") <= keep).drop("n")
    return good.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("node"), "vector", "ids")


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def plant(sample: np.ndarray, count: int, total: int, leaf: int, seed: int) -> list[list[tuple[np.ndarray, float]]]:
    """Trees of hyperplanes in heap order, fitted so that a sampled node's leaf holds some leaf / 2 of total nodes."""
    depth = max(0, int(np.ceil(np.log2(max(total, 1) / (leaf * 0.75)))))
    depth = min(depth, int(np.log2(max(len(sample), 1))) if len(sample) else 0)
    draw, trees = np.random.default_rng(seed), []
    for _ in range(count):
        tree, groups = [], [np.arange(len(sample))]
        for _ in range(depth):
            below = []
            for g in groups:
                normal = draw.standard_normal(sample.shape[1])
                if len(g) > 1:
                    a, b = sample[draw.choice(g, 2, replace=False)]
                    normal = a - b if (a != b).any() else normal
                side = sample[g] @ normal
                bar = float(np.median(side)) if len(g) else 0.0
                tree.append((normal, bar))
                below += [g[side <= bar], g[side > bar]]
            groups = below
        trees.append(tree)
    return trees


def leaf_of(x: np.ndarray, tree: list[tuple[np.ndarray, float]]) -> np.ndarray:
    """The leaf of each vector."""
    at = np.zeros(len(x), np.int64)
    levels, i = int(np.log2(len(tree) + 1)), 0
    for level in range(levels):
        normals = np.stack([n for n, _ in tree[i : i + (1 << level)]])
        bars = np.array([b for _, b in tree[i : i + (1 << level)]])
        at = at * 2 + (np.einsum("ij,ij->i", x, normals[at]) > bars[at])
        i += 1 << level
    return at


def _nearest(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the places of the k nearest other rows, and their squared distances."""
    x = x.astype(np.float32)
    square = (x * x).sum(1)
    places, found = [], []
    for i in range(0, len(x), 512):
        d = square[i : i + 512, None] + square - 2 * x[i : i + 512] @ x.T
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        p = np.argpartition(d, min(k, len(x) - 1) - 1, 1)[:, :k] if len(x) - 1 > k else np.argsort(d, 1)[:, : len(x) - 1]
        places.append(p)
        found.append(np.take_along_axis(d, p, 1))
    return np.concatenate(places), np.concatenate(found)


_EDGE = "a long, b long, d float, new boolean"
_FOUND = "query long, node long, d double"


def _edges(a: np.ndarray, b: np.ndarray, d: np.ndarray, new: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "d": pa.array(d, pa.float32()), "new": pa.array(new, pa.bool_())})


def _shard(node: Column | str, shards: int) -> Column:
    """The shard of a node, by a hash."""
    return F.pmod(F.xxhash64(node, F.lit(3)), F.lit(shards)).cast("int")


def _sorted(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of a shard in order, and their vectors; places are those in this order."""
    ids = group["node"].to_numpy()
    order = np.argsort(ids)
    return ids[order], _matrix(group["vector"])[order]


def _ranks(of: np.ndarray) -> np.ndarray:
    """Of each of some sorted values how many equal ones are before it."""
    return np.arange(len(of)) - np.searchsorted(of, of)


def _keep(a: np.ndarray, b: np.ndarray, d: np.ndarray, new: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """keep_nearest() within a shard, of places, in the order of a and d."""
    pair = (a.astype(np.int64) << 32 | b) << 1 | new
    order = np.argsort(pair)
    pair = pair[order]
    first = np.flatnonzero(np.diff(pair >> 1, prepend=-1))
    if not len(first):
        return a, b, d, new
    a, b, new = pair[first] >> 33, pair[first] >> 1 & 0xFFFFFFFF, (pair[first] & 1).astype(bool)
    d = np.maximum(np.minimum.reduceat(d[order], first), 0).astype(np.float32)
    order = np.argsort(a << 32 | d.view(np.int32), kind="stable")  # the bits of floats from 0 on are in their order
    order = order[_ranks(a) < k]
    return a[order], b[order], d[order], new[order]


def _reversed(a: np.ndarray, b: np.ndarray, first: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place the edges that lead to it, most at most (-1: none): those marked as first, then by chance."""
    by = np.lexsort((np.random.default_rng(5).random(len(b)), ~first, b))
    rank = _ranks(b[by])
    by, rank = by[rank < most], rank[rank < most]
    back, marks = np.full((n, most), -1, np.int64), np.zeros((n, most), bool)
    back[b[by], rank], marks[b[by], rank] = a[by], first[by]
    return back, marks


def first_graph(vectors: DataFrame, total: int, k: int, trees: int, leaf: int, seed: int = 11, shards: int = 1) -> DataFrame:
    """(a, b, d, new): for each node the k nearest nodes of its leaves within its shard, and their squared distances.

    Trees are fitted on a bounded sample of a shard. Leaves that grow beyond the bound, where the sample was thin, are
    split by chance into parts that don't.
    """

    def within(group: pa.Table) -> pa.Table:
        ids, x = _sorted(group)
        draw, found = np.random.default_rng(seed), [np.zeros((3, 0))]
        sample = x if len(x) <= SAMPLE else x[draw.choice(len(x), SAMPLE, replace=False)]
        planted = plant(sample, trees, len(x), leaf, seed)
        for tree in planted if planted[0] else planted[:1]:  # one leaf of all is the same in each tree
            at = leaf_of(x, tree) if tree else np.zeros(len(x), np.int64)
            order = np.lexsort((draw.random(len(x)), at))
            for group_ in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                for g in np.array_split(group_, -(-len(group_) // leaf)):
                    if len(g) > 1:
                        places, d = _nearest(x[g], k)
                        found.append(np.stack([np.repeat(g, places.shape[1]), g[places.ravel()], d.ravel()]))
        a, b, d = np.concatenate(found, 1)
        a, b, d, new = _keep(a.astype(np.int64), b.astype(np.int64), d.astype(np.float32), np.ones(len(a), bool), k)
        return _edges(ids[a], ids[b], d, new)

    return vectors.select(_shard("node", shards).alias("shard"), "node", "vector").repartition(shards, "shard").groupBy("shard").applyInArrow(within, _EDGE)


def keep_nearest(edges: DataFrame, k: int) -> DataFrame:
    """Of each node the k nearest of the proposed neighbours (a, b, d, new), ties to the smaller; known ones aren't new."""
    order = Window.partitionBy("a").orderBy("d", "b")
    return edges.groupBy("a", "b").agg(F.min("d").alias("d"), F.min("new").alias("new")).withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")


def _joined(x: np.ndarray, a: np.ndarray, b: np.ndarray, d: np.ndarray, new: np.ndarray, k: int, reverse: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The graph of a shard after one round; edges of places, as _keep() gives them."""
    n = len(x)
    rank = _ranks(a)
    to, fresh = np.full((n, k), -1, np.int64), np.zeros((n, k), bool)
    to[a, rank], fresh[a, rank] = b, new
    back, marks = _reversed(a, b, new, n, reverse)
    twice = back[:, :, None] == to[:, None, :]  # a neighbour of which the pivot is one too comes once
    fresh |= (twice & marks[:, :, None]).any(1)
    back[twice.any(2)] = -1
    around, fresh = np.concatenate([to, back], 1), np.concatenate([fresh, marks], 1) & (np.concatenate([to, back], 1) >= 0)
    # pivots without a new neighbour have nothing to propose
    busy, new = np.flatnonzero(fresh.any(1)), np.zeros(len(a), bool)
    square, width, some = (x * x).sum(1), k + reverse, [(a, b, d, new)]
    reach = lambda g: np.where(np.bincount(g[0], minlength=n) >= k, np.maximum.reduceat(np.append(g[2], 0), np.searchsorted(g[0], np.arange(n))), np.inf).astype(np.float32)
    far, waiting = reach(some[0]), 0
    for rows in np.array_split(busy, max(1, len(busy) * width * width // JOINED)):
        m = around[rows]
        v = x[m]
        dd = square[m][:, :, None] + square[m][:, None, :] - 2 * v @ v.transpose(0, 2, 1)
        dd[:, np.arange(width), np.arange(width)] = np.inf
        given = m >= 0
        i, p, q = np.nonzero((dd < np.where(given, far[m], -np.inf)[:, :, None]) & given[:, None, :] & (fresh[rows][:, :, None] | fresh[rows][:, None, :]))
        some.append((m[i, p], m[i, q], dd[i, p, q], np.ones(len(i), bool)))
        waiting += len(i)
        if waiting > 8 * JOINED:  # bounded, and what comes next has to be nearer
            some, waiting = [_keep(*map(np.concatenate, zip(*some)), k)], 0
            far = reach(some[0])
    return _keep(*map(np.concatenate, zip(*some)), k)


def _places(ids: np.ndarray, edges: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The edges of a shard as places of its sorted nodes, in the order of a."""
    a = np.searchsorted(ids, edges["a"].to_numpy())
    order = np.argsort(a, kind="stable")
    return a[order], np.searchsorted(ids, edges["b"].to_numpy())[order], edges["d"].to_numpy()[order], edges["new"].to_numpy()[order]


def _by_shard(graph: DataFrame, vectors: DataFrame, shards: int):
    """The edges and the nodes of each shard, together."""
    deal = lambda df, node: df.withColumn("shard", _shard(node, shards)).repartition(shards, "shard").groupBy("shard")
    return deal(graph.select("a", "b", "d", "new"), "a").cogroup(deal(vectors.select("node", "vector"), "node"))


def descend(graph: DataFrame, vectors: DataFrame, k: int, reverse: int, shards: int = 1) -> DataFrame:
    """One round: the graph (a, b, d, new) after joining neighbours of neighbours, of which one at least is new.

    Edges stay within a shard, as those of first_graph() do.
    """

    def within(edges: pa.Table, group: pa.Table) -> pa.Table:
        ids, x = _sorted(group)
        a, b, d, new = _joined(x.astype(np.float32), *_keep(*_places(ids, edges), k), k, reverse) if len(edges) else _places(ids, edges)
        return _edges(ids[a], ids[b], d, new)

    return _by_shard(graph, vectors, shards).applyInArrow(within, _EDGE)


def build(vectors: DataFrame, total: int, k: int = NEIGHBOURS, reverse: int = REVERSE, rounds: int = ROUNDS, trees: int = TREES, leaf: int = LEAF, delta: float = DELTA, shards: int = 1) -> DataFrame:
    """(a, b, d, new): the neighbour graph of each shard over written nodes (node, vector, ...)."""
    graph = cut(first_graph(vectors, total, k, trees, leaf, shards=shards))
    for _ in range(rounds):
        graph = cut(descend(graph, vectors, k, reverse, shards))
        edges, new = graph.agg(F.count("*"), F.count(F.when(F.col("new"), 1))).first()
        if new <= delta * edges:
            break
    return graph


def index_of(graph: DataFrame, vectors: DataFrame, links: int, shards: int) -> DataFrame:
    """(shard, node, vector, to): each node with the places of its neighbours, and of links nodes that it is one of."""

    def within(edges: pa.Table, group: pa.Table) -> pa.Table:
        ids, x = _sorted(group)
        a, b, *_ = _places(ids, edges)
        back, _ = _reversed(a, b, np.zeros(len(a), bool), len(ids), links)
        pairs = np.concatenate([a * len(ids) + b, (np.arange(len(ids))[:, None] * len(ids) + back)[back >= 0]])
        pairs = np.unique(pairs)
        ends = np.searchsorted(pairs, np.arange(len(ids) + 1) * len(ids))
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
        shard = group["shard"][0].as_py() if len(ids) else 0
        to = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pairs % max(len(ids), 1), pa.int32()))
        return pa.table({"shard": pa.array(np.full(len(ids), shard), pa.int32()), "node": pa.array(ids, pa.int64()), "vector": flat, "to": to})

    return _by_shard(graph, vectors, shards).applyInArrow(within, "shard int, node long, vector array<double>, to array<int>")


def exact(vectors: DataFrame, queries: DataFrame, k: int, total: int, asked: int, same: tuple[str, ...] = ()) -> DataFrame:
    """(query, node, d): the k nearest nodes of each query (query, q, ...) by brute force, in blocks of nodes and queries.

    same: columns of both sides that have to be equal.
    """
    across, down = -(-max(asked, 1) // QUERIES), -(-max(total, 1) // NODES)
    part = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = queries.select("query", "q", *same, part("query", across).alias("qb"), each(down).alias("nb"))
    right = vectors.select("node", F.col("vector").alias("v"), *same, part("node", down).alias("nb"), each(across).alias("qb"))

    def compare(q: pa.Table, v: pa.Table) -> pa.Table:
        out = [pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float32())], names=["query", "node", "d"])]
        x, ids = _matrix(v["v"]) if len(v) else None, v["node"].to_numpy()
        square = (x * x).sum(1) if len(v) else None
        for a in range(0, len(q) if len(v) else 0, 64):
            some = _matrix(q["q"].slice(a, 64))
            d = np.maximum((some * some).sum(1)[:, None] + square - 2 * some @ x.T, 0)
            place = np.argpartition(d, k - 1, 1)[:, :k] if len(ids) > k else np.tile(np.arange(len(ids)), (len(some), 1))
            out.append(pa.RecordBatch.from_arrays([pa.array(np.repeat(q["query"].slice(a, 64).to_numpy(), place.shape[1]), pa.int64()), pa.array(ids[place].ravel(), pa.int64()), pa.array(np.take_along_axis(d, place, 1).ravel(), pa.float32())], names=["query", "node", "d"]))
        return pa.Table.from_batches(out)

    keys = [*same, "qb", "nb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "query long, node long, d float")
    return found.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("d", "node"))).where(F.col("n") <= k).drop("n")


def _greedy(x: np.ndarray, to: np.ndarray, q: np.ndarray, starts: np.ndarray, origin: np.ndarray, beam: int) -> np.ndarray:
    """The squared distances of each query to the nodes of a shard that its search meets, infinite for all others.

    to: the neighbours of each node (-1: none). Each step expands the nearest nodes of a query that weren't yet, until
    all of its beam are.
    """
    n, count, square = len(x), len(q), (x * x).sum(1)
    own = (q * q).sum(1)
    dist, done = np.full((count, n), np.inf, np.float32), np.zeros((count, n), bool)
    dist[:, starts] = np.maximum(own[:, None] + square[starts] - 2 * q @ x[starts].T, 0)
    dist[np.flatnonzero(origin >= 0), origin[origin >= 0]] = 0
    left, bar = np.arange(count), np.full(count, np.inf, np.float32)
    while True:
        if beam < n:
            bar[left] = np.partition(dist[left], beam - 1, 1)[:, beam - 1]
        row, node = np.nonzero((dist[left] <= bar[left][:, None]) & (dist[left] < np.inf) & ~done[left])
        if not len(row):
            return dist
        row = left[row]
        order = np.lexsort((dist[row, node], row))
        row, node = row[order], node[order]
        first = _ranks(row) < max(1, beam // STEPS)
        row, node = row[first], node[first]
        done[row, node] = True
        left = np.unique(row)
        met = (row[:, None] * n + to[node])[to[node] >= 0]
        met = np.unique(met[dist.ravel()[met] == np.inf])
        for part in np.array_split(met, len(met) // MEASURED + 1):
            row, node = np.divmod(part, n)
            dist[row, node] = np.maximum(own[row] + square[node] - 2 * np.einsum("ij,ij->i", q[row], x[node]), 0)


def _search(index: DataFrame, queries: DataFrame, number: int, shards: int, k: int, beam: int) -> DataFrame:
    """(query, node, d): the nearest nodes that each of number queries (query, origin, q) finds in each shard's graph."""
    across = -(-max(number, 1) // QUERIES_AT_ONCE)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.withColumn("qb", each(across))
    right = queries.select("query", "origin", "q", F.pmod(F.xxhash64("query"), F.lit(across)).cast("int").alias("qb")).withColumn("shard", each(shards))

    def find(nodes_: pa.Table, asked: pa.Table) -> pa.Table:
        none = pa.table({"query": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "d": pa.array([], pa.float64())})
        if not len(nodes_) or not len(asked):
            return none
        ids, x = _sorted(nodes_)
        light = x.astype(np.float32)
        lists = nodes_["to"].combine_chunks().take(pa.array(np.argsort(nodes_["node"].to_numpy())))
        size = np.diff(lists.offsets.to_numpy())
        to = np.full((len(ids), max(int(size.max()), 1)), -1, np.int64)
        to[np.repeat(np.arange(len(ids)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = lists.flatten().to_numpy()
        starts = np.unique(np.linspace(0, len(ids) - 1, min(STARTS, len(ids))).astype(np.int64))
        own = asked["origin"].to_numpy()
        at = np.minimum(np.searchsorted(ids, own), len(ids) - 1)
        at = np.where(ids[at] == own, at, -1)
        keep, out = min(max(beam, k + MORE), len(ids)), [none]
        for i in range(0, len(asked), max(1, DENSE // len(ids))):
            of = slice(i, i + max(1, DENSE // len(ids)))
            q = _matrix(asked["q"].slice(i, of.stop - i))
            dist = _greedy(light, to, q.astype(np.float32), starts, at[of], beam)
            place = np.argpartition(dist, keep - 1, 1)[:, :keep]
            # the best again, in double precision and without differences of squares
            d = np.stack([((x[p] - v) ** 2).sum(1) for p, v in zip(place, q)])
            d[~np.isfinite(np.take_along_axis(dist, place, 1))] = np.inf
            best = np.argsort(d, 1)[:, : k + MORE]
            row, col = np.nonzero(np.isfinite(np.take_along_axis(d, best, 1)))
            place, d = np.take_along_axis(place, best, 1), np.take_along_axis(d, best, 1)
            out.append(pa.table({"query": pa.array(asked["query"].slice(i, of.stop - i).to_numpy()[row], pa.int64()), "node": pa.array(ids[place[row, col]], pa.int64()), "d": pa.array(d[row, col], pa.float64())}))
        return pa.concat_tables(out)

    group = lambda df: df.repartition(shards * across, "shard", "qb").groupBy("shard", "qb")
    found = group(left).cogroup(group(right)).applyInArrow(find, _FOUND)
    return found.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("d", "node"))).where(F.col("n") <= k + MORE).drop("n")


def search(graph: DataFrame, vectors: DataFrame, queries: DataFrame, total: int, k: int, beam: int = BEAM, recall: float = RECALL, links: int = NEIGHBOURS, shards: int = 1) -> DataFrame:
    """(query, node, d): nodes near each query, at least k if there are; queries: (query, origin, vector), origin a node.

    The sampled queries are searched first, with a beam that is doubled until their recall holds, then all queries.
    """
    index = cut(index_of(graph, vectors, links, shards))
    asked = cut(queries.select("query", "origin", F.col("vector").alias("q")))
    number = asked.count()
    sample = cut(asked.orderBy(F.xxhash64("query"), "query").limit(ASKED))
    truth = cut(exact(vectors, sample, k, total, min(number, ASKED)).select("query", "node"))
    wanted, beam = truth.count(), max(1, beam // shards)
    while True:
        best = _search(index, sample, ASKED, shards, k, beam).withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("d", "node"))).where(F.col("n") <= k)
        if best.join(truth, ["query", "node"], "left_semi").count() >= recall * wanted:
            return _search(index, asked, number, shards, k, beam)
        if beam * shards >= total:
            return exact(vectors, asked, max(BEAM, k), total, number)
        beam *= 2


def nearest(rows: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", small: int = LEAF, recall: float = RECALL, beam: int = BEAM, **index) -> DataFrame:
    """(query_id, rank, vec_id, score): of each row that is a query the k nearest other rows found, ties to smaller ids.

    Only rows that take part are queries.
    """
    vectors = cut(nodes(taking_part(rows, vec_id, vector), k + 1).withColumn("dim", F.size("vector")))
    sizes = vectors.groupBy("dim").count().orderBy(F.desc("count"), "dim").withColumnRenamed("count", "n")
    main, total = next(((r.dim, r.n) for r in sizes.limit(1).collect()), (0, 0))
    large = [(r.dim, r.n) for r in sizes.where(F.col("n") > small).collect()] or [(main, total)]  # the rows by LEAF at most
    same = taking_part(rows.where(is_query), vec_id, vector)
    asked = cut(same.join(vectors.select("vector", "dim", F.col("node").alias("origin")), "vector").select(F.col("id").alias("query"), "origin", "vector", "dim"))
    found = None
    for dim, total in large:
        part = vectors.where(F.col("dim") == dim)
        shards = -(-max(total, 1) // SHARD)
        got = search(build(part, total, shards=shards, **index), part, asked.where(F.col("dim") == dim), total, k + 1, beam, recall, shards=shards)
        found = got if found is None else found.unionByName(got)
    # other lengths have at most `small` nodes each
    rest = ~F.col("dim").isin([d for d, _ in large])
    found = found.unionByName(exact(vectors.where(rest), asked.where(rest).withColumnRenamed("vector", "q"), max(BEAM, k + 1), 1, 1, ("dim",)))

    members = found.join(vectors, "node").join(asked.select("query", F.col("vector").alias("q")), "query")
    distance = F.sqrt(F.aggregate(F.zip_with("q", "vector", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    flat = members.select("query", distance.alias("score"), F.explode("ids").alias("vec_id")).where(F.col("vec_id") != F.col("query"))
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    return flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


def query(spark: SparkSession, rows: DataFrame) -> DataFrame:
    return nearest(rows.select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)
