"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard (operator 6)."""

from __future__ import annotations

import io
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellflux.llm.common import materialise

SHARD = 4096  # distinct vectors in one graph
QUERIES = 2048  # that search a graph together
MOST_TASKS = 10_000
BROADCAST_LENGTHS = 100_000
DEGREE = 40
BEAM = 80  # kept while a graph is built
SEARCH_BEAM = 192  # kept by a query
RELAX = 1.1
_BATCH = 256
_WIDE = 4  # nodes that a search opens at a time


@dataclass
class Graph:
    """`edges[i]` are the out-neighbours of vector i, padded with -1; searches start at `entry`."""

    vectors: np.ndarray
    squares: np.ndarray
    edges: np.ndarray
    entry: int


def _beam(graph: Graph, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search of all queries at once: ids and squared distances, nearest first, padded with -1."""
    count, (n, degree) = len(queries), graph.edges.shape
    own = np.einsum("ij,ij->i", queries, queries)
    ids = np.full((count, beam), -1)
    far = np.full((count, beam), np.inf)
    opened = np.ones((count, beam), bool)
    ids[:, 0], opened[:, 0] = graph.entry, False
    far[:, 0] = own - 2 * queries @ graph.vectors[graph.entry] + graph.squares[graph.entry]
    seen = np.zeros((count, n), bool)
    seen[:, graph.entry] = True
    live = np.arange(count)
    while len(live):
        order = np.argsort(np.where(opened[live], np.inf, far[live]), axis=1)[:, :_WIDE]
        chosen = ids[live[:, None], order]
        fresh = ~opened[live[:, None], order]
        opened[live[:, None], order] = True
        near = np.where(fresh[:, :, None], graph.edges[chosen], -1).reshape(len(live), -1)
        near.sort(axis=1)
        ok = near >= 0
        ok[:, 1:] &= near[:, 1:] != near[:, :-1]
        ok &= ~seen[live[:, None], np.maximum(near, 0)]
        rows, at = np.nonzero(ok)
        found = near[rows, at]
        seen[live[rows], found] = True
        dist = np.full(near.shape, np.inf)
        dot = np.einsum("ij,ij->i", graph.vectors[found], queries[live[rows]])
        dist[rows, at] = own[live[rows]] - 2 * dot + graph.squares[found]
        all_ids = np.concatenate([ids[live], near], axis=1)
        all_far = np.concatenate([far[live], dist], axis=1)
        all_open = np.concatenate([opened[live], ~ok], axis=1)
        keep = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        ids[live] = np.take_along_axis(all_ids, keep, 1)
        far[live] = np.take_along_axis(all_far, keep, 1)
        opened[live] = np.take_along_axis(all_open, keep, 1) | np.isinf(far[live])
        live = live[~opened[live].all(axis=1)]
    ids[np.isinf(far)] = -1
    return ids, far


def _pruned(graph: Graph, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Robust pruning: the nearest candidate stays, and drops those much nearer to it than to the node."""
    degree = graph.edges.shape[1]
    x, squares = graph.vectors, graph.squares
    candidates = np.sort(candidates, axis=1)
    valid = (candidates >= 0) & (candidates != nodes[:, None])
    valid[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    safe = np.maximum(candidates, 0)
    vectors = x[safe]
    far = squares[nodes][:, None] + squares[safe] - 2 * np.einsum("ijk,ik->ij", vectors, x[nodes])
    far = np.where(valid, far, np.inf)
    order = np.argsort(far, axis=1)
    safe = np.take_along_axis(safe, order, 1)
    far = np.take_along_axis(far, order, 1)
    vectors = x[safe]
    between = squares[safe][:, :, None] + squares[safe][:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
    alive = np.isfinite(far)
    out = np.full((len(nodes), degree), -1)
    rows = np.arange(len(nodes))
    for place in range(degree):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, place] = safe[rows, first][some]
        alive &= RELAX**2 * between[rows, first] > far
        alive[rows, first] = False
    return out


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, seed: int = 5) -> Graph:
    """A graph over distinct vectors: points come in by growing batches, each linked by search and pruning."""
    x = np.ascontiguousarray(vectors, dtype=np.float64)
    n = len(x)
    graph = Graph(x, np.einsum("ij,ij->i", x, x), np.full((n, degree), -1), 0)
    center = x.mean(axis=0)
    graph.entry = int(np.argmin(graph.squares - 2 * x @ center))
    order = np.random.default_rng(seed).permutation(n)
    order = order[order != graph.entry]
    at, size = 0, 1
    while at < len(order):
        nodes = order[at : at + size]
        found, _ = _beam(graph, x[nodes], beam)
        graph.edges[nodes] = _pruned(graph, nodes, found)
        # Links back; a node with too many is pruned again.
        ends = graph.edges[nodes]
        rows, places = np.nonzero(ends >= 0)
        target, source = ends[rows, places], nodes[rows]
        by = np.argsort(target, kind="stable")
        target, source = target[by], source[by]
        heads, starts, counts = np.unique(target, return_index=True, return_counts=True)
        for low in range(0, len(heads), 1024):
            part = slice(low, low + 1024)
            widest = int(counts[part].max())
            added = np.full((len(heads[part]), widest), -1)
            for k in range(widest):
                has = counts[part] > k
                added[has, k] = source[starts[part][has] + k]
            both = np.concatenate([graph.edges[heads[part]], added], axis=1)
            fits = (both >= 0).sum(axis=1) <= degree
            some = np.sort(both[fits], axis=1)[:, ::-1][:, :degree]
            graph.edges[heads[part][fits]] = some
            if (~fits).any():
                graph.edges[heads[part][~fits]] = _pruned(graph, heads[part][~fits], both[~fits])
        at += size
        size = min(_BATCH, size * 2, max(1, at))
    return graph


def search(graph: Graph, queries: np.ndarray, k: int, beam: int = SEARCH_BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Up to k nearest found: ids (-1: none) and exact Euclidean distances."""
    ids = np.concatenate(
        [_beam(graph, queries[i : i + _BATCH], max(beam, k))[0] for i in range(0, len(queries), _BATCH)]
    )
    exact = np.full(ids.shape, np.inf)
    for i, row in enumerate(ids):
        kept = row >= 0
        exact[i, kept] = np.sqrt(((graph.vectors[row[kept]] - queries[i]) ** 2).sum(axis=1))
    order = np.argsort(exact, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(exact, order, 1)


def usable(vector: str | Column) -> Column:
    """Not null, not empty, all components finite numbers, and one of them not zero."""
    finite = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _packed(graph: Graph, ids: list[np.ndarray]) -> bytes:
    """A graph, and the ids of each of its points, as bytes."""
    out = io.BytesIO()
    sizes = np.array([len(i) for i in ids], np.int64)
    np.savez(
        out, vectors=graph.vectors, edges=graph.edges.astype(np.int32), entry=graph.entry, ids=np.concatenate(ids), sizes=sizes
    )
    return out.getvalue()


def _unpacked(raw: bytes) -> tuple[Graph, list[np.ndarray]]:
    with np.load(io.BytesIO(raw)) as held:
        x = held["vectors"]
        graph = Graph(x, np.einsum("ij,ij->i", x, x), held["edges"].astype(np.int64), int(held["entry"]))
        return graph, np.split(held["ids"], np.cumsum(held["sizes"])[:-1])


def _built(points: pa.Table) -> pa.Table:
    """The graph of one shard, as one row."""
    size, shard = points.column("size")[0].as_py(), points.column("shard")[0].as_py()
    vectors = points.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    graph = build(vectors.reshape(len(points), size))
    ids = [np.array(i, np.int64) for i in points.column("ids").to_pylist()]
    return pa.table({"size": pa.array([size], pa.int32()), "shard": pa.array([shard], pa.int32()), "graph": [_packed(graph, ids)]})


def _searched(k: int, beam: int):
    """The best answers of one shard to one block of queries."""

    def run(graphs: pa.Table, asked: pa.Table) -> pa.Table:
        queries, found, scores = [], [], []
        if len(graphs) and len(asked):
            graph, own = _unpacked(graphs.column("graph")[0].as_py())
            flat = asked.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            ids, far = search(graph, flat.reshape(len(asked), -1), k, beam)
            for query, row, distances in zip(asked.column("digest").to_pylist(), ids, far, strict=True):
                pairs = sorted((d, v) for i, d in zip(row.tolist(), distances.tolist(), strict=True) if i >= 0 for v in own[i].tolist())
                queries += [query] * len(pairs[:k])
                found += [v for _, v in pairs[:k]]
                scores += [d for d, _ in pairs[:k]]
        return pa.table(
            {"query": pa.array(queries, pa.string()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(scores, pa.float64())}
        )

    return run


def nearest(
    vectors: DataFrame, queries: Column, k: int = 10, shard: int = SHARD, beam: int = SEARCH_BEAM
) -> DataFrame:
    """The `k` nearest rows found for each row that `queries` selects: query_id, rank, vec_id, score.

    `vectors`: vec_id, embedding (an array of numbers); other columns are ignored. Distances are Euclidean, in double
    precision, nearest first, ties to the smaller id. Rows without id, and vectors that are null,
    zero or hold null or non-finite components, take no part; a vector is compared with those
    of its own length only; rows with the query's id are not its neighbours.

    Equal vectors are one point with its `k + 1` smallest ids, which is all that an answer can hold. Points are
    dealt by content to shards of about `shard`, each with a graph of its own, which is built once and written as
    a row. Queries search all shards, in blocks of `QUERIES`, so that a task holds one graph and one block whatever the
    size of the table; the best answers are merged.
    """
    ids = F.col("vec_id").cast("long")
    rows = vectors.select(ids.alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable("vector"))
    # Minus zero is zero.
    rows = rows.withColumn("vector", F.transform("vector", lambda v: v + F.lit(0.0)))
    rows = rows.withColumn("digest", F.sha2(F.to_json("vector").cast("binary"), 256))
    first = Window.partitionBy("digest").orderBy("vec_id")
    least = rows.dropDuplicates(["digest", "vec_id"]).withColumn("_n", F.row_number().over(first))
    least = least.filter(F.col("_n") <= k + 1)
    points = least.groupBy("digest").agg(
        F.first("vector").alias("vector"), F.array_sort(F.collect_list("vec_id")).alias("ids")
    )
    points = materialise(points.withColumn("size", F.size("vector")), "points")
    asked = rows.filter(queries).select(F.col("vec_id").alias("query_id"), "digest", "vector").distinct()
    asked = materialise(asked, "asked")

    counts = points.groupBy("size").agg(F.count(F.lit(1)).alias("points")).select(
        F.col("size").alias("_size"), F.ceil(F.col("points") / shard).cast("int").alias("_shards")
    )
    counts = materialise(counts, "shards")
    lengths, shards = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("_shards"), F.lit(0))).first()
    few = F.broadcast(counts) if lengths <= BROADCAST_LENGTHS else counts
    dealt = points.join(few, F.col("size") == F.col("_size")).withColumn(
        "shard", F.pmod(F.xxhash64("digest"), F.col("_shards")).cast("int")
    )
    # A stated number of partitions, which adaptive execution does not merge: each shard is much work.
    tasks = max(1, min(MOST_TASKS, 2 * shards))
    dealt = dealt.select("size", "shard", "vector", "ids").repartition(tasks, "size", "shard")
    graphs = dealt.groupBy("size", "shard").applyInArrow(_built, "size int, shard int, graph binary")
    graphs = materialise(graphs, "graphs", 16)

    once = asked.dropDuplicates(["digest"]).select("digest", "vector", F.size("vector").alias("size"))
    blocks = max(1, math.ceil(once.count() / QUERIES))
    once = once.withColumn("block", F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(blocks)).cast("int"))
    sent = once.join(few, F.col("size") == F.col("_size")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.col("_shards") - 1))
    )
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key, tasks = ["size", "shard", "block"], max(1, min(MOST_TASKS, 2 * shards * blocks))
    sent = sent.select(*key, "digest", "vector").toDF("_size", "_shard", "_block", "digest", "vector")
    found = (
        held.repartition(tasks, *key)
        .groupBy(*key)
        .cogroup(sent.repartition(tasks, "_size", "_shard", "_block").groupBy("_size", "_shard", "_block"))
        .applyInArrow(_searched(k + 1, beam), "query string, vec_id bigint, score double")
    )
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    merged = found.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k + 1).drop("_n")
    answers = asked.select("query_id", "digest").join(merged, F.col("digest") == F.col("query"))
    ranks = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        answers.filter(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(ranks))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
