"""Approximate nearest neighbours by robust-pruned directed graphs.

Equal vectors are one node, which carries the smallest ids of its rows; no more
than k + 1 of them can ever be among the k nearest. Nodes are dealt to shards by
a hash. In each shard nodes are inserted in batches: a greedy beam search from
fixed entries proposes neighbours, and robust pruning keeps the nearest one and
drops those it covers, ``ALPHA`` times nearer to it than to the node, until
``DEGREE`` diverse edges are left. Edges are also entered backwards, and a node
with more than ``MOST`` is pruned again.

The graphs are stored. A task reads a shard's nodes once and lets the queries pass
by them; a beam search finds each shard's best, whose cosines are then computed in
double precision. Neither the index nor the queries of a shard are held whole but
for the one graph.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnlake.llm.words import pieces
from churnlake.scratch import stage

SHARD_ROWS = 4096
ALPHA = 1.2
DEGREE, MOST = 32, 48
BUILD_BEAM, SEARCH_BEAM = 64, 128
BATCH = 128
ENTRIES = 8
WIDTH = 4


def beam_search(
    points: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes found for each query and their squared
    distances, nearest first; all points have length 1, and -1 is no node."""
    size, many = len(queries), len(points)
    seen = np.zeros((size, many), bool)
    rows = np.arange(size)[:, None]
    ids = np.full((size, beam), -1, np.int64)
    far = np.full((size, beam), np.inf, np.float32)
    open_ = np.zeros((size, beam), bool)
    fresh = np.broadcast_to(entries, (size, len(entries)))
    while True:
        fresh = np.sort(fresh, axis=1)
        use = fresh >= 0
        use[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
        use &= ~seen[rows, fresh]
        found = np.where(use, fresh, 0)
        seen[np.broadcast_to(rows, fresh.shape)[use], fresh[use]] = True
        near = 2 - 2 * np.matmul(points[found], queries[:, :, None])[:, :, 0]
        near[~use] = np.inf
        ids = np.concatenate([ids, np.where(use, fresh, -1)], axis=1)
        far = np.concatenate([far, near], axis=1)
        open_ = np.concatenate([open_, use], axis=1)
        order = np.argsort(far, axis=1, kind="stable")[:, :beam]
        ids, far, open_ = ids[rows, order], far[rows, order], open_[rows, order]
        chosen = open_ & (np.cumsum(open_, axis=1) <= WIDTH)
        if not chosen.any():
            return ids, far
        open_ &= ~chosen
        at = np.argsort(~chosen, axis=1, kind="stable")[:, :WIDTH]
        node = np.where(chosen[rows, at], ids[rows, at], -1)
        fresh = np.where(node[:, :, None] >= 0, edges[node], -1).reshape(size, -1)


def robust_prune(points: np.ndarray, nodes: np.ndarray, proposed: np.ndarray) -> np.ndarray:
    """Up to ``DEGREE`` diverse edges for each node out of its proposed ones."""
    rows = np.arange(len(nodes))
    vectors = points[proposed]
    far = 2 - 2 * np.matmul(vectors, points[nodes][:, :, None])[:, :, 0]
    far[(proposed < 0) | (proposed == nodes[:, None])] = np.inf
    order = np.argsort(far, axis=1, kind="stable")
    far, proposed = far[rows[:, None], order], proposed[rows[:, None], order]
    vectors = vectors[rows[:, None], order]
    alive, kept = np.isfinite(far), np.full((len(nodes), MOST), -1, np.int64)
    for edge in range(DEGREE):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        kept[some, edge] = proposed[rows, first][some]
        between = 2 - 2 * np.matmul(vectors, vectors[rows, first][:, :, None])[:, :, 0]
        alive &= ALPHA * between > far
        alive[rows, first] = False
    return kept


def _enter_back(points: np.ndarray, edges: np.ndarray, nodes: np.ndarray) -> None:
    """Enter the new nodes' edges in the other direction."""
    source = np.repeat(nodes, MOST)
    target = edges[nodes].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.lexsort((source, target))
    source, target = source[order], target[order]
    touched, start, count = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(start, count)
    wide = np.full((len(touched), MOST + count.max(initial=0)), -1, np.int64)
    wide[:, :MOST] = edges[touched]
    wide[np.repeat(np.arange(len(touched)), count), MOST + place] = source
    wide = -np.sort(-wide, axis=1)
    twice = np.zeros(wide.shape, bool)
    twice[:, 1:] = wide[:, 1:] == wide[:, :-1]
    wide = -np.sort(-np.where(twice, -1, wide), axis=1)
    full = (wide >= 0).sum(axis=1) > MOST
    edges[touched[~full]] = wide[~full, :MOST]
    for at in range(0, int(full.sum()), 4 * BATCH):
        some = np.flatnonzero(full)[at : at + 4 * BATCH]
        edges[touched[some]] = robust_prune(points, touched[some], wide[some])


def entry_points(size: int) -> np.ndarray:
    return np.unique(np.linspace(0, size - 1, min(size, ENTRIES)).astype(np.int64))


def build_graph(points: np.ndarray) -> np.ndarray:
    """Edges of each point (of length 1), padded with -1."""
    size = len(points)
    edges = np.full((size, MOST), -1, np.int64)
    entries = entry_points(size)
    edges[entries, : len(entries)] = entries
    rest = np.setdiff1d(np.arange(size), entries)
    done, batch = 0, 8
    while done < len(rest):
        nodes = rest[done : done + batch]
        found, _ = beam_search(points, edges, entries, points[nodes], BUILD_BEAM)
        edges[nodes] = robust_prune(points, nodes, found)
        _enter_back(points, edges, nodes)
        done += len(nodes)
        batch = min(2 * batch, BATCH)
    return edges


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = np.concatenate([np.asarray(chunk.flatten(), np.float64) for chunk in chunks])
    return flat.reshape(table.num_rows, -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    return (scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))).astype(np.float32)


def _indexed(table: pa.Table) -> pa.Table:
    """The rows of a shard with their place in it and their edges."""
    edges = build_graph(_unit(_matrix(table, "vector")))
    rows = pa.array([row[row >= 0].astype(np.int32) for row in edges], pa.list_(pa.int32()))
    return table.append_column("place", pa.array(np.arange(len(edges), dtype=np.int32))).append_column(
        "edges", rows
    )


def _bounded(vectors: np.ndarray) -> np.ndarray:
    """The vectors, each times a power of two that keeps its squares in range; that
    changes no cosine, not even in its last digit."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


class _Shard:
    """A shard's graph, and the ids of the rows of its nodes."""

    def __init__(self, nodes: pa.Table) -> None:
        self.vectors = _bounded(_matrix(nodes, "vector"))
        self.lengths = np.sqrt((self.vectors**2).sum(axis=1))
        self.points = _unit(self.vectors)
        self.names = nodes.column("vec_ids").to_pylist()
        self.edges = np.full((len(self.points), MOST), -1, np.int64)
        for row, own in enumerate(nodes.column("edges").to_pylist()):
            self.edges[row, : len(own)] = own

    def search(self, queries: pa.Table, k: int) -> pa.RecordBatch:
        """The k + 1 best nodes for each query."""
        found = {"query_id": [], "vec_ids": [], "score": []}
        asked, entries = _bounded(_matrix(queries, "vector")), entry_points(len(self.points))
        best, _ = beam_search(self.points, self.edges, entries, _unit(asked), SEARCH_BEAM)
        for query, vector, near in zip(queries.column("query_id").to_pylist(), asked, best, strict=True):
            near = near[near >= 0]
            score = (self.vectors[near] * vector).sum(axis=1)
            score /= self.lengths[near] * np.sqrt((vector**2).sum())
            for node in np.lexsort(([self.names[n][0] for n in near], -score))[: k + 1]:
                found["query_id"].append(query)
                found["vec_ids"].append(self.names[near[node]])
                found["score"].append(float(score[node]))
        kinds = {"query_id": pa.int64(), "vec_ids": pa.list_(pa.int64()), "score": pa.float64()}
        return pa.record_batch({name: pa.array(found[name], kind) for name, kind in kinds.items()})


def _searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Answers of the shards of a partition, whose rows come by shard, the nodes by
    their place before the queries."""
    waiting: list[pa.RecordBatch] = []
    current, shard = None, None
    for batch in pieces(batches, BATCH):
        keys = np.stack([batch.column(name).to_numpy() for name in ("length", "shard")])
        asks = batch.column("query_id").is_valid().to_numpy(zero_copy_only=False)
        change = (keys[:, 1:] != keys[:, :-1]).any(axis=0) | (asks[1:] != asks[:-1])
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if low == high:
                continue
            part, key = batch.slice(low, high - low), tuple(keys[:, low].tolist())
            if key != current:
                current, shard, waiting = key, None, []
            if not asks[low]:
                waiting.append(part)
                continue
            if shard is None and waiting:
                shard, waiting = _Shard(pa.Table.from_batches(waiting)), []
            if shard is not None:
                yield shard.search(pa.Table.from_batches([part]), k)


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, vector) whose vector has finite components, not all 0."""
    return (
        vectors.select("vec_id", F.col("embedding").alias("vector"))
        .where("vec_id is not null and vector is not null and size(vector) > 0")
        .where("forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
        .where("exists(vector, x -> x != 0)")
        .distinct()
    )


def build_index(vectors: DataFrame, *, k: int) -> DataFrame:
    """The stored graphs: one row per distinct vector of ``usable`` rows.

    Vectors of different lengths never share a shard."""
    same = Window.partitionBy("vector").orderBy("vec_id")
    nodes = stage(
        vectors.withColumn("rank", F.row_number().over(same))
        .where(F.col("rank") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("vec_ids"))
        .withColumn("length", F.size("vector")),
        "vectors",
    )
    sizes = nodes.groupBy("length").agg(
        F.ceil(F.count(F.lit(1)) / SHARD_ROWS).alias("shards")
    )
    dealt = nodes.join(sizes, "length").withColumn(
        "shard", F.pmod(F.xxhash64("vec_ids"), F.col("shards"))
    )
    # A given number of partitions, which AQE leaves as they are: a graph takes long.
    tasks = sizes.agg(F.sum("shards")).first()[0] or 1
    return stage(
        dealt.select("length", "shard", "vector", "vec_ids")
        .repartition(tasks, "length", "shard")
        .groupBy("length", "shard")
        .applyInArrow(
            _indexed,
            f"length int, shard long, vector {nodes.schema['vector'].dataType.simpleString()},"
            " vec_ids array<long>, place int, edges array<int>",
        ),
        "graphs",
    )


def nearest(queries: DataFrame, index: DataFrame, *, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest cosines found for each row
    of ``queries`` (query_id, vector), ties to the smaller vec_id, without the
    query's own id. Fewer candidates give fewer rows."""
    shards = stage(index.select("length", "shard").distinct(), "shards")
    nodes = index.select(
        "length", "shard", F.lit(None).cast("long").alias("query_id"), "place", "vector", "vec_ids", "edges"
    )
    asked = (
        queries.withColumn("length", F.size("vector"))
        .join(shards, "length")
        .select(
            "length",
            "shard",
            "query_id",
            F.lit(None).cast("int").alias("place"),
            "vector",
            F.lit(None).cast("array<long>").alias("vec_ids"),
            F.lit(None).cast("array<int>").alias("edges"),
        )
    )
    # Nodes have no query, so they come first in their shard.
    found = (
        nodes.union(asked)
        .repartition(max(1, shards.count()), "length", "shard")
        .sortWithinPartitions("length", "shard", "query_id", "place")
        .mapInArrow(partial(_searched, k=k), "query_id long, vec_ids array<long>, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.select("query_id", "score", F.explode("vec_ids").alias("vec_id"))
        .where("vec_id != query_id")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
