"""Approximate nearest neighbours by inner product: a robust-pruned directed graph for each shard.

Equal vectors are indexed once with their smallest ids, as many as an answer can hold. Each number of
components has shards of its own, and within it each range of Euclidean lengths (the longest of a range is
about 1.4 times its shortest), as points of very different lengths would lie in one spot on a shard's
sphere; ranges are cut by a hash of the vector into shards of about ``shard_rows`` each, whatever the
size of the table, and one task builds one shard's graph. Points are inserted in batches: a greedy search of the graph so far proposes
neighbours, the relaxed rule (a candidate goes if a kept neighbour is ``alpha`` times nearer to it
than the point is) keeps few and diverse ones, and edges back are pruned alike. Inner products become
distances on a sphere by one further coordinate.

Queries meet every shard of their number of components: blocks of queries against shards, a beam search each; the answers of all
shards are merged by a ranking that is cut before it is shuffled. Graphs work on single precision after
scaling by a power of two, scores on the vectors as they are in the table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


@dataclass(frozen=True)
class Settings:
    shard_rows: int = 8192
    block_rows: int = 4096  # queries searched by one task
    degree: int = 32
    build_beam: int = 64
    beam: int = 96
    alpha: float = 1.2
    batch: int = 512


def _search(points: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, width: int, at_once: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of all queries in step: ids (-1 where none) and inner products, best first."""
    q, rows = len(queries), np.arange(len(queries))[:, None]
    ids = np.full((q, width), -1, np.int64)
    value = np.full((q, width), -np.inf, np.float32)
    done = np.ones((q, width), bool)
    ids[:, 0], value[:, 0], done[:, 0] = entry, queries @ points[entry], False
    seen = np.zeros((q, len(points)), bool)
    seen[:, entry] = True
    while not done.all():
        pick = np.argsort(done, axis=1, kind="stable")[:, :at_once]
        chosen = np.where(done[rows, pick], -1, ids[rows, pick])
        done[rows, pick] = True
        near = np.where(chosen[:, :, None] < 0, -1, graph[chosen]).reshape(q, -1)
        near = np.where((near < 0) | seen[rows, near], -1, near)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        seen[np.broadcast_to(rows, near.shape)[near >= 0], near[near >= 0]] = True
        found = np.einsum("qnd,qd->qn", points[near], queries, optimize=True)
        found[near < 0] = -np.inf
        ids, value = np.concatenate((ids, near), 1), np.concatenate((value, found), 1)
        done = np.concatenate((done, near < 0), 1)
        best = np.argsort(-value, axis=1, kind="stable")[:, :width]
        ids, value, done = ids[rows, best], value[rows, best], done[rows, best]
        done |= ids < 0
    return ids, value


def _prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float, square: float) -> np.ndarray:
    """For each point at most ``degree`` of its candidates (-1: none), diverse ones first kept nearest first."""
    rows = np.arange(len(own))
    candidates = np.where(candidates == own[:, None], -1, candidates)
    candidates = np.sort(candidates, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    vectors = points[candidates]
    apart = 2 * (square - np.einsum("pcd,pd->pc", vectors, points[own], optimize=True))
    apart[candidates < 0] = np.inf
    kept = np.full((len(own), degree), -1, np.int64)
    for i in range(degree):
        nearest = np.argmin(apart, axis=1)
        live = np.isfinite(apart[rows, nearest])
        if not live.any():
            break
        kept[live, i] = candidates[rows, nearest][live]
        between = 2 * (square - np.einsum("pcd,pd->pc", vectors, vectors[rows, nearest], optimize=True))
        apart[(alpha * alpha * between <= apart) & live[:, None]] = np.inf
        apart[rows, nearest] = np.inf
    return kept


def build_graph(vectors: np.ndarray, settings: Settings) -> tuple[np.ndarray, int]:
    """Neighbours of every vector (-1 pads) and the entry point."""
    n = len(vectors)
    norms = np.einsum("nd,nd->n", vectors.astype(np.float64), vectors.astype(np.float64))
    square = float(norms.max())
    points = np.concatenate((vectors, np.sqrt(np.maximum(square - norms, 0))[:, None].astype(np.float32)), 1).astype(np.float32)
    entry = int(np.argmax(points @ points.mean(axis=0)))
    graph = np.full((n, settings.degree), -1, np.int64)
    order = np.random.default_rng(11).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    at, prune = 1, lambda own, cands: _prune(points, own, cands, settings.degree, settings.alpha, square)
    while at < n:
        own = order[at : at + min(max(at, 8), settings.batch)]
        at += len(own)
        found, _ = _search(points, graph, entry, points[own], settings.build_beam)
        graph[own] = prune(own, found)
        # Edges back, by the point they start from.
        to, source = graph[own].ravel(), np.repeat(own, settings.degree)
        source, to = source[to >= 0], to[to >= 0]
        sort = np.argsort(to, kind="stable")
        to, source = to[sort], source[sort]
        heads, first, counts = np.unique(to, return_index=True, return_counts=True)
        for some in np.array_split(np.arange(len(heads)), -(-len(heads) // 256)) if len(heads) else ():
            widest = int(counts[some].max())
            slot = first[some][:, None] + np.arange(widest)
            new = np.where(np.arange(widest) < counts[some][:, None], source[np.minimum(slot, len(source) - 1)], -1)
            both = np.concatenate((graph[heads[some]], new), 1)
            room = (both >= 0).sum(axis=1) <= settings.degree
            packed = -np.sort(-both, axis=1)[:, : settings.degree]
            graph[heads[some][room]] = packed[room]
            if (~room).any():
                graph[heads[some][~room]] = prune(heads[some][~room], both[~room])
    return graph, entry


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector, width) of the distinct rows that take part: not null, not zero, finite. Floats stay floats, all else is double."""
    kind = "array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast(kind).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    return rows.distinct().withColumn("width", F.size("vector"))


def _matrix(cells: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows, in their own precision."""
    cells = cells.combine_chunks() if isinstance(cells, pa.ChunkedArray) else cells
    return cells.flatten().to_numpy(zero_copy_only=False).reshape(len(cells), -1)


def _scaled(vectors: np.ndarray, axis: int | None = None) -> np.ndarray:
    """Single precision, with the largest entry (of all, or of each row) brought under 1 by a power of two."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=axis, keepdims=True))[1]).astype(np.float32)


def build(df: DataFrame, key: str, vector: str, k: int, settings: Settings = Settings()) -> DataFrame:
    """Index of every usable row, one row a shard: vectors, graph, entry point, ids of each vector.

    Written to the shared folder. An empty table gives an empty index. It answers at most ``k`` neighbours
    a query; asked for more, the search stops with an error.
    """
    ranked = _usable(df, key, vector).withColumn("nth", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("nth") <= k + 1)
    distinct = materialise(ranked.groupBy("vector", "width").agg(F.array_sort(F.collect_list("id")).alias("ids")), "vectors")
    # Half powers of two of the length, the middle of a range being one; by the largest component where squares leave the doubles.
    squares = F.aggregate("vector", F.lit(0.0), lambda sum_, x: sum_ + x.cast("double") * x.cast("double"))
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    power = F.when((squares > 1e-300) & (squares < 1e300), F.log2(squares)).otherwise(2 * F.log2(largest))
    distinct = distinct.withColumn("span", F.floor(power + 0.5).cast("int"))
    # Few rows: a table of n numbers of components has n * n / 2 numbers at least, and doubles have some 4,300 ranges.
    shards = distinct.groupBy("width", "span").agg(F.ceil(F.count("*") / settings.shard_rows).alias("shards"))
    placed = distinct.join(F.broadcast(shards), ["width", "span"]).withColumn("shard", F.pmod(F.xxhash64("vector"), "shards").cast("int"))

    def made(table: pa.Table) -> pa.Table:
        vectors = _matrix(table.column("vector"))
        graph, entry = build_graph(_scaled(vectors), settings)
        return pa.table({"span": table.column("span")[:1], "shard": table.column("shard")[:1], "most": pa.array([k], pa.int32()), "entry": pa.array([entry], pa.int32()), "width": pa.array([vectors.shape[1]], pa.int32()), "kind": pa.array([vectors.dtype.str]), "vectors": pa.array([vectors.tobytes()], pa.binary()), "graph": pa.array([graph.astype(np.int32).tobytes()], pa.binary()), "ids": pa.array([table.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64())))})

    index = placed.groupBy("width", "span", "shard").applyInArrow(made, "span int, shard int, most int, entry int, width int, kind string, vectors binary, graph binary, ids array<array<bigint>>")
    return materialise(index, "graph-index")


def search(index: DataFrame, queries: DataFrame, key: str, vector: str, k: int, settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): for each usable query its ``k`` nearest found, its own id apart.

    Scores are inner products in double precision; ties go to the smaller id. A query meets the vectors
    of its own length, others have no inner product with it. A query id that occurs
    with several vectors is answered for each, and the best answers are kept.
    """
    asked = _usable(queries, key, vector)
    blocks = -(-asked.count() // settings.block_rows) or 1
    shards = index.groupBy("width", (F.col("span") + 0).alias("span")).agg(F.max("shard").alias("last"))  # a column of its own, not the index's
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.join(F.broadcast(shards), "width").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), "last")))

    def answer(shard: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if shard.num_rows and asked.num_rows:
            row = shard.slice(0, 1).to_pylist()[0]
            if k > row["most"]:
                raise ValueError(f"the index holds equal vectors for {row['most']} answers, not {k}")
            vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(-1, row["width"])
            points = _scaled(vectors)
            graph = np.frombuffer(row["graph"], np.int32).reshape(len(vectors), -1)
            wanted, own = _matrix(asked.column("vector")), asked.column("id").to_numpy()
            for at in range(0, len(wanted), settings.batch):
                some = wanted[at : at + settings.batch]
                found, _ = _search(points, graph, row["entry"], _scaled(some, 1), max(settings.beam, k))
                exact = np.einsum("qnd,qd->qn", vectors[found].astype(np.float64), some.astype(np.float64))
                for me, ids, scores in zip(own[at : at + settings.batch].tolist(), found.tolist(), exact.tolist()):
                    near = sorted((-s, i) for v, s in zip(ids, scores) if v >= 0 for i in row["ids"][v] if i != me)[:k]
                    out["query_id"] += [me] * len(near)
                    out["vec_id"] += [i for _, i in near]
                    out["score"] += [-s for s, _ in near]
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()), "score": pa.array(out["score"], pa.float64())})

    found = left.groupBy("width", "span", "shard", "block").cogroup(right.groupBy("width", "span", "shard", "block")).applyInArrow(answer, "query_id bigint, vec_id bigint, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
