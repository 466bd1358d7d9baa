"""Exact windows of inner products over a multiway hyperplane tree, and hard negatives mined with it.

Components become integers, floor(scale * x). A split has several split points; every row belongs to
the nearest one, and the split stores for each split point the range of its distances to every
sibling's rows. A question is a vector with a window of scores. By the lengths of a subtree's rows its
window is an annulus around the vector, and a sibling goes if, seen from any split point, its range
of distances cannot meet that annulus, or if none of its labels is asked for. As soon as k answers are
known the annulus shrinks to what still beats them. What is left is scored exactly in the leaves.

The first split is the table's: its points are chosen from at most ``sample`` rows of each width, the
smallest by a hash; every row is placed, and its distance ranges are aggregated by Spark. Its subtrees
are shards; one with more than ``shard_rows`` rows (a heap of copies, say) is dealt over several by
a hash of the row. Each shard holds its own tree, built in one task. A question first visits the
shards of its own subtree; what it finds there narrows its window for the others, which it visits only
if the first split does not rule them out. Answers are merged by a ranking cut before its shuffle.

Rows without id or label, and vectors that are null or hold null or non-finite components, take no
part. Equal rows (id, label and vector) count once, different rows of one id are rows of their own,
and an anchor never meets rows of its own id. Vectors of different lengths never meet. Ties go to the
smaller id; an empty table gives an empty result. A score beyond 64 bits that would be returned stops
the job. Result columns are named by the operator; other columns of the table are not looked at.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialise
from . import vectors

SLACK = 1e-6  # of the lengths involved: rounding never rules out a row


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    roots: int = 32  # split points of the first split
    sample: int = 2048  # rows of each width they are chosen from
    shard_rows: int = 16384
    fan: int = 8  # split points of a split inside a shard
    leaf: int = 256
    block_rows: int = 2048  # questions searched by one task


def spread(points: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` different points, each far from those before it."""
    chosen, apart = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < n and (best := int(np.argmax(apart))) not in chosen and apart[best] > 0:
        chosen.append(best)
        apart = np.minimum(apart, ((points - points[best]) ** 2).sum(axis=1))
    return points[chosen]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all of ``b``, good to ``SLACK`` times both lengths."""
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


@dataclass
class Split:
    """Split points, and for each of them (rows) the range of distances to every subtree (columns)."""

    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    shortest: np.ndarray  # squared lengths of each subtree's rows
    longest: np.ndarray
    labels: list[np.ndarray]  # the smallest and the largest of each subtree; none if it is empty
    below: list = field(default_factory=list)

    def reach(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the inner products of each question with each subtree's rows."""
        squares = (asked * asked).sum(axis=1)
        slack = SLACK * (np.sqrt(squares)[:, None] + np.sqrt((self.points * self.points).sum(axis=1)))[:, :, None]
        away = distances(asked, self.points)[:, :, None]
        near = np.maximum(np.maximum(away - self.high, self.low - away) - slack, 0).max(axis=1)
        far = (away + self.high + slack).min(axis=1)
        room = SLACK * (squares[:, None] + self.longest) + SLACK
        return (squares[:, None] + self.shortest - far * far) / 2 - room, (squares[:, None] + self.longest - near * near) / 2 + room

    def open(self, asked: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, reach=None) -> np.ndarray:
        """(question, subtree): whether the subtree can hold an answer."""
        least, most = reach or self.reach(asked)
        found = (most >= low[:, None].astype(float)) & (least <= high[:, None].astype(float))
        for j, have in enumerate(self.labels):
            if not len(have):
                found[:, j] = False
            else:
                found[:, j] &= (labels >= have[0]) & (labels <= have[-1]) if same else (labels != have[0]) | (labels != have[-1])
        return found


def _ranges(points: np.ndarray, rows: np.ndarray, nearest: np.ndarray, away: np.ndarray, labels: np.ndarray) -> Split:
    n = len(points)
    squares = (rows * rows).sum(axis=1)
    slack = SLACK * (np.sqrt(squares)[:, None] + np.sqrt((points * points).sum(axis=1)))
    parts = [np.flatnonzero(nearest == j) for j in range(n)]
    low = np.stack([(away - slack)[p].min(axis=0, initial=np.inf) for p in parts], axis=1)
    high = np.stack([(away + slack)[p].max(axis=0, initial=-np.inf) for p in parts], axis=1)
    return Split(points, low, high, np.array([squares[p].min(initial=np.inf) for p in parts]), np.array([squares[p].max(initial=-np.inf) for p in parts]), [np.unique(labels[p])[[0, -1]] if len(p) else labels[p] for p in parts])


def grow(rows: np.ndarray, labels: np.ndarray, settings: Settings) -> tuple[Split | tuple[int, int], np.ndarray]:
    """Tree over ``rows`` and the order in which its leaves (begin, end) hold them."""
    order: list[np.ndarray] = []

    def made(some: np.ndarray, random: np.random.Generator):
        points = spread(rows[random.permutation(some)[: settings.fan * 16]], settings.fan) if len(some) > settings.leaf else rows[:0]
        if len(points) < 2:  # few rows, or all alike
            begin = sum(map(len, order))
            order.append(some)
            return begin, begin + len(some)
        away = distances(rows[some], points)
        nearest = np.argmin(away, axis=1)
        split = _ranges(points, rows[some], nearest, away, labels[some])
        split.below = [made(some[nearest == j], random) if (nearest == j).any() else None for j in range(len(points))]
        return split

    tree = made(np.arange(len(rows)), np.random.default_rng(17))
    return tree, np.concatenate(order)


class Walk:
    """Search of one shard by a block of questions; keeps the ``k`` best of each."""

    def __init__(self, shard: dict, asked: dict[str, np.ndarray], same: bool, k: int):
        self.tree, self.rows, self.ids, self.labels = shard["tree"], shard["rows"].astype(np.float64), shard["ids"], shard["labels"]
        self.vectors, self.own, self.label, self.same, self.k = asked["vector"], asked["id"], asked["label"], same, k
        self.kind = vectors.exact_kind(self.vectors, self.rows)
        edge = 2**53 if self.kind is np.float64 else 2**62
        self.low, self.high = (asked[x] if self.kind is object else np.clip(asked[x], -edge, edge) for x in ("low", "high"))
        self.exact = vectors.as_kind(self.vectors, self.kind), vectors.as_kind(self.rows, self.kind)
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, self.kind)) for _ in self.own]
        self.low = self.low.astype(object if self.kind is object else np.int64)
        self.visit(self.tree, np.arange(len(self.own)))

    def visit(self, node, active: np.ndarray) -> None:
        if not isinstance(node, Split):
            self.score(slice(*node), active)
            return
        least, most = node.reach(self.vectors[active])
        for j in np.argsort(-most.mean(axis=0)):
            if node.below[j] is not None:
                open_ = node.open(self.vectors[active], self.label[active], self.low[active], self.high[active], self.same, (least, most))[:, j]
                if open_.any():
                    self.visit(node.below[j], active[open_])

    def score(self, leaf: slice, active: np.ndarray) -> None:
        scores = np.dot(self.exact[0][active], self.exact[1][leaf].T)
        fits = (self.labels[leaf] == self.label[active][:, None]) == self.same
        fits &= (scores >= self.low[active][:, None]) & (scores <= self.high[active][:, None]) & (self.ids[leaf] != self.own[active][:, None])
        for i in np.flatnonzero(fits.any(axis=1)):
            q, some = active[i], np.flatnonzero(fits[i])
            ids = np.concatenate((self.found[q][0], self.ids[leaf][some]))
            own = np.concatenate((self.found[q][1], scores[i, some]))
            best = vectors.highest(own, ids, self.k)
            self.found[q] = ids[best], own[best]
            if len(best) == self.k:
                self.low[q] = max(self.low[q], int(own[best[-1]]))


@dataclass(frozen=True)
class Index:
    rows: DataFrame  # id, label, vector, width, cell: every usable row
    shards: DataFrame  # width, cell, part, tree
    roots: dict[int, Split]  # the first split of each width
    settings: Settings


def _placed(rows: DataFrame, points: dict[int, np.ndarray], scale: int) -> DataFrame:
    """``rows`` with the number of the nearest first split point."""
    sent = rows.sparkSession.sparkContext.broadcast(points)

    def work(batches):
        for batch in batches:
            widths = batch.column("width").to_numpy()
            cells = np.zeros(batch.num_rows, np.int32)
            for width in np.unique(widths).tolist():
                some = np.flatnonzero(widths == width)
                whole = vectors.integers(batch.column("vector").take(pa.array(some)), width, scale)
                cells[some] = np.argmin(distances(whole, sent.value[width]), axis=1)
            yield batch.append_column("cell", pa.array(cells))

    return rows.mapInArrow(work, StructType([*rows.schema.fields]).add("cell", "integer"))


def _first_splits(rows: DataFrame, points: dict[int, np.ndarray], scale: int) -> dict[int, Split]:
    """Distance ranges, lengths and labels of the first split over all rows: ``roots`` squared numbers of each width."""
    sent = rows.sparkSession.sparkContext.broadcast(points)

    def work(batches):
        for batch in batches:
            widths, cells, labels = (batch.column(c).to_numpy() for c in ("width", "cell", "label"))
            for width in np.unique(widths).tolist():
                some = np.flatnonzero(widths == width)
                whole = vectors.integers(batch.column("vector").take(pa.array(some)), width, scale)
                split = _ranges(sent.value[width], whole, cells[some], distances(whole, sent.value[width]), labels[some])
                full = [j for j, have in enumerate(split.labels) if len(have)]
                yield pa.RecordBatch.from_pydict({
                    "width": pa.array([width] * len(full), pa.int32()), "cell": pa.array(full, pa.int32()), "low": pa.array(split.low[:, full].T.tolist(), pa.list_(pa.float64())),
                    "high": pa.array(split.high[:, full].T.tolist(), pa.list_(pa.float64())), "shortest": pa.array(split.shortest[full]), "longest": pa.array(split.longest[full]),
                    "least": pa.array([int(split.labels[j][0]) for j in full], pa.int64()), "most": pa.array([int(split.labels[j][-1]) for j in full], pa.int64()),
                })

    parts = rows.mapInArrow(work, "width int, cell int, low array<double>, high array<double>, shortest double, longest double, least bigint, most bigint")
    each = parts.select("width", "cell", "shortest", "longest", "least", "most", F.posexplode(F.arrays_zip("low", "high")).alias("i", "x"))
    ends = each.groupBy("width", "cell", "i").agg(
        F.min("x.low").alias("low"), F.max("x.high").alias("high"), F.min("shortest").alias("shortest"), F.max("longest").alias("longest"), F.min("least").alias("least"), F.max("most").alias("most"),
    )
    out = {}
    for width, own in points.items():
        n = len(own)
        out[width] = Split(own, np.full((n, n), np.inf), np.full((n, n), -np.inf), np.full(n, np.inf), np.full(n, -np.inf), [np.zeros(0, np.int64)] * n)
    for r in ends.collect():
        split = out[r.width]
        split.low[r.i, r.cell], split.high[r.i, r.cell], split.shortest[r.cell], split.longest[r.cell] = r.low, r.high, r.shortest, r.longest
        split.labels[r.cell] = np.array([r.least, r.most])
    return out


def build(df: DataFrame, key: str, label: str, vector: str, settings: Settings = Settings()) -> Index:
    """Index of every usable row, written to the shared folder."""
    rows = vectors.usable(df, key, vector, label=F.col(label).cast("bigint")).where(F.col("label").isNotNull())
    rows = materialise(rows, "vectors")
    first = F.row_number().over(Window.partitionBy("width").orderBy(F.xxhash64("id", "vector", "label"), "id"))
    sample: dict[int, list] = {}
    for r in rows.select("width", "vector", first.alias("nth")).where(F.col("nth") <= settings.sample).toLocalIterator():
        sample.setdefault(r.width, []).append(r.vector)
    points = {w: spread(np.floor(settings.scale * np.array(v, np.float64).reshape(len(v), w)), settings.roots) for w, v in sample.items()}
    rows = materialise(_placed(rows, points, settings.scale), "placed")
    roots = _first_splits(rows, points, settings.scale)
    parts = rows.groupBy("width", "cell").agg(F.ceil(F.count("*") / settings.shard_rows).alias("parts"))
    dealt = rows.join(F.broadcast(parts), ["width", "cell"]).withColumn("part", F.pmod(F.xxhash64("id", "vector", "label"), "parts").cast("int"))

    def made(table: pa.Table) -> pa.Table:
        whole = vectors.integers(table.column("vector"), table.column("width")[0].as_py(), settings.scale)
        ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
        tree, order = grow(whole, labels, settings)
        small = next((k for k in (np.int16, np.int32) if np.abs(whole).max(initial=0) <= np.iinfo(k).max), np.float64)
        shard = {"tree": tree, "rows": whole[order].astype(small), "ids": ids[order], "labels": labels[order]}
        return pa.table({c: table.column(c)[:1] for c in ("width", "cell", "part")} | {"shard": pa.array([pickle.dumps(shard)], pa.binary())})

    shards = dealt.groupBy("width", "cell", "part").applyInArrow(made, "width int, cell int, part int, shard binary")
    return Index(rows, materialise(shards, "hyperplane-tree"), roots, settings)


def _visits(index: Index, asked: DataFrame, same: bool) -> DataFrame:
    """``asked`` once for each subtree of the first split that can hold an answer, with its number in ``visit``."""
    sent = asked.sparkSession.sparkContext.broadcast(index.roots)
    scale = index.settings.scale

    def work(batches):
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths).tolist():
                some = np.flatnonzero(widths == width)
                part = batch.take(pa.array(some))
                whole = vectors.integers(part.column("vector"), width, scale)
                low, high, label = (part.column(c).to_numpy() for c in ("low", "high", "label"))
                who, cell = np.nonzero(sent.value[width].open(whole, label, low, high, same))
                yield part.take(pa.array(who)).append_column("visit", pa.array(cell.astype(np.int32)))

    return asked.mapInArrow(work, StructType([*asked.schema.fields]).add("visit", "integer"))


def _answers(index: Index, visits: DataFrame, same: bool, k: int) -> DataFrame:
    """(ask, id, score): the ``k`` best answers of every visited shard."""
    settings = index.settings
    parts = index.shards.select("width", F.col("cell").alias("visit"), (F.col("part") + 0).alias("part"))  # a column of its own, not the shards'
    # Blocks of questions by subtree: as many as its visits fill.
    blocks = visits.groupBy("width", "visit").agg(F.ceil(F.count("*") / settings.block_rows).alias("blocks"))
    left = index.shards.withColumnRenamed("cell", "visit").join(F.broadcast(blocks), ["width", "visit"]).withColumn("block", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))).drop("blocks")
    right = visits.join(F.broadcast(blocks), ["width", "visit"]).withColumn("block", F.pmod(F.xxhash64("ask"), "blocks").cast("int")).drop("blocks")
    right = right.join(F.broadcast(parts), ["width", "visit"])

    def answer(shard: pa.Table, asked: pa.Table) -> pa.Table:
        asks, ids, scores = [], [], []
        if shard.num_rows and asked.num_rows:
            questions = {c: asked.column(c).to_numpy() for c in ("id", "label", "low", "high")}
            questions["vector"] = vectors.integers(asked.column("vector"), asked.column("width")[0].as_py(), settings.scale)
            walk = Walk(pickle.loads(shard.column("shard")[0].as_py()), questions, same, k)
            for ask, (near, score) in zip(asked.column("ask").to_pylist(), walk.found):
                asks += [ask] * len(near)
                ids += near.tolist()
                scores += score.tolist()
        return pa.table({"ask": pa.array(asks, pa.int64()), "id": pa.array(ids, pa.int64()), "score": vectors.long_scores(scores)})

    keys = ["width", "visit", "part", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(answer, "ask bigint, id bigint, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("ask").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def windows(index: Index, asked: DataFrame, same: bool, k: int) -> DataFrame:
    """(ask, rank, id, score): the ``k`` highest scores within [low, high] for each question.

    Questions are (ask, id, label, vector, width, cell, low, high), ``ask`` unique; answers have the
    question's label or, unless ``same``, another, and another id.
    """
    asked = asked.select("ask", "id", "label", "vector", "width", "cell", "low", "high").where("low <= high")
    at_home = materialise(_ranked(_answers(index, asked.withColumn("visit", F.col("cell")), same, k), k), "at-home")
    known = at_home.groupBy("ask").agg(F.when(F.count("*") >= k, F.min("score")).alias("__least"))
    narrowed = asked.join(known, "ask", "left").withColumn("low", F.greatest("low", "__least")).drop("__least")
    abroad = materialise(_visits(index, narrowed, same).where("visit <> cell"), "visits")
    both = at_home.select("ask", "id", "score").unionByName(_answers(index, abroad, same, k))
    return _ranked(both, k).select("ask", "rank", "id", "score")


def mine(df: DataFrame, key: str, label: str, vector: str, anchors: Column, positives: int = 5, negatives: int = 10, low: tuple[int, int] = (30, 100), high: tuple[int, int] = (90, 100), settings: Settings = Settings()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose ``id`` fulfils the condition ``anchors``; their positives the best
    other rows of their label; the negatives of a positive the best rows of other labels whose score is
    at least ``low`` and at most ``high`` of the positive's score (fractions, exact).
    """
    index = build(df, key, label, vector, settings)
    asked = index.rows.where(anchors).withColumns({"ask": F.monotonically_increasing_id(), "low": F.lit(-(2**63)), "high": F.lit(2**63 - 1)})
    asked = materialise(asked, "anchors")
    near = windows(index, asked, True, positives).select("ask", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    part = lambda p, up: f"positive_score div {p[1]} * {p[0]} + {'ceil' if up else 'floor'}(cast(positive_score % {p[1]} * {p[0]} AS decimal(38, 0)) / {p[1]})"
    pairs = near.join(asked.drop("low", "high"), "ask").withColumns({"low": F.expr(part(low, True)).cast("bigint"), "high": F.expr(part(high, False)).cast("bigint")})
    pairs = materialise(pairs.withColumn("ask", F.monotonically_increasing_id()), "windows")
    found = windows(index, pairs, False, negatives)
    return found.select("ask", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(pairs.select("ask", F.col("id").alias("anchor_id"), "positive_id", "positive_score"), "ask").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
