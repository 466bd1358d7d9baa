"""N-gram Jaccard join: count-vector R-trees over word shingles.

A document's set is that of its distinct shingles. Equal sets are one node. Shingles are hashed into
groups; the counts by group are a node's point, and the sum of the coordinates' minima of two points
bounds their overlap from above, as it does for the upper corners of two boxes of points.

A point's sketch is the parity of the counts by eight times as many groups: two sets differ in as
many shingles at least as their sketches do in bits, which bounds the overlap once more and far closer.

Two sets of similarity t share a shingle among the first n - ceil(t n) + 1 of each in any common order.
Nodes that share one are one cell of the join. The order puts
frequent shingles last (counted over all documents in a table of fixed size), so that a passage many
documents share makes no large cells. Work inside the cells has two rounds:

1. Every node of a cell list is paired with the list's first node: as many pairs as list entries,
   however large the list. Pairs that pass the point bound are verified on their sets, and the
   verified links give components.
2. Lists whose nodes are not all in one component are joined through packed R-trees, cell by cell and,
   within a cell, each size band with itself and the next; a cell beyond ``block`` nodes is split into
   pairs of blocks. Cells of one leaf, which most are, have no boxes to compare: all of a batch are done at once. Every pair that is not linked already and passes both bounds is verified.

A pair left out is thus in one component, or too different by a bound: no link between components
is lost. Shingles are 64-bit hashes, sets are told apart by 128 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import texts
from .components import components

U = np.uint64
HOT_BITS, SHARDS = 20, 256
FINER = 8  # bits of a sketch for each group of a point
PAIR_BYTES = 1 << 22  # of points compared at once


@dataclass(frozen=True)
class Settings:
    words: int = 5
    part: int = 4  # linked if whole * intersection >= part * union
    whole: int = 5
    page: int = 32  # points on a leaf of an R-tree
    block: int = 4096  # nodes of a cell joined in one task
    stars: int = 4  # most rounds of new first nodes
    small: int = 1_000_000  # most ids sent to all executors; beyond, the join is shuffled


def _dims(n):
    """Groups of a point: finer for larger sets, so that the bound stays sharp."""
    return np.where(np.asarray(n) < 400, 64, np.where(np.asarray(n) < 2000, 256, 1024))


def _sets(part: pa.RecordBatch, text: str, words: int) -> list[np.ndarray]:
    """Sorted distinct shingles of every text."""
    made, bounds = texts.shingles(texts.words(*texts.flat(part.column(text))), words)
    return [np.unique(made[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def _prints(own: np.ndarray) -> tuple[int, int]:
    """Two 64-bit fingerprints of a set."""
    return tuple(int(x.view(np.int64)) for x in (np.add.reduce(texts.mix(own)), np.bitwise_xor.reduce(texts.mix(own ^ U(0x5851F42D4C957F2D)))))


def frequent(df: DataFrame, text: str, words: int) -> np.ndarray:
    """Buckets of the shingles that occur far more often than the mean bucket: at most 2 ** HOT_BITS flags."""

    def tally(batches):
        counts, seen = np.zeros(1 << HOT_BITS, np.uint32), False
        for batch in batches:
            for part in texts.slices(batch, text):
                for own in _sets(part, text, words):
                    np.add.at(counts, (own >> U(64 - HOT_BITS)).astype(np.int64), 1)
                    seen = True
        texts.release()
        if seen:
            yield pa.record_batch({"shard": pa.array(range(SHARDS), pa.int32()), "counts": pa.array([_packed(x) for x in np.split(counts, SHARDS)], pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        counts = sum(_unpacked(x).astype(np.int64) for x in table.column("counts").to_pylist())
        hot = np.flatnonzero(counts > 4 * counts.mean() + 50) + table.column("shard")[0].as_py() * len(counts)
        return pa.table({"bucket": pa.array(hot, pa.int32())})

    parts = df.select(text).mapInArrow(tally, "shard int, counts binary")
    found = parts.groupBy("shard").applyInArrow(total, "bucket int").toPandas()
    flags = np.zeros(1 << HOT_BITS, bool)
    flags[found.bucket.to_numpy(np.int64)] = True
    return flags


def _nodes(df: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """(id, text_hash, row, n, h1, h2, prefix, point, sketch) of every row, written to the shared folder."""
    hot = df.sparkSession.sparkContext.broadcast(np.packbits(frequent(df, text, settings.words)))

    def work(batches):
        from pyspark import TaskContext

        flags, row = np.unpackbits(hot.value).view(bool), TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in texts.slices(batch, text):
                sizes, prints, prefixes, points, sketches = [], [], [], [], []
                for own in _sets(part, text, settings.words):
                    n = len(own)
                    sizes.append(n)
                    prints.append(_prints(own))
                    late = flags[(own >> U(64 - HOT_BITS)).astype(np.int64)]
                    first = n - -(-settings.part * n // settings.whole) + 1 if n else 0
                    prefixes.append(np.concatenate((own[~late], own[late]))[:first].view(np.int64))
                    dims = int(_dims(n))
                    points.append(_packed(np.bincount((own & U(dims - 1)).astype(np.int64), minlength=dims)))
                    sketches.append(_sketch(own, FINER * dims))
                yield pa.record_batch({
                    "id": part.column(key), "text_hash": part.column("__hash"), "row": pa.array(np.arange(row, row + part.num_rows)), "n": pa.array(sizes, pa.int32()),
                    "h1": pa.array([a for a, _ in prints], pa.int64()), "h2": pa.array([b for _, b in prints], pa.int64()),
                    "prefix": pa.array(prefixes, pa.list_(pa.int64())), "point": pa.array(points, pa.binary()), "sketch": pa.array(sketches, pa.binary()),
                })
                row += part.num_rows
        texts.release()

    made = df.select(F.col(key).cast("bigint").alias(key), text, F.xxhash64(text).alias("__hash")).mapInArrow(work, "id bigint, text_hash bigint, row bigint, n int, h1 bigint, h2 bigint, prefix array<bigint>, point binary, sketch binary")
    return materialise(made, "shingle-sets")


def _lists(entries: DataFrame) -> DataFrame:
    """(token, first, node) of every list of two nodes or more; a list is read in order, never held."""

    def runs(batches):
        token = first = None
        lone = False  # whether the open list has one node so far
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            begins = np.flatnonzero(np.concatenate(([token is None or tokens[0] != token], tokens[1:] != tokens[:-1])))
            head = np.zeros(len(tokens), np.int64)
            head[begins] = 1
            nth = np.cumsum(head)
            firsts = np.concatenate(([first if first is not None else 0], nodes[begins]))[nth]
            sizes = np.bincount(nth, minlength=len(begins) + 1)
            several = sizes[nth] > 1
            out_t, out_f, out_n = [], [], []
            if sizes[0]:  # the list of the batch before goes on
                several[: sizes[0]] = True
                if lone:
                    out_t, out_f, out_n = [token], [first], [first]
            last = nth == nth[-1]
            pending = len(begins) > 0 and sizes[-1] == 1
            if pending:
                several[last] = False
            lone = pending if len(begins) else False
            token, first = int(tokens[-1]), int(firsts[-1])
            yield pa.record_batch({"token": pa.array(np.concatenate((np.array(out_t, np.int64), tokens[several]))), "first": pa.array(np.concatenate((np.array(out_f, np.int64), firsts[several]))), "node": pa.array(np.concatenate((np.array(out_n, np.int64), nodes[several])))})

    return entries.repartition("token").sortWithinPartitions("token", "node").mapInArrow(runs, "token bigint, first bigint, node bigint")


def _packed(counts: np.ndarray) -> bytes:
    """An even number of counts in as few bytes each as hold them, or half a byte; the first byte says how many (0: half)."""
    most = counts.max()
    if most < 1 << 4:
        low = counts.astype(np.uint8)
        return b"\0" + (low[::2] | low[1::2] << 4).tobytes()
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _unpacked(cell: bytes) -> np.ndarray:
    if cell[0]:
        return np.frombuffer(cell, f"<u{cell[0]}", offset=1)
    pairs = np.frombuffer(cell, np.uint8, offset=1)
    return np.stack((pairs & 15, pairs >> 4), axis=1).ravel()


def _size(point: bytes) -> int:
    return (len(point) - 1) // point[0] if point[0] else 2 * (len(point) - 1)


def _fold(point: bytes, dims: int) -> np.ndarray:
    return _unpacked(point).reshape(-1, dims).sum(axis=0, dtype=np.int32)


def _sketch(own: np.ndarray, bits: int) -> bytes:
    """Parity of the number of shingles in each of ``bits`` groups."""
    return np.packbits(np.bincount((own >> U(16) & U(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def _fold_bits(sketch: bytes, bits: int) -> np.ndarray:
    """The sketch with fewer ``bits``, as 64-bit words."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, U).reshape(-1, bits // 64), axis=0)


def _needs(n, m, s: Settings):
    """Smallest overlap of two sets of these sizes that are linked: ceil(part (n + m) / (part + whole))."""
    return -(-s.part * (n + m) // (s.part + s.whole))


def _passing(pairs: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose points allow the overlap that a link needs."""
    sizes, side = nodes.select("row", "n"), nodes.select("row", "point")
    near = pairs.join(sizes.selectExpr("row AS a", "n"), "a").join(sizes.selectExpr("row AS b", "n AS m"), "b")
    # Sizes rule out most pairs, before points travel.
    near = near.where((settings.part * F.greatest("n", "m") <= settings.whole * F.least("n", "m")))
    near = near.join(side.selectExpr("row AS a", "point AS p"), "a").join(side.selectExpr("row AS b", "point AS q"), "b")

    def bound(batches):
        for batch in batches:
            keep = []
            for n, p, m, q in zip(*(batch.column(c).to_pylist() for c in ("n", "p", "m", "q"))):
                dims = min(_size(p), _size(q))
                keep.append(int(np.minimum(_fold(p, dims), _fold(q, dims)).sum()) >= _needs(n, m, settings))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        texts.release()

    return near.select("a", "b", "n", "p", "m", "q").mapInArrow(bound, "a bigint, b bigint")


def _verified(pairs: DataFrame, nodes: DataFrame, df: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """The pairs (a, b) that are links, by their sets. Sets travel once to each star around an ``a``."""
    pairs = materialise(pairs.where("a <> b").distinct(), "pairs")
    stars = pairs.groupBy("a").agg(F.count("*").alias("size")).select("a", F.ceil(F.col("size") / 512).cast("int").alias("salts"))
    members = pairs.join(stars, "a").select("a", F.col("b").alias("node"), F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    centres = stars.select("a", F.col("a").alias("node"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    members = materialise(members.unionByName(centres), "stars")
    wanted = members.select("node").distinct().join(nodes.select(F.col("row").alias("node"), "id", "h1", "h2"), "node")
    size = members.count()
    small = (lambda d: F.broadcast(d)) if size <= settings.small else (lambda d: d)
    rows = df.select(F.col(key).cast("bigint").alias("__id"), F.col(text).alias("__text"))
    rows = rows.join(small(wanted), F.col("__id").eqNullSafe(F.col("id"))).select("node", "h1", "h2", "__text")

    def sets(part: pa.RecordBatch) -> pa.RecordBatch:
        own = _sets(part, "__text", settings.words)
        same = [_prints(x) == (a, b) for x, a, b in zip(own, part.column("h1").to_pylist(), part.column("h2").to_pylist())]
        cells = [x.tobytes() for x, ok in zip(own, same) if ok]
        return pa.record_batch({"node": part.column("node").filter(pa.array(same, pa.bool_())), "set": pa.array(cells, pa.binary())})

    spelled = rows.mapInArrow(texts.on_slices("__text", sets), "node bigint, set binary")
    placed = spelled.join(small(members), "node").select("a", "salt", (F.col("node") != F.col("a")).alias("leaf"), "node", "set")

    def check(batches):
        at = own = None
        for batch in batches:
            out = []
            for a, salt, leaf, node, cell in zip(*(batch.column(c) for c in ("a", "salt", "leaf", "node", "set"))):
                other = np.frombuffer(cell.as_buffer(), U)
                if not leaf.as_py():
                    at, own = (a.as_py(), salt.as_py()), np.array(other)
                elif at == (a.as_py(), salt.as_py()):
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    if settings.whole * both >= settings.part * (len(own) + len(other) - both):
                        out.append((at[0], node.as_py()))
            yield pa.record_batch({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})
        texts.release()

    return placed.repartition("a", "salt").sortWithinPartitions("a", "salt", "leaf").mapInArrow(check, "a bigint, b bigint").distinct()


class Tree:
    """Packed R-tree over points of one dimension: pages of neighbours, each with the corner of largest counts."""

    def __init__(self, points: np.ndarray, sketches: np.ndarray, sizes: np.ndarray, labels: np.ndarray, page: int):
        # Sort-tile packing: by size, then by the heaviest coordinate.
        order = np.lexsort((points.argmax(axis=1), sizes))
        self.order, self.points, self.sketches, self.sizes, self.labels = order, points[order], sketches[order], sizes[order], labels[order]
        self.begins = np.arange(0, len(order), page)
        self.corner = np.maximum.reduceat(self.points, self.begins, axis=0)
        self.least, self.most = np.minimum.reduceat(self.sizes, self.begins), np.maximum.reduceat(self.sizes, self.begins)
        self.low, self.high = np.minimum.reduceat(self.labels, self.begins), np.maximum.reduceat(self.labels, self.begins)
        self.page = page

    def near(self, other: Tree, settings: Settings):
        """Pairs of points (places in the input) with different labels that both bounds let pass."""
        for i, begin in enumerate(self.begins):
            room = np.minimum(self.corner[i], other.corner).sum(axis=1)
            may = room >= _needs(self.least[i], other.least, settings)
            may &= (settings.part * self.least[i] <= settings.whole * other.most) & (settings.part * other.least <= settings.whole * self.most[i])
            may &= ~((self.low[i] == self.high[i]) & (other.low == other.high) & (self.low[i] == other.low))
            own = slice(begin, begin + self.page)
            for j in np.flatnonzero(may):
                theirs = slice(other.begins[j], other.begins[j] + other.page)
                room = np.minimum(self.points[own, None], other.points[None, theirs]).sum(axis=2)
                ok = room >= _needs(self.sizes[own, None], other.sizes[None, theirs], settings)
                ok &= self.labels[own, None] != other.labels[None, theirs]
                x, y = np.nonzero(ok)
                x, y = x + begin, y + theirs.start
                apart = np.bitwise_count(self.sketches[x] ^ other.sketches[y]).sum(axis=1, dtype=np.int64)
                ok = self.sizes[x] + other.sizes[y] - apart >= 2 * _needs(self.sizes[x], other.sizes[y], settings)
                yield self.order[x[ok]], other.order[y[ok]]


def _joined(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate([np.zeros(0, np.int64), *(pair[side] for pair in pairs)]) for side in (0, 1))


def _begins(table: pa.Table) -> np.ndarray:
    """Where the cells (token, i, j) begin."""
    new = np.arange(table.num_rows) == 0
    for values in (table.column(name).to_numpy() for name in ("token", "i", "j")):
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _matrix(column: pa.ChunkedArray, rows: np.ndarray) -> np.ndarray:
    """The binary values of ``rows``, all of one length, as rows of bytes."""
    data, offsets = texts.flat(column)
    return data[offsets[rows][:, None] + np.arange(offsets[rows[0] + 1] - offsets[rows[0]])]


def _counts(column: pa.ChunkedArray, rows: np.ndarray, dims: int) -> np.ndarray:
    """The packed points of ``rows``, all of ``dims`` groups, as a matrix."""
    data, offsets = texts.flat(column)
    widths = data[offsets[rows]]
    out = np.empty((len(rows), dims), f"u{max(1, int(widths.max()))}")
    for width in np.unique(widths):
        of = np.flatnonzero(widths == width)
        cells = _matrix(column, rows[of])[:, 1:]
        out[of] = np.ascontiguousarray(cells).view(f"<u{width}") if width else np.stack((cells & 15, cells >> 4), axis=2).reshape(len(of), dims)
    return out


def _leaves(table: pa.Table, begins: np.ndarray, counts: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """``Tree.near`` for all cells of one leaf each at once: places of the pairs with different labels that both bounds let pass."""
    labels, sizes = table.column("label").to_numpy(), table.column("n").to_numpy().astype(np.int64)
    # Every row with those behind it in its cell.
    rows = np.arange(counts.sum()) + np.repeat(begins - np.cumsum(counts) + counts, counts)
    behind = np.repeat(begins + counts, counts) - rows - 1
    x = np.repeat(rows, behind)
    y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(behind) - behind, behind)
    may = (labels[x] != labels[y]) & (settings.part * np.maximum(sizes[x], sizes[y]) <= settings.whole * np.minimum(sizes[x], sizes[y]))
    x, y = x[may], y[may]
    groups, place, found = _dims(sizes), np.zeros(table.num_rows, np.int64), []
    used = np.unique(np.concatenate((x, y)))
    points, bits = {}, {}
    for dims in np.unique(groups[used]).tolist():
        own = used[groups[used] == dims]
        place[own] = np.arange(len(own))
        points[dims], bits[dims] = _counts(table.column("point"), own, dims), _matrix(table.column("sketch"), own).view(U)
    for one, two in [(d, e) for d in points for e in points]:
        dims = min(one, two)
        of = np.flatnonzero((groups[x] == one) & (groups[y] == two))
        if not len(of):
            continue
        (p, s), (q, t) = ((points[d] if d == dims else points[d].reshape(-1, d // dims, dims).sum(axis=1, dtype=np.int32), np.bitwise_xor.reduce(bits[d].reshape(len(bits[d]), -1, FINER * dims // 64), axis=1)) for d in (one, two))
        for part in np.array_split(of, len(of) * dims // PAIR_BYTES + 1):
            a, b = x[part], y[part]
            needs = _needs(sizes[a], sizes[b], settings)
            ok = sizes[a] + sizes[b] - np.bitwise_count(s[place[a]] ^ t[place[b]]).sum(axis=1, dtype=np.int64) >= 2 * needs
            a, b, needs = a[ok], b[ok], needs[ok]
            ok = np.minimum(p[place[a]], q[place[b]]).sum(axis=1, dtype=np.int64) >= needs
            found.append((a[ok], b[ok]))
    return _joined(found)


def _named(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(token, node, label) of lists; a node without links is its own label."""
    return lists.select("token", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _mixed(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(token, node) of the lists that hold several components; lists of the same nodes, many for two near copies, once."""
    named = _named(lists, labels)
    spread = F.xxhash64("node", F.lit(1)).cast("decimal(38,0)")
    mixed = named.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.sum(spread).alias("s"), F.bit_xor(F.xxhash64("node")).alias("x"), F.count("*").alias("c"))
    mixed = mixed.where("lo < hi").groupBy("s", "x", "c").agg(F.min("token").alias("token")).select("token")
    return named.join(mixed, "token", "left_semi").select("token", "node")


def _more_stars(mixed: DataFrame, labels: DataFrame, firsts: DataFrame, checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(token, first) of the lists with a node outside the components of their ``firsts``, and the new pairs (first, node) as (a, b)."""
    named = _named(mixed, labels)
    covered = _named(firsts.select("token", F.col("first").alias("node")), labels).select("token", "label").distinct()
    open_ = named.join(covered, ["token", "label"], "left_anti")
    new = open_.groupBy("token").agg(F.min(F.struct("node", "label")).alias("x")).select("token", F.col("x.node").alias("first"), F.col("x.label").alias("own"))
    new = materialise(new, "new-firsts")
    pairs = named.join(new, "token").where("label <> own").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    known = checked.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
    fresh = pairs.withColumns({"x": F.least("a", "b"), "y": F.greatest("a", "b")}).join(known, ["x", "y"], "left_anti").select("a", "b")
    return new.select("token", "first"), materialise(fresh, "star-pairs")


def _cells(mixed: DataFrame, nodes: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) from the lists that hold several components, by R-tree joins of their cells."""
    named = _named(mixed, labels)
    mixed = named.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("token")
    held = named.join(mixed, "token")
    counts = held.groupBy("token").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("blocks"))
    held = held.join(counts, "token").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    held = held.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    held = held.select("token", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), (F.col("own") <= F.col("with")).alias("left"), "node", "label")
    held = held.join(nodes.selectExpr("row AS node", "n", "point", "sketch"), "node")

    def join(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        one_block = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        left = table.column("left").to_numpy()
        labels, sizes = (table.column(c).to_numpy() for c in ("label", "n"))
        points, sketches = (table.column(c).to_pylist() for c in ("point", "sketch"))
        bands = (np.log(sizes) / np.log(1.25)).astype(np.int64)
        out = []
        for band in np.unique(bands):
            # A band has links with itself and the next only.
            held = np.flatnonzero((bands == band) | (bands == band + 1))
            dims = min(_size(points[x]) for x in held)
            folded = np.stack([_fold(points[x], dims) for x in held])
            bits = np.stack([_fold_bits(sketches[x], FINER * dims) for x in held])
            lower, own = bands[held] == band, left[held]
            other = own if one_block else ~own
            # Both bands of both blocks; pairs within the upper band come with that band.
            for some, others in [(lower & own, lower & other), (lower & own, ~lower & other)] + ([] if one_block else [(~lower & own, lower & other)]):
                if some.any() and others.any():
                    x, y = held[some], held[others]
                    one, two = (Tree(folded[z], bits[z], sizes[held[z]].astype(np.int64), labels[held[z]], settings.page) for z in (some, others))
                    out += [(x[p], y[q]) for p, q in one.near(two, settings)]
        return _joined(out)

    def pairs(table: pa.Table) -> pa.RecordBatch:
        nodes, begins = table.column("node").to_numpy(), np.append(_begins(table), table.num_rows)
        sizes = np.diff(begins)
        out = [_leaves(table, begins[:-1][sizes <= settings.page], sizes[sizes <= settings.page], settings)]
        for cell in np.flatnonzero(sizes > settings.page):
            x, y = join(table.slice(begins[cell], sizes[cell]))
            out.append((x + begins[cell], y + begins[cell]))
        x, y = (nodes[z] for z in _joined(out))
        found = np.unique(np.stack((np.minimum(x, y), np.maximum(x, y))), axis=1)
        return pa.record_batch({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    def cells(batches):
        rest = None  # the open cell
        for batch in batches:
            if batch.num_rows:
                table = pa.concat_tables([*([] if rest is None else [rest]), pa.Table.from_batches([batch])])
                last = int(_begins(table)[-1])
                if last:
                    yield pairs(table.slice(0, last))
                rest = table.slice(last)
        if rest is not None:
            yield pairs(rest)
        texts.release()

    dealt = held.select("token", "i", "j", "left", "node", "label", "n", "point", "sketch").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return dealt.mapInArrow(cells, "a bigint, b bigint").distinct()


def _labelled(df: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """(id, text_hash, row, n, class, label) of every row; rows of one component share a label, wordless ones have none."""
    nodes = _nodes(df, key, text, settings)
    classes = materialise(nodes.where("n > 0").groupBy("h1", "h2").agg(F.min("row").alias("class"), F.count("*").alias("c")), "classes")
    own = nodes.select("id", "text_hash", "row", "n", "h1", "h2").join(classes.select("h1", "h2", "class"), ["h1", "h2"], "left").select("id", "text_hash", "row", "n", "class")
    own = materialise(own, "class-members")
    repeats = own.where("row <> class").select("row")
    repeats = F.broadcast(repeats) if repeats.count() <= settings.small else repeats
    heads = nodes.where("n > 0").join(repeats, "row", "left_anti")
    lists = materialise(_lists(heads.select(F.explode("prefix").alias("token"), F.col("row").alias("node"))), "shingle-lists")
    checked = materialise(lists.where("node <> first").selectExpr("first AS a", "node AS b").distinct(), "first-pairs")
    kept = nodes.where("n > 0")
    first = materialise(_verified(_passing(checked, kept, settings), nodes, df, key, text, settings), "links")
    labels = components(first)
    mixed = materialise(_mixed(lists, labels), "mixed-lists")
    leads, links = mixed.groupBy("token").agg(F.min("node").alias("first")), first
    for _ in range(settings.stars):
        new, pairs = _more_stars(mixed, labels, leads, checked)
        if pairs.isEmpty():
            break
        leads, checked = leads.unionByName(new), checked.unionByName(pairs)
        links = materialise(links.unionByName(_verified(_passing(pairs, kept, settings), nodes, df, key, text, settings)), "links")
        labels = components(links)
    known = checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = _cells(mixed, kept, labels, settings).join(known, ["a", "b"], "left_anti")
    labels = components(links.unionByName(_verified(rest, nodes, df, key, text, settings)))
    return own.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))


def link(df: DataFrame, key: str, text: str, settings: Settings = Settings()) -> DataFrame:
    """(key, n_shingles, component_id) of every row: set size, and the smallest id reachable by links.

    A null, empty or wordless text has an empty set and is linked with nothing: its component is its
    own id. Rows with equal sets are linked, whatever their ids; a null id never is the smallest
    unless the component has no other. Ids should be integers.
    """
    marked = _labelled(df, key, text, settings)
    smallest = marked.where("label IS NOT NULL").groupBy("label").agg(F.min("id").alias("least"))
    out = marked.join(smallest, "label", "left")
    return out.select(F.col("id").alias(key), F.col("n").cast("bigint").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"))


def firsts(df: DataFrame, key: str, text: str, settings: Settings = Settings()) -> DataFrame:
    """(key, text_hash): for each component the id and the ``xxhash64`` of the text of its first row.

    The first row has the smallest id, nulls last, and of its texts the one of the smallest hash.
    Wordless texts are in no component.
    """
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("text_hash").alias("text_hash"))
    best = _labelled(df, key, text, settings).where("label IS NOT NULL").groupBy("label").agg(F.min(order).alias("first"))
    return best.select(F.col("first.id").alias(key), "first.text_hash")
