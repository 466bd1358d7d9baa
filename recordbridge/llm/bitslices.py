"""Exact top-k by inner product over a bit-sliced index.

Components become integers, floor(scale * x). Rows are dealt by a hash into blocks; a block keeps,
for each component, the ``bits`` highest bits of its offset from the block's smallest value, one bitmap
of all rows for each bit (and its complement). A query's weights are written in signed binary digits;
each digit adds a component's slices, shifted by its place, or their complements where it is negative,
to the sum. All additions are done by carry-save adders on whole bitmaps, so the sum of every row of the
block comes out as slices too. From its most significant slice downward the k-th highest sum is found;
the bits left out can move a score by a known amount, and every row within it of that sum is scored
exactly on its integers. Blocks hold so many rows that a task's bitmaps stay in cache.

Blocks of queries meet blocks of rows; the k best of every block are merged by a ranking that is cut
before it is shuffled. No row is left out at any step, whatever its values: where one huge value
makes the slices of a block coarse, more of its rows are scored exactly. A score beyond 64 bits that
would be returned stops the job.

Rows without id, and vectors that are null or hold null or non-finite components, take no part. Equal
rows count once; of an id with several vectors the best score counts. A query meets only vectors of its
own length. Ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from . import vectors


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    bits: int = 7  # slices of a component
    cells: int = 1 << 21  # components in a block of rows
    queries: int = 512  # in a block of queries


@dataclass
class Block:
    """Rows of one width, by id: their integers, and the slices of every component with their complements."""

    ids: np.ndarray
    whole: np.ndarray
    slices: list[list[np.ndarray]]
    others: list[list[np.ndarray]]
    shifts: list[int]

    @classmethod
    def made(cls, ids: np.ndarray, whole: np.ndarray, bits: int) -> Block:
        exact = vectors.as_kind(whole, np.int64 if np.abs(whole).max(initial=0) < 2**52 else object)
        low = exact.min(axis=0)
        spans = [int(s) for s in exact.max(axis=0) - low]
        shifts = [max(0, s.bit_length() - bits) for s in spans]
        high = ((exact - low) >> np.array(shifts, exact.dtype)).astype(np.int64)
        ones = np.zeros(-(-len(ids) // 64) * 64, np.uint8)
        slices = []
        for d, (span, shift) in enumerate(zip(spans, shifts)):
            own = []
            for j in range((span >> shift).bit_length()):
                ones[: len(ids)] = (high[:, d] >> j) & 1
                own.append(np.packbits(ones, bitorder="little").view(np.uint64))
            slices.append(own)
        return cls(ids, whole, slices, [[~x for x in own] for own in slices], shifts)


def digits(weight: int) -> list[tuple[int, int]]:
    """(place, sign) of a signed binary form without neighbouring digits."""
    out, place = [], 0
    while weight:
        if weight & 1:
            sign = 2 - (weight & 3)
            out.append((place, sign))
            weight -= sign
        weight >>= 1
        place += 1
    return out


def added(levels: dict[int, list[np.ndarray]]) -> list[np.ndarray | None]:
    """Slices of the sum of bitmaps weighted by 2^level, least significant first."""
    out: list[np.ndarray | None] = []
    while levels:
        waiting = levels.pop(len(out), [])
        carried = levels.setdefault(len(out) + 1, [])
        while len(waiting) > 2:
            a, b, c = waiting.pop(), waiting.pop(), waiting.pop()
            half = a ^ b
            waiting.insert(0, half ^ c)
            carried.append((a & b) | (half & c))
        if len(waiting) == 2:
            a, b = waiting
            waiting = [a ^ b]
            carried.append(a & b)
        if not carried:
            del levels[len(out) + 1]
        out.append(waiting[0] if waiting else None)
    return out


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def kth_highest(sums: list[np.ndarray | None], valid: np.ndarray, k: int) -> int:
    """The k-th highest sum among the ``valid`` rows, read from the most significant slice downward."""
    rest, above, value = valid, 0, 0
    for level in range(len(sums) - 1, -1, -1):
        if sums[level] is None:
            continue
        have = rest & sums[level]
        n = _count(have)
        if above + n >= k:
            rest, value = have, value | 1 << level
        else:
            above, rest = above + n, rest & ~sums[level]
    return value


def at_least(sums: list[np.ndarray | None], valid: np.ndarray, bound: int) -> np.ndarray:
    """Bitmap of the ``valid`` rows whose sum reaches ``bound``."""
    if bound <= 0:
        return valid
    if bound >> len(sums):
        return np.zeros_like(valid)
    more, same = np.zeros_like(valid), valid
    for level in range(len(sums) - 1, -1, -1):
        own = sums[level]
        if bound >> level & 1:
            same = same & own if own is not None else np.zeros_like(valid)
        elif own is not None:
            more, same = more | (same & own), same & ~own
    return more | same


def top(block: Block, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact scores of the ``k`` best rows for one query, its own id apart."""
    n = len(block.ids)
    valid = np.zeros(-(-n // 64) * 64, np.uint8)
    valid[:n] = 1
    valid[np.searchsorted(block.ids, own) : np.searchsorted(block.ids, own, "right")] = 0
    valid = np.packbits(valid, bitorder="little").view(np.uint64)
    near = valid
    if _count(valid) > k:
        levels: dict[int, list[np.ndarray]] = {}
        unsure = 0
        for weight, slices, others, shift in zip(map(int, query.tolist()), block.slices, block.others, block.shifts):
            unsure += abs(weight) * ((1 << shift) - 1)
            for place, sign in digits(weight):
                for j, bitmap in enumerate(slices if sign > 0 else others):
                    levels.setdefault(place + shift + j, []).append(bitmap)
        sums = added(levels)
        near = at_least(sums, valid, kth_highest(sums, valid, k) - unsure)
    some = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little")[:n])
    kind = vectors.exact_kind(query[None], block.whole[some])
    scores = vectors.products(query[None], block.whole[some], kind)[0]
    best = vectors.highest(scores, block.ids[some], k)
    return block.ids[some][best], scores[best]


def build(df: DataFrame, key: str, vector: str, settings: Settings = Settings()) -> DataFrame:
    """Index of every usable row: one row a block with ids, integers and slices, written to the shared folder."""
    rows = materialise(vectors.usable(df, key, vector), "vectors")
    # Few rows: a table of n lengths has n * n / 2 numbers at least.
    blocks = rows.groupBy("width").agg(F.ceil(F.count("*") * F.greatest("width", F.lit(1)) / settings.cells).alias("blocks"))
    placed = rows.join(F.broadcast(blocks), "width").withColumn("block", F.pmod(F.xxhash64("id", "vector"), "blocks").cast("int"))

    def made(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        width = table.column("width")[0].as_py()
        whole = vectors.integers(table.column("vector"), width, settings.scale)
        block = Block.made(table.column("id").to_numpy(), whole, settings.bits)
        small = next((k for k in (np.int16, np.int32) if np.abs(whole).max(initial=0) <= np.iinfo(k).max), np.float64)
        return pa.table({
            "width": pa.array([width], pa.int32()), "block": table.column("block")[:1], "ids": pa.array([block.ids.tobytes()], pa.binary()),
            "kind": pa.array([np.dtype(small).str]), "whole": pa.array([whole.astype(small).tobytes()], pa.binary()),
            "shifts": pa.array([block.shifts], pa.list_(pa.int32())), "sizes": pa.array([[len(x) for x in block.slices]], pa.list_(pa.int32())),
            "slices": pa.array([b"".join(x.tobytes() for own in block.slices for x in own)], pa.binary()),
        })

    schema = "width int, block int, ids binary, kind string, whole binary, shifts array<int>, sizes array<int>, slices binary"
    return materialise(placed.groupBy("width", "block").applyInArrow(made, schema), "bit-slices")


def _loaded(row: dict) -> Block:
    ids = np.frombuffer(row["ids"], np.int64)
    whole = np.frombuffer(row["whole"], row["kind"]).astype(np.float64).reshape(len(ids), row["width"])
    bitmaps = iter(np.frombuffer(row["slices"], np.uint64).reshape(-1, -(-len(ids) // 64)))
    slices = [[next(bitmaps) for _ in range(n)] for n in row["sizes"]]
    return Block(ids, whole, slices, [[~x for x in own] for own in slices], row["shifts"])


def search(index: DataFrame, queries: DataFrame, key: str, vector: str, k: int, settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): for each usable query the ``k`` highest scores among the indexed rows of other ids."""
    asked = materialise(vectors.usable(queries, key, vector), "queries")
    parts = -(-asked.count() // settings.queries) or 1
    blocks = index.groupBy("width").agg(F.max("block").alias("last"))
    left = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = asked.join(F.broadcast(blocks), "width").withColumn("part", F.pmod(F.xxhash64("id", "vector"), F.lit(parts)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), "last")))

    def answer(block: pa.Table, asked: pa.Table) -> pa.Table:
        ids, near, scores = [], [], []
        if block.num_rows and asked.num_rows:
            row = block.slice(0, 1).to_pylist()[0]
            index = _loaded(row)
            for own, query in zip(asked.column("id").to_pylist(), vectors.integers(asked.column("vector"), row["width"], settings.scale)):
                found, score = top(index, query, own, k)
                ids += [own] * len(found)
                near += found.tolist()
                scores += score.tolist()
        return pa.table({"query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(near, pa.int64()), "score": vectors.long_scores(scores)})

    found = left.groupBy("width", "block", "part").cogroup(right.groupBy("width", "block", "part")).applyInArrow(answer, "query_id bigint, vec_id bigint, score bigint")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
