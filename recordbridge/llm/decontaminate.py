"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

A pattern is a window of ``width`` consecutive words of a benchmark item, or the whole item where it
has fewer. Patterns of one length share a shift table over blocks of two words: an entry says how far
the search may skip because no pattern can end sooner. Where it says zero, the block's bucket lists
the patterns ending in it, and their words are compared with the text's directly.

All texts of a batch are searched at once, cut into segments that advance in step; each text stays
in its row, so nothing is shuffled. The benchmark goes to the executors in parts of at most
``part_bytes`` of text, one pass over the rows each, so that a broadcast never exceeds that bound.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from . import texts

U = np.uint64
SEGMENT = 512  # window ends searched by one cursor


class Group(NamedTuple):
    """Patterns of one length: shift table and buckets by the hash of the last block."""

    length: int
    block: int
    bits: int
    shift: np.ndarray
    buckets: dict[int, list[tuple[bytes, tuple[str, ...]]]]


def _block_hashes(hashes: np.ndarray, ends: np.ndarray, block: int, bits: int) -> np.ndarray:
    """Of the block that ends at each given word."""
    made = hashes[ends] * texts.MULTIPLIERS[0]
    if block == 2:
        made = made + hashes[ends - 1] * texts.MULTIPLIERS[1]
    return (texts.mix(made) >> U(64 - bits)).astype(np.int64)


def _spelled(data: np.ndarray, found: texts.Words, first: int, last: int) -> bytes:
    """Words ``first`` to ``last`` in lower case with one space between."""
    low = texts.LOWER[data[found.starts[first] : found.ends[last]]].tobytes()
    base = found.starts[first]
    return b" ".join(low[found.starts[i] - base : found.ends[i] - base] for i in range(first, last + 1))


def compile_patterns(items: list[tuple[str | None, str | None]], width: int = 13) -> list[Group]:
    """Search tables of (item id, text) rows; items without words have no pattern."""
    data, offsets = texts.flat(pa.array([t for _, t in items], pa.string()))
    found = texts.words(data, offsets, texts.ALNUM)
    named: dict[int, dict[bytes, tuple[int, set]]] = defaultdict(dict)
    for (item, _), lo, hi in zip(items, found.bounds[:-1].tolist(), found.bounds[1:].tolist()):
        length = min(width, hi - lo)
        for first in range(lo, hi - length + 1) if length else ():
            at, ids = named[length].setdefault(_spelled(data, found, first, first + length - 1), (first, set()))
            ids.update([item] if item is not None else [])
    groups = []
    for length, patterns in sorted(named.items()):
        block = min(2, length)
        bits = max(12, min(22, int(16 * len(patterns) * length).bit_length()))
        # As narrow as the longest skip: every worker holds the table.
        shift = np.full(1 << bits, length - block + 1, np.min_scalar_type(length))
        firsts = np.array([at for at, _ in patterns.values()])
        for end in range(block - 1, length):
            np.minimum.at(shift, _block_hashes(found.hashes, firsts + end, block, bits), length - 1 - end)
        buckets = defaultdict(list)
        for key, (spelling, (_, ids)) in zip(_block_hashes(found.hashes, firsts + length - 1, block, bits).tolist(), patterns.items()):
            buckets[key].append((spelling, tuple(sorted(ids))))
        groups.append(Group(length, block, bits, shift, dict(buckets)))
    return groups


def _search(data: np.ndarray, found: texts.Words, group: Group):
    """(last word, item ids) of every occurrence."""
    lo, hi = found.bounds[:-1] + group.length - 1, found.bounds[1:]
    pieces = np.maximum(-(-(hi - lo) // SEGMENT), 0)
    begins = np.repeat(lo, pieces)
    nth = np.arange(len(begins)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = begins + nth * SEGMENT
    stop = np.minimum(at + SEGMENT, np.repeat(hi, pieces))
    zeros, blocks = [], []
    while len(at):
        key = _block_hashes(found.hashes, at, group.block, group.bits)
        skip = group.shift[key]
        here = skip == 0
        zeros.append(at[here])
        blocks.append(key[here])
        at = at + np.maximum(skip, 1).astype(np.int64)
        left = at < stop
        at, stop = at[left], stop[left]
    for last, key in zip(np.concatenate(zeros).tolist(), np.concatenate(blocks).tolist()) if zeros else ():
        bucket = group.buckets.get(key)
        if bucket:
            spelling = _spelled(data, found, last - group.length + 1, last)
            for pattern, ids in bucket:
                if pattern == spelling:
                    yield last, ids


def _hits(column: pa.Array, groups: list[Group], before_spans: list[list[int]], before_items: list[list[str]]):
    """For each text: its word count, hit words as [first, behind, first, behind ...], item ids; joined to those before."""
    data, offsets = texts.flat(column)
    found = texts.words(data, offsets, texts.ALNUM)
    edges = np.zeros(len(found.hashes) + 1, np.int64)
    items = [set(x) for x in before_items]
    for i, spans in enumerate(before_spans):
        np.add.at(edges, found.bounds[i] + np.array(spans[::2], np.int64), 1)
        np.add.at(edges, found.bounds[i] + np.array(spans[1::2], np.int64), -1)
    for group in groups:
        for last, ids in _search(data, found, group):
            edges[last - group.length + 1] += 1
            edges[last + 1] -= 1
            items[int(np.searchsorted(found.bounds, last, "right")) - 1].update(ids)
    inside = np.cumsum(edges)[:-1] > 0
    spans = []
    for lo, hi in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist()):
        own = inside[lo:hi]
        spans.append(np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0])))).tolist() if own.any() else [])
    return np.diff(found.bounds), spans, [sorted(x) for x in items]


def search(df: DataFrame, text: str, benchmark: DataFrame, item: str = "item_id", item_text: str = "text", width: int = 13, part_bytes: int = 16 << 20) -> DataFrame:
    """Rows of ``df`` with ``n_words``, ``hit_spans`` and ``hit_items``.

    ``hit_spans`` lists disjoint runs of hit words as first, behind, first, behind, and so on;
    ``hit_items`` the ids (as text, sorted) of the items of which a window occurs. A null text has no
    words. Items that share an id count as one; words of an item without id are hit but it is not
    listed. Columns of those three names are replaced.
    """
    df = df.drop("n_words", "hit_spans", "hit_items")
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    parts = total // part_bytes + 1
    schema = StructType([*df.schema.fields]).add("n_words", LongType()).add("hit_spans", ArrayType(LongType())).add("hit_items", ArrayType(StringType()))
    context = df.sparkSession.sparkContext
    out = df.select("*", F.lit(0).cast("bigint").alias("n_words"), F.array().cast("array<bigint>").alias("hit_spans"), F.array().cast("array<string>").alias("hit_items"))
    for i in range(parts):
        own = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == i)
        shared = context.broadcast([tuple(g) for g in compile_patterns([tuple(r) for r in own.collect()], width)])

        def work(part: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            rest = part.drop_columns(["n_words", "hit_spans", "hit_items"])
            counts, spans, items = _hits(part.column(text), [Group(*g) for g in shared.value], part.column("hit_spans").to_pylist(), part.column("hit_items").to_pylist())
            return texts.with_columns(rest, n_words=pa.array(counts, pa.int64()), hit_spans=pa.array(spans, pa.list_(pa.int64())), hit_items=pa.array(items, pa.list_(pa.string())))

        out = out.mapInArrow(texts.on_slices(text, work), schema)
    return out


def judged(df: DataFrame) -> DataFrame:
    """From ``search``'s columns: ``n_hit`` and ``contaminated`` (a twentieth of the words or more are hit)."""
    signed = F.transform("hit_spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    df = df.withColumn("n_hit", F.aggregate(signed, F.lit(0).cast("bigint"), lambda a, x: a + x))
    return df.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
