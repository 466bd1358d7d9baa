"""Words and shingles of whole texts as numpy arrays, inside Spark tasks.

Texts arrive as Arrow columns; their bytes are read in place. A word is a run of bytes that a
table admits, so bytes of longer UTF-8 letters are word bytes. Words and shingles become 64-bit
hashes: two different ones collide with a chance of 2^-64 a pair.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 20  # text handled at once within a task; a single longer text is handled alone
BLOCK = 1 << 18  # bytes hashed at once, so that the working arrays stay in the cache


def _table(*, but: bytes = b"", only: bytes = b"") -> np.ndarray:
    table = np.full(256, bool(but))
    table[list(but or only)] = bool(only)
    return table


#: Word bytes of the two word patterns in use.
PLAIN = _table(but=b" \t\n\x0b\x0c\r")
ALNUM = _table(only=bytes([*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(128, 256)]))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> U(33))
    h *= U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
LOWER_VALUES = BYTE_VALUES[LOWER]
STEP = U(0x9E3779B97F4A7C55)
STEP_BACK = U(pow(int(STEP), -1, 1 << 64))
MULTIPLIERS = [U(x) for x in mix(np.arange(901, 933, dtype=U)) | U(1)]

_powers = {"up": np.ones(1, U), "down": np.ones(1, U)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP^i and STEP^-i for i < n."""
    if len(_powers["up"]) < n:
        for name, step in (("up", STEP), ("down", STEP_BACK)):
            row = np.full(max(n, BLOCK + 4096), step)
            row[0] = 1
            _powers[name] = np.cumprod(row)
    return _powers["up"][:n], _powers["down"][:n]


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins and ends. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) and column.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words(NamedTuple):
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # of text i: words bounds[i] to bounds[i + 1]


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = PLAIN, values: np.ndarray = LOWER_VALUES) -> Words:
    """Every word of every text, hashed; with ``LOWER_VALUES`` A-Z count as a-z."""
    hashes, starts, ends, at, total = [], [], [], 0, len(data)
    while at < total:
        end = min(at + BLOCK, total)
        while end < total and table[data[end]] and table[data[end - 1]]:  # a word goes on here: cut behind it
            outside = np.flatnonzero(~table[data[end : end + 65536]])
            end = end + int(outside[0]) if len(outside) else min(end + 65536, total)
        block = data[at:end]
        inside = table[block]
        first = np.zeros(len(block) + 1, bool)  # where a text begins
        lo, hi = np.searchsorted(offsets, (at, end))
        first[offsets[lo:hi] - at] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | first[1:-1]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:] | first[1:-1]
        b, e = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        up, down = powers(len(block) + 1)
        sums = np.zeros(len(block) + 1, U)
        np.cumsum(values[block] * up[:-1], out=sums[1:])
        hashes.append(mix((sums[e] - sums[b]) * down[b]))
        starts.append(b + at)
        ends.append(e + at)
        at = end
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    starts = join(starts, np.int64)
    return Words(join(hashes, U), starts, join(ends, np.int64), np.searchsorted(starts, offsets))


def shingles(found: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``k`` words in order, and their bounds by text.

    A text of fewer words, but not none, has its whole sequence as its only shingle.
    """
    h, bounds = found.hashes, found.bounds
    counts = np.diff(bounds)
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(out_bounds[-1], U)
    if len(h) >= k:
        n = len(h) - k + 1
        runs = np.zeros(n, U)
        for i in range(k):
            runs += h[i : i + n] * MULTIPLIERS[i]
        text = np.repeat(np.arange(len(counts)), counts)
        whole = np.flatnonzero(text[:n] == text[k - 1 :])
        out[out_bounds[text[whole]] + whole - bounds[text[whole]]] = mix(runs[whole])
    for size in range(1, k):
        short = np.flatnonzero(counts == size)
        if len(short):
            run = np.full(len(short), U(size))
            for i in range(size):
                run = run * MULTIPLIERS[k] + h[bounds[short] + i] * MULTIPLIERS[i]
            out[out_bounds[short]] = mix(run)
    return out, out_bounds


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``SLICE_BYTES`` of text, or a single row."""
    sizes = np.diff(flat(batch.column(column))[1]) if batch.num_rows else np.zeros(0)
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > SLICE_BYTES:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def release() -> None:
    """Give free memory back to the system: a worker lives on and would keep what its largest task took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library keeps its own ways
        pass


def on_slices(column: str, work: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """Function for mapInArrow that applies ``work`` to parts of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                yield work(part)
        release()

    return run


def with_columns(batch: pa.RecordBatch, **columns) -> pa.RecordBatch:
    """The batch with further columns behind its own."""
    made = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *columns])
