"""Two tokenizers' tokens of the same texts, aligned by diagonal run skipping.

Each text with one space before it is encoded by a byte-level BPE (A) and by a piece model that adds
the space itself (B). The ends of their tokens are byte offsets, and tokens of A and B that end
together cut the text into groups. The two arrays of ends are compared at the current index shift:
8, 16, 32, ... entries at once as long as they are equal, the first difference read off their bits, so a
one-to-one stretch is jumped in a few comparisons. Where the run breaks, the side that lags is
advanced until both end together again, which makes one irregular group and the next shift.

The last tokens of a group end together and are linked. How often a pair of ids is linked in the whole
corpus is counted by Spark. The most frequent pairs, at most ``head`` of them, travel to the tasks as a
table; the others, each of them a share of at most 2 / ``head`` of all links, are joined by a shuffle.

Texts longer than ``chunk`` characters are encoded in parts cut at single blanks between other
characters: neither tokenizer has a token across such a place, and both sides end there. Where a
tokenizer's file does not guarantee that, texts stay whole. A file of A that holds plain byte-level
merges in the order of their ids is encoded by rank with a faster library, any other by its own.

A text that is null or empty, or that either side does not spell again byte for byte, has no tokens:
all its counts are 0 and its digest is ''. Equal rows are rows of their own, ids are not looked at,
columns named like a result are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialise
from . import texts

CHUNK = 1 << 18  # characters encoded at once
HEAD = 1 << 18  # pairs of ids that travel to the tasks
PROBE = 8  # ends compared at first
END = (1 << 32) - 1
#: Fixed value: the pattern by which byte-level tokenizer files split texts unless they say otherwise.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary spells each byte: printable ones as they are, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokenizers:
    """Both tokenizers and the bytes of each of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tokenizers

        with open(a_path, encoding="utf-8") as file:
            said = json.load(file)
        letters, model, before = byte_letters(), said["model"], said.get("pre_tokenizer") or {}
        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        spelled = {i: bytes(letters[c] for c in token) for token, i in model["vocab"].items() if all(c in letters for c in token)}
        self.a_bytes = [spelled.get(i, b"") for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side], np.uint32) for side in (self.a_bytes, self.b_bytes))
        byte_level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not said.get("normalizer")
        self.cuts = byte_level and not any("▁" in p.lstrip("▁") for p in pieces)
        # Two forms of every token's id: within its group, and as the group's last of its side.
        ids_a, ids_b = range(len(self.a_bytes)), range(len(self.b_bytes))
        self.words = np.array([f"{i}{end}" for ids, ends in ((ids_a, ",|"), (ids_b, ",;")) for i in ids for end in ends], "S")
        self.ranked = None
        merged = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model.get("merges", [])]
        special = {t["id"] for t in said.get("added_tokens", [])}
        odd = any(model.get(x) for x in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        if byte_level and not odd and model.get("type") == "BPE" and merged == sorted(set(merged)) and len(merged) + 256 == len(spelled.keys() - special):
            import tiktoken

            ranks = {token: i for i, token in spelled.items() if i not in special}
            self.ranked = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def parts(self, text: str, chunk: int) -> Iterator[str]:
        """The text behind a space, in parts of about ``chunk`` characters that each begin with one."""
        text = " " + text
        begin = 0
        while self.cuts and len(text) - begin > chunk and (cut := _CUT.search(text, begin + chunk)):
            yield text[begin : cut.start()]
            begin = cut.start()
        yield text[begin:]

    def encode(self, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides for each part; None if a side does not spell it again."""
        left = map(self.ranked.encode_to_numpy, parts) if self.ranked else (np.array(x.ids) for x in self.a.encode_batch_fast(parts, add_special_tokens=False))
        right = self.b.encode([p[1:] for p in parts], num_threads=1)
        for part, a, b in zip(parts, left, right):
            raw = part.encode()
            # Encoding by rank leaves out no byte.
            same = (self.ranked or b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw) and b"".join(map(self.b_bytes.__getitem__, b)) == raw
            yield (a.astype(np.int64), np.array(b, np.int64)) if same else None


_loaded: dict[tuple[str, str], Tokenizers] = {}


def tokenizers_of(a_path: str, b_path: str) -> Tokenizers:
    """One pair of tokenizers a Python worker and files."""
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Tokenizers(a_path, b_path)
    return _loaded[a_path, b_path]


def runs(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """(i, j, n): a[i + t] equals b[j + t] for t < n, all equal entries of two rising arrays (uint32, below END), run by run."""
    at_a, at_b = [*a.tolist(), END], [*b.tolist(), END]
    # Behind the last entries stand different marks, so that every run ends there.
    raw_a, raw_b = np.append(a, np.uint32(END)).tobytes(), np.append(b, np.uint32(END - 1)).tobytes()
    found, i, j, whole = [], 0, 0, int.from_bytes
    while True:
        x, y = at_a[i], at_b[j]
        while x != y:  # an irregular group
            if x < y:
                i += 1
                x = at_a[i]
            else:
                j += 1
                y = at_b[j]
        if x == END:
            return found
        here, there, step = 4 * i, 4 * j, 4 * PROBE
        while not (differ := whole(raw_a[here : here + step], "little") ^ whole(raw_b[there : there + step], "little")):
            here, there, step = here + step, there + step, 2 * step
        n = (here >> 2) - i + ((differ & -differ).bit_length() - 1 >> 5)
        found.append((i, j, n))
        i, j = i + n, j + n


def align(tool: Tokenizers, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group the places of its last tokens in ``a`` and in ``b``."""
    found = runs(np.cumsum(tool.a_sizes[a], dtype=np.uint32), np.cumsum(tool.b_sizes[b], dtype=np.uint32))
    begins_a, begins_b, sizes = np.array(found, np.int64).reshape(-1, 3).T
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(begins_a, sizes) + within, np.repeat(begins_b, sizes) + within


def spelled(tool: Tokenizers, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> bytes:
    """The groups as text: ``a1,a2|b1;a3|b2,b3``, and a semicolon behind the last."""
    out = np.empty(len(a) + len(b), np.int64)
    for ids, last, other, base in ((a, last_a, np.concatenate(([0], last_b + 1)), 0), (b, last_b, last_a + 1, 2 * len(tool.a_bytes))):
        sizes = np.diff(last, prepend=-1)
        ends = np.zeros(len(ids), np.int64)
        ends[last] = 1
        # Before a group's ids stand those of the other side: of the groups before it, for B of its own too.
        out[np.arange(len(ids)) + np.repeat(other[: len(last)], sizes)] = base + 2 * ids + ends
    return tool.words[out].tobytes().translate(None, b"\0")


class _Row:
    """What the parts of one text add up to."""

    def __init__(self):
        self.whole, self.a, self.b, self.groups, self.pairs, self.times, self.sha = True, 0, 0, 0, [], [], hashlib.sha256()

    def add(self, tool: Tokenizers, ids: tuple[np.ndarray, np.ndarray] | None) -> None:
        self.whole = self.whole and ids is not None
        if not self.whole:
            return
        a, b = ids
        last_a, last_b = align(tool, a, b)
        self.sha.update((b";" if self.groups else b"") + spelled(tool, a, b, last_a, last_b)[:-1])
        pairs, times = np.unique(a[last_a] << 32 | b[last_b], return_counts=True)
        self.pairs.append(pairs)
        self.times.append(times)
        self.a, self.b, self.groups = self.a + len(a), self.b + len(b), self.groups + len(last_a)
        if len(self.pairs) > 16:
            self.links()

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Different pairs of ids (A's in the upper half) and how often each is linked."""
        if len(self.pairs) > 1:
            pairs, place = np.unique(np.concatenate(self.pairs), return_inverse=True)
            self.times = [np.bincount(place, np.concatenate(self.times)).astype(np.int64)]
            self.pairs = [pairs]
        return (self.pairs[0], self.times[0]) if self.pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _listed(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *rows]), kind))


def links(df: DataFrame, text: str, a_path: str, b_path: str, chunk: int = CHUNK) -> DataFrame:
    """``df`` without ``text``, with n_a, n_b, n_groups (bigint), groups_sha256, and the different
    linked pairs of each text: __pairs (A's id in the upper 32 bits, B's in the lower) and __times."""
    made = StructType.fromDDL("n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, __pairs array<bigint>, __times array<int>")
    named = df.withColumn("__text", F.col(text)).drop(text, *made.names)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        tool = tokenizers_of(a_path, b_path)
        rows = [_Row() for _ in range(part.num_rows)]

        def flush(waiting: list[tuple[_Row, str]]) -> None:
            for (row, _), ids in zip(waiting, tool.encode([p for _, p in waiting])):
                row.add(tool, ids)

        waiting, size = [], 0
        for row, cell in zip(rows, part.column("__text")):
            cell = cell.as_py()
            if not cell:
                row.whole = False
                continue
            for piece in tool.parts(cell, chunk):
                waiting.append((row, piece))
                size += len(piece)
                if size >= chunk:
                    flush(waiting)
                    waiting, size = [], 0
        flush(waiting)
        kept = [r if r.whole else _Row() for r in rows]
        pairs, times = zip(*[r.links() for r in kept])
        return texts.with_columns(
            part.drop_columns(["__text"]), n_a=pa.array([r.a for r in kept], pa.int64()), n_b=pa.array([r.b for r in kept], pa.int64()),
            n_groups=pa.array([r.groups for r in kept], pa.int64()), groups_sha256=pa.array([r.sha.hexdigest() if r.groups else "" for r in kept], pa.string()),
            __pairs=_listed(pairs, pa.int64()), __times=_listed(times, pa.int32()),
        )

    schema = StructType([f for f in named.schema.fields if f.name != "__text"] + made.fields)
    return named.mapInArrow(texts.on_slices("__text", work), schema)


def pair_counts(linked: DataFrame) -> DataFrame:
    """(pair, count, best): corpus-wide count of every linked pair, and whether it is its B id's highest (ties included)."""
    each = linked.select(F.explode(F.arrays_zip("__pairs", "__times")).alias("x")).select(F.col("x.__pairs").alias("pair"), F.col("x.__times").alias("times"))
    counts = each.groupBy("pair").agg(F.sum("times").alias("count")).withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1))
    counts = materialise(counts, "pair-counts")
    # One row for each id of B; a B id has at most as many partners as A has ids.
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def _least_of_head(counts: DataFrame, head: int) -> int:
    """The smallest power of two that at most ``head`` counts reach."""
    sizes = dict(counts.groupBy(F.floor(F.log2("count")).cast("int").alias("size")).count().collect())  # 63 rows at most
    total = 0
    for size in range(max(sizes, default=0), -1, -1):
        total += sizes.get(size, 0)
        if total > head:
            return 1 << (size + 1)
    return 1


def counted(linked: DataFrame, head: int = HEAD) -> DataFrame:
    """The rows of ``links`` with n_links, n_best and count_sum (bigint) instead of the pairs themselves."""
    rows = materialise(linked.withColumn("__row", F.monotonically_increasing_id()), "links")
    counts = materialise(pair_counts(rows), "pairs")
    least = _least_of_head(counts, head)
    top = counts.where(F.col("count") >= least).orderBy("pair").toArrow()
    sent = rows.sparkSession.sparkContext.broadcast([top.column(c).to_numpy() for c in ("pair", "count", "best")])
    made = StructType.fromDDL("n_links bigint, n_best bigint, count_sum bigint, __rest array<struct<pair: bigint, times: int>>")
    fields = [f for f in rows.schema.fields if f.name not in {"__pairs", "__times", *made.names}]
    rest = pa.struct([("pair", pa.int64()), ("times", pa.int32())])

    def look_up(batches):
        pair, count, best = sent.value
        for batch in batches:
            ends = batch.column("__times").offsets.to_numpy()
            ends, own, times = ends - ends[0], batch.column("__pairs").flatten().to_numpy(), batch.column("__times").flatten().to_numpy().astype(np.int64)
            place = np.minimum(np.searchsorted(pair, own), max(len(pair) - 1, 0))
            known = pair[place] == own if len(pair) else np.zeros(len(own), bool)
            tally = np.zeros((3, len(own) + 1), np.int64)
            tally[0, 1:] = times
            if len(pair):
                tally[1, 1:], tally[2, 1:] = times * (known & best[place]), times * known * count[place]
            n_links, n_best, count_sum = np.diff(np.cumsum(tally, axis=1)[:, ends], axis=1)
            left = np.concatenate(([0], np.cumsum(~known)))[ends].astype(np.int32)
            tail = pa.StructArray.from_arrays([pa.array(own[~known], pa.int64()), pa.array(times[~known], pa.int32())], fields=list(rest))
            yield texts.with_columns(
                batch.select([f.name for f in fields]), n_links=pa.array(n_links), n_best=pa.array(n_best), count_sum=pa.array(count_sum),
                __rest=pa.ListArray.from_arrays(pa.array(left), tail),
            )

    known = materialise(rows.mapInArrow(look_up, StructType([*fields, *made.fields])), "linked")
    each = known.select("__row", F.explode("__rest").alias("x")).select(F.col("__row").alias("__of"), "x.pair", "x.times")
    tail = each.join(counts.where(F.col("count") < least), "pair").groupBy("__of").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("__best"), F.sum(F.col("times") * F.col("count")).alias("__sum"),
    )
    both = known.join(tail, F.col("__row") == F.col("__of"), "left")
    add = lambda name, more: (F.col(name) + F.coalesce(F.col(more), F.lit(0))).alias(name)
    return both.select(*[f.name for f in fields if f.name != "__row"], "n_links", add("n_best", "__best"), add("count_sum", "__sum"))


def digests(df: DataFrame, text: str, a_path: str, b_path: str, chunk: int = CHUNK, head: int = HEAD) -> DataFrame:
    """``df`` without ``text``, with n_a, n_b, n_groups, groups_sha256, n_links, n_best and count_sum."""
    return counted(links(df.drop("n_links", "n_best", "count_sum"), text, a_path, b_path, chunk), head)


def groups(df: DataFrame, text: str, a_path: str, b_path: str, output: str = "groups", chunk: int = CHUNK) -> DataFrame:
    """Every row with the groups of its text: array of (a: ids of A, b: ids of B), empty without tokens."""
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
    df = df.drop(output)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        tool, out = tokenizers_of(a_path, b_path), []
        for cell in part.column(text):
            found = []
            for ids in tool.encode(list(tool.parts(cell.as_py(), chunk))) if cell.as_py() else ():
                if ids is None:
                    found = []
                    break
                i = j = 0
                for x, y in zip(*(side.tolist() for side in align(tool, *ids))):
                    found.append({"a": ids[0][i : x + 1], "b": ids[1][j : y + 1]})
                    i, j = x + 1, y + 1
            out.append(found)
        return texts.with_columns(part, __groups=pa.array(out, kind))

    schema = StructType([*df.schema.fields, *StructType.fromDDL("__groups array<struct<a: array<int>, b: array<int>>>").fields])
    return df.mapInArrow(texts.on_slices(text, work), schema).withColumnRenamed("__groups", output)
