"""Byte-level BPE encoding and decoding.

Texts of at most ``chunk`` characters are pre-tokenised and encoded in their row. A longer text is
cut into overlapping chunks that are pre-tokenised in parallel: a chunk that begins in the middle of
a pre-token soon falls into step with its predecessor, and from a boundary that both have inside
their overlap all further boundaries agree, since a pre-token depends only on what follows its
beginning. The text is cut at the first such boundary of each overlap, the pieces are encoded on
their own, and their ids are joined in order. Neighbours without a common boundary stay one piece.

Within a pre-token the pair of lowest rank is merged first, the leftmost of equals; a pre-token that
is a token itself is that token. Decoding joins the raw bytes of the tokens.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import texts

CACHE = 150_000  # pre-tokens whose ids a Python worker keeps, as bytes
DECODED = 1 << 16  # ids decoded at once


class Codec:
    """Encoder and decoder for one file of ranks."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token, by repeated merging of the pair of lowest rank."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        ends, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        # Pairs by rank, then by place; a pair is out of date when one of its parts has grown or gone.
        heap = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if ends[i] < 0 or j >= n or ends[j] != end:
                continue
            ends[i], ends[j], after[i] = end, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                rank = ranks.get(piece[i : ends[after[i]]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ends[after[i]]))
            if before[i] >= 0:
                rank = ranks.get(piece[before[i] : end])
                if rank is not None:
                    heapq.heappush(heap, (rank, before[i], end))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : ends[i]]])
            i = after[i]
        return ids

    def encode(self, text: str) -> np.ndarray:
        known, ids = self.known, []
        for piece in self.pattern.findall(text):
            own = known.get(piece)
            if own is None:
                own = array("i", self.merge(piece.encode())).tobytes()
                if len(known) < CACHE and len(piece) < 64:
                    known[piece] = own
            ids.append(own)
        return np.frombuffer(b"".join(ids), np.int32)

    def decode(self, ids: np.ndarray | list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.asarray(ids).tolist()))

    def boundaries(self, text: str) -> list[int]:
        """Ends of the pre-tokens."""
        return [m.end() for m in self.pattern.finditer(text)]


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec a Python worker and file."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


class Decoder:
    """The tokens of one file of ranks, as one row of bytes: a worker that only decodes holds nothing else."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            tokens = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines if line.strip())}
        sizes = np.full(max(tokens, default=-1) + 1, -1, np.int64)  # -1: an id without token
        sizes[list(tokens)] = [len(t) for t in tokens.values()]
        self.known = sizes >= 0
        self.ends = np.cumsum(np.maximum(sizes, 0))
        self.sizes = np.maximum(sizes, 0)
        self.bytes = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        if len(ids) and not (ids.min() >= 0 and ids.max() < len(self.known) and self.known[ids].all()):
            raise KeyError("an id without token")
        out = []
        for at in range(0, len(ids), DECODED):
            own = ids[at : at + DECODED]
            sizes = self.sizes[own]
            ends = np.cumsum(sizes)
            out.append(self.bytes[np.arange(sizes.sum()) + np.repeat(self.ends[own] - ends, sizes)].tobytes())
        return b"".join(out)


_decoders: dict[str, Decoder] = {}


def decoder(path: str) -> Decoder:
    """One decoder a Python worker and file."""
    if path not in _decoders:
        _decoders[path] = Decoder(path)
    return _decoders[path]


def _parts(batch: pa.RecordBatch, ids: str):
    """Parts of a batch of at most about ``texts.SLICE_BYTES`` of ids, or a single row."""
    sizes = 4 * batch.column(ids).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > begin and total + size > texts.SLICE_BYTES:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def _per_text(df: DataFrame, text: str, path: str, pattern: str, columns: str, finish) -> DataFrame:
    """``df`` without ``text``, with what ``finish(codec, ids)`` makes of every text."""
    made = StructType.fromDDL(columns)
    schema = StructType([f for f in df.schema.fields if f.name != text] + made.fields)
    kinds = pa.schema([(f.name, {"bigint": pa.int64(), "string": pa.string()}.get(f.dataType.simpleString(), pa.list_(pa.int32()))) for f in made.fields])

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        tool = codec(path, pattern)
        rows = [finish(tool, tool.encode(t or "")) for t in part.column(text).to_pylist()]
        own = {k.name: pa.array([r[i] for r in rows], k.type) for i, k in enumerate(kinds)}
        return texts.with_columns(part.drop_columns([text]), **own)

    return df.mapInArrow(texts.on_slices(text, work), schema)


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, k, begin, part): the overlapping chunks of each different text, once."""
    starts = F.sequence(F.lit(0), F.greatest(F.length("text") - overlap - 1, F.lit(0)), F.lit(chunk))
    rows = long.select("key", "text", F.posexplode(starts).alias("k", "begin"))
    return rows.select("key", "k", "begin", F.substring("text", F.col("begin") + 1, F.lit(chunk + overlap)).alias("part")).dropDuplicates(["key", "k"])


def _pieces(long: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(key, piece, text): the texts cut where the pre-tokens of neighbouring chunks agree."""
    parts = _chunks(long, chunk, overlap)

    def edges(part: pa.RecordBatch) -> pa.RecordBatch:
        heads, tails = [], []
        for begin, text in zip(part.column("begin").to_pylist(), part.column("part").to_pylist()):
            found = codec(path, pattern).boundaries(text)
            # The last one is due to the cut, not to the text.
            tails.append([begin + x for x in found[:-1] if x >= chunk])
            heads.append([begin + x for x in found if x <= overlap])
        kind = pa.list_(pa.int32())
        return texts.with_columns(part.drop_columns(["part", "begin"]), head=pa.array(heads, kind), tail=pa.array(tails, kind))

    ends = parts.mapInArrow(texts.on_slices("part", edges), "key string, k int, head array<int>, tail array<int>")
    ends = ends.selectExpr("key", "k", "array_min(array_intersect(tail, lead(head) OVER (PARTITION BY key ORDER BY k))) AS cut")
    # A chunk that did not fall into step is no measure for its successor: the rest stays one piece.
    ends = ends.selectExpr("key", "k", "if(count_if(cut IS NULL) OVER (PARTITION BY key ORDER BY k) = 0, cut, NULL) AS cut")
    ends = ends.selectExpr("key", "k", "cut", "lag(cut) OVER (PARTITION BY key ORDER BY k) AS since", "count(cut) OVER (PARTITION BY key ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS piece", "k = max(k) OVER (PARTITION BY key) AS is_last")
    # Without a common boundary a chunk ends where the next begins, and both belong to one piece.
    own = parts.join(ends, ["key", "k"]).selectExpr(
        "key", "piece", "k",
        f"substring(part, coalesce(since - begin, 0) + 1, coalesce(cut - begin, if(is_last, {chunk + overlap}, {chunk})) - coalesce(since - begin, 0)) AS part",
    )
    joined = own.groupBy("key", "piece").agg(F.array_sort(F.collect_list(F.struct("k", "part"))).alias("parts"))
    return joined.select("key", "piece", F.array_join(F.col("parts.part"), "").alias("text"))


def encode(df: DataFrame, text: str, path: str, pattern: str, output: str = "ids", chunk: int = 65536, overlap: int = 1024) -> DataFrame:
    """Every row with the ids of its whole text in ``output`` (array of int); a null text has none.

    Rows may repeat and lack ids: long texts are followed by their own SHA-256. A column named like
    ``output`` is replaced.
    """
    return _encoded(df.drop(output), text, path, pattern, f"{output} array<int>", lambda tool, ids: (ids,), chunk, overlap)


def _encoded(df: DataFrame, text: str, path: str, pattern: str, columns: str, finish, chunk: int, overlap: int) -> DataFrame:
    named = df.withColumn("__text", F.col(text))
    length = F.coalesce(F.length("__text"), F.lit(0))
    short = _per_text(named.where(length <= chunk), "__text", path, pattern, columns, finish)
    long = named.where(length > chunk).withColumn("__key", F.sha2("__text", 256))
    pieces = _per_text(_pieces(long.select(F.col("__key").alias("key"), F.col("__text").alias("text")), path, pattern, chunk, overlap), "text", path, pattern, "__ids array<int>", lambda tool, ids: (ids,))
    whole = pieces.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("piece", "__ids"))).alias("parts")).select("key", F.flatten(F.col("parts.__ids")).alias("__ids"))
    made = StructType.fromDDL(columns)
    kinds = {"bigint": pa.int64(), "string": pa.string()}

    def finished(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                values = finish(codec(path, pattern), row.column("__ids")[0].values.to_numpy())
                own = {f.name: pa.array([v], kinds.get(f.dataType.simpleString(), pa.list_(pa.int32()))) for f, v in zip(made.fields, values)}
                yield texts.with_columns(row.drop_columns(["__ids"]), **own)

    whole = whole.mapInArrow(finished, StructType([whole.schema["key"], *made.fields]))
    long = long.drop("__text").join(whole, F.col("__key") == F.col("key")).drop("__key", "key")
    return short.unionByName(long)


def decode(df: DataFrame, ids: str, path: str, pattern: str, output: str = "decoded") -> DataFrame:
    """Every row with the raw bytes of its ids; null ids give no bytes, an unknown id stops the job."""
    df = df.drop(output)

    def work(batches):
        for batch in batches:
            tool = decoder(path)
            for part in _parts(batch, ids):
                # Row by row: a Python list takes many times the bytes of an Arrow one.
                decoded = (tool.decode(x.values.to_numpy()) if x.is_valid else b"" for x in part.column(ids))
                yield texts.with_columns(part, __out=pa.array(decoded, pa.binary()))
        texts.release()

    return df.mapInArrow(work, StructType([*df.schema.fields]).add("__out", "binary")).withColumnRenamed("__out", output)


def digests(df: DataFrame, text: str, path: str, pattern: str, chunk: int = 65536, overlap: int = 1024) -> DataFrame:
    """Rows with ``n_tokens``, ``ids_sha256`` of the decimal ids joined by spaces, ``decoded_sha256`` of the decoded bytes."""

    def finish(tool: Codec, ids: np.ndarray):
        sha = lambda x: hashlib.sha256(x).hexdigest()
        return len(ids), sha(" ".join(map(str, ids.tolist())).encode()), sha(tool.decode(ids))

    df = df.drop("n_tokens", "ids_sha256", "decoded_sha256")
    return _encoded(df, text, path, pattern, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", finish, chunk, overlap)
