"""Quality classifier: supervised subword embeddings.

A document has three families of features: words, pairs of neighbouring words (hashed from the
difference of their hashes, so a word repeated at once is one feature whatever the word), and byte
n-grams. Each feature's hash picks a learned vector; a family's vectors are averaged, the averages
added up, and a linear softmax over two classes gives the probability of label 1. Vectors and
softmax are trained together by stochastic gradient descent in numpy.

Training runs in one task on at most ``sample`` labelled documents with their whole texts, the
first by a hash of their id: a documented bound that does not grow with the corpus. Scoring reads
every whole text. A document's score is linear in its averaged vectors, so executors get the
product of vectors and softmax weights: one number a bucket, ``2 ** bits`` in all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import texts

U = np.uint64
GRAMS = (3, 4, 5)
FAMILIES = 2 + len(GRAMS)


@dataclass(frozen=True)
class Settings:
    bits: int = 17  # buckets: 2 ** bits
    width: int = 8  # length of the vectors
    passes: int = 4
    rate: float = 1.0
    sample: int = 3000  # most documents to train on
    seed: int = 7


def _features(data: np.ndarray, offsets: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each family the bucket of every feature in order, and the bounds of each text's features."""
    shift = U(64 - bits)
    found = texts.words(data, offsets, texts.PLAIN, texts.BYTE_VALUES)
    yield (texts.mix(found.hashes ^ U(1)) >> shift).astype(np.int64), found.bounds
    pairs = texts.mix(np.diff(found.hashes) ^ U(2)) if len(found.hashes) else found.hashes
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(found.bounds))
    same = text[1:] == text[:-1]
    yield (pairs[same] >> shift).astype(np.int64), np.concatenate(([0], np.cumsum(np.bincount(text[1:][same], minlength=len(offsets) - 1))))
    up, down = texts.powers(texts.BLOCK + 16)
    lengths = np.diff(offsets)
    for n in GRAMS:
        buckets = np.empty(max(len(data) - n + 1, 0), np.int64)
        for at in range(0, len(buckets), texts.BLOCK):
            block = data[at : at + texts.BLOCK + n - 1]
            sums = np.zeros(len(block) + 1, U)
            np.cumsum(texts.BYTE_VALUES[block] * up[: len(block)], out=sums[1:])
            count = len(block) - n + 1
            grams = (sums[n:] - sums[:-n]) * down[:count]
            buckets[at : at + count] = texts.mix(grams ^ U(n)) >> shift
        # Grams that would reach into the next text are left out.
        left = np.maximum(lengths - n + 1, 0)
        inside = np.ones(len(buckets), bool)
        for d in range(1, n):
            past = offsets[1:] - d
            past = past[(past >= offsets[:-1]) & (past < len(buckets))]
            inside[past] = False
        yield buckets[inside], np.concatenate(([0], np.cumsum(left)))


def _means(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)


def scores(column: pa.Array, table: np.ndarray, bias: float) -> np.ndarray:
    """Probability of label 1 for every text."""
    data, offsets = texts.flat(column)
    margin = np.full(len(offsets) - 1, bias)
    bits = int(len(table)).bit_length() - 1
    for buckets, bounds in _features(data, offsets, bits):
        margin += _means(table[buckets], bounds)
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent over documents given as (buckets, weights); weights are those of the averages."""
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1, 1, (1 << settings.bits, settings.width)).astype(np.float32) / settings.width
    weights = np.zeros((settings.width, 2), np.float32)
    bias = np.zeros(2, np.float32)
    steps, done = settings.passes * len(docs), 0
    for _ in range(settings.passes):
        for i in rng.permutation(len(docs)):
            rate = np.float32(settings.rate * (1 - done / steps))
            done += 1
            buckets, share = docs[i]
            hidden = share @ vectors[buckets]
            logits = hidden @ weights + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[labels[i]] -= 1
            vectors[buckets] -= rate * np.outer(share, weights @ error)
            weights -= rate * np.outer(hidden, error)
            bias -= rate * error
    margins = weights[:, 1] - weights[:, 0]
    return vectors @ margins, float(bias[1] - bias[0])


def fit(labelled: DataFrame, text: str, label: str, key: str, settings: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Train on rows with a label of 0 or 1; without any, every text scores one half.

    ``labelled`` is cut to the ``sample`` rows first by the hash of ``key``; its texts count whole,
    null as empty. Returns the number of each bucket and the bias.
    """
    rows = labelled.where(F.col(label).isin(0, 1)).select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"), F.xxhash64(F.col(key).cast("string"), F.lit(settings.seed)).alias("order"))
    rows = rows.orderBy("order", F.xxhash64("text"), "label").limit(settings.sample).select("text", "label")

    def train(batches):
        docs, labels = [], []
        for batch in batches:
            for part in texts.slices(batch, "text"):
                labels += part.column("label").to_pylist()
                own = [([], []) for _ in range(part.num_rows)]
                for buckets, bounds in _features(*texts.flat(part.column("text")), settings.bits):
                    for i, (ids, shares) in enumerate(own):
                        found, counts = np.unique(buckets[bounds[i] : bounds[i + 1]], return_counts=True)
                        ids.append(found.astype(np.int32))
                        shares.append((counts / max(counts.sum(), 1)).astype(np.float32))
                for ids, shares in own:
                    # One entry a bucket: a bucket in several families adds up.
                    found, back = np.unique(np.concatenate(ids), return_inverse=True)
                    docs.append((found, np.bincount(back, np.concatenate(shares), len(found)).astype(np.float32)))
        if docs:
            table, bias = _train(docs, np.array(labels), settings)
            yield pa.record_batch({"table": pa.array([table.astype(np.float32).tobytes()]), "bias": pa.array([bias])})
        docs.clear()
        texts.release()

    made = rows.repartition(1).mapInArrow(train, "table binary, bias double").collect()
    if not made:
        return np.zeros(1 << settings.bits, np.float32), 0.0
    return np.frombuffer(made[0]["table"], np.float32), made[0]["bias"]


def score(df: DataFrame, text: str, model: tuple[np.ndarray, float], output: str = "score") -> DataFrame:
    """Every row with the probability of label 1 in ``output``; null texts count as empty.

    An empty text has no features and gets the score of the bias alone. A column named like
    ``output`` is replaced.
    """
    df = df.drop(output)
    table, bias = df.sparkSession.sparkContext.broadcast(model[0]), model[1]

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        return texts.with_columns(part, __score=pa.array(scores(part.column(text), table.value, bias)))

    from pyspark.sql.types import DoubleType, StructType

    schema = StructType([*df.schema.fields]).add("__score", DoubleType())
    return df.mapInArrow(texts.on_slices(text, work), schema).withColumnRenamed("__score", output)


def fold(key: str) -> Column:
    """Hash of an id's decimal text modulo five; a null id is in none."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def train_on(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Model from ``labels.quality`` of the documents outside fold 0.

    Labels that occur several times for one id count by their mean, a tie as 1. The ids of the
    sample are chosen before texts are read, so only those rows (at most ``sample`` ids) are joined.
    """
    rows = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id") != 0))
    rows = rows.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("__label"))
    rows = rows.orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(settings.seed)), "doc_id").limit(settings.sample)
    joined = documents.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
    return fit(joined, "text", "__label", "doc_id", settings)


def judge(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, settings: Settings = Settings()) -> DataFrame:
    """Documents with ``score`` and ``predicted`` (1 at the threshold and above)."""
    scored = score(documents.drop("predicted"), "text", train_on(documents, labels, settings))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
