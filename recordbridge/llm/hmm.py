"""Language-model scores from a hidden Markov model over words.

Words have classes: each of the most frequent ``own_classes`` training words is a class of its own,
the others fall into ``suffix_classes`` by a hash of their last three bytes, and the end of a text is
a class. Latent states emit classes; a class emits its words by their smoothed shares of its training
tokens, with room for one unknown word a class. So the model's tables are of fixed size, while every
count of every word of the corpus enters the likelihood.

Word counts are a shuffled aggregate of the whole training part. The most frequent ``head`` words (a
fixed bound) go to the executors; the rest of the words are joined with their counts. Baum-Welch
counts are summed over all training texts in each round, by task and then by a shuffled sum. The
likelihood of a text comes from the scaled forward recursion over its whole length. Texts are encoded
once, into a table in the shared folder, where each row also gets a number to join by.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialise
from . import texts

U = np.uint64


@dataclass(frozen=True)
class Settings:
    states: int = 4
    own_classes: int = 1000
    suffix_classes: int = 1000
    head: int = 131_072  # words whose counts every executor holds
    rounds: int = 3
    seed: int = 5
    at_once: int = 1_500_000  # tokens whose recursion runs in step


class Vocabulary(NamedTuple):
    """Counts every executor holds, as plain arrays."""

    words: np.ndarray  # hashes of the head, sorted
    counts: np.ndarray
    classes: np.ndarray
    class_room: np.ndarray  # by suffix class: log10 of tokens + (words + 1) / 2
    suffixes: int
    end: int  # class of the end


class Model(NamedTuple):
    first: np.ndarray
    step: np.ndarray
    emit: np.ndarray  # class by state


def _suffixes(data: np.ndarray, found: texts.Words, n: int) -> np.ndarray:
    code = np.zeros(len(found.starts), U)
    for i in range(1, 4):
        at = found.ends - i
        code = code * U(257) + np.where(at >= found.starts, texts.LOWER[data[np.maximum(at, 0)]].astype(U) + U(1), U(0))
    return (texts.mix(code) % U(n)).astype(np.int64)


def word_counts(df: DataFrame, text: str, suffixes: int) -> DataFrame:
    """(word, suffix, n): every word of the texts by its hash, and how often it occurs."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = texts.flat(part.column(text))
        found = texts.words(data, offsets)
        words, first, counts = np.unique(found.hashes, return_index=True, return_counts=True)
        suffix = _suffixes(data, found._replace(starts=found.starts[first], ends=found.ends[first]), suffixes)
        return pa.record_batch({"word": pa.array(words.view(np.int64)), "suffix": pa.array(suffix.astype(np.int32)), "n": pa.array(counts.astype(np.int64))})

    return df.select(text).mapInArrow(texts.on_slices(text, work), "word bigint, suffix int, n bigint").groupBy("word", "suffix").agg(F.sum("n").alias("n"))


def _vocabulary(counts: DataFrame, settings: Settings, ends: int) -> tuple[Vocabulary, np.ndarray]:
    """The shared counts, and the tokens of every class.

    The head is all words above a count that is read off a histogram of logarithms, so that no task
    sends more than its share of the head to the driver.
    """
    level = F.floor(F.log2("n") * 32)
    room, least = settings.head, None
    for row in counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        if row.words > room:
            break
        room, least = room - row.words, row.level
    head = counts.where(level >= least if least is not None else F.lit(False)).toPandas().sort_values(["n", "word"], ascending=[False, True])
    own, rest = head.iloc[: settings.own_classes], counts
    if len(own):
        n, word = int(own.n.iloc[-1]), int(own.word.iloc[-1])
        rest = counts.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word)))
    tokens, kinds = np.zeros(settings.suffix_classes), np.zeros(settings.suffix_classes)
    for row in rest.groupBy("suffix").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():
        tokens[row.suffix], kinds[row.suffix] = row.n, row.kinds
    classes = head.suffix.to_numpy(np.int64) + settings.own_classes
    classes[: len(own)] = np.arange(len(own))
    words = head.word.to_numpy(np.int64).view(U)
    order = np.argsort(words)
    totals = np.concatenate((np.pad(own.n.to_numpy(float), (0, settings.own_classes - len(own))), tokens, [ends]))
    shared = Vocabulary(words[order], head.n.to_numpy(np.int64)[order], classes[order], np.log10(tokens + 0.5 * (kinds + 1)), settings.suffix_classes, settings.own_classes + settings.suffix_classes)
    return shared, totals


def _encode(df: DataFrame, text: str, vocabulary: tuple, own_classes: int, ends: int) -> DataFrame:
    """Rows without their text, with ``__row``, class sequence, sums over head words, and tail words with their numbers."""
    schema = StructType([f for f in df.schema.fields if f.name != text])
    for column in "__row long,__n long,__head double,__inside double,__known long,__classes binary".split(","):
        schema.add(*column.split())
    schema.add("__tail", StructType.fromDDL("t array<struct<word:bigint,n:int>>")["t"].dataType)
    pair = pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int32())]))

    def work(batches):
        from pyspark import TaskContext

        v, row = Vocabulary(*vocabulary.value), TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in texts.slices(batch, text):
                data, offsets = texts.flat(part.column(text))
                found = texts.words(data, offsets)
                at = np.minimum(np.searchsorted(v.words, found.hashes), max(len(v.words) - 1, 0))
                known = v.words[at] == found.hashes if len(v.words) else np.zeros(len(found.hashes), bool)
                classes = _suffixes(data, found, v.suffixes) + own_classes
                count = np.zeros(len(classes))
                if len(v.words):
                    classes[known], count[known] = v.classes[at[known]], v.counts[at[known]]
                logs = np.where(known, np.log10(count + 0.5), 0.0)
                grouped = classes >= own_classes
                inside = np.where(grouped, logs - v.class_room[np.maximum(classes - own_classes, 0)], 0.0)
                sums = [np.concatenate(([0], np.cumsum(x))) for x in (logs, inside, known)]
                n_head, n_inside, n_known = (x[found.bounds[1:]] - x[found.bounds[:-1]] for x in sums)
                lost = np.flatnonzero(~known)
                cuts = np.searchsorted(lost, found.bounds)
                cells, tails = [], []
                for i in range(part.num_rows):
                    cells.append(np.append(classes[found.bounds[i] : found.bounds[i + 1]], v.end).astype("<u2").tobytes())
                    words, times = np.unique(found.hashes[lost[cuts[i] : cuts[i + 1]]], return_counts=True)
                    tails.append((words.view(np.int64), times))
                flat = pa.StructArray.from_arrays([pa.array(np.concatenate([w for w, _ in tails])), pa.array(np.concatenate([t for _, t in tails]).astype(np.int32))], names=["word", "n"])
                sizes = np.concatenate(([0], np.cumsum([len(w) for w, _ in tails]))).astype(np.int32)
                tail = pa.ListArray.from_arrays(pa.array(sizes), flat).cast(pair)
                end = np.log10(ends + 0.5)
                yield texts.with_columns(
                    part.drop_columns([text]), __row=pa.array(np.arange(row, row + part.num_rows)), __n=pa.array(np.diff(found.bounds) + 1), __head=pa.array(n_head + end),
                    __inside=pa.array(n_inside), __known=pa.array(n_known.astype(np.int64) + (ends > 0)), __classes=pa.array(cells, pa.binary()), __tail=tail,
                )
                row += part.num_rows

    return materialise(df.mapInArrow(work, schema), "encoded-texts")


class Steps(NamedTuple):
    """Token sequences laid out by position: at position t the longer texts come first."""

    classes: np.ndarray
    begins: np.ndarray  # of position t: begins[t] to begins[t + 1]
    rank: np.ndarray  # text of each entry, by decreasing length
    order: np.ndarray  # original number of each text


def _laid_out(cells: list[bytes]) -> Steps:
    lengths = np.array([len(c) // 2 for c in cells], np.int64)
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    flat = np.frombuffer(b"".join(cells[i] for i in order), "<u2")
    starts = np.cumsum(lengths) - lengths
    text = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(flat)) - starts[text]
    begins = np.concatenate(([0], np.cumsum(np.bincount(place))))
    classes, rank = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
    at = begins[place] + text
    classes[at], rank[at] = flat, text
    return Steps(classes, begins, rank, order)


def _in_step(cells, at_once: int):
    """Lists of neighbouring cells of at most ``at_once`` tokens, or a single one."""
    group, total = [], 0
    for cell in cells:
        if group and total + len(cell) // 2 > at_once:
            yield group
            group, total = [], 0
        group.append(cell)
        total += len(cell) // 2
    if group:
        yield group


def log_likelihoods(cells: list[bytes], model: Model) -> np.ndarray:
    """Log10 probability of each class sequence, by the scaled forward recursion."""
    steps = _laid_out(cells)
    scales = np.empty(len(steps.classes))
    state = None
    for lo, hi in zip(steps.begins[:-1].tolist(), steps.begins[1:].tolist()):
        emitted = model.emit[steps.classes[lo:hi]]
        state = emitted * model.first if state is None else (state[: hi - lo] @ model.step) * emitted
        scales[lo:hi] = state.sum(axis=1)
        state /= scales[lo:hi, None]
    out = np.empty(len(cells))
    out[steps.order] = np.bincount(steps.rank, np.log10(scales), len(cells))
    return out


def expected_counts(cells: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts of first states, transitions, and emissions by class."""
    steps = _laid_out(cells)
    first, step, emit = (x.astype(np.float32) for x in model)
    n, k = len(steps.classes), len(first)
    forward, betas, onward = (np.empty((n, k), np.float32) for _ in range(3))
    scales = np.empty(n, np.float32)
    bounds = list(zip(steps.begins[:-1].tolist(), steps.begins[1:].tolist()))
    state = None
    for lo, hi in bounds:
        emitted = emit[steps.classes[lo:hi]]
        state = emitted * first if state is None else (state[: hi - lo] @ step) * emitted
        scales[lo:hi] = state.sum(axis=1)
        state /= scales[lo:hi, None]
        forward[lo:hi] = state
    counts = np.zeros(k), np.zeros((k, k)), np.zeros((len(emit), k))
    behind, back = np.ones((0, k), np.float32), step.T.copy()
    for lo, hi in reversed(bounds):
        beta = np.ones((hi - lo, k), np.float32)
        beta[: len(behind)] = behind @ back
        # What the texts that go on hand back: emission times later evidence, scaled.
        onward[lo:hi] = emit[steps.classes[lo:hi]] * beta / scales[lo:hi, None]
        behind = onward[lo:hi]
        betas[lo:hi] = beta
    posterior = forward * betas
    for s in range(k):
        counts[2][:, s] = np.bincount(steps.classes, posterior[:, s], len(emit))
    head = slice(0, bounds[0][1])
    counts[0][:] = posterior[head].sum(axis=0)
    # Transitions: the filtered state before, the step, and what comes back from the next position.
    later = np.arange(bounds[0][1], n)
    place = np.searchsorted(steps.begins, later, "right") - 1
    counts[1][:] = (forward[steps.begins[place - 1] + steps.rank[later]].T @ onward[later]) * step
    return counts


def _start(totals: np.ndarray, settings: Settings) -> Model:
    rng = np.random.default_rng(settings.seed)
    k = settings.states
    emit = (totals + 0.5)[:, None] * np.exp(rng.normal(0, 1, (len(totals), k)))
    return Model(np.full(k, 1 / k), np.full((k, k), 0.2 / k) + 0.8 * np.eye(k), emit / emit.sum(axis=0))


def _round(encoded: DataFrame, model: Model, totals: np.ndarray, at_once: int) -> Model:
    k, classes = len(model.first), len(totals)
    shared = encoded.sparkSession.sparkContext.broadcast(tuple(model))

    def work(batches):
        sums = np.zeros(k + k * k + k * classes)
        own = Model(*shared.value)
        for batch in batches:
            for cells in _in_step(batch.column(0).to_pylist(), at_once):
                sums += np.concatenate([x.ravel() for x in expected_counts(cells, own)])
        yield pa.record_batch({"sums": pa.array([sums], pa.list_(pa.float64()))})

    made = encoded.select("__classes").mapInArrow(work, "sums array<double>").select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
    sums = np.zeros(k + k * k + k * classes)
    for row in made.collect():
        sums[row.at] = row.x
    first, step, emit = sums[:k] + 0.1, sums[k : k + k * k].reshape(k, k) + 0.1, sums[k + k * k :].reshape(classes, k)
    # Smoothed by what the classes have in all, so that no class is impossible in a state.
    emit = emit + 10 * ((totals + 0.5) / (totals + 0.5).sum())[:, None]
    return Model(first / first.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def score(df: DataFrame, text: str, training: str, settings: Settings = Settings()) -> DataFrame:
    """Rows of ``df`` without ``text`` and with n_tokens, n_known, train_tokens, base_score and score.

    ``training`` is a boolean column that marks the rows to learn from (null: not). A null text is
    empty; every text has one end token. Without training rows all words are unknown and only the
    smoothing speaks. Rows may repeat. Columns of the new names are replaced.
    """
    df = df.drop("n_tokens", "n_known", "train_tokens", "base_score", "score")
    rows = df.where(F.col(training))
    counts = materialise(word_counts(rows, text, settings.suffix_classes), "word-counts")
    ends = rows.count()
    words, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
    tokens, kinds = words + ends, kinds + (ends > 0)
    room = float(np.log10(tokens + 0.5 * (kinds + 1)))
    shared, totals = _vocabulary(counts, settings, ends)
    broadcast = df.sparkSession.sparkContext.broadcast(tuple(shared))
    encoded = _encode(df, text, broadcast, settings.own_classes, ends)
    model = _start(totals, settings)
    for _ in range(settings.rounds):
        model = _round(encoded.where(F.col(training)), model, totals, settings.at_once)
    final = df.sparkSession.sparkContext.broadcast(tuple(model))

    def forward(batches):
        own = Model(*final.value)
        for batch in batches:
            found = [log_likelihoods(cells, own) for cells in _in_step(batch.column("__classes").to_pylist(), settings.at_once)]
            yield texts.with_columns(batch.drop_columns(["__classes"]), __hidden=pa.array(np.concatenate(found) if found else np.zeros(0)))

    kept = encoded.drop("__tail")
    hidden = kept.mapInArrow(forward, StructType([f for f in kept.schema.fields if f.name != "__classes"]).add("__hidden", "double"))
    tail = encoded.select("__row", F.explode("__tail").alias("t")).select("__row", F.col("t.word").alias("word"), F.col("t.n").alias("times"))
    tail = tail.join(counts.select("word", "n"), "word", "left").groupBy("__row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("__rest"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("__more"),
    )
    rest = F.coalesce("__rest", F.lit(0.0))
    out = hidden.join(tail, "__row", "left")
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns if c != text], F.col("__n").alias("n_tokens"), (F.col("__known") + F.coalesce("__more", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"), (F.col("__head") + rest - F.col("__n") * F.lit(room)).alias("base_score"), (F.col("__hidden") + F.col("__inside") + rest).alias("score"),
    )
