"""Exact searches of vectors against brute force: the bit-sliced index and the hyperplane tree."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordbridge.llm import bitslices, hyperplanes, neighbours

FEW = bitslices.Settings(cells=1500, queries=7)
SMALL = hyperplanes.Settings(roots=5, sample=40, shard_rows=30, fan=3, leaf=8, block_rows=11)


def floored(v):
    return [math.floor(256 * float(x)) for x in v]


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def score(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_top(rows, queries, k):
    data = {(i, tuple(floored(v))) for i, v in rows if i is not None and good(v)}
    out = []
    for q in {i for i, _ in data if i in queries}:
        best = {}
        for own in [z for i, z in data if i == q]:
            for i, z in data:
                if i != q and len(z) == len(own):
                    best[i] = max(best.get(i, -math.inf), score(own, z))
        out += [(q, r, i, s) for r, (s, i) in enumerate(sorted(((-s, i) for i, s in best.items()))[:k], 1)]
    return sorted((q, r, i, -s) for q, r, i, s in out)


def brute_mine(rows, positives, negatives):
    data = {(i, label, tuple(floored(v))) for i, label, v in rows if i is not None and label is not None and good(v)}
    out = []
    for a, label, z in data:
        if a % 100:
            continue
        ranked = sorted((-score(z, y), i, other) for i, other, y in data if i != a and len(y) == len(z))
        for p, pid, _ in [x for x in ranked if x[2] == label][:positives]:
            fits = [x for x in ranked if x[2] != label and 30 * -p <= 100 * -x[0] <= 90 * -p][:negatives]
            out += [(a, pid, r, i, -p, -s) for r, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    return df.select("*", *[F.lit("x").alias(c) for c in ("id", "score", "rank", "query_id", "width", "block", "part", "cell", "ask", "low", "high", "vector")])


def rough(n, seed, scale=None):
    """Vectors around few centres, with copies, ties, zeros, nulls, and lengths that vary if ``scale`` does."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, 12))
    v = centres[rng.integers(0, 4, n)] + rng.normal(size=(n, 12)) * 0.4
    v = v / np.linalg.norm(v, axis=1, keepdims=True) * (1 if scale is None else scale(rng, n)[:, None])
    v[: n // 3] = v[0]  # a third are copies
    rows = [(i * 10, int(rng.integers(0, 3)), [float(np.float32(x)) for x in own]) for i, own in enumerate(v)]
    rows[5] = (50, 1, None)
    rows[6] = (60, 1, [1.0] * 11 + [None])
    rows[7] = (70, 1, [1.0] * 11 + [math.inf])
    rows[8] = (80, 1, [0.0] * 12)
    rows[9] = (90, None, rows[9][2])
    rows += [rows[0], rows[11], (None, 1, rows[3][2]), (100, 2, rows[40][2]), (7001, 0, [0.5] * 3), (7000, 1, [0.25] * 3), (7002, 1, [0.125] * 3), (7100, 0, []), (7101, 1, [])]
    return rows


SCALES = {"unit": None, "lognormal": lambda r, n: r.lognormal(0, 1.5, n), "outlier": lambda r, n: np.where(np.arange(n) == n - 1, 1e6, 1.0), "long": lambda r, n: np.where(np.arange(n) % 97 == 96, 3e6, 1.0)}


@pytest.mark.parametrize("scale", SCALES)
def test_bit_sliced_top_equals_brute_force(spark, scale):
    rows = rough(300, 3, SCALES[scale])
    df = frame(spark, rows)
    asked = {i for i, _, _ in rows if i is not None and i % 50 == 0}
    out = bitslices.search(bitslices.build(df, "vec_id", "embedding", FEW), df.where("vec_id % 50 = 0"), "vec_id", "embedding", 5, FEW)
    assert sorted(tuple(r) for r in out.collect()) == brute_top([(i, v) for i, _, v in rows], asked, 5)


def test_fewer_bits_and_more_answers_than_rows(spark):
    rows = rough(60, 4)
    df = frame(spark, rows)
    for bits, k in ((1, 3), (12, 500)):
        settings = bitslices.Settings(bits=bits, cells=400, queries=3)
        out = bitslices.search(bitslices.build(df, "vec_id", "embedding", settings), df, "vec_id", "embedding", k, settings)
        assert sorted(tuple(r) for r in out.collect()) == brute_top([(i, v) for i, _, v in rows], {i for i, _, _ in rows}, k)


def test_sums_of_bitmaps():
    rng = np.random.default_rng(2)
    whole = rng.integers(-300, 300, (500, 9)).astype(float)
    block = bitslices.Block.made(np.arange(500), whole, 20)
    for query in rng.integers(-400, 400, (20, 9)):
        ids, scores = bitslices.top(block, query.astype(float), 3, 7)
        exact = whole @ query
        exact[3] = -1e18
        order = np.lexsort((np.arange(500), -exact))[:7]
        assert ids.tolist() == order.tolist() and scores.tolist() == exact[order].tolist()
    for w in range(-1000, 1000):
        parts = bitslices.digits(w)
        assert sum(s << p for p, s in parts) == w and all(b[0] - a[0] > 1 for a, b in zip(parts, parts[1:]))


@pytest.mark.parametrize("scale", SCALES)
def test_hard_negatives_equal_brute_force(spark, scale):
    rows = rough(400, 5, SCALES[scale])
    out = hyperplanes.mine(frame(spark, rows), "vec_id", "label", "embedding", F.col("id") % 100 == 0, 4, 6, settings=SMALL)
    assert sorted(tuple(r) for r in out.collect()) == brute_mine(rows, 4, 6)


def test_empty_tables(spark):
    df = frame(spark, [])
    assert bitslices.search(bitslices.build(df, "vec_id", "embedding"), df, "vec_id", "embedding", 5).count() == 0
    assert hyperplanes.mine(df, "vec_id", "label", "embedding", F.col("id") % 100 == 0).count() == 0


def test_tree_rules_out_what_it_can():
    """Far apart heaps: a narrow window reaches few leaves, and nothing is lost."""
    rng = np.random.default_rng(6)
    rows = np.concatenate([np.floor(rng.normal(size=(200, 8)) * 3 + rng.normal(size=8) * 300) for _ in range(20)])
    labels = np.arange(len(rows)) % 2
    tree, order = hyperplanes.grow(rows, labels, hyperplanes.Settings(leaf=50))
    shard = {"tree": tree, "rows": rows[order], "ids": order, "labels": labels[order]}
    scores = rows @ rows[7]
    low, high = int(np.sort(scores)[-60]), int(np.sort(scores)[-20])
    asked = {"id": np.array([7]), "label": labels[[7]], "low": np.array([low]), "high": np.array([high]), "vector": rows[[7]]}
    seen, score = [], hyperplanes.Walk.score
    try:
        hyperplanes.Walk.score = lambda self, leaf, active: (seen.append(leaf.stop - leaf.start), score(self, leaf, active))
        walk = hyperplanes.Walk(shard, asked, False, 1000)
    finally:
        hyperplanes.Walk.score = score
    fits = np.flatnonzero((scores >= low) & (scores <= high) & (labels != labels[7]))
    assert sorted(walk.found[0][0].tolist()) == fits.tolist() and sum(seen) < len(rows) / 2


@pytest.mark.parametrize("lengths", ["unit", "lognormal", "one of 1e6", "one of 1e20"])
def test_neighbours_of_any_length(spark, lengths):
    """Recall at 20 against brute force; every answer's score is exact."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1200, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths == "lognormal":
        x *= rng.lognormal(0, 1.5, len(x))[:, None]
    elif lengths.startswith("one"):
        x[17] *= float(lengths.split()[-1])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    index = neighbours.build(df, "vec_id", "embedding", 20)
    found = {}
    for r in neighbours.search(index, df.where("vec_id % 10 = 0"), "vec_id", "embedding", 20).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for q, answers in found.items():
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len({i for _, i, _ in answers} & set(np.argsort(-scores)[:20].tolist()))
        assert [r for r, _, _ in sorted(answers)] == list(range(1, 21)) and all(math.isclose(s, scores[i], rel_tol=1e-9, abs_tol=1e-9) for _, i, s in answers)
    assert len(found) == 120 and hits >= 0.9 * 20 * 120
    with pytest.raises(Exception, match="20 answers"):
        neighbours.search(index, df.where("vec_id = 0"), "vec_id", "embedding", 30).collect()
