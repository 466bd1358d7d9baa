"""Cross-tokenizer alignment against plain sets of ends, with cut texts and a small head."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from recordbridge.llm import alignment
from recordbridge.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """(ids of A, ids of B, groups) of a text, straight from the libraries; None without tokens."""
    a, b = tokenizers.Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = alignment.byte_letters()

    def tokens(text):
        if not text:
            return None
        left, right = a.encode(" " + text, add_special_tokens=False), b.encode(text)
        bytes_a = [bytes(letters[c] for c in t) for t in left.tokens]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in right]
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            return None
        ends = [[sum(map(len, side[: i + 1])) for i in range(len(side))] if len(side) < 400 else _ends(side) for side in (bytes_a, bytes_b)]
        found, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            found.append((left.ids[i:x], right[j:y]))
            i, j = x, y
        return left.ids, right, found

    return tokens


def _ends(side):
    out, total = [], 0
    for t in side:
        out.append(total := total + len(t))
    return out


def expected(plain, cells):
    """Result rows of a list of texts."""
    made = [plain(t) for t in cells]
    counts = Counter((a[-1], b[-1]) for m in made if m for a, b in m[2])
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    rows = []
    for m in made:
        if m is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(a[-1], b[-1]) for a, b in m[2]]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in m[2])
        rows.append((len(m[0]), len(m[1]), len(links), len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest()))
    return rows


def cells():
    random.seed(5)
    words = ["the", "quick", "brown", "é", "日本語", "\U0001f600", "<|endoftext|>", "<0x0A>", "<s>", "don't", "12345", "x" * 60, "naïve", "  ", "\n", "\t", "Привет", "!?", "a"]
    made = [" ".join(random.choice(words) for _ in range(random.randint(1, 120))) for _ in range(60)]
    return [*made, made[0], made[0], "", None, " ", "\n", "x", "▁ is no blank", " nbsp ", "é combined", " lead and trail ", "y" * 3000]


def test_runs():
    random.seed(1)
    for _ in range(300):
        a, b = (sorted(random.sample(range(60), random.randint(0, 50))) for _ in range(2))
        found = alignment.runs(np.array(a, np.uint32), np.array(b, np.uint32))
        got = [a[i + t] for i, j, n in found for t in range(n) if a[i + t] == b[j + t]]
        assert got == sorted(set(a) & set(b)) and sum(n for _, _, n in found) == len(got)
    long = np.arange(1000, dtype=np.uint32)
    assert alignment.runs(long, long) == [(0, 0, 1000)] and alignment.runs(long, np.delete(long, 500)) == [(0, 0, 500), (501, 500, 499)]


def test_ranks_are_the_file():
    """Every code point beside letters, digits, blanks and marks: encoding by rank equals the file's own tokenizer."""
    tool = alignment.Tokenizers(A, B)
    assert tool.ranked and tool.cuts
    probes = [f"a{c}b 1{c}2 {c} {c}{c}!{c}?  {c}" for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    for i in range(0, len(probes), 100_000):
        some = probes[i : i + 100_000]
        assert [x.ids for x in tool.a.encode_batch_fast(some, add_special_tokens=False)] == [tool.ranked.encode_ordinary(p) for p in some]


@pytest.mark.parametrize("chunk, head", [(1 << 18, 1 << 18), (40, 7), (300, 0)])
def test_digests_equal_brute_force(spark, plain, chunk, head):
    texts = cells()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumns({c: F.lit("x") for c in ("n_a", "count_sum", "pair", "count", "best")})
    out = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.digests(df, "text", A, B, chunk, head).collect()}
    assert [out[i] for i in range(len(texts))] == expected(plain, texts)


def test_groups(spark, plain):
    texts = cells()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = {r.doc_id: [(list(g.a), list(g.b)) for g in r.groups] for r in alignment.groups(df, "text", A, B, chunk=100).collect()}
    assert out == {i: [(list(a), list(b)) for a, b in m[2]] if (m := plain(t)) else [] for i, t in enumerate(texts)}


def test_query_equals_brute_force(spark, plain):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    out = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_alignment"](spark, "/root/testdata/sf0.001").collect()}
    assert [out[r.doc_id] for r in docs] == expected(plain, [r.text for r in docs]) and len(out) == len(docs)


def test_empty_table_and_null_ids(spark, plain):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id int, text string")
    out = [tuple(r[c] for c in COLUMNS) for r in alignment.digests(df, "text", A, B).collect()]
    assert sorted(out) == sorted(expected(plain, ["a b", "a b", None]))
    assert alignment.digests(df.where("false"), "text", A, B).count() == 0
