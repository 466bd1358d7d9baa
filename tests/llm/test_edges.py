"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from recordbridge.llm import bpe, decontaminate, hmm, jaccard, neighbours, passages, pii, quality, tokencounts, urlrules

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
LONG = " ".join(f"w{i % 997}" for i in range(30_000))
TEXTS = [None, "", "   \n", "one", "one two three four five six", "one two three four five six", LONG, LONG + " end", "a@b.com called 4111111111111111", "É" * 5000]
#: Names that operators make or use inside.
CLASHING = "score predicted n_words hit_spans hit_items n_tokens n_known train_tokens base_score ids_sha256 decoded_sha256 ids host path rule verdict text_ k row node label a b n".split()


def frame(spark, rows=None):
    rows = [(i if i % 4 else None, t) for i, t in enumerate(TEXTS)] + [(1, TEXTS[1]), (5, TEXTS[5])] if rows is None else rows
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (5, 1), (7, 0), (9, None), (None, 1), (5, 1)], "doc_id bigint, quality int")


def bench(spark):
    return spark.createDataFrame([(1, "ONE two, three"), (1, "five six"), (None, "w1 w2 w3"), (2, None), (3, " ")], "item_id bigint, text string")


APPLIED = {
    "quality": lambda s, df: quality.judge(df, labels(s)),
    "bpe": lambda s, df: bpe.encode(df, "text", PATH, PATTERN, chunk=1000, overlap=50),
    "bpe digests": lambda s, df: bpe.digests(df, "text", PATH, PATTERN),
    "decontaminate": lambda s, df: decontaminate.judged(decontaminate.search(df, "text", bench(s))),
    "hmm": lambda s, df: hmm.score(df.withColumn("training", F.col("doc_id") % 2 == 0), "text", "training"),
    "pii": lambda s, df: pii.replace(df, "text", count="score"),
    "jaccard": lambda s, df: jaccard.link(df, "doc_id", "text"),
}


@pytest.mark.parametrize("name", APPLIED)
def test_one_row_for_each_row(spark, name):
    df = frame(spark)
    out = APPLIED[name](spark, df)
    assert out.count() == df.count()
    if name in ("quality", "bpe", "decontaminate", "pii"):
        assert set(df.columns) <= set(out.columns)
    assert len(set(out.columns)) == len(out.columns)


@pytest.mark.parametrize("name", APPLIED)
def test_empty_table(spark, name):
    assert APPLIED[name](spark, frame(spark, [])).count() == 0


def test_no_label_scores_one_half(spark):
    out = quality.judge(frame(spark), labels(spark).where("false"))
    assert {r.score for r in out.select("score").collect()} == {0.5}


def test_no_benchmark_hits_nothing(spark):
    out = decontaminate.judged(decontaminate.search(frame(spark), "text", bench(spark).where("false")))
    assert not out.where("contaminated OR n_hit > 0").count()


def test_hits_of_items_without_id_count_but_are_not_listed(spark):
    rows = decontaminate.judged(decontaminate.search(frame(spark), "text", bench(spark))).where(F.length("text") > 100_000).collect()
    assert {tuple(r.hit_items) for r in rows} == {()} and all(r.n_hit > 0 for r in rows)


def test_passages(spark):
    assert passages.find(frame(spark, []), "doc_id", "text").count() == 0
    got = passages.find(frame(spark), "doc_id", "text").collect()
    assert {(r.doc_id, r.like_doc_id, r.equal) for r in got} == {(7, 6, True)}


def test_jaccard_classes(spark):
    rows = jaccard.link(frame(spark), "doc_id", "text").collect()
    got = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert got[5, 2] == 5 and got[None, 2] == 5  # equal sets, one of them without an id
    assert got[7, 998] == 6 and got[1, 0] == 1 and got[3, 1] == 3 and got[None, 0] is None


def test_token_counts_of_files(spark):
    rows = [("a", 0, b"\x01\x00\xff\xff\x02\x00"), ("a", 1, b"\x03\x00"), ("a", 2, b"\xff\xff\xff\xff\x05\x00"), ("b", 0, None), ("c", 0, b"\x07\x00")]
    blocks = spark.createDataFrame(rows, "file string, block bigint, ids binary")
    got = sorted(map(tuple, tokencounts.count(blocks).collect()))
    assert got == [("a", 0, 1), ("a", 1, 2), ("a", 2, 0), ("a", 3, 1), ("c", 0, 1)]
    assert tokencounts.count(blocks.where("false")).count() == 0


def test_token_files_are_read_in_blocks(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(bytes(range(1, 21)) + b"\xff\xff" + bytes(range(1, 7)))
    got = sorted(tuple(r)[1:] for r in tokencounts.count(tokencounts.read_files(spark, str(tmp_path), 8)).collect())
    assert got == [(0, 10), (1, 3)]


def test_token_counts_of_a_table(spark):
    blocks, order = tokencounts.word_files(frame(spark), "text", "doc_id", 64)
    got = order.join(tokencounts.count(blocks), ["file", "document"])
    assert sorted(r.n_tokens for r in got.collect()) == sorted(len((t or "").split()) for t in [*TEXTS, TEXTS[1], TEXTS[5]])


def test_urls(spark):
    urls = [None, "", "no scheme", "http://X.ORG/a", "http://x.org", "https://a.example.org/es/1?q#f", "x://com/fr/", "http://bad.net/z", "http://bad.net/z"]
    pages = spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate(urls)], "page_id int, url string, verdict string, sure2 string")
    seen = spark.createDataFrame([("http://bad.net/q", True)] * 3 + [("http://good.net/q", False)] * 30 + [(None, True), ("http://u.net/", None)], "url string, bad boolean")
    rules = urlrules.mine(seen, "url", "bad")
    rows = urlrules.judge(pages, "url", rules, urlrules.STATED).orderBy("page_id").collect()
    assert [r.verdict for r in rows] == ["allow"] * 5 + ["block", "allow", "block", "block"]
    assert [r.rule for r in rows] == [None, None, None, "org/", None, "example.org/es/", "com/fr/", None, None]
    assert [(r.host, r.path) for r in rows[:5]] == [("", ""), ("", ""), ("", ""), ("x.org", "/a"), ("x.org", "")]
    assert urlrules.mine(seen.where("false"), "url", "bad").count() == 0
    assert urlrules.judge(pages.where("false"), "url", rules, urlrules.STATED).count() == 0


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), 1.0, 2.0]) for i in range(1, 40)] + [(1, [1.0, 1.0, 2.0]), (50, None), (51, [0.0, 0.0, 0.0]), (52, [nan, 1.0, 1.0]), (53, [inf, 1.0, 1.0]), (54, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], "vec_id int, embedding array<float>, score string, shard string")
    out = neighbours.search(neighbours.build(df, "vec_id", "embedding", 3), df.where("vec_id IN (6, 20, 50, 51)"), "vec_id", "embedding", 3)
    got = [tuple(r) for r in out.orderBy("query_id", "rank").collect()]
    # Equal vectors tie: the smaller id first, the query itself left out.
    assert got == [(6, 1, 13, 41.0), (6, 2, 20, 41.0), (6, 3, 27, 41.0), (20, 1, 6, 41.0), (20, 2, 13, 41.0), (20, 3, 27, 41.0)]
    none = df.where("false")
    assert neighbours.search(neighbours.build(none, "vec_id", "embedding", 3), none, "vec_id", "embedding", 3).count() == 0


def test_neighbours_of_every_length_and_precision(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 5)] + [(10, [1.0, 0.0, 0.1]), (11, [2.0, 0.0, 0.1]), (12, [1e300, 0.0, 0.0, 0.0, 0.0]), (13, [1.0, 0.1, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    out = neighbours.search(neighbours.build(df, "vec_id", "embedding", 2), df.where("vec_id IN (1, 10, 13)"), "vec_id", "embedding", 2)
    got = [tuple(r) for r in out.orderBy("query_id", "rank").collect()]
    assert got == [(1, 1, 4, 5.0), (1, 2, 3, 4.0), (10, 1, 11, 2.0 + 0.1 * 0.1), (13, 1, 12, 1e300)]


def site(spark, n, bad, name):
    """``n`` pages of a site, the first ``bad`` of them bad."""
    return spark.range(n).select(F.concat(F.lit(f"http://{name}/page/"), F.col("id").cast("string")).alias("url"), (F.col("id") < bad).alias("bad"))


@pytest.mark.parametrize("others", [300, 30_000])
def test_a_rare_bad_site_is_found_at_any_size(spark, others):
    """Four of six pages bad among a quarter: a rule, however many other pages there are; a site like all others gives none."""
    mixed = spark.range(others).select(F.concat(F.lit("http://host"), (F.col("id") % 50).cast("string"), F.lit(".net/page/"), F.col("id").cast("string")).alias("url"), (F.col("id") * 7919 % 4 == 0).alias("bad"))
    rules = urlrules.mine(mixed.unionByName(site(spark, 6, 4, "spamfarm.org")).unionByName(site(spark, 8, 2, "plain.org")), "url", "bad").collect()
    single = {r.tokens[0]: r.confidence for r in rules if len(r.tokens) == 1}
    assert abs(single["h:spamfarm"] - 4 / 6) < 1e-9 and "h:plain" not in single and "p:page" not in single
    assert not [r for r in rules if len(r.tokens) == 1 and r.tokens[0].startswith("h:host") and r.confidence < 0.6]


def test_combinations_and_supports(spark):
    """A pair of tokens that is bad only together; every rule's numbers counted again by brute force."""
    rows = [(f"http://{h}.com/{p}/x{i}", h == "a" and p == "s") for h in "abcd" for p in ("s", "t", "u") for i in range(10)]
    seen = spark.createDataFrame(rows, "url string, bad boolean")
    rules = {tuple(r.tokens): r.confidence for r in urlrules.mine(seen, "url", "bad").collect()}
    assert rules == {("h:a", "p:s"): 1.0}
    own = [(set(r.own), r.bad) for r in seen.select(urlrules.tokens("url").alias("own"), "bad").collect()]
    for tokens, sure in rules.items():
        fits = [b for t, b in own if set(tokens) <= t]
        assert sum(fits) >= 3 and abs(sum(fits) / len(fits) - sure) < 1e-9


def test_tokens_of_equal_rows_stand_for_each_other(spark):
    """p:v and p:w stand in the same labelled rows; other pages have one of them only."""
    rows = [(f"http://{h}.com/{p}/x{i}", h == "a" and p == "v/w") for h in "abcd" for p in ("v/w", "t", "u") for i in range(10)]
    rules = urlrules.mine(spark.createDataFrame(rows, "url string, bad boolean"), "url", "bad")
    urls = ["http://a.com/v/x1", "http://a.com/w/x1", "http://a.com/v/w/x1", "http://b.com/w/x1", "http://a.com/t/x1"]
    got = urlrules.match(spark.createDataFrame([(u,) for u in urls], "url string"), "url", rules).collect()
    assert {tuple(r) for r in got} == {(u, 1.0) for u in urls[:3]}


def test_a_trap_of_many_segments_ends(spark):
    """Urls of 60 segments on half the rows, the same ones and any ones."""
    same = "/".join(f"s{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    letters = F.array(*[F.lit(f"t{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(90)])
    marked = F.array_sort(F.transform(letters, lambda x: F.struct(F.xxhash64(x, F.col("id")).alias("mark"), x.alias("x"))))
    some = F.array_join(F.transform(F.slice(marked, 1, 60), lambda x: x["x"]), "/")
    trap = spark.range(200).select(F.when(F.col("id") % 2 == 0, F.concat(F.lit("http://x.net/"), F.lit(same))).otherwise(F.concat(F.lit("http://x.net/"), some)).alias("url"), (F.col("id") % 3 == 0).alias("bad"))
    assert urlrules.mine(trap.unionByName(site(spark, 200, 0, "good.org")), "url", "bad").count() >= 0


def test_token_counts_give_memory_back(spark, monkeypatch):
    """Both passes end by giving free memory back, as the other text operators do."""
    given = []
    kind = type(spark.range(1))
    monkeypatch.setattr(kind, "mapInArrow", lambda df, work, schema, kept=kind.mapInArrow: (given.append(work), kept(df, work, schema))[1])
    blocks, _ = tokencounts.word_files(frame(spark), "text", "doc_id", 64)
    tokencounts.count(blocks)
    assert len(given) == 2 and all("release" in work.__code__.co_names for work in given)


def test_jaccard_passes_give_memory_back(spark, monkeypatch):
    given = []
    kind = type(spark.range(1))
    monkeypatch.setattr(kind, "mapInArrow", lambda df, work, schema, kept=kind.mapInArrow: (given.append(work), kept(df, work, schema))[1])
    jaccard.frequent(frame(spark), "text", 5)
    pairs, nodes = spark.createDataFrame([(1, 2)], "a bigint, b bigint"), spark.createDataFrame([(1, 1, b"\x01\x01")], "row bigint, n int, point binary")
    jaccard._passing(pairs, nodes, jaccard.Settings())
    assert len(given) == 2 and all("release" in work.__code__.co_names for work in given)


def test_shift_tables_are_narrow():
    """Every worker holds the tables: a skip of at most 13 words takes one byte."""
    (group,) = decontaminate.compile_patterns([(str(i), " ".join(f"w{i}-{j}" for j in range(40))) for i in range(50)])
    assert group.length == 13 and group.shift.itemsize == 1 and group.shift.max() == 12 and group.shift.min() == 0
