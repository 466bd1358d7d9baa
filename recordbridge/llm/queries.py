"""The operators on the test tables, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import alignment, bitslices, bpe, decontaminate, hmm, hyperplanes, jaccard, neighbours, passages, pii, quality, tokencounts, urlrules
from .registry import ORACLE, QUERIES, query, table  # noqa: F401


@query("op1_quality")
def op1(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = quality.judge(docs, table(spark, folder, "labels"))
    return judged.select("doc_id", F.coalesce(quality.fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op2_bpe")
def op2(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.digests(docs, "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).drop("text")


WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op10_decontamination", f"""
WITH docs AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
     items AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
     firsts AS (SELECT item_id, w, least(len(w), 13) AS m, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0),
     patterns AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS p FROM firsts),
     sizes AS (SELECT DISTINCT m FROM patterns),
     places AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, sizes WHERE len(w) >= m),
     hits AS (SELECT doc_id, m, i, item_id FROM (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS p FROM places) JOIN patterns USING (m, p)),
     spread AS (SELECT doc_id, unnest(range(i, i + m)) AS k FROM (SELECT DISTINCT doc_id, m, i FROM hits)),
     words_hit AS (SELECT doc_id, count(DISTINCT k) AS n FROM spread GROUP BY doc_id),
     items_hit AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words_hit h USING (doc_id) LEFT JOIN items_hit t USING (doc_id)""")
def op10(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.judged(decontaminate.search(docs, "text", table(spark, folder, "benchmark")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query("op6_token_counts", r"SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents")
def op6(spark, folder):
    blocks, order = tokencounts.word_files(table(spark, folder, "documents"), "text", "doc_id")
    return order.join(tokencounts.count(blocks), ["file", "document"]).select("doc_id", "n_tokens")


@query("op8_url_rules")
def op8(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(F.bool_or((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    labelled = pages.join(labels, F.col("page_id") == F.col("doc_id")).select("url", "bad")
    return urlrules.judge(pages, "url", urlrules.mine(labelled, "url", "bad"), urlrules.STATED).select("page_id", "host", "path", "rule", "verdict")


@query("op7_neighbours")
def op7(spark, folder):
    vectors = table(spark, folder, "embeddings")
    index = neighbours.build(vectors, "vec_id", "embedding", 20)
    return neighbours.search(index, vectors.where(F.col("vec_id") % 20 == 0), "vec_id", "embedding", 20)


@query("op9_hmm")
def op9(spark, folder):
    held_out = F.coalesce(quality.fold("doc_id") == 1, F.lit(False))
    docs = table(spark, folder, "documents").select("doc_id", "text", held_out.alias("held_out"), (~held_out).alias("training"))
    return hmm.score(docs, "text", "training").drop("training")


@query("op5_jaccard_join")
def op5(spark, folder):
    return jaccard.link(table(spark, folder, "documents"), "doc_id", "text")


@query("op4_surrogates")
def op4(spark, folder):
    return pii.replace(table(spark, folder, "documents").select("doc_id", "text"), "text", count="n_replaced")


@query("op3_passages")
def op3(spark, folder):
    return passages.find(table(spark, folder, "documents"), "doc_id", "text")


@query("op13_alignment")
def op13(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return alignment.digests(docs, "text", public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


VECTORS_SQL = """SELECT DISTINCT vec_id, {label}[floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS z FROM embeddings
     WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"""


@query("op11_bit_sliced", f"""
WITH v AS ({VECTORS_SQL.format(label="")}),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_dot_product(q.z, c.z) AS BIGINT)) AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.z) = len(c.z) GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""")
def op11(spark, folder):
    rows = table(spark, folder, "embeddings")
    return bitslices.search(bitslices.build(rows, "vec_id", "embedding"), rows.where("vec_id % 50 = 0"), "vec_id", "embedding", 5)


@query("op12_hard_negatives", f"""
WITH v AS ({VECTORS_SQL.format(label="CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, ")} AND label IS NOT NULL),
     s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same, CAST(list_dot_product(a.z, c.z) AS BIGINT) AS score
           FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.z) = len(c.z)),
     p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
     n AS (SELECT p.*, s.other AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other) AS rank
           FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""")
def op12(spark, folder):
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").withColumn("label", turned)
    return hyperplanes.mine(rows, "vec_id", "label", "embedding", F.col("id") % 100 == 0)
