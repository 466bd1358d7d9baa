"""The corpus pipeline: quality, near duplicates, contamination, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
back as the next stage's ``docs``. All but the last return the columns of documents.

Every stage judges rows, not ids: null and repeated ids are rows like any other, and further columns of any
name pass through. A null or empty text has the quality score of no features, is no near duplicate, is not
contaminated, holds no personal data and has no tokens. Long texts count whole. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordbridge.llm import bpe, decontaminate, jaccard, pii, quality
from recordbridge.llm.registry import table
from recordbridge.session import materialise


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is 1. The model learns from the labelled rows of ``docs``; a
    row without id has no label and is judged like all others."""
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    return judged.where("predicted = 1").select(docs.columns)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: that of the smallest id (nulls last), and of its rows the first by text hash.

    Rows are judged one by one: different texts that share an id, or have none, stay. Texts without
    words are in no group, and all their rows stay.
    """
    wordy = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # Null ids as two columns without nulls, so that the join and the numbering are dealt alike.
    place = {"__none": F.col("doc_id").isNull(), "__id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0).cast("bigint"))}
    kept = jaccard.firsts(docs, "doc_id", "text").withColumns(place).withColumnRenamed("text_hash", "__hash").select(*place, "__hash")
    rows = docs.where(wordy).withColumns(place | {"__hash": F.xxhash64("text")}).join(kept, [*place, "__hash"], "left_semi")
    first = F.row_number().over(Window.partitionBy(*place, "__hash").orderBy("text"))
    alone = rows.withColumn("__nth", first).where("__nth = 1").select(docs.columns)
    return alone.unionByName(docs.where(~wordy))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark passages."""
    found = decontaminate.judged(decontaminate.search(docs, "text", table(spark, sf_dir, "benchmark")))
    return found.where("NOT contaminated").select(docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data, and ``n_chars`` of the new texts."""
    replaced = pii.replace(docs, "text")
    return replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids; a text whose ids do not decode to it stops the job."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    tokens = bpe.encode(docs, "text", path, pattern, "token_ids")
    back = bpe.decode(tokens, "token_ids", path, pattern, "__bytes")
    same = F.col("__bytes") == F.coalesce("text", F.lit("")).cast("binary")
    checked = F.when(same, F.size("token_ids")).otherwise(F.raise_error(F.lit("ids do not decode to the text")).cast("int"))
    return back.withColumn("n_tokens", checked).drop("__bytes")


STAGES = [
    ("quality", quality_stage),
    ("jaccard", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]

#: A trained classifier and merges by rank are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
