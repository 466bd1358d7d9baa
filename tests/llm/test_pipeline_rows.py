"""The pipeline's filters judge rows, not ids."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
GIVEN = [(None, None), (None, ""), (1, "  "), (1, "one two three"), (1, "one two three"), (2, "call a@b.com or 4111111111111111 now"), (None, "six words of text and more"), (3, "w " * 40_000)]


def given(spark, rows=GIVEN):
    """Documents with null and repeated ids, and columns named like those that stages make."""
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return docs.withColumns({c: F.lit("x") for c in ("score", "predicted", "label", "contaminated", "node", "row", "n_words", "text_hash")})


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_any_rows(spark, name, stage):
    docs = given(spark)
    out = stage(spark, docs, SMALL)
    assert set(docs.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    if name != "bpe":
        assert out.columns == docs.columns
    kept = [r.text for r in out.collect()]
    if name in ("quality", "jaccard", "decontamination"):
        assert set(kept) <= {t for _, t in GIVEN} and {None, ""} & set(kept)
    if name == "jaccard":
        assert sorted(map(repr, kept)) == sorted(map(repr, [t for i, t in GIVEN if t != "one two three"] + ["one two three"]))
    if name == "decontamination":
        assert len(kept) == len(GIVEN)
    if name in ("pii", "bpe"):
        assert len(kept) == len(GIVEN)
        assert ("call a@b.com or 4111111111111111 now" in kept) == (name == "bpe")
    empty = stage(spark, given(spark, []), SMALL)
    assert empty.count() == 0 and empty.columns == out.columns


def test_near_duplicates_leave_by_row(spark, rows):
    text = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    near = text("a", 39) + " z"
    given = [
        (None, text("b")), (None, text("c")), (None, text("c")), (None, near), (1, text("a")),
        (2, text("d")), (2, text("e")), (2, near), (3, text("d")), (4, text("f")), (4, text("f")), (None, ""), (None, ""), (5, None), (5, " "),
    ]
    docs = spark.createDataFrame(given, "doc_id int, text string")
    want = [(None, text("b")), (None, text("c")), (1, text("a")), (2, text("d")), (2, text("e")), (4, text("f")), (None, ""), (None, ""), (5, None), (5, " ")]
    assert rows(corpus_pipeline.jaccard_stage(spark, docs, "")) == sorted(want, key=repr)
