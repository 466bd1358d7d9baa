"""Notes are cleaned as before on every code point, without the slow test of a negated class."""

import re
import time

from pyspark.sql import functions as F

from recordbridge.functions import text
from recordbridge.operators import reconcile


def test_every_code_point(make):
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    given = make("x string", ("".join(map(chr, points)),), ("a1\u000b b c \U0001f600d e",), (None,), ("",))
    got = [r[0] for r in given.select(text.strip_stopwords(F.col("x"), ["zzz"])).collect()]
    assert got == [None if r.x is None else re.sub(r"[^a-zA-Z \t\n\x0b\f\r]+", "", r.x) for r in given.collect()]


def test_cleaning_is_faster_than_a_negated_class(spark):
    given = spark.range(4000, numPartitions=8).select(F.repeat(F.concat(F.lit("Quetion éenelle, le 12 "), F.col("id").cast("string")), 200).alias("x")).cache()

    def seconds(column):
        times = []
        for _ in range(3):
            begun = time.perf_counter()
            given.select(F.xxhash64(column).alias("h")).agg(F.bit_xor("h")).collect()
            times.append(time.perf_counter() - begun)
        return min(times)

    given.count()
    assert 2 * seconds(text.strip_stopwords(F.col("x"), ["zzz"])) < seconds(F.regexp_replace(F.regexp_replace("x", "zzz", ""), r"[^a-zA-Z\s]+", ""))


def test_words_ending_in_com(make):
    cases = ["acomb com xcomycomz", "comcom a com", "x", "", "mail me at abc comma", "écom é1com", "a" * 300 + "com" + "b" * 40, "cocom\ncomco com"]
    new, old = make("x string", *[(c,) for c in cases]).select(F.collect_list(F.regexp_replace("x", reconcile.COM_WORDS, "")), F.collect_list(F.regexp_replace("x", "[A-Za-z0-9]*com", ""))).head()
    assert new == old


def test_a_note_of_one_long_word(make):
    """A word of a million letters is passed once, not once for each of its letters."""
    a, b = make("p int, t string", (1, "q" * 1_000_000)), make("p int, t string", (1, "zzz yyy"))
    begun = time.perf_counter()
    assert {(r["side"], r["similar"]) for r in reconcile.text_reconcile(a, b, "p", "t").collect()} == {("left", 0), ("right", 0)}
    assert time.perf_counter() - begun < 60
