"""Where the source data's rules differ from Spark's own, on a few rows each."""

from pyspark.sql import functions as F

from recordbridge.functions import dates, nulls, text
from recordbridge.operators import groups, joins


def test_null_keys_match(make, rows):
    left = make("k string, a int", ("x", 1), (None, 2), ("z", 3))
    right = make("k string, b int", ("x", 10), (None, 20), ("y", 30))
    assert rows(joins.ns_join(left, right, "k")) == [("x", 1, 10), (None, 2, 20)]
    assert rows(joins.ns_join(left, right, "k", "full")) == [("x", 1, 10), ("y", None, 30), ("z", 3, None), (None, 2, 20)]
    assert rows(joins.anti_exclude(left, right, "k")) == [("z", 3)]
    assert rows(joins.ns_join(left, right, "k", nulls_match=False)) == [("x", 1, 10)]


def test_clashing_names_get_suffixes(make):
    left, right = make("k int, v int, `a.b` int", (1, 2, 3)), make("k int, v int, w int", (1, 4, 5))
    out = joins.ns_join(left, right, "k", suffix=("_sp", "_cl"))
    assert out.columns == ["k", "v_sp", "a.b", "v_cl", "w"] and tuple(out.first()) == (1, 2, 3, 4, 5)
    other = joins.ns_join(left, make("n int, k int", (1, 9)), [("k", "n")])
    assert other.columns == ["k", "v", "a.b", "k_y"]


def test_exclusion_keeps_nulls(make, rows):
    df = make("x int", (1,), (2,), (None,))
    assert rows(df.where(nulls.not_in(F.col("x"), [1]))) == [(2,), (None,)]


def test_unknown_condition_gives_null(make, rows):
    df = make("x int", (1,), (2,), (None,))
    assert rows(df.select("x", nulls.tri_if(F.col("x") == 1, "a", "b"))) == [(1, "a"), (2, "b"), (None, None)]


def test_ties_are_kept(make, rows):
    df = make("k int, t int, v string", (1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, None, "d"), (2, None, "e"), (3, None, "f"), (3, 1, "g"))
    assert rows(groups.latest(df, ["k"], "t")) == [(1, 5, "a"), (1, 5, "b"), (2, None, "d"), (2, None, "e"), (3, 1, "g")]
    assert rows(groups.latest(df, ["k"], "t", ascending=True)) == [(1, 4, "c"), (2, None, "d"), (2, None, "e"), (3, 1, "g")]


def test_two_level_latest(make, rows):
    df = make("k int, a int, b int", (1, 2, None), (1, 2, 7), (1, 1, 9), (2, 1, None), (2, 1, None), (None, 3, 3))
    assert rows(groups.latest(df, ["k"], ["a", "b"])) == [(1, 2, 7), (2, 1, None), (2, 1, None), (None, 3, 3)]
    assert rows(groups.latest(df, ["k"], ["a", "b"], ascending=True)) == [(1, 1, 9), (2, 1, None), (2, 1, None), (None, 3, 3)]


def test_strict_aggregates(make, rows):
    df = make("k int, x int", (1, 1), (1, 2), (2, 1), (2, None))
    out = df.groupBy("k").agg(nulls.strict_agg(F.max, F.col("x")).alias("m"))
    assert rows(out) == [(1, 2), (2, None)]


def test_paste_writes_na(make, rows):
    df = make("a string, b int", ("x", None), (None, 2))
    assert rows(df.select(nulls.paste(F.col("a"), F.col("b"), sep="-"))) == [("NA-2",), ("x-NA",)]


def test_only_first_match_goes(make, rows):
    df = make("x string", ("Ash County, Old County, Ohio",), ("a (1) b (2)\n(3)",), ("none",))
    assert rows(df.select(text.strip_suffix(F.col("x"), " County"))) == [("Ash, Old County, Ohio",), ("a (1) b (2)\n(3)",), ("none",)]
    assert rows(df.select(text.strip_suffix(F.col("x"), r"\(\d\)")).limit(3))[1] == ("a  b (2)\n(3)",)


def test_bad_dates_are_null(make, rows):
    df = make("x string", ("2021-02-03 04:05:06",), ("2021-02-03",), ("2021-02-30",), ("2/3/2021",), ("soon",), (None,))
    day, time = "2021-02-03 00:00:00", "2021-02-03 04:05:06"
    read = [r[0] for r in df.select(dates.as_time_text(dates.parse_dt(F.col("x")))).collect()]
    assert read == [time, day, None, day, None, None]


def test_numbers_do_not_depend_on_partitions(make, rows):
    df = make("a int, b string", *[(i % 7, f"r{i}") for i in range(200)])
    one = rows(groups.surrogate_id(df.repartition(1), ["a", "b"], "id"))
    assert one == rows(groups.surrogate_id(df.repartition(16).orderBy(F.desc("b")), ["a", "b"], "id"))
    assert sorted(r[0] for r in one) == list(range(1, 201))
    expected = sorted(((i % 7, f"r{i}") for i in range(200)))
    assert [r[1:] for r in sorted(one)] == expected
