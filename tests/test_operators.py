"""Operators on hand-made rows, with results worked out by hand or by brute force."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recordbridge.functions import codes, dates, text
from recordbridge.operators import approximate, groups, guards, joins, reconcile, reshape, shape, translate

DAY = dt.date


def test_interval_join_bounds(make, rows):
    spans = make(
        "c int, p int, id string, lo date, hi date",
        (1, 1, "a", DAY(2020, 1, 1), DAY(2020, 3, 1)), (1, 1, "b", DAY(2020, 2, 1), None), (1, 2, "c", DAY(2020, 1, 1), None),
        (2, 1, "d", DAY(2020, 5, 1), DAY(2020, 4, 1)), (None, 1, "n", DAY(2020, 1, 1), None),
    )
    events = make(
        "c int, p int, e int, at date",
        (1, 1, 1, DAY(2020, 1, 1)), (1, 1, 2, DAY(2020, 3, 1)), (1, 1, 3, DAY(2020, 2, 15)), (1, 1, 4, DAY(2020, 12, 31)),
        (1, 1, 5, DAY(2021, 1, 1)), (1, 1, 6, DAY(2019, 12, 31)), (2, 1, 7, DAY(2020, 4, 15)), (None, 1, 8, DAY(2020, 6, 1)),
    )
    out = joins.interval_join(events, spans, ["c", "p"], "at", "lo", "hi", dates.day("2020-12-31"))
    assert rows(out.select("e", "id")) == [(1, "a"), (2, "a"), (2, "b"), (3, "a"), (3, "b"), (4, "b"), (8, "n")]


def test_dyadic_cover(make):
    spans = [(lo, lo + n) for lo in (-9, -8, -1, 0, 1, 5, 6, 32768) for n in (0, 1, 2, 3, 7, 8, 30, 1000)]
    got = {}
    for r in joins.dyadic_cover(make("lo int, hi int", *spans), F.col("lo"), F.col("hi")).collect():
        got.setdefault((r.lo, r.hi), []).append((r["__level"], r["__bin"]))
    for lo, hi in spans:
        blocks = got[lo, hi]
        assert sorted(x for level, b in blocks for x in range(b << level, (b + 1) << level)) == list(range(lo, hi + 1))
        assert len(blocks) <= 2 * (hi - lo + 1).bit_length()


def test_an_open_span_takes_few_rows(make):
    day = lambda *x: F.floor(F.unix_date(F.lit(DAY(*x))))
    assert joins.dyadic_cover(make("k int", (1,)), day(1990, 3, 7), day(9999, 12, 31)).count() < 40


@pytest.mark.parametrize("bin_days", [1, 10, 1000])
def test_interval_join_against_brute_force(make, rows, bin_days):
    rnd = random.Random(3)
    day = lambda: DAY(2020, 1, 1) + dt.timedelta(days=rnd.randrange(400))
    events = [(rnd.randrange(4), i, day()) for i in range(120)]
    spans = [(rnd.randrange(4), j, day(), rnd.choice([None, day()])) for j in range(40)]
    want = sorted(
        ((e, s) for k, e, at in events for q, s, lo, hi in spans if k == q and lo <= at <= (hi or DAY(2020, 12, 1))), key=repr
    )
    out = joins.interval_join(
        make("k int, e int, at date", *events), make("k int, s int, lo date, hi date", *spans), "k", "at", "lo", "hi", dates.day("2020-12-01"), bin_days
    )
    assert rows(out.select("e", "s")) == want


def test_full_coalesce_forms_agree(make, rows):
    a = make("k int, x int", (1, 10), (None, 11))
    b = make("k int, y int", (1, 20), (2, 21))
    c = make("k int, z int", (None, 30), (2, 31))
    want = [(1, 10, 20, None), (2, None, 21, 31), (None, 11, None, 30)]
    assert rows(joins.full_coalesce([a, b, c], ["k"])) == want
    assert rows(joins.full_coalesce([a, b, c], ["k"], unique_keys=True)) == want


def test_fallback_join(make, rows):
    df = make("city string, county string", ("A", "B"), ("X", "B"), (None, "X"))
    lookup = make("name string, code int", ("A", 1), ("B", 2))
    assert rows(joins.fallback_join(df, lookup, [("city", "name"), ("county", "name")], "code")) == [("A", "B", 1), ("X", "B", 2), (None, "X", None)]


def test_list_and_nth(make, rows):
    df = make("k int, v int", (1, 3), (1, 1), (1, 3), (1, None), (2, 9))
    assert rows(groups.list_agg(df, ["k"], "v")) == [(1, 4, "1, 3, 3, NA"), (2, 1, "9")]
    assert rows(groups.nth_columns(df, ["k"], "v", 2, "v")) == [(1, 4, "1", "3"), (2, 1, "9", "")]
    assert rows(groups.nth_columns(df.where("v is not null"), ["k"], "v", 3, "v", dedupe=True)) == [(1, 2, "1", "3", ""), (2, 1, "9", "", "")]


def test_duplicates(make, rows):
    df = make("a int, b string", (1, "x"), (1, "x"), (1, "y"), (None, "z"), (None, "z"))
    assert rows(groups.duplicate_groups(df, ["a"])) == [(1, "x", 3), (1, "x", 3), (1, "y", 3), (None, "z", 2), (None, "z", 2)]
    assert rows(groups.duplicate_groups(df).distinct()) == [(1, "x", 2), (None, "z", 2)]


def test_sequence_with_and_without_slices(make, rows):
    df = make("k int, t int, v int", *[(i % 3 if i % 5 else None, i // 4, i) for i in range(60)])
    plain = rows(groups.seq_in_group(df, ["k"], ["t", "v"], small=True).select("k", "v", F.col("n").cast("int")))
    for unique in (False, True):
        assert plain == rows(groups.seq_in_group(df, ["k"], ["t", "v"], unique=unique).select("k", "v", F.col("n").cast("int")))
    sliced = rows(groups.seq_in_group(df, ["k"], ["t", "v"], slice_by=F.floor(F.col("t") / 3)).select("k", "v", F.col("n").cast("int")))
    assert plain == sliced


def test_latest_pivot_is_latest_then_pivot(make, rows):
    rnd = random.Random(5)
    df = make("k int, t int, q string, v string", *[(rnd.randrange(4), rnd.choice([None, 1, 2, 3]), rnd.choice("abc"), rnd.choice([None, "x", "y", "z"])) for _ in range(150)])
    names = {"a": "A", "b": "B"}
    for per_attribute, keys in ((True, ["k", "q"]), (False, ["k"])):
        slow = reshape.eav_pivot(groups.latest(df, keys, "t"), ["k"], "q", "v", names)
        fast = reshape.latest_pivot(df, ["k"], ["t"], "q", "v", names, per_attribute)
        assert rows(slow) == rows(fast)


def test_reshape(make, rows):
    df = make("k int, a string, b int", (1, "p,q,r", None), (2, "p", 5))
    assert reshape.separate(df, "a", ["x", "y"], ",").columns == ["k", "x", "y", "b"]
    assert rows(reshape.separate(df, "a", ["x", "y"], ",")) == [(1, "p", "q", None), (2, "p", None, 5)]
    assert rows(reshape.unite(df, "u", ["a", "b"])) == [(1, "p,q,r_NA"), (2, "p_5")]
    assert reshape.unite(df, "u", ["a", "b"], remove=False).columns == ["k", "u", "a", "b"]
    lists = make("k int, l array<string>, r array<string>", (1, ["a", "b"], ["b"]), (2, ["c"], None), (3, [], []))
    assert rows(reshape.unnest_diff(lists, "l", "r")) == [(1, "a"), (2, "c")]
    seq = make("k int, o int, v string", (1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "d"))
    assert rows(reshape.spread_numbered(seq, ["k"], ["o"], ["v"], 2)) == [(1, "a", "b"), (2, "d", None)]
    assert rows(reshape.duplicate_cells(make("k int, q string, v int", (1, "a", 1), (1, "a", 2), (1, "b", 3)), ["k"], "q", "v")) == [(1, "a", 2)]


def test_shape_and_names(make):
    df = make("aID int, b int, c int, dID int, xDate int", (1, 2, 3, 4, 5))
    assert shape.shape(df, ("id", "aID"), "b:dID", drop=["c"]).columns == ["id", "b", "dID"]
    assert shape.shape(df, drop=["*ID"]).columns == ["b", "c", "xDate"]
    assert shape.shape(df, ("first", "#1"), "x*").columns == ["first", "xDate"]
    assert shape.relocate(df, ["dID"], after="aID").columns == ["aID", "dID", "b", "c", "xDate"]
    assert shape.relocate(df, ["dID"], before="aID").columns[0] == "dID"
    assert shape.snake_names(["User ID", "userID", "X1", "% done", "2nd", "User.ID"]) == ["user_id", "user_id_2", "x1", "percent_done", "x2nd", "user_id_3"]


def test_scalars(make, rows):
    df = make("a string, b string", ("O'Neil-Smith", "Ann (x) (y)"), (None, "plain"))
    assert rows(df.select(text.login_name(F.col("b"), F.col("a")))) == [("aoneilsmith",), ("pna",)]
    assert rows(df.select(text.cut_at_paren(F.col("b")))) == [("Ann ",), (None,)]
    assert rows(df.select(text.suffix_if_present(F.col("a"), "!"))) == [("O'Neil-Smith!",), (None,)]
    hidden = text.address_line(F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("a"))
    assert set(rows(df.select(hidden))) == {("Confidential - NA",), ("Confidential - O'Neil-Smith",)}
    messy = make("x string", ("a\r\nb \n  c\r",))
    assert rows(messy.select(text.squish_newlines(F.col("x")))) == [("a b c",)]
    words = make("x string", ("the cat and théme, 2 themes The",))
    assert rows(words.select(text.strip_stopwords(F.col("x")))) == [(" cat  thme  themes The",)]


def test_dates(make, rows):
    df = make("n int", (44000,), (None,))
    assert [r[0] for r in df.select(dates.excel_date(F.col("n"))).collect()] == [DAY(2020, 6, 18), None]
    spans = make("x date", (DAY(2020, 1, 1),), (DAY(2022, 1, 1),), (None,))
    assert {r[0] for r in spans.select(dates.as_of_exit(F.col("x"), dates.day("2021-01-01"))).collect()} == {DAY(2020, 1, 1), DAY(2021, 1, 1)}
    assert [r[0] for r in spans.select(dates.open_status(F.col("x"), dates.day("2021-01-01"))).collect()] == [0, 1, 1]
    assert spans.select(dates.stamp_export_id(F.col("x"))).first()[0] == 20200101


def test_codes(make, rows):
    df = make("n string, q int", (None, 1), (None, 8), ("123456780", 1), ("12345678", 1), ("123456789", 1), ("923456780", 1), ("123456780", 2), ("123456780", None), ("123450000", 1), ("123006780", 1))
    got = [r[0] for r in df.select(codes.ssn_class(F.col("n"), F.col("q"))).collect()]
    assert got == ["Missing", "DKR", "ok", "Invalid", "Invalid", "Invalid", "Invalid", "Missing", "Invalid", "Invalid"]
    money = make("x decimal(12,2)", *[(Decimal(x),) for x in ("0.50", "1.50", "2.50", "-0.50")])
    assert [int(r[0]) for r in money.select(codes.round_even(F.col("x"))).collect()] == [0, 2, 2, 0]


def test_rule_matrix_and_recode_lookup(make, rows):
    df = make("t string, c string", ("a", "1"), ("a", "2"), ("b", "2"), (None, "1"))
    assert rows(translate.rule_matrix_filter(df, {"a": ("1",), "b": ("2", "3")}, "t", "c")) == [("a", "1"), ("b", "2")]
    lookup = make("Value string, ReferenceNo int", ("a", 7))
    assert rows(translate.recode_lookup(df, {"t": lookup})) == [(7, "1"), (7, "2"), (None, "1"), (None, "2")]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i] + row[1:], row
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


def test_fuzzy_prefix_is_exact(make, rows):
    rnd = random.Random(11)
    base = ["".join(rnd.choice("abc ") for _ in range(rnd.choice([0, 1, 3, 9, 10, 11, 20, 29, 30, 40]))) for _ in range(60)]

    def altered(s):
        s = list(s)
        for _ in range(rnd.randrange(5)):
            i = rnd.randrange(len(s) + 1)
            s[i : i + rnd.randrange(2)] = rnd.choice(["", "a", "z"])
        return "".join(s)

    a = [(rnd.choice([1, 2, None]), s) for s in base]
    b = [(rnd.choice([1, 2, None]), altered(s)) for s in base for _ in range(2)]
    for whole, distance in ((True, edits), (False, edits_inside)):
        want = sorted(
            {(k, s[:30]) for k, s in a if not any(q == k and distance(s[:30], t[:30]) <= -(-len(s[:30]) // 10) for q, t in b)}, key=repr
        )
        out = reconcile.fuzzy_prefix(make("k int, t string", *a), make("k int, t string", *b), "k", "t", whole=whole)
        assert rows(out) == want and 0 < len(want) < len(set(a))


def edits_inside(pattern, text):
    """Fewest edits between the pattern and any substring of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        row, last = [i] + row[1:], row
        for j, y in enumerate(text, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return min(row)


def test_substring_that_stands_later(make, rows):
    a = make("k int, t string", (1, "asked for rent help"), (1, "never mentioned"), (2, "asked for rent help"), (None, "asked for rent help"), (1, ""), (3, "x"), (4, "x"))
    b = make("k int, t string", (1, "today asked for rnt help again"), (2, "other words"), (None, "then asked for rent helq"), (3, ""))
    assert rows(reconcile.fuzzy_prefix(a, b, "k", "t")) == [(1, "never mentioned"), (2, "asked for rent help"), (4, "x")]


def test_a_common_piece_makes_no_pairs(spark):
    """3,000 prefixes a side share 12 of 30 letters: pieces are taken from the other 18."""
    i = F.col("id")
    word = lambda seed: F.substring(F.translate(F.sha2(F.concat(i.cast("string"), F.lit(seed)), 256), "0123456789", "ghijklmnop"), 1, 9)
    side = lambda seed: spark.range(3000).select(F.lit(1).alias("k"), F.concat(word(seed), F.lit("phone called"), word(seed + "2")).alias("prefix"))
    sized = side("a").withColumns({"n": F.lit(30), "d": F.lit(3), "q": F.lit(5)})
    met = approximate.candidates(sized, side("b").withColumnRenamed("prefix", "text"), "k", "prefix", "text").count()
    assert met < 12_000  # of 9,000,000 pairs
    assert approximate.unmatched_substrings(side("a"), side("b"), "k").count() == 3000
    assert approximate.unmatched_substrings(side("a"), side("a").select("k", F.concat(F.lit("so "), "prefix").alias("prefix")), "k").count() == 0


def test_a_shared_piece_makes_few_candidates(spark):
    """200 patterns of a shared phrase and own letters beside 200 such texts: letter pairs rule almost all pairs out."""
    tail = lambda salt: F.translate(F.substring(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256), 1, 12), "0123456789", "ghijklmnop")
    left = spark.range(200).select(F.lit("p").alias("k"), F.concat(F.lit("the shared phrase "), tail("a")).alias("prefix"), F.lit(30).alias("n"), F.lit(3).alias("d"), F.lit(5).alias("q"))
    right = spark.range(200).select(F.lit("p").alias("k"), F.concat(F.lit("the shared phrase "), tail("b")).alias("text"))
    # Two pieces of each pattern are of the phrase, which all texts have: 80,000 rows.
    assert approximate.candidates(left, right, "k", "prefix", "text").count() < 20_000
    near = left.limit(20).select("k", F.concat(F.substring("prefix", 1, 17), F.lit("#"), F.substring("prefix", 18, 13)).alias("text"))
    kept = left.limit(20).select("k", "prefix")
    assert approximate.unmatched_substrings(kept, near.withColumnRenamed("text", "prefix"), "k").count() == 0


def test_text_reconcile_compares_once(make, monkeypatch):
    """Both sides are looked for in one comparison."""
    calls = []
    keep = reconcile.unmatched_substrings
    monkeypatch.setattr(reconcile, "unmatched_substrings", lambda *a: (calls.append(a), keep(*a))[1])
    a, b = make("p string, t string", ("1", "green apples fell down"), (None, "red pears")), make("p string, t string", ("1", "green apple fell down"), (None, "blue plums"))
    got = {(r["p"], r["side"], r["similar"]) for r in reconcile.text_reconcile(a, b, "p", "t").collect()}
    assert got == {("1", "left", 1), ("1", "right", 1), (None, "left", 0), (None, "right", 0)} and len(calls) == 1


def test_text_reconcile(make, rows):
    a = make("p int, t string", (1, "the client moved in on Monday, all fine"), (1, "kept note"), (2, "lost note about rent"), (2, None))
    b = make("p int, t string", (1, "the client moved on Monday, all fine"), (1, "kept, note!"), (3, "new one"))
    got = {(r["p"], r["side"], r["similar"]) for r in reconcile.text_reconcile(a, b, "p", "t").collect()}
    assert got == {(1, "left", 1), (1, "right", 1), (2, "left", 0), (3, "right", 0)}


def test_cells_that_differ(make, rows):
    a = make("k int, x int, y string", (1, 1, "a"), (2, None, "b"), (3, 3, "c"), (None, 7, "n"), (5, 5, "e"))
    b = make("k int, x int, y string", (1, 1, "z"), (2, 2, None), (4, 3, "c"), (None, 8, "n"), (5, 5, "e"))
    assert rows(reconcile.cell_diff(a, b, ["k"], ["x", "y"])) == sorted([
        ("y", 1, "a", "z"), ("x", 2, None, "2"), ("y", 2, "b", None), ("x", None, "7", "8"), ("(only left)", 3, None, None), ("(only right)", 4, None, None),
    ], key=repr)
    twice = a.unionByName(a.where("k = 1"))
    assert rows(reconcile.code_verify(twice, a, ["k", "y"])) == [(1, "a", "expected only")]


def test_equal_tables_ship_checksums_only(spark):
    a = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    b = a.orderBy(F.desc("text"))
    out = reconcile.cell_diff(a, b, ["id"], ["text"])
    assert out.collect() == []
    text = out._jdf.queryExecution().executedPlan().toString()
    final = text[text.index("== Final Plan ==") : text.index("== Initial Plan ==")]
    assert "hashpartitioning(id" not in final  # no row was dealt by its key
    changed = b.withColumn("text", F.when(F.col("id") == 77, "other").otherwise(F.col("text")))
    assert [tuple(r)[:2] for r in reconcile.cell_diff(a, changed, ["id"], ["text"]).collect()] == [("text", 77)]


def test_reconcile_tables(make, rows):
    a = make("k int, x int, y string", (1, 1, "a"), (2, None, "b"), (3, 3, "c"))
    b = make("k int, x int, y string", (1, 1, "z"), (2, None, "b"), (4, 3, "c"))
    assert rows(reconcile.table_diff(a, b, ["k"], ["x", "y"])) == [("(only left)", 1), ("(only right)", 1), ("x", 0), ("y", 1)]
    assert rows(reconcile.column_drift(a, b, ["k"], "y")) == [(1, "a", "z")]
    assert rows(reconcile.rowcount_drift(a.unionByName(a.where("k = 1")), b, ["k"])) == [(1, 2, 1)]
    assert rows(reconcile.code_verify(a, b, ["k"])) == [(3, "expected only"), (4, "actual only")]
    money = make("k int, amt int", (1, 10), (2, 10), (3, 10), (4, 1))
    other = make("k int, amt int", (1, 10), (2, 12), (3, 30), (3, 80), (5, 1))
    extra = make("k int, amt int", (3, 30))
    assert rows(reconcile.amount_reconcile(money, other, extra, "k", "amt")) == [(3, 1, 10, 1, 80, 70)]


def test_checks_run_inside_the_write(spark, make, rows):
    df = make("k int, v int", (1, 1), (2, -1), (3, None))
    bad = {"negative": F.col("v") < 0, "no key": F.col("k").isNull()}
    stored, report = guards.checked_write(df, "t", bad, stop=False)
    assert rows(stored) == rows(df) and rows(report) == [("negative", 0, 1), ("no key", 1, 0)]
    with pytest.raises(guards.CheckFailed, match="negative") as error:
        guards.checked_write(df, "t", bad)
    assert error.value.failing == {"negative": 1}
    assert rows(guards.checked_write(df.where("false"), "t", bad)[1]) == [("negative", 1, 0), ("no key", 1, 0)]


def test_fan_out_stops_the_job(make, rows):
    left = make("k int, v int", (1, 1), (1, 2), (None, 3), (4, 4))
    once = make("k int, name string", (1, "a"), (None, "n"), (2, "b"))
    assert rows(guards.guarded_join(left, once, "k")) == [(1, 1, "a"), (1, 2, "a"), (4, 4, None), (None, 3, "n")]
    with pytest.raises(Exception, match="crosswalk: key occurs more than once.*1"):
        guards.guarded_join(left, once.unionByName(once.where("k = 1")), "k", label="crosswalk").collect()
    with pytest.raises(Exception, match="more than once"):
        guards.guarded_join(left, once.unionByName(once.where("k IS NULL")), [("k", "k")]).select("v").collect()


def test_surrogate_id_joins_no_rows_back(spark, make):
    """The numbers stand in the sorted rows; what is joined is one row a sorted part. Null and repeated rows are numbered too."""
    df = make("a int, b string", (2, "x"), (None, "y"), (2, "x"), (1, None), (2, None)).repartition(3)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = groups.surrogate_id(df, ["a"], "id", start=5)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, out.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == [(5, 1, None), (6, 2, "x"), (7, 2, "x"), (8, 2, None), (9, None, "y")]
    assert "SortMergeJoin" not in plan and "hashpartitioning(__row" not in plan
