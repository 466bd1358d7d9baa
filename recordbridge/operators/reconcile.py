"""Comparing the old system with the new one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import round_even
from ..functions.dates import day, days_between
from ..functions.nulls import not_in, strict_agg
from ..functions.text import strip_stopwords
from ..session import materialise
from .approximate import PREFIX_LENGTH, distance_limit, unmatched_substrings
from .groups import count_by, surrogate_id
from .joins import anti_exclude, ns_join


def table_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per column, how many matched rows differ; then the rows only one side has.

    Keys name the rows (unique on each side). For rows known by position only, number
    both sides with ``by_position`` and use that as the key.
    """
    marked_a = a.select(*keys, *columns).withColumn("__in_a", F.lit(True))
    marked_b = b.select(*keys, *columns).withColumn("__in_b", F.lit(True))
    both = ns_join(marked_a, marked_b, list(keys), "full")
    matched = F.col("__in_a") & F.col("__in_b")
    counts = [F.count_if(matched & ~F.col(f"{c}_x").eqNullSafe(F.col(f"{c}_y"))).alias(c) for c in columns]
    totals = both.agg(
        *counts,
        F.count_if(F.col("__in_b").isNull()).alias("(only left)"),
        F.count_if(F.col("__in_a").isNull()).alias("(only right)"),
    )
    return columns_to_rows(totals, "column", "n")


BUCKETS = 1 << 14  # by which two tables are compared first


def _bucket(columns: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(BUCKETS))


def differing_buckets(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Buckets of keys (``__bucket``) in which the two tables do not hold the same rows.

    Each bucket has a row count and the sum of its rows' hashes, in two halves, so neither order nor
    layout matters; a task ships one row a bucket. Unequal buckets pass for equal with a chance of 2^-64.
    """
    def hashed(df: DataFrame) -> DataFrame:
        return df.select(_bucket(keys).alias("__bucket"), F.xxhash64(*[F.col(f"`{c}`") for c in dict.fromkeys([*keys, *columns])]).alias("__hash"))

    halves = {"__high": F.shiftright("__hash", 32), "__low": F.col("__hash").bitwiseAND(F.lit((1 << 32) - 1))}
    sums = [F.sum(of_side(i, h)).alias(f"{n}{i}") for n, h in halves.items() for i in (1, 2)]
    sums += [F.count_if(F.col("side") == i).alias(f"__n{i}") for i in (1, 2)]
    per = both_sides(hashed(a), hashed(b)).groupBy("__bucket").agg(*sums)
    same = reduce(Column.__and__, [F.col(f"{n}1").eqNullSafe(F.col(f"{n}2")) for n in ("__high", "__low", "__n")])
    return per.where(~same).select("__bucket")


def _in_buckets(df: DataFrame, buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    # At most BUCKETS rows are sent to the executors.
    return df.join(F.broadcast(buckets), _bucket(keys) == F.col("__bucket"), "left_semi")


def cell_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Every differing cell of matched rows: (column, the keys, left, right), values as text.

    A row that only one side has is one row, with ``(only left)`` or ``(only right)`` as its column.
    Keys name the rows (unique on each side). The tables are compared from the top: checksums of
    buckets, then one hash a row in the buckets that differ, then the cells of the rows that differ.
    Of equal tables nothing but the checksums is shipped.
    """
    keys, columns = list(keys), list(columns)
    buckets = differing_buckets(a, b, keys, columns)
    near = [_in_buckets(df.select(*keys, *columns), buckets, keys) for df in (a, b)]
    hashes = [df.select(*keys, F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("__hash")) for df in near]
    each = both_sides(*hashes).groupBy(*keys).agg(*[F.max(of_side(i, F.col("__hash"))).alias(f"__h{i}") for i in (1, 2)])
    wanted = each.where(~F.col("__h1").eqNullSafe(F.col("__h2"))).select(*keys)
    left, right = (ns_join(df, wanted, keys, "left_semi").withColumn(mark, F.lit(True)) for df, mark in zip(near, ("__in_a", "__in_b")))
    both = ns_join(left, right, keys, "full")
    text = lambda c: F.col(f"`{c}`").cast("string")
    cells = [
        F.when(~F.col(f"`{c}_x`").eqNullSafe(F.col(f"`{c}_y`")), F.struct(F.lit(c).alias("column"), text(f"{c}_x").alias("left"), text(f"{c}_y").alias("right")))
        for c in columns
    ]
    none = F.lit(None).cast("string")
    alone = F.struct(F.when(F.col("__in_a"), "(only left)").otherwise("(only right)").alias("column"), none.alias("left"), none.alias("right"))
    found = F.when(F.col("__in_a") & F.col("__in_b"), F.filter(F.array(*cells), lambda c: c.isNotNull())).otherwise(F.array(alone))
    return both.select(*keys, F.explode(found).alias("__c")).select("__c.column", *keys, "__c.left", "__c.right")


def columns_to_rows(one_row: DataFrame, name: str, value: str) -> DataFrame:
    """A one-row table as (column name, value) rows."""
    pairs = [F.struct(F.lit(c).alias(name), F.col(f"`{c}`").alias(value)) for c in one_row.columns]
    return one_row.select(F.inline(F.array(*pairs)))


def by_position(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Row position in an explicit order, for tables without a key."""
    return surrogate_id(df, order, "position")


def column_drift(a: DataFrame, b: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows with the same key whose column differs, both values known."""
    both = ns_join(a.select(*keys, column), b.select(*keys, column), list(keys), "inner")
    return both.where(F.col(f"{column}_x") != F.col(f"{column}_y"))


def both_sides(a: DataFrame, b: DataFrame, *more: DataFrame) -> DataFrame:
    """The frames stacked, each row marked with its side (1, 2, ..).

    Grouping the stack gives the aggregates of all sides next to each other: one
    shuffle, combined before it, and null keys meet as in ``ns_join``.
    """
    frames = [df.withColumn("side", F.lit(i)) for i, df in enumerate((a, b, *more), 1)]
    return reduce(DataFrame.unionByName, frames)


def of_side(side: int, value: Column) -> Column:
    return F.when(F.col("side") == side, value)


def rowcount_drift(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups that both sides have, with different row counts."""
    counts = both_sides(a.select(*keys), b.select(*keys)).groupBy(*keys).agg(
        F.count_if(F.col("side") == 1).alias("n_x"), F.count_if(F.col("side") == 2).alias("n_y")
    )
    return counts.where("n_x > 0 AND n_y > 0 AND n_x <> n_y")


def date_drift(a: DataFrame, b: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Earliest and latest date per group on both sides, whether they differ, days off.

    A group that one side lacks has nulls there.
    """
    value = F.col(column)
    spans = both_sides(a.select(*keys, column), b.select(*keys, column)).groupBy(*keys).agg(
        *[fn(of_side(side, value)).alias(f"{name}_{tag}") for side, tag in ((1, "x"), (2, "y")) for name, fn in (("max", F.max), ("min", F.min))]
    )
    differ = (F.col("max_x") != F.col("max_y")) | (F.col("min_x") != F.col("min_y"))
    return spans.withColumns({
        "different": F.when(differ, 1).when(~differ, 0),
        "max_days_off": days_between(F.col("max_x"), F.col("max_y")),
    })


def member_drift(a: DataFrame, b: DataFrame, on: Sequence[str | tuple[str, str]]) -> DataFrame:
    """Rows of ``a``, with all their attributes, whose key ``b`` does not have."""
    return anti_exclude(a, b, on)


def user_comparison(
    source: DataFrame, target: DataFrame, opened: str, skipped: Sequence[str] = (), support_role: str = "SUPPORT",
) -> DataFrame:
    """Users of two systems that need a look, with all attributes of their own system as a map.

    ``created after file``: added to the source on or after ``opened``. ``not in target``: active, not of the
    support role, not ``skipped``, and unknown to the target. ``not in source``: with a role in the
    target, unknown to the source. ``source``: users_username, users_status, users_role,
    users_audit_date_added; ``target``: staff_username, staff_primary_access_role; both may have more.
    """
    def found(df: DataFrame, name: str, finding: str) -> DataFrame:
        attributes = F.map_from_arrays(F.array(*[F.lit(c) for c in df.columns]), F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns]))
        return df.select(F.lit(finding).alias("finding"), F.col(name).alias("username"), attributes.alias("attributes"))

    staff = target.where(F.col("staff_primary_access_role").isNotNull())
    late = source.where(F.col("users_audit_date_added") >= day(opened))
    # An unknown status or role is no reason to expect the user.
    expected = source.where((F.col("users_status") == "Yes") & (F.col("users_role") != support_role) & not_in(F.col("users_username"), list(skipped)))
    missing = member_drift(expected, staff, [("users_username", "staff_username")])
    new = member_drift(staff, source, [("staff_username", "users_username")])
    return reduce(DataFrame.unionByName, [
        found(late, "users_username", "created after file"), found(missing, "users_username", "not in target"), found(new, "staff_username", "not in source"),
    ])


def amount_reconcile(left: DataFrame, right: DataFrame, extra: DataFrame, key: str, amount: str) -> DataFrame:
    """Ids whose amounts disagree by more than the average disagreement.

    ``extra`` holds records that sit in the right system beside the compared ones;
    their count and amount are taken off. Amounts are compared after rounding half
    to even. The frames need only the key and the amount. The
    disagreeing ids are written once, as their average comes before their selection.
    """
    cols = [key, amount]
    stacked = both_sides(left.select(*cols), right.select(*cols), extra.select(*cols)).where(F.col(key).isNotNull())
    tags = {1: "left", 2: "right", 3: "extra"}
    totals = stacked.groupBy(key).agg(
        *[F.count_if(F.col("side") == i).alias(f"N_{tag}") for i, tag in tags.items()],
        *[F.coalesce(F.sum(of_side(i, F.col(amount))), F.lit(0)).alias(f"Amt_{tag}") for i, tag in tags.items()],
    )
    net = totals.where("N_left > 0 AND N_right > 0").select(
        key, "N_left", "Amt_left", (F.col("N_right") - F.col("N_extra")).alias("N_right"),
        (F.col("Amt_right") - F.col("Amt_extra")).alias("Amt_right"),
    )
    off = net.where(round_even(F.col("Amt_left")) != round_even(F.col("Amt_right")))
    off = materialise(off.withColumn("Amt_diff", F.abs(F.col("Amt_right") - F.col("Amt_left"))), "amounts")
    return off.where(F.col("Amt_diff") > off.agg(F.avg("Amt_diff")).scalar())


def mapped_amounts(
    left: DataFrame, right: DataFrame, extra: DataFrame, id_map: DataFrame, key: str = "EnrollmentID", person: str = "PersonalID", amount: str = "FAAmount"
) -> tuple[DataFrame, DataFrame]:
    """Amounts of two systems whose ids differ, and the left ids that have no counterpart.

    ``id_map``: left_id, right_id. Both sides are summed by the pair of ids; a left id with several
    right ones adds their sums up, and has unknown ones if the right side lacks a pair. ``extra`` holds
    records (by left id) that sit in the right system beside the compared ones and are taken off. The first table has the
    ids whose rounded amounts differ by more than the average of those that do, with each
    right id and its person; the second the left ids without a right one, with their person.
    """
    def sums(df: DataFrame, own: str) -> DataFrame:
        mapped = ns_join(df.select(F.col(key).alias(own), amount), id_map.select("left_id", "right_id"), own, "left")
        return mapped.groupBy("left_id", "right_id").agg(F.count(F.lit(1)).alias("N"), F.coalesce(F.sum(amount), F.lit(0)).alias("Amt"))

    ours = sums(left, "left_id")
    both = ns_join(ours, sums(right, "right_id"), ["left_id", "right_id"], "left", ("_left", "_right"))
    both = materialise(both, "mapped-amounts")
    per = both.where(F.col("left_id").isNotNull()).groupBy("left_id").agg(*[strict_agg(F.sum, F.col(c)).alias(c) for c in ("N_left", "Amt_left", "N_right", "Amt_right")])
    less = extra.groupBy(F.col(key).alias("left_id")).agg(F.count(F.lit(1)).alias("__n"), F.coalesce(F.sum(amount), F.lit(0)).alias("__amt"))
    net = ns_join(per, less, "left_id", "left").withColumns({
        "N_right": F.col("N_right") - F.coalesce("__n", F.lit(0)), "Amt_right": F.col("Amt_right") - F.coalesce("__amt", F.lit(0)),
    }).drop("__n", "__amt")
    off = net.where(round_even(F.col("Amt_left")) != round_even(F.col("Amt_right"))).withColumn("Amt_diff", F.abs(F.col("Amt_right") - F.col("Amt_left")))
    off = ns_join(off, both.select("left_id", "right_id").distinct(), "left_id", "left")
    off = ns_join(off, right.select(F.col(key).alias("right_id"), F.col(person).alias("right_person")).distinct(), "right_id", "left")
    off = materialise(off, "differing-amounts")
    people = left.select(F.col(key).alias("left_id"), F.col(person).alias("left_person")).distinct()
    unmapped = ns_join(both.where(F.col("right_id").isNull()).select("left_id", "N_left", "Amt_left"), people, "left_id", "left")
    return off.where(F.col("Amt_diff") > off.agg(F.avg("Amt_diff")).scalar()), unmapped


def fuzzy_prefix(a: DataFrame, b: DataFrame, key: str, text: str, length: int = PREFIX_LENGTH, whole: bool = False) -> DataFrame:
    """Distinct (key, prefix) rows of ``a`` that no prefix under the same key in ``b`` approximately holds.

    Holds means anywhere inside, within ``distance_limit`` edits; with ``whole`` both prefixes
    are compared as wholes instead. The texts are read once: their distinct prefixes are written and
    compared from there.
    """
    def prefixes(df: DataFrame, side: int) -> DataFrame:
        return df.select(key, F.substring(F.col(text), 1, length).alias("prefix"), F.lit(side).alias("side")).distinct()

    stored = materialise(prefixes(a, 1).unionByName(prefixes(b, 2)), "prefixes").where(F.col("prefix").isNotNull())
    left, right = (stored.where(F.col("side") == side).select(key, "prefix") for side in (1, 2))
    return unmatched_prefixes(left, right, key, length) if whole else unmatched_substrings(left, right, key)


def unmatched_prefixes(left: DataFrame, right: DataFrame, key: str, length: int = PREFIX_LENGTH) -> DataFrame:
    """Rows (key, prefix) of ``left`` with no similar prefix under the same key in ``right``.

    Similar means within ``distance_limit`` edits. Candidates are found without pairing
    all texts of a key: a prefix is cut into one piece more than the edits allowed, so
    a similar one must hold some piece unchanged. Piece ``i`` can have moved by at most
    ``i`` places counted from the front and by what the later pieces leave counted from
    the back (the multi-match-aware bound of Li et al., Pass-Join, 2011). The join is
    on key, length and piece, and exact. Equal prefixes are taken out first.
    """
    most = -(-length // 10)
    left = anti_exclude(left, right, [key, "prefix"])
    right = right.select(F.col(key).alias("__key"), F.col("prefix").alias("__other"))

    size, limit = F.char_length("prefix"), distance_limit(F.col("prefix"))
    lengths = F.struct(size.alias("size"), limit.alias("limit"))

    def cut(i: Column, n: Column, pieces: Column) -> Column:
        """Start (0-based) of piece ``i`` when ``n`` letters are cut into ``pieces``."""
        return F.floor(i * n / pieces).cast("int")

    def piece(i: Column) -> Column:
        n, parts = F.char_length("prefix"), distance_limit(F.col("prefix")) + 1
        start = cut(i, n, parts)
        return F.struct(i.alias("no"), F.substring(F.col("prefix"), start + 1, cut(i + 1, n, parts) - start).alias("piece"))

    left_pieces = left.select(
        key, "prefix", lengths.alias("__l"), F.inline(F.transform(F.sequence(F.lit(0), limit), piece))
    )

    own = F.char_length("__other")
    sizes = F.sequence(F.greatest(own - most, F.lit(0)), F.least(own + most, F.lit(length)))
    sized = right.where(own <= length).select("__key", "__other", F.explode(sizes).alias("__size"))
    sized = sized.withColumn("__limit", F.ceil(F.col("__size") / F.lit(10.0)).cast("int"))
    numbered = sized.select("*", F.explode(F.sequence(F.lit(0), F.col("__limit"))).alias("__no"))
    no, limit_, gap = F.col("__no"), F.col("__limit"), own - F.col("__size")
    start = cut(no, F.col("__size"), limit_ + 1)
    width = cut(no + 1, F.col("__size"), limit_ + 1) - start
    low, high = F.greatest(-no, gap - (limit_ - no)), F.least(no, gap + (limit_ - no))
    placed = numbered.select(
        "__key", "__other", "__size", "__no", width.alias("__width"), (start + low).alias("__from"), (start + high).alias("__to")
    ).where("__from <= __to")
    right_pieces = (
        placed.select("*", F.explode(F.sequence("__from", "__to")).alias("__spot")).where("__spot >= 0")
        .withColumn("__piece", F.substring(F.col("__other"), F.col("__spot") + 1, F.col("__width")))
        .where(F.char_length("__piece") == F.col("__width"))
        .select("__key", "__other", "__size", "__no", "__piece")
    )
    candidates = left_pieces.join(
        right_pieces,
        F.col(key).eqNullSafe(F.col("__key"))
        & (F.col("__l.size") == F.col("__size"))
        & (F.col("no") == F.col("__no"))
        & (F.col("piece") == F.col("__piece"))
        # One bounded comparison; it gives -1 beyond the largest limit.
        & F.array_contains(F.sequence(F.lit(0), F.col("__l.limit")), F.levenshtein(F.col("prefix"), F.col("__other"), most)),
        "left_semi",
    )
    return anti_exclude(left, candidates.select(key, "prefix"), [key, "prefix"])


#: Words up to their last "com". Looked for where a word begins only: what is left of it holds no further one.
COM_WORDS = "(?<![A-Za-z0-9])[A-Za-z0-9]*com"


def text_reconcile(a: DataFrame, b: DataFrame, key: str, text: str, length: int = PREFIX_LENGTH) -> DataFrame:
    """Cleaned notes that one side has and the other has not, per person and side.

    ``side`` says who has the note; ``similar`` is 1 where the first ``length`` letters of
    this note, words ending in "com" left out before, are found approximately anywhere in the first
    ``length`` letters of one of the other side's missing notes. The texts are cleaned and compared
    in one pass; the one-sided notes are written once with both their prefixes, from
    which the comparison works, and are read whole only for the result. Both sides are looked for in one
    comparison, in which a person and the side that has the note are one key.
    """
    def cleaned(df: DataFrame, side: int) -> DataFrame:
        noted = df.where(F.col(text).isNotNull())
        return noted.select(key, strip_stopwords(F.col(text)).alias("note"), F.lit(side).alias("side"))

    grouped = cleaned(a, 1).unionByName(cleaned(b, 2)).groupBy(key, "note")
    sides = grouped.agg(F.min("side").alias("lo"), F.max("side").alias("hi")).where("lo = hi")
    asked = F.substring(F.regexp_replace("note", COM_WORDS, ""), 1, length)
    one_sided = materialise(sides.select(key, "note", "lo", F.substring("note", 1, length).alias("start"), asked.alias("prefix")), "one-sided")
    starts = materialise(one_sided.select(key, "lo", "start", "prefix").distinct(), "one-sided-starts")

    has = F.struct(F.col(key).alias("key"), F.col("lo").alias("lo")).alias("has")
    lacks = F.struct(F.col(key).alias("key"), (3 - F.col("lo")).alias("lo")).alias("has")
    asked, given = starts.select(has, "prefix").distinct(), starts.select(lacks, F.col("start").alias("prefix")).distinct()
    lonely = unmatched_substrings(asked, given, "has").select(F.col("has.key").alias(key), "prefix", F.col("has.lo").alias("lo"), F.lit(True).alias("alone"))
    joined = ns_join(one_sided.drop("start"), lonely, [key, "prefix", "lo"], "left")
    return joined.select(key, "note", F.when(F.col("lo") == 1, "left").otherwise("right").alias("side"), F.when(F.col("alone"), 0).otherwise(1).alias("similar"))


def code_verify(expected: DataFrame, actual: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, counted as often as they occur, that only one side has.

    Checksums of buckets come first; only rows of buckets that differ are grouped, both sides in one pass.
    """
    e, x = expected.select(*columns), actual.select(*columns)
    buckets = differing_buckets(e, x, columns, [])
    counts = both_sides(*[_in_buckets(df, buckets, columns) for df in (e, x)]).groupBy(*columns).agg(
        *[F.count_if(F.col("side") == i).alias(f"__n{i}") for i in (1, 2)]
    )
    more = F.col("__n1") - F.col("__n2")
    side = F.when(more > 0, "expected only").otherwise("actual only").alias("side")
    return counts.where(more != 0).select(*columns, side, F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs(more))).alias("__i")).drop("__i")


def checks(df: DataFrame, bad: Mapping[str, Column]) -> DataFrame:
    """Row checks as rows (name, ok, failing), all in one pass. ``bad`` marks failing rows."""
    counted = df.agg(*[F.count_if(c).alias(n) for n, c in bad.items()])
    rows = columns_to_rows(counted, "name", "failing")
    return rows.select("name", (F.col("failing") == 0).cast("int").alias("ok"), "failing")


def unique_check(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One check row: how many keys occur more than once."""
    repeated = count_by(df, keys).agg(F.count_if(F.col("n") > 1).alias("failing"))
    return repeated.select(F.lit(name).alias("name"), (F.col("failing") == 0).cast("int").alias("ok"), "failing")


def all_checks(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
