"""Joins with the source data's null rule: a null key equals a null key.

Lookups carry no broadcast hint. Spark broadcasts a side whose size it knows to be
under its threshold and otherwise joins by shuffle, where adaptive execution splits
the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

Keys = str | Sequence[str | tuple[str, str]]


def key_pairs(on: Keys) -> list[tuple[str, str]]:
    items = [on] if isinstance(on, str) else list(on)
    return [(k, k) if isinstance(k, str) else tuple(k) for k in items]


def ns_join(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    how: str = "inner",
    suffix: tuple[str, str] = ("_x", "_y"),
    nulls_match: bool = True,
) -> DataFrame:
    """Join on named keys; other names that clash get a suffix, keys keep the left name.

    ``nulls_match=False`` is for keys known to be never null on one side.
    """
    pairs = key_pairs(on)
    left_names, right_names = left.columns, right.columns
    right = right.withColumnsRenamed({c: f"__r_{c}" for c in right_names})

    def same(lk: str, rk: str) -> Column:
        a, b = left[f"`{lk}`"], right[f"`__r_{rk}`"]
        return a.eqNullSafe(b) if nulls_match else a == b

    joined = left.join(right, reduce(and_, [same(lk, rk) for lk, rk in pairs]), how)
    if how in ("left_semi", "left_anti"):
        return joined
    left_keys, right_keys = dict(pairs), {rk for _, rk in pairs}
    right_rest = [c for c in right_names if c not in right_keys]
    clash = set(left_names) & set(right_rest)

    def named(source: str, name: str) -> Column | str:
        return f"`{name}`" if source == name else F.col(f"`{source}`").alias(name)

    def key(c: str) -> Column | str:
        if how in ("right", "full"):
            return F.coalesce(f"`{c}`", f"`__r_{left_keys[c]}`").alias(c)
        return f"`{c}`"

    return joined.select(
        *[key(c) if c in left_keys else named(c, c + suffix[0] if c in clash else c) for c in left_names],
        *[named(f"__r_{c}", c + suffix[1] if c in clash else c) for c in right_rest],
    )


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every column name the two frames share."""
    return ns_join(left, right, [c for c in left.columns if c in right.columns], how)


def semi_restrict(df: DataFrame, scope: DataFrame, on: Keys, nulls_match: bool = True) -> DataFrame:
    """Keep the rows that have a partner."""
    return ns_join(df, scope, on, "left_semi", nulls_match=nulls_match)


def anti_exclude(df: DataFrame, drop: DataFrame, on: Keys, nulls_match: bool = True) -> DataFrame:
    """Keep the rows that have no partner."""
    return ns_join(df, drop, on, "left_anti", nulls_match=nulls_match)


def lookup_join(df: DataFrame, lookup: DataFrame, on: Keys) -> DataFrame:
    """Left join on the lookup's own key, which is never null: plain equality will do."""
    return ns_join(df, lookup, on, "left", nulls_match=False)


def left_chain(fact: DataFrame, *lookups: tuple[DataFrame, Keys]) -> DataFrame:
    """Enrich one fact table by several left joins."""
    for lookup, on in lookups:
        fact = ns_join(fact, lookup, on, "left")
    return fact


def full_coalesce(frames: Sequence[DataFrame], keys: Sequence[str], unique_keys: bool = False) -> DataFrame:
    """Full outer join of several frames on the same keys.

    With ``unique_keys`` (one row per key in each frame) the frames are stacked and
    grouped: one shuffle for all of them, combined before it. Else every frame is joined to the
    different keys of all: the keys stay the left side's own, so their partitions serve all
    joins, and each frame is shuffled once.
    """
    keys = list(keys)
    if not unique_keys:
        every = reduce(DataFrame.unionByName, [f.select(*keys) for f in frames]).distinct()
        return reduce(lambda a, b: ns_join(a, b, keys, "left"), frames, every)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    rest = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(F.col(c)).alias(c) for c in rest])


def fallback_join(df: DataFrame, lookup: DataFrame, by: Sequence[tuple[str, str]], value: str, name: str | None = None) -> DataFrame:
    """Look a value up by a first key, where that fails by the next, and so on."""
    temp = [f"__v{i}" for i in range(len(by))]
    for (left_key, right_key), t in zip(by, temp):
        side = lookup.select(F.col(right_key).alias(f"__k{t}"), F.col(value).alias(t))
        df = ns_join(df, side, [(left_key, f"__k{t}")], "left")
    return df.withColumn(name or value, F.coalesce(*[F.col(t) for t in temp])).drop(*temp)


def fanout_report(right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that would multiply rows in a join, with their row count."""
    return right.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where("count > 1")


#: Blocks (level, block) that make up the whole numbers __lo to __hi: on a level at most the first and the
#: last block inside, where the block of twice the size around it would reach beyond.
_FIRST, _LAST = "shiftright(__lo + shiftleft(1L, l) - 1, l)", "(shiftright(__hi + 1, l) - 1)"
_COVER = f"""
flatten(transform(sequence(0, cast(floor(log2(__hi - __lo + 1)) AS int)), l -> transform(
  filter(array_distinct(array(if({_FIRST} % 2 <> 0, {_FIRST}, NULL), if({_LAST} % 2 = 0, {_LAST}, NULL))), b -> b IS NOT NULL AND {_FIRST} <= {_LAST}),
  b -> named_struct('level', l, 'block', b))))"""


def dyadic_cover(df: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Each row once for every block of the shortest cover of the whole numbers lo..hi: ``__level``, ``__bin``.

    Block b of a level holds the numbers b * 2^level to (b + 1) * 2^level - 1; a stretch of n
    numbers has at most 2 * log2(n) + 1 of them.
    """
    ends = df.withColumns({"__lo": lo.cast("bigint"), "__hi": hi.cast("bigint")})
    blocks = ends.withColumn("__block", F.explode(F.expr(_COVER)))
    return blocks.withColumns({"__level": F.col("__block.level"), "__bin": F.col("__block.block")}).drop("__lo", "__hi", "__block")


#: Spans of a key up to which all its rows are placed on one level; blocks that a key may have there, for each span and beside that.
DENSE, BLOCKS_A_SPAN, BLOCKS_MORE = 1000, 8, 24
LEVELS = 25  # blocks of 2^24 bins hold every date


def _key_levels(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(__k0, .., __levels, __dense): the levels of the keys that are not just placed on level 0, written to the shared folder.

    ``spans`` has ``__lo`` and ``__hi``, in bins. A key of few spans gets the lowest level on which they make few blocks; one
    of more than ``DENSE`` is ``__dense`` and gets all levels of their dyadic covers.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    ends = spans.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "__lo", "__hi")
    blocks = lambda l: F.sum(F.shiftright("__hi", l) - F.shiftright("__lo", l) + 1)
    few = F.col("__n") * BLOCKS_A_SPAN + BLOCKS_MORE
    sizes = ends.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"), blocks(0).alias("__blocks"))
    sizes = sizes.where((F.col("__n") > DENSE) | (F.col("__blocks") > few)).drop("__blocks")
    theirs = ns_join(ends, sizes, names, "inner")
    level = F.coalesce(*[F.when(blocks(l) <= few, l) for l in range(LEVELS)], F.lit(LEVELS - 1))
    loose = theirs.where(F.col("__n") <= DENSE).groupBy(*names, "__n").agg(F.array(level).alias("__levels")).drop("__n").withColumn("__dense", F.lit(False))
    dense = dyadic_cover(theirs.where(F.col("__n") > DENSE), F.col("__lo"), F.col("__hi")).groupBy(*names).agg(F.collect_set("__level").alias("__levels"))
    return materialise(loose.unionByName(dense.withColumn("__dense", F.lit(True))), "key-levels")


def interval_join(
    events: DataFrame,
    spans: DataFrame,
    keys: Keys,
    at: str,
    start: str,
    end: str,
    as_of: Column,
    bin_days: int = 90,
) -> DataFrame:
    """Attach each event to every span of the same keys that contains it.

    Both ends count as inside; a missing end means ``as_of``. Events inside no span
    are dropped, events inside several come out once per span. Rows meet on the keys
    and a block of calendar bins. Almost every key has one level: an event is one row, and a span
    one for each block that it touches, on the lowest level where the key's spans make few. Where a key
    has more than ``DENSE`` spans, each is cut into the dyadic blocks that make it up, and an event has one
    row on each level that the key uses. A key holding most of the events is spread over its blocks.
    """

    def bin_of(c: Column) -> Column:
        return F.floor(F.unix_date(c.cast("date")) / bin_days).cast("bigint")

    pairs = key_pairs(keys)
    shut = F.coalesce(F.col(end), as_of.cast(spans.schema[end].dataType))
    closed = spans.withColumn("__shut", shut).where(F.col(start) <= F.col("__shut"))
    closed = closed.withColumns({"__lo": bin_of(F.col(start)), "__hi": bin_of(F.col("__shut"))})
    levels = _key_levels(closed, [rk for _, rk in pairs])
    one = F.coalesce(F.col("__levels")[0], F.lit(0))
    touched = F.transform(F.sequence(F.call_function("shiftright", "__lo", one), F.call_function("shiftright", "__hi", one)), lambda b: F.struct(one.alias("level"), b.alias("block")))
    binned = ns_join(closed, levels, [(rk, f"__k{i}") for i, (_, rk) in enumerate(pairs)], "left")
    binned = binned.withColumn("__block", F.explode(F.when(F.col("__dense"), F.expr(_COVER)).otherwise(touched)))
    binned = binned.withColumns({"__level": F.col("__block.level"), "__bin": F.col("__block.block")}).drop("__lo", "__hi", "__block", "__levels", "__dense")
    placed = ns_join(events, levels, [(lk, f"__k{i}") for i, (lk, _) in enumerate(pairs)], "left")
    placed = placed.withColumn("__level", F.explode(F.coalesce("__levels", F.array(F.lit(0))))).drop("__levels", "__dense")
    placed = placed.withColumn("__bin", F.call_function("shiftright", bin_of(F.col(at)), F.col("__level")))
    joined = ns_join(placed, binned, [*pairs, "__level", "__bin"], "inner")
    inside = (F.col(start) <= F.col(at)) & (F.col(at) <= F.col("__shut"))
    return joined.where(inside).drop("__level", "__bin", "__shut")
