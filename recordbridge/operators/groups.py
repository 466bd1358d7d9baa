"""Grouping, per-group extremes and numbering.

No operator here sorts or collects a whole group in one task unless its result is one
cell per group: extremes are aggregated before the shuffle and joined back, numbers
come from sorted slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .joins import ns_join


def group_profile(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """One row per group with named aggregates."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_amount(df: DataFrame, keys: Sequence[str], amount: str, count: str = "N", total: str = "Amt") -> DataFrame:
    """Row count and sum; missing amounts count as nothing, also if all are missing."""
    summed = F.coalesce(F.sum(F.col(amount)), F.lit(0))
    return group_profile(df, keys, {count: F.count(F.lit(1)), total: summed})


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Row counts under several conditions in one pass."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def group_minmax_dates(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Earliest and latest of several columns per group: ``min_<name>``, ``max_<name>``."""
    aggs = {}
    for name, source in columns.items():
        aggs[f"max_{name}"] = F.max(source)
        aggs[f"min_{name}"] = F.min(source)
    return group_profile(df, keys, aggs)


def list_agg(df: DataFrame, keys: Sequence[str], col: str, name: str = "items", count: str = "count") -> DataFrame:
    """Values per group, sorted and comma-joined, with the group size.

    Equal values are counted first, so a group ships each value once however often
    it occurs. The text of one group is one cell, as the result demands.
    """
    value = F.coalesce(F.col(col).cast("string"), F.lit("NA"))
    distinct = df.groupBy(*keys, value.alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    pairs = F.sort_array(F.collect_list(F.struct("__v", "__n")))
    repeated = F.transform(pairs, lambda p: F.array_repeat(p["__v"], p["__n"].cast("int")))
    return distinct.groupBy(*keys).agg(
        F.sum("__n").alias(count), F.array_join(F.flatten(repeated), ", ").alias(name)
    )


def nth_columns(df: DataFrame, keys: Sequence[str], col: str, n: int, prefix: str, count: str = "count", dedupe: bool = False) -> DataFrame:
    """The first ``n`` sorted values of a group in columns, blank if absent, and the count.

    Only the first ``n`` rows of a group are shuffled; the count is aggregated apart.
    """
    src = df.select(*keys, col)
    if dedupe:
        src = src.distinct()
    order = Window.partitionBy(*keys).orderBy(F.col(col).asc_nulls_last())
    first = src.withColumn("__i", F.row_number().over(order)).where(F.col("__i") <= n)
    cells = [
        F.coalesce(F.max(F.when(F.col("__i") == i, F.col(col).cast("string"))), F.lit("")).alias(f"{prefix}{i}")
        for i in range(1, n + 1)
    ]
    sizes = count_by(src, keys, count)
    return ns_join(sizes, first.groupBy(*keys).agg(*cells), list(keys), "left")


def duplicate_groups(df: DataFrame, keys: Sequence[str] | None = None, name: str = "dupe_count") -> DataFrame:
    """The rows whose key (all columns by default) occurs more than once, with the count."""
    keys = list(keys or df.columns)
    repeated = count_by(df, keys, name).where(F.col(name) > 1)
    return ns_join(df, repeated, keys, "inner")


def distinct_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One full row per key, the first in an explicit order."""
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("__i", F.row_number().over(first)).where("__i = 1").drop("__i")


def above_mean(df: DataFrame, col: str) -> DataFrame:
    """Rows above the overall mean of a column."""
    return df.where(F.col(col) > df.agg(F.avg(col)).scalar())


def latest(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], ascending: bool = False, many_ties: bool = False) -> DataFrame:
    """All rows at the group's extreme, ties included.

    One pass: rows below the best of their task are dropped before the shuffle, so of a
    large group only ties meet in a task. With ``many_ties``, for ties that would fill a
    task, the extreme is aggregated and joined back on keys and order value instead,
    which spreads a group over its order values but reads the input twice. A group with
    only nulls is kept. Several order columns rank by the first, then the next.
    """
    order = [order] if isinstance(order, str) else list(order)
    if not many_ties:
        ranking = [F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last() for c in order]
        return df.withColumn("__i", F.rank().over(Window.partitionBy(*keys).orderBy(*ranking))).where("__i = 1").drop("__i")
    if len(order) == 1:
        best = (F.min if ascending else F.max)(F.col(order[0]))
        parts = [F.col("__best")]
    elif ascending:
        best = F.min(F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c).alias(c))]))
        parts = [F.col(f"__best.{c}") for c in order]
    else:
        best = F.max(F.struct(*order))
        parts = [F.col(f"__best.{c}") for c in order]
    winners = df.groupBy(*keys).agg(best.alias("__best")).select(*keys, *[p.alias(f"__o{i}") for i, p in enumerate(parts)])
    return ns_join(df, winners, [*keys, *[(c, f"__o{i}") for i, c in enumerate(order)]], "left_semi")


def global_min_row(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The single row that sorts first."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(1)


def with_group(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Group aggregates attached to every row of the group."""
    return ns_join(df, group_profile(df, keys, aggs), list(keys), "left")


def _ranked(df: DataFrame, order: Sequence[str], unique: bool) -> tuple[DataFrame, DataFrame]:
    """``df`` written once with a mark (``__row``), and sorted by range in a total order.

    The order is ended by all other columns, unless the given ones are ``unique``, and by the
    mark, so that rows of one key at one moment spread over parts too.
    """
    rest = [] if unique else [f.name for f in df.schema if f.name not in order and f.dataType.typeName() not in ("map", "variant")]
    rows = materialise(df.withColumn("__row", F.monotonically_increasing_id()), "rows")
    return rows, rows.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in [*order, *rest]], "__row")


def _placed(ranked: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` of sorted rows, written, with ``__part`` and ``__place``: sorted part, and place in it from 0."""
    stored = materialise(ranked.select(*[f"`{c}`" for c in keep], F.monotonically_increasing_id().alias("__at")), "places")
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.withColumns({"__part": part, "__place": place}).drop("__at")


def _places(df: DataFrame, order: Sequence[str], keep: Sequence[str], unique: bool) -> tuple[DataFrame, DataFrame]:
    """``df`` written once with marks, and the columns ``keep``, marks and places of its sorted rows: a row is wider than these."""
    rows, ranked = _ranked(df, order, unique)
    return rows, _placed(ranked, [*keep, "__row"])


def seq_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "n", slice_by: Column | None = None, small: bool = False, unique: bool = False) -> DataFrame:
    """Number the rows of each group 1..n in an explicit order.

    The rows are sorted by range over keys and order together, so a large group spreads over many
    sorted parts, whatever its moments. A row's number is its place since its group began in its part,
    and the rows of the group in earlier parts: a group has at most one summand a part. The order
    is made total by all other columns unless keys and order are ``unique`` together.

    ``slice_by`` saves the sort where it never falls when the order rises (the day of the first
    order column, say) and no slice of a group is large: rows are numbered inside a slice, and
    the sizes of earlier slices added. ``small`` numbers each group in one task; it is for groups known
    to be small, or where just the first few numbers are kept.
    """
    ordering = [F.col(c).asc_nulls_last() for c in order]
    if small:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)))
    if slice_by is None:
        rows, places = _places(df, [*keys, *order], keys, unique)
        parts = places.groupBy(*keys, "__part").agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__n"))
        earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        added = parts.select(*keys, "__part", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__added"))
        numbers = ns_join(places, added, [*keys, "__part"], "inner").select(F.col("__row").alias("__of"), (F.col("__place") + F.col("__added")).alias("__number"))
        return rows.join(numbers, F.col("__row") == F.col("__of")).select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.col("__number").alias(name))
    sliced = df.withColumn("__slice", slice_by)
    before = Window.partitionBy(*keys).orderBy(F.col("__slice").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select(*keys, "__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(*keys, "__slice").orderBy(*ordering))
    numbered = ns_join(sliced.withColumn("__i", inside), offsets, [*keys, "__slice"], "left")
    return numbered.withColumn(name, (F.col("__i") + F.col("__before")).cast("long")).drop("__slice", "__i", "__before")


def surrogate_id(df: DataFrame, order: Sequence[str], name: str, start: int = 1, unique: bool = False) -> DataFrame:
    """Number all rows start..N in an explicit order, ended by all other columns to make it total.

    Rows are sorted once and written as sorted, each with its place in its part; the row
    counts of earlier sorted parts (one number a part) are added. Nothing is joined back by row. Where the
    order columns are ``unique``, nothing else is sorted.
    """
    _, ranked = _ranked(df, order, unique)
    places = _placed(ranked, df.columns)
    sizes = places.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sort partition: bounded by the shuffle partition setting.
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    number = (F.col("__place") + F.col("__before") + start).alias(name)
    return places.join(F.broadcast(offsets), "__part").select(number, *[F.col(f"`{c}`") for c in df.columns])
