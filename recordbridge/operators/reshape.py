"""Stacking, set difference and pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import paste
from .groups import seq_in_group
from .joins import anti_exclude


def sort_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Order rows, missing values last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames whose columns are in different orders; ids and text meet as text."""
    kinds: dict[str, set[str]] = {}
    for f in frames:
        for c, t in f.dtypes:
            kinds.setdefault(c, set()).add(t)
    mixed = {c for c, t in kinds.items() if len(t) > 1 and "string" in t}
    cast = [f.withColumns({c: F.col(c).cast("string") for c in mixed if c in f.columns}) for f in frames]
    return reduce(lambda a, b: a.unionByName(b), cast)


def union_sparse(*frames: DataFrame) -> DataFrame:
    """Stack frames with different columns; what a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def key_diff(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``a`` whose key is not in ``b``, and rows of ``b`` whose key is not in ``a``."""
    return anti_exclude(a, b, keys), anti_exclude(b, a, keys)


def row_diff(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` does not have, on the chosen columns."""
    return a.select(*columns).subtract(b.select(*columns))


def id_intersect(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    return a.select(column).intersect(b.select(column))


def unite(df: DataFrame, name: str, columns: Sequence[str], sep: str = "_", remove: bool = True) -> DataFrame:
    """Join columns as text into one, placed where the first of them was."""
    joined = paste(*[F.col(c) for c in columns], sep=sep).alias(name)
    out: list[Column] = []
    for c in df.columns:
        if c == columns[0]:
            out.append(joined)
        if not (remove and c in columns):
            out.append(F.col(c))
    return df.select(*out)


def separate(df: DataFrame, column: str, into: Sequence[str], sep: str) -> DataFrame:
    """Split text into fixed columns: further parts are dropped, missing ones null."""
    parts = F.split(F.col(column), sep)
    out: list[Column] = []
    for c in df.columns:
        if c == column:
            out += [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(into)]
        else:
            out.append(F.col(c))
    return df.select(*out)


def eav_pivot(df: DataFrame, ids: Sequence[str], attr: str, val: str, mapping: Mapping[str, str]) -> DataFrame:
    """Attribute rows to columns for a declared attribute list.

    One aggregate per attribute, combined before the only shuffle. Several values in
    one cell give the largest.
    """
    cells = [F.max(F.when(F.col(attr) == code, F.col(val))).alias(name) for code, name in mapping.items()]
    return df.groupBy(*ids).agg(*cells)


def latest_pivot(
    df: DataFrame,
    ids: Sequence[str],
    order: Sequence[str],
    attr: str,
    val: str,
    mapping: Mapping[str, str],
    per_attribute: bool = True,
) -> DataFrame:
    """Latest answers straight to columns: ``latest`` then ``eav_pivot`` in one aggregate.

    ``per_attribute`` takes the latest row of each attribute; otherwise only answers
    given at the group's latest moment count, whichever attribute set it.
    """
    ranked = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    moment = F.struct(ranked.alias("at"), F.col(val).alias("val"))
    cells = {f"__{i}": F.max(F.when(F.col(attr) == code, moment)) for i, code in enumerate(mapping)}
    grouped = df.groupBy(*ids).agg(*[c.alias(n) for n, c in cells.items()], F.max(ranked).alias("__at"))

    def cell(i: int) -> Column:
        value = F.col(f"__{i}.val")
        return value if per_attribute else F.when(F.col(f"__{i}.at").eqNullSafe(F.col("__at")), value)

    return grouped.select(*ids, *[cell(i).alias(name) for i, name in enumerate(mapping.values())])


def duplicate_cells(df: DataFrame, ids: Sequence[str], attr: str, val: str) -> DataFrame:
    """Pivot cells that hold more than one distinct value."""
    return df.groupBy(*ids, attr).agg(F.count_distinct(val).alias("values")).where("values > 1")


def spread_numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], n: int
) -> DataFrame:
    """The first ``n`` rows of a group side by side: ``<value>_1`` .. ``<value>_n``."""
    numbered = seq_in_group(df, keys, order, "__i", small=True).where(F.col("__i") <= n)
    cells = [
        F.max(F.when(F.col("__i") == i, F.col(v))).alias(f"{v}_{i}") for v in values for i in range(1, n + 1)
    ]
    return numbered.groupBy(*keys).agg(*cells)


def unnest_diff(df: DataFrame, left: str, right: str, name: str = "item") -> DataFrame:
    """Elements of one list column that its sibling list column does not hold."""
    rest = [c for c in df.columns if c not in (left, right)]
    absent = F.filter(F.col(left), lambda x: ~F.coalesce(F.array_contains(F.col(right), x), F.lit(False)))
    return df.select(*rest, F.explode(absent).alias(name))
