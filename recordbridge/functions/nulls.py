"""Null rules of the source data that differ from Spark's own."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_in(col: Column, values: Iterable) -> Column:
    """Membership that is false, not null, for a null."""
    return F.coalesce(col.isin(list(values)), F.lit(False))


def not_in(col: Column, values: Iterable) -> Column:
    """Exclusion that keeps nulls: a null is in no list."""
    return ~is_in(col, values)


def tri_if(cond: Column, yes, no) -> Column:
    """If/else where an unknown condition gives null, not the else value."""
    return F.when(cond, yes).when(~cond, no)


def strict_agg(fn: Callable[[Column], Column], col: Column) -> Column:
    """Aggregate that is null as soon as one input in the group is null."""
    return F.when(F.count(col) == F.count(F.lit(1)), fn(col))


def paste(*cols: Column, sep: str = " ") -> Column:
    """Concatenate as text, writing a null as the two letters ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("NA")) for c in cols])


def default_null(col: Column, *fallbacks) -> Column:
    """First non-null of a column and its fallbacks (columns or constants)."""
    return F.coalesce(col, *[f if isinstance(f, Column) else F.lit(f) for f in fallbacks])
