"""Column selection, naming and templates."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` in table order."""
    names = df.columns
    return names[names.index(first) : names.index(last) + 1]


def shape(df: DataFrame, *spec: str | tuple[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """Select, rename and reorder.

    A spec is a name, ``(new, old)``, a range ``"a:b"``, a position ``"#3"``, or a
    pattern ``"abc*"`` / ``"*abc"``. Without specs all columns are kept. ``drop`` takes
    the same forms and is applied to what the specs select.
    """

    def expand(item: str) -> list[str]:
        if item.startswith("#"):
            return [df.columns[int(item[1:]) - 1]]
        if item.endswith("*"):
            return [c for c in df.columns if c.startswith(item[:-1])]
        if item.startswith("*"):
            return [c for c in df.columns if c.endswith(item[1:])]
        if ":" in item and item not in df.columns:
            return column_range(df, *item.split(":", 1))
        return [item]

    dropped = {c for item in drop for c in expand(item)}
    out: dict[str, str] = {}
    for item in spec or df.columns:
        new_old = [item] if isinstance(item, tuple) else [(c, c) for c in expand(item)]
        for new, old in new_old:
            old = expand(old)[0]
            if old not in dropped and new not in out:
                out[new] = old
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in out.items()])


def relocate(df: DataFrame, columns: Sequence[str], before: str | None = None, after: str | None = None) -> DataFrame:
    """Move columns in front of or behind another one (to the front by default)."""
    rest = [c for c in df.columns if c not in columns]
    at = rest.index(after) + 1 if after else rest.index(before) if before else 0
    return df.select(*[F.col(f"`{c}`") for c in rest[:at] + list(columns) + rest[at:]])


def snake_names(names: Sequence[str]) -> list[str]:
    """Names as snake_case, made unique by a running number."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        text = name.strip().replace("%", "_percent_").replace("#", "_number_").replace("'", "")
        text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
        text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
        text = re.sub(r"[^0-9a-zA-Z]+", "_", text).strip("_").lower() or "x"
        if text[0].isdigit():
            text = "x" + text
        seen[text] = seen.get(text, 0) + 1
        out.append(text if seen[text] == 1 else f"{text}_{seen[text]}")
    return out


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*snake_names(df.columns))


def across(df: DataFrame, pick: Callable[[str], bool], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply one expression to every column whose name is picked."""
    return df.select(*[fn(F.col(f"`{c}`")).alias(c) if pick(c) else F.col(f"`{c}`") for c in df.columns])


def template_columns(df: DataFrame, constants: Mapping[str, object], order: Sequence[str] | None = None) -> DataFrame:
    """Add constant or computed columns and put all into a fixed order."""
    added = {n: v if isinstance(v, Column) else F.lit(v) for n, v in constants.items()}
    out = df.withColumns(added)
    return out.select(*[F.col(f"`{c}`") for c in order]) if order else out
