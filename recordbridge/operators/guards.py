"""Checks that run inside the work they guard, and stop it before its result is used."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import materialise
from ..sources.readers import literal_table
from .joins import Keys, key_pairs, ns_join


class CheckFailed(ValueError):
    """Rows that break a rule: ``failing`` has their number by check."""

    def __init__(self, label: str, failing: Mapping[str, int]):
        super().__init__(f"{label}: " + ", ".join(f"{n} ({k} rows)" for n, k in failing.items()))
        self.failing = dict(failing)


def checked_write(df: DataFrame, label: str, bad: Mapping[str, Column], stop: bool = True) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` to the shared folder and count the rows marked ``bad`` in the same pass.

    Returns the stored table and the checks as rows (name, ok, failing). With ``stop``, a check
    that fails raises ``CheckFailed``, so nothing behind it reads the table. The counts are kept
    by the tasks that write, and those of repeated tasks count once; nothing is scanned again.
    """
    names = list(bad)
    seen = Observation(f"{label}-{uuid.uuid4().hex}")
    counted = df.observe(seen, F.count(F.lit(1)).alias("__rows"), *[F.count_if(c).alias(f"__{i}") for i, c in enumerate(bad.values())])
    stored = materialise(counted, label)
    failing = {n: int(seen.get.get(f"__{i}") or 0) for i, n in enumerate(names)}
    if stop and any(failing.values()):
        raise CheckFailed(label, {n: k for n, k in failing.items() if k})
    report = literal_table(df.sparkSession, [(n, int(k == 0), k) for n, k in failing.items()], "name string, ok int, failing long")
    return stored, report


def one_row_a_key(right: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """``right``, and the error that a key occurs more than once, as part of the plan.

    Rows are grouped by the keys, which a join on them needs anyway; equal rows count too. The error
    names the first such key it meets and stops whatever job would use the rows.
    """
    rest = [c for c in right.columns if c not in keys]
    grouped = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.any_value(F.col(c)).alias(c) for c in rest])
    said = F.concat(F.lit(f"{label}: key occurs more than once: "), F.to_json(F.struct(*keys)))
    first = keys[0]
    sound = F.when(F.col("__n") > 1, F.raise_error(said).cast(right.schema[first].dataType)).otherwise(F.col(first))
    return grouped.select(*[sound.alias(c) if c == first else F.col(c) for c in right.columns])


def guarded_join(left: DataFrame, right: DataFrame, on: Keys, how: str = "left", label: str = "lookup") -> DataFrame:
    """``ns_join`` to a table that must have one row a key: the join keeps the rows of ``left`` or stops the job."""
    return ns_join(left, one_row_a_key(right, [rk for _, rk in key_pairs(on)], label), on, how)
