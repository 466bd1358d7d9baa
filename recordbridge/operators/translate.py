"""Crosswalks: legacy ids to target ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import recode_literal
from .joins import ns_join


def rule_matrix_filter(df: DataFrame, rules: Mapping[str, Sequence[str]], type_col: str, code_col: str) -> DataFrame:
    """Keep rows whose code is allowed for their type.

    The rules are literals of the plan, so the test is one pass over the rows
    without a join and can reach the file scan.
    """
    keep = F.lit(False)
    for kind, codes in rules.items():
        keep = keep | ((F.col(type_col) == kind) & F.col(code_col).isin(*codes))
    return df.where(keep)


def recode_lookup(df: DataFrame, lookups: Mapping[str, DataFrame], label: str = "Value", code: str = "ReferenceNo") -> DataFrame:
    """Replace each listed column by the code of its value in that column's lookup table."""
    order = df.columns
    for column, lookup in lookups.items():
        side = lookup.select(F.col(label).alias("__label"), F.col(code).alias("__code"))
        joined = ns_join(df, side, [(column, "__label")], "left")
        df = joined.withColumn(column, F.col("__code")).drop("__code")
    return df.select(*order)


def with_parent(provider: DataFrame, id_col="provider_id", name_col="name", parent_col="hud_organization_id", active_col: str | None = "active",
                out=("ProjectID", "ProjectName", "AgencyID", "AgencyName")) -> DataFrame:
    """Each (active) child with the name of its parent from the same table."""
    child_id, child_name, parent_id, parent_name = out
    child = provider.where(F.col(active_col) == F.lit(True)) if active_col else provider
    child = child.select(
        F.col(id_col).alias(child_id), F.col(name_col).alias(child_name), F.col(parent_col).alias(parent_id)
    )
    parent = provider.select(F.col(id_col).alias(parent_id), F.col(name_col).alias(parent_name))
    return ns_join(child, parent, [parent_id], "left")


def build_projects(
    provider: DataFrame,
    moves: DataFrame,
    name_overrides: Mapping[int, str],
    agency_overrides: Mapping[int, str],
) -> DataFrame:
    """Projects with agency, after corrections to parents, project names and agency names."""
    moved = ns_join(provider, moves.select("Legacy_ProgramID", "correct_Legacy_AgencyID"), [("provider_id", "Legacy_ProgramID")], "left")
    patched = moved.withColumns({
        "name": override(F.col("provider_id"), name_overrides, F.col("name")),
        "hud_organization_id": F.coalesce("correct_Legacy_AgencyID", "hud_organization_id"),
    })
    child = patched.where(F.col("active") == F.lit(True)).select(
        F.col("provider_id").alias("Legacy_ProgramID"),
        F.col("name").alias("Legacy_ProgramName"),
        F.col("hud_organization_id").alias("Legacy_AgencyID"),
    )
    parent = provider.select(F.col("provider_id").alias("Legacy_AgencyID"), F.col("name").alias("Legacy_AgencyName"))
    out = ns_join(child, parent, ["Legacy_AgencyID"], "left")
    named = override(F.col("Legacy_AgencyID"), agency_overrides, F.col("Legacy_AgencyName"))
    return out.select("Legacy_ProgramID", "Legacy_ProgramName", "Legacy_AgencyID", named.alias("Legacy_AgencyName"))


def override(key: Column, fixed: Mapping, otherwise: Column) -> Column:
    """Value listed for the key, else the given one."""
    return F.coalesce(recode_literal(key, fixed), otherwise) if fixed else otherwise


def build_crosswalk(projects: DataFrame, in_scope: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Projects in scope with their target ids by name, and those without a target.

    ``in_scope`` rows that match no project stay, with null agency columns.
    """
    scoped = ns_join(
        projects, in_scope.select("Legacy_ProgramID", "Legacy_ProgramName"),
        ["Legacy_ProgramID", "Legacy_ProgramName"], "right",
    )
    crosswalk = ns_join(scoped, target, [("Legacy_ProgramName", "Target_ProgramName")], "left").withColumn(
        "Target_ProgramName", F.col("Legacy_ProgramName")
    )
    front = ["Legacy_AgencyID", "Legacy_AgencyName", "Legacy_ProgramID", "Legacy_ProgramName"]
    crosswalk = crosswalk.select(*front, *[c for c in crosswalk.columns if c not in front])
    return crosswalk, crosswalk.where(F.col("Target_ProgramID").isNull())


def extend_crosswalk(current: DataFrame, additions: DataFrame, final: DataFrame, on: Sequence[str], started: str = "OperatingStart") -> DataFrame:
    """Append new rows once each and flag the rows that have data in the final extract."""
    grown = current.unionByName(additions.distinct())
    flagged = ns_join(grown, final.select(*on, started), list(on), "left")
    return flagged.withColumn("GettingData", F.when(F.col(started).isNull(), "No").otherwise("Yes")).drop(started)


def agency_fallback(
    legacy_program: Column, agency: Column, overrides: Mapping[int, int], default: Column | int | None = None
) -> Column:
    """Fixed agency for listed programs, else the crosswalk's, else a default."""
    chosen = override(legacy_program, overrides, agency)
    if default is None:
        return chosen
    return F.coalesce(chosen, default if isinstance(default, Column) else F.lit(default))
