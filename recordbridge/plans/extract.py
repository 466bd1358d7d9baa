"""Repairs to the standard extract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import MOVE_IN_COLLECTED_FROM, as_of_exit, day
from ..operators.groups import group_profile
from ..operators.joins import lookup_join, ns_join
from ..operators.shape import relocate


def hud_names(project: DataFrame, organization: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Projects and organisations with the names of a lookup (ProjectID, ProjectName, ProjectAKA)."""
    side = names.select("ProjectID", F.col("ProjectName").alias("__name"), F.col("ProjectAKA").alias("__aka"))
    renamed = lookup_join(project, side, "ProjectID")
    projects = renamed.withColumns({"ProjectName": F.col("__name"), "ProjectCommonName": F.col("__aka")}).select(*project.columns)
    labelled = lookup_join(organization, side, [("OrganizationID", "ProjectID")])
    return projects, labelled.withColumn("OrganizationName", F.col("__name")).select(*organization.columns)


def household_move_in(enrollment: DataFrame, exits: DataFrame, project: DataFrame, as_of: Column,
                      collected_from: str = MOVE_IN_COLLECTED_FROM) -> DataFrame:
    """Enrolments with a validated move-in date.

    A member's date counts if its project type says so (see below); the household's
    earliest valid date is given to every member, moved up to the member's own entry,
    and dropped where it lies after the exit. Types 3 and 9: assumed on entry before
    the start of collection, else on or after entry and before exit. Type 13: from
    entry to exit, both included.
    """
    spans = lookup_join(enrollment, exits.select("EnrollmentID", "ExitDate"), "EnrollmentID")
    spans = spans.withColumn("ExitAdjust", as_of_exit(F.col("ExitDate"), as_of.cast(exits.schema["ExitDate"].dataType)))
    typed = lookup_join(
        spans.select("HouseholdID", "ProjectID", "EntryDate", "MoveInDate", "ExitAdjust"),
        project.select("ProjectID", "ProjectType"), "ProjectID",
    )
    entry, moved, left, kind = (F.col(c) for c in ("EntryDate", "MoveInDate", "ExitAdjust", "ProjectType"))
    supportive = kind.isin(3, 9)
    assumed = supportive & (entry < day(collected_from))
    valid = (
        F.when(assumed, entry)
        .when(supportive & (entry <= moved) & (moved < left), moved)
        .when((kind == 13) & (entry <= moved) & (moved <= left), moved)
    )
    household = group_profile(typed.where(kind.isin(3, 9, 13)), ["HouseholdID"], {"HHMoveIn": F.min(valid)})
    joined = ns_join(spans, household, "HouseholdID", "left")
    shared = F.col("HHMoveIn")
    joined = joined.withColumn("MoveInDate", F.when(shared <= left, F.greatest(shared, entry)))
    out = joined.drop("ExitDate", "ExitAdjust", "HHMoveIn")
    if "DateOfEngagement" in out.columns:
        out = relocate(out, ["MoveInDate"], after="DateOfEngagement")
    return out
