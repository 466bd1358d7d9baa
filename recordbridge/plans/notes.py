"""Notes of five kinds in one table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_day_text, as_time_text, day
from ..functions.nulls import paste
from ..functions.text import squish_newlines
from ..operators.groups import count_by, surrogate_id
from ..operators.joins import lookup_join, semi_restrict
from ..operators.reshape import union_by_name
from ..operators.translate import agency_fallback
from . import fixed


def _note(df: DataFrame, clients: DataFrame, program: str, date: str, note: Column, title: Column,
          enrollment: Column | None = None, service: Column | None = None) -> DataFrame:
    rows = semi_restrict(df.where(F.col("active") & note.isNotNull()), clients, "client_id", nulls_match=False)
    blank = F.lit("")
    return rows.select(
        F.col("client_id").alias("PersonalID"),
        F.col(program).try_cast("long").alias("Legacy_ProgramID"),
        (blank if enrollment is None else enrollment.cast("string")).alias("EnrollmentID"),
        (blank if service is None else service.cast("string")).alias("ServicesID"),
        title.alias("Title"),
        as_day_text(F.col(date)).alias("Date"),
        squish_newlines(note).alias("Note"),
        as_time_text(F.col("date_added")).alias("DateCreated"),
        as_time_text(F.col("date_updated")).alias("DateUpdated"),
    )


def note_rows(
    clients: DataFrame, projects: DataFrame, *, client_notes: DataFrame | None = None, goals: DataFrame | None = None,
    services: DataFrame | None = None, needs: DataFrame | None = None, exits: DataFrame | None = None, cutoff: str = "2014-06-01",
) -> DataFrame:
    """The given note sources in one schema, without agencies."""
    parts = []
    if client_notes is not None:
        parts.append(_note(client_notes, clients, "provider_creating_id", "note_date", F.col("note"), F.lit("imported from Client")))
    if exits is not None:
        ended = exits.where(F.col("exit_date") >= day(cutoff))
        named = lookup_join(ended, projects.select("Legacy_ProgramID", "Legacy_ProgramName"), [("provider_id", "Legacy_ProgramID")])
        title = paste(F.lit("Exit note: Exited"), F.col("Legacy_ProgramName"), F.lit("on"), as_time_text(F.col("exit_date")))
        parts.append(_note(named, clients, "provider_id", "exit_date", F.col("notes"), title, enrollment=F.col("entry_exit_id")))
    if goals is not None:
        parts.append(_note(goals, clients, "provider_id", "note_date", F.col("note"), F.lit("imported from Goals")))
    if needs is not None:
        noted = needs.where(F.col("note").isNotNull())
        text = paste(
            F.lit("Note:"), F.col("note"), F.lit("\rStatus:"), F.col("status"),
            F.lit("\rOutcome:"), F.col("outcome"), F.lit("\rReason Unmet:"), F.col("reason_unmet"),
        )
        parts.append(_note(noted, clients, "provider_id", "date_set", text, F.lit("imported from ServicePoint Need")))
    if services is not None:
        parts.append(_note(services, clients, "provide_provider_id", "provide_start_date", F.col("service_note"),
                           F.lit("imported from ServicePoint Service"), service=F.col("need_service_id")))
    return union_by_name(*parts)


def with_agency(notes: DataFrame, crosswalk: DataFrame, overrides: Mapping[int, int] = fixed.NOTE_AGENCY_OVERRIDES) -> DataFrame:
    """Notes with the corrected agency."""
    placed = lookup_join(notes, crosswalk.select("Legacy_ProgramID", "Target_AgencyID"), "Legacy_ProgramID")
    agency = agency_fallback(F.col("Legacy_ProgramID"), F.col("Target_AgencyID"), overrides)
    return placed.withColumn("AgencyID", agency).drop("Target_AgencyID")


def all_notes(notes: DataFrame, crosswalk: DataFrame, overrides: Mapping[int, int] = fixed.NOTE_AGENCY_OVERRIDES, numbered: bool = True) -> DataFrame:
    """Notes that have an agency, numbered, in import form."""
    out = with_agency(notes, crosswalk, overrides).where(F.col("AgencyID").isNotNull()).select(
        "PersonalID", "AgencyID", "EnrollmentID", "ServicesID", "Title", "Date", "Note", "DateCreated", "DateUpdated",
    )
    if not numbered:
        return out
    order = ["PersonalID", "Date", "Title", "EnrollmentID", "ServicesID", "DateCreated", "Note", "AgencyID"]
    return surrogate_id(out, order, "NoteID")


def notes_missing_agency(notes: DataFrame, crosswalk: DataFrame, providers: DataFrame, overrides: Mapping[int, int] = fixed.NOTE_AGENCY_OVERRIDES) -> DataFrame:
    """Programs whose notes have no agency, with the number of notes and the name."""
    lost = with_agency(notes, crosswalk, overrides).where(F.col("AgencyID").isNull())
    return lookup_join(count_by(lost, ["Legacy_ProgramID"]), providers.select("provider_id", "name"), [("Legacy_ProgramID", "provider_id")])
