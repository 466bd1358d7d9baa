"""Client-level attributes, files and county answers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import recode_literal
from ..functions.dates import as_day_text, as_time_text, day, excel_date, parse_dt, stamp_export_id
from ..functions.nulls import strict_agg, tri_if
from ..operators.groups import latest, surrogate_id
from ..operators.joins import lookup_join, semi_restrict
from ..operators.reshape import latest_pivot, union_by_name
from ..operators.translate import agency_fallback
from . import fixed


def client_custom(
    answers: DataFrame, clients: DataFrame, as_of: Column,
    questions: Mapping[str, str] = fixed.CLIENT_QUESTIONS,
    dates: Sequence[str] = fixed.CLIENT_DATES,
    answer_lists: Mapping[str, Mapping[str, int]] = fixed.ANSWER_LISTS,
    numbered: bool = True,
) -> DataFrame:
    """Latest answer to each client-level question, by effective then by entry date,
    as one row per client, with list answers as codes."""
    asked = answers.where(F.col("active") & F.col("question_code").isin(*questions))
    asked = semi_restrict(asked, clients, "client_id", nulls_match=False)
    wide = latest_pivot(asked, ["client_id"], ["date_effective", "date_added"], "question_code", "val", questions)
    days = {c: as_day_text(parse_dt(F.col(c))) for c in dates}
    codes = {c: recode_literal(F.col(c), codes) for c, codes in answer_lists.items()}
    out = wide.withColumns(days | codes).select(
        F.col("client_id").alias("PersonalID"), stamp_export_id(as_of).alias("ExportID"), *questions.values()
    )
    return surrogate_id(out, ["PersonalID"], "ClientCustomID", unique=True) if numbered else out


def stray_answers(
    strays: DataFrame, cohort: DataFrame, clients: DataFrame, answers: DataFrame, questions: Sequence[str],
    opened: str = "2021-05-07", closed: str = "2021-06-01",
) -> DataFrame:
    """Why cohort clients are unexpectedly present: created after the window opened, or
    answered wholly before it closed or after it opened.

    ``strays``: client_id. A client without answers has null answer columns.
    """
    why = strays.select("client_id").intersect(cohort.select("client_id"))
    created = lookup_join(why, clients.select("client_id", "date_added"), "client_id").withColumn(
        "created_why", F.when(F.col("date_added") >= day(opened), "client created after file created")
    )
    asked = semi_restrict(answers.where(F.col("active") & F.col("question_code").isin(*questions)), why, "client_id")
    newest = latest(asked, ["client_id", "question_code"], ["date_effective", "date_added"])
    span = newest.groupBy("client_id").agg(
        strict_agg(F.max, F.col("date_added")).alias("max_added"), strict_agg(F.min, F.col("date_added")).alias("min_added")
    )
    outside = (F.col("max_added") < day(closed)) | (F.col("min_added") >= day(opened))
    span = span.withColumn("answer_why", tri_if(outside, "answers added before or after window", "don't know"))
    return lookup_join(created, span, "client_id")


def client_files(
    attachments: DataFrame, clients: DataFrame, crosswalk: DataFrame, as_of: Column,
    overrides: Mapping[int, int] = fixed.FILE_AGENCY_OVERRIDES, cutoff: str = "2014-06-01",
) -> DataFrame:
    """File attachments, each for its lowest client id, with the target agency."""
    recent = attachments.where(F.col("active") & (F.col("date_added") >= day(cutoff)))
    recent = semi_restrict(recent, clients, "client_id", nulls_match=False)
    owned = latest(recent, ["server_filename"], "client_id", ascending=True)
    placed = lookup_join(owned, crosswalk.select("Legacy_ProgramID", "Target_AgencyID"), [("provider_creating_id", "Legacy_ProgramID")])
    agency = agency_fallback(F.col("provider_creating_id"), F.col("Target_AgencyID"), overrides)
    return placed.select(
        F.col("server_filename").alias("FileID"),
        F.col("client_id").alias("PersonalID"),
        agency.alias("AgencyID"),
        F.lit(fixed.IMPORT_CATEGORY).alias("Category"),
        F.lit("Other").alias("FileName"),
        F.col("file_name").alias("OtherName"),
        as_time_text(F.col("date_created")).alias("DateCreated"),
        as_time_text(F.col("date_updated")).alias("DateUpdated"),
        F.col("user_creating_id").alias("UserID"),
        stamp_export_id(as_of).alias("ExportID"),
    ).where(F.col("AgencyID").isNotNull())


def enrollment_counties(
    at_entry: DataFrame, at_exit: DataFrame, counties: DataFrame, as_of: Column, order: Sequence[str] = ("EnrollmentID", "DataCollectionStage"),
    outside: str = fixed.OUTSIDE_STATE, numbered: bool = True,
) -> DataFrame:
    """County served and prior county as codes, entry and exit answers stacked.

    ``counties``: County, Geocode. A county outside the state is "0", an unknown one null.
    """
    stacked = union_by_name(at_entry, at_exit)
    if dict(stacked.dtypes)["InformationDate"] in ("int", "bigint", "double"):
        stacked = stacked.withColumn("InformationDate", excel_date(F.col("InformationDate")))
    for source, target in (("CountyPrior", "c_county_prior"), ("CountyServed", "c_county_served")):
        side = counties.select(F.col("County").alias("__county"), F.col("Geocode").cast("string").alias("__code"))
        stacked = lookup_join(stacked, side, [(source, "__county")])
        stacked = stacked.withColumn(target, tri_if(F.col(source) == outside, F.lit("0"), F.col("__code"))).drop("__code")
    out = stacked.select(
        "PersonalID", "EnrollmentID", as_day_text(F.col("InformationDate")).alias("InformationDate"),
        "DataCollectionStage", stamp_export_id(as_of).alias("ExportID"), "c_county_served", "c_county_prior",
    )
    return surrogate_id(out, order, "EnrollmentCustomID") if numbered else out
