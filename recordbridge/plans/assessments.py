"""Assessment rows from attribute/value answers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import recode_literal, yes_no
from ..functions.dates import as_day_text, date_or_fallback, parse_dt
from ..functions.nulls import not_in
from ..operators.groups import latest, surrogate_id
from ..operators.joins import lookup_join, ns_join, semi_restrict
from ..operators.reshape import latest_pivot, union_sparse
from ..operators.shape import across
from ..operators.translate import agency_fallback
from . import fixed

KEY_COLUMNS = ("AssessmentID", "AssessmentName", "PersonalID", "AgencyID", "InformationDate")


def _kind(kind: str) -> tuple[Column, Column]:
    number, name = fixed.ASSESSMENTS[kind]
    return F.lit(number).alias("AssessmentID"), F.lit(name).alias("AssessmentName")


def covid_screening(
    answers: DataFrame,
    clients: DataFrame,
    crosswalk: DataFrame,
    questions: Mapping[str, str] = fixed.SCREENING_QUESTIONS,
    yes_no_columns: Sequence[str] = fixed.SCREENING_YES_NO,
    yes_no_prefixes: Sequence[str] = fixed.SCREENING_YES_NO_PREFIXES,
    numbered: bool = True,
    date_question: str = "COHCOV19ASSESSMENTDATE",
) -> DataFrame:
    """One row per client, day, provider and user, from the answers given at the latest
    moment of that day; answers to other questions given earlier the same day are lost,
    as in the source system's export. The answer to ``date_question`` is the assessment
    date, null where it is missing or unreadable.

    ``answers``: client_id, question_code, val, date_effective, provider_id, user_id,
    active. ``clients``: client_id. ``crosswalk``: Legacy_ProgramID, Target_AgencyID.
    """
    asked = answers.where(F.col("active") & F.col("question_code").isin(*questions, date_question))
    asked = semi_restrict(asked, clients, "client_id", nulls_match=False)
    ids = ["client_id", "InformationDate", "provider_id", "user_id"]
    wide = latest_pivot(
        asked.withColumn("InformationDate", as_day_text(F.col("date_effective"))),
        ids, ["date_effective"], "question_code", "val", {**questions, date_question: "__asked"}, per_attribute=False,
    )
    agencies = crosswalk.select("Legacy_ProgramID", "Target_AgencyID")
    placed = lookup_join(wide, agencies, [("provider_id", "Legacy_ProgramID")])
    out = placed.select(
        *_kind("screening"),
        F.col("client_id").alias("PersonalID"),
        agency_fallback(F.col("provider_id"), F.col("Target_AgencyID"), {}, fixed.DEFAULT_AGENCY).alias("AgencyID"),
        "InformationDate",
        as_day_text(parse_dt(F.col("__asked"))).alias("assessment_date"),
        F.col("user_id").alias("UserID"),
        *[F.col("__asked" if q == date_question else name).alias(name) for q, name in questions.items()],
    )
    flagged = across(out, lambda c: c in yes_no_columns or c.startswith(tuple(yes_no_prefixes)), yes_no)
    if "c_covid19_test_results" in flagged.columns:
        coded = recode_literal(F.col("c_covid19_test_results"), fixed.TEST_RESULTS)
        flagged = flagged.withColumn("c_covid19_test_results", coded)
    if not numbered:
        return flagged
    return surrogate_id(flagged, ["PersonalID", "InformationDate", "AgencyID", "UserID"], "AssessmentCustomID")


class SubKind(NamedTuple):
    """Which sub-records belong to a kind, and which of their answers become which columns."""

    names: tuple[str, ...]
    newest: Mapping[str, str] = {}  # question: column with the answer added last
    every: Mapping[str, str] = {}  # question: column with a list of all different answers
    last_ones: Mapping[str, str] = {}  # question: column with a list of the answers added last, as structs
    by_creator: bool = True  # answers of different users or providers stay apart


def subrecords(recordsets: DataFrame, answers: DataFrame, clients: DataFrame, kinds: Mapping[str, SubKind]) -> DataFrame:
    """Sub-records of several kinds with their answers as columns, in one pass over the answers.

    Both tables are read once for all kinds: an answer is kept if its question is one of its
    sub-record's kind, and one aggregate fills the columns of all kinds, each from its own rows.
    Ranking and aggregate work on the partitions of the join by sub-record. ``kind`` tells the rows
    apart; columns of other kinds are null. A sub-record without answers is kept.
    """
    kind_of = {name: kind for kind, k in kinds.items() for name in k.names}
    questions = {kind: [*k.newest, *k.every, *k.last_ones] for kind, k in kinds.items()}
    subs = recordsets.where(F.col("active") & F.col("question").isin(*kind_of)).select(
        "recordset_id", "client_id", "date_effective", F.col("date_added").alias("sub_date_added"),
        F.col("question").alias("subassessment_name"), recode_literal(F.col("question"), kind_of).alias("kind"),
        F.col("provider_creating_id").alias("sub_provider_created"), F.col("user_creating_id").alias("sub_user_created"),
    )
    subs = semi_restrict(subs, clients, "client_id", nulls_match=False)
    given = answers.where(F.col("active") & F.col("question").isin(*{q for own in questions.values() for q in own})).select(
        F.col("recordset_id").alias("__of"), F.col("question").alias("__question"), F.col("val").alias("__val"), F.col("date_added").alias("__added"),
        F.col("provider_creating_id").alias("answer_provider_created"), F.col("user_creating_id").alias("answer_user_created"),
    )
    asked = reduce(or_, [(F.col("__kind") == kind) & F.col("__question").isin(*own) for kind, own in questions.items()])
    whose = subs.select(F.col("recordset_id").alias("__sub"), F.col("kind").alias("__kind")).distinct()
    given = given.join(whose, F.col("__of") == F.col("__sub")).where(asked)
    added_last = Window.partitionBy("__of", "__kind", "__question").orderBy(F.col("__added").desc_nulls_last())
    given = given.withColumn("__i", F.rank().over(added_last))
    apart = F.col("__kind").isin(*[kind for kind, k in kinds.items() if k.by_creator])
    given = given.withColumns({c: F.when(apart, F.col(c)) for c in ("answer_provider_created", "answer_user_created")})

    def cells(part: str) -> dict[str, Column]:
        """For each column of a part, the rows that fill it."""
        found: dict[str, Column] = {}
        for kind, k in kinds.items():
            for question, column in getattr(k, part).items():
                here = (F.col("__kind") == kind) & (F.col("__question") == question)
                found[column] = found[column] | here if column in found else here
        return found

    newest, value = F.col("__i") == 1, F.col("__val")
    # Whoever gave only answers that were replaced later makes no row.
    used = reduce(or_, cells("every").values(), newest)
    wide = given.where(used).groupBy("__of", "__kind", "answer_provider_created", "answer_user_created").agg(
        *[F.max(F.when(newest & here, value)).alias(c) for c, here in cells("newest").items()],
        *[F.collect_set(F.when(here, value)).alias(c) for c, here in cells("every").items()],
        *[F.collect_list(F.when(newest & here, F.struct(value.alias("val")))).alias(c) for c, here in cells("last_ones").items()],
    )
    same = (F.col("recordset_id") == F.col("__of")) & (F.col("kind") == F.col("__kind"))
    return subs.join(wide, same, "left").drop("__of", "__kind")


DOSES, OFFERS, SCORES = "doses", "offers", "scores"


def dose_kind(name: str = fixed.DOSE_KIND, questions: Mapping[str, str] = fixed.DOSE_QUESTIONS) -> SubKind:
    return SubKind((name,), questions)


def offer_kind(name: str = fixed.OFFER_KIND, questions: Mapping[str, str] = fixed.OFFER_QUESTIONS) -> SubKind:
    return SubKind((name,), questions)


def score_kind(names: Iterable[str] = fixed.SCORE_KINDS, score_question: str = fixed.SCORE_QUESTION, start_question: str = fixed.SCORE_START_QUESTION) -> SubKind:
    return SubKind(tuple(names), every={start_question: "__starts"}, last_ones={score_question: "__totals"}, by_creator=False)


def provider_agencies(providers: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Target agencies by legacy provider, through the provider's organisation."""
    agencies = crosswalk.select("Legacy_AgencyID", "Target_AgencyID").distinct()
    own = providers.select(F.col("provider_id").alias("Legacy_ProgramID"), "hud_organization_id")
    joined = ns_join(own, agencies, [("hud_organization_id", "Legacy_AgencyID")], "left")
    return joined.select("Legacy_ProgramID", "Target_AgencyID")


def _with_agency(rows: DataFrame, providers: DataFrame, crosswalk: DataFrame) -> DataFrame:
    return lookup_join(rows, provider_agencies(providers, crosswalk), [("sub_provider_created", "Legacy_ProgramID")])


def _number(df: DataFrame, order: Sequence[str], numbered: bool) -> DataFrame:
    return surrogate_id(df, order, "AssessmentCustomID") if numbered else df


def doses_of(rows: DataFrame, providers: DataFrame, crosswalk: DataFrame, numbered: bool = True) -> DataFrame:
    """The doses among ``subrecords``."""
    rows = _with_agency(rows.where(F.col("kind") == DOSES), providers, crosswalk)
    agency = agency_fallback(F.col("sub_provider_created"), F.col("Target_AgencyID"), fixed.DOSE_AGENCY_OVERRIDES)
    out = rows.select(
        "recordset_id",
        *_kind("doses"),
        F.col("client_id").alias("PersonalID"),
        agency.alias("AgencyID"),
        as_day_text(F.col("date_effective")).alias("InformationDate"),
        F.col("c_covid19_date_vaccine_administered").alias("assessment_date"),
        "c_covid19_client_contact_info",
        recode_literal(F.col("c_covid19_vaccine_manufacturer"), fixed.VACCINE_MAKERS).alias("c_covid19_vaccine_manufacturer"),
        recode_literal(F.col("c_covid19_vaccine_documentation"), fixed.VACCINE_PROOF).alias("c_covid19_vaccine_documentation"),
    )
    order = ["PersonalID", "InformationDate", "recordset_id", *out.columns[6:]]
    return _number(out, order, numbered).drop("recordset_id")


def vaccine_doses(
    recordsets: DataFrame, answers: DataFrame, clients: DataFrame, providers: DataFrame, crosswalk: DataFrame,
    kind: str = fixed.DOSE_KIND, questions: Mapping[str, str] = fixed.DOSE_QUESTIONS, numbered: bool = True,
) -> DataFrame:
    return doses_of(subrecords(recordsets, answers, clients, {DOSES: dose_kind(kind, questions)}), providers, crosswalk, numbered)


def offers_of(rows: DataFrame, providers: DataFrame, crosswalk: DataFrame, numbered: bool = True) -> DataFrame:
    """The offers among ``subrecords``; an offer date that does not parse is replaced by the information date."""
    rows = _with_agency(rows.where(F.col("kind") == OFFERS), providers, crosswalk)
    out = rows.select(
        "recordset_id",
        *_kind("offers"),
        F.col("client_id").alias("PersonalID"),
        F.coalesce("Target_AgencyID", F.lit(fixed.DEFAULT_AGENCY)).alias("AgencyID"),
        as_day_text(F.col("date_effective")).alias("InformationDate"),
        as_day_text(date_or_fallback(F.col("offer_date"), F.col("date_effective"))).alias("assessment_date"),
        recode_literal(F.col("c_offer_type"), fixed.OFFER_TYPES).alias("c_offer_type"),
        recode_literal(F.col("c_offer_accepted"), fixed.OFFER_ACCEPTED).alias("c_offer_accepted"),
        as_day_text(parse_dt(F.col("c_offer_accept_decline_date"))).alias("c_offer_accept_decline_date"),
    )
    order = ["PersonalID", "InformationDate", "recordset_id", *out.columns[6:]]
    return _number(out, order, numbered).drop("recordset_id")


def housing_offers(
    recordsets: DataFrame, answers: DataFrame, clients: DataFrame, providers: DataFrame, crosswalk: DataFrame,
    kind: str = fixed.OFFER_KIND, questions: Mapping[str, str] = fixed.OFFER_QUESTIONS, numbered: bool = True,
) -> DataFrame:
    return offers_of(subrecords(recordsets, answers, clients, {OFFERS: offer_kind(kind, questions)}), providers, crosswalk, numbered)


def scores_of(rows: DataFrame, crosswalk: DataFrame, county_providers: DataFrame, kinds: Mapping[str, int] = fixed.SCORE_KINDS, numbered: bool = True) -> DataFrame:
    """The scores among ``subrecords``, dated by their own start-date answer.

    Per client, day and kind the sub-record added last counts, and of it the total
    answered last. Sub-records without a readable start date are left out.
    ``county_providers``: provider_id of those that get the county's agency.
    """
    days = F.array_distinct(F.transform("__starts", lambda x: as_day_text(parse_dt(x))))
    dated = rows.where(F.col("kind") == SCORES).select(
        "recordset_id", "client_id", "subassessment_name", "sub_date_added", F.col("sub_provider_created").alias("provider_id"), "__totals",
        F.explode(days).alias("InformationDate"),
    )
    dated = dated.where(F.col("InformationDate").isNotNull()).distinct()
    newest = latest(dated, ["client_id", "InformationDate", "subassessment_name"], "sub_date_added")
    scored = newest.select("*", F.explode("__totals").alias("__total")).withColumn("c_vispdat_score", F.col("__total.val")).drop("__totals", "__total")
    named = lookup_join(scored, crosswalk.select("Legacy_ProgramID", "Legacy_ProgramName"), [("provider_id", "Legacy_ProgramID")])
    county = county_providers.select("provider_id").distinct().withColumn("__county", F.lit(True))
    placed = lookup_join(named, county, "provider_id")
    out = placed.select(
        "recordset_id",
        *_kind("scores"),
        F.col("client_id").alias("PersonalID"),
        F.when(F.col("__county"), fixed.COUNTY_AGENCY).otherwise(fixed.DEFAULT_AGENCY).alias("AgencyID"),
        "InformationDate",
        F.col("InformationDate").alias("assessment_date"),
        F.lit(1).alias("assessment_type"),
        F.lit(2).alias("assessment_level"),
        F.lit(0).alias("assessment_location"),
        recode_literal(F.col("subassessment_name"), kinds).alias("c_vispdat_type"),
        F.col("Legacy_ProgramName").alias("c_vispdat_program_name"),
        "c_vispdat_score",
    )
    order = ["PersonalID", "InformationDate", "recordset_id", "c_vispdat_score"]
    return _number(out, order, numbered).drop("recordset_id")


def vulnerability_scores(
    recordsets: DataFrame, answers: DataFrame, clients: DataFrame, crosswalk: DataFrame, county_providers: DataFrame,
    kinds: Mapping[str, int] = fixed.SCORE_KINDS, score_question: str = fixed.SCORE_QUESTION,
    start_question: str = fixed.SCORE_START_QUESTION, numbered: bool = True,
) -> DataFrame:
    rows = subrecords(recordsets, answers, clients, {SCORES: score_kind(kinds, score_question, start_question)})
    return scores_of(rows, crosswalk, county_providers, kinds, numbered)


def combined_assessments(
    *kinds: DataFrame, order: Sequence[str], dates: Sequence[str] = fixed.ASSESSMENT_DATES, skip_clients: Iterable[int] = (fixed.COMBINED_TEST_CLIENT,)
) -> DataFrame:
    """All assessment kinds in one wide, numbered table.

    The kinds are stacked: their assessment numbers differ, so no two rows of
    different kinds could ever be merged. ``dates`` hold text that becomes days, those
    that no kind has left out. Rows
    are numbered before the test person is taken out.
    """
    stacked = union_sparse(*[k.drop("AssessmentCustomID") for k in kinds])
    dated = stacked.withColumn(
        "assessment_date", F.coalesce(as_day_text(parse_dt(F.col("assessment_date"))), F.when(F.col("assessment_date").isNull(), F.col("InformationDate")))
    ).withColumns({c: as_day_text(parse_dt(F.col(c))) for c in dates if c in stacked.columns})
    return surrogate_id(dated, order, "AssessmentCustomID").where(not_in(F.col("PersonalID"), skip_clients))


def missing_columns(df: DataFrame, needed: Sequence[str] = (*KEY_COLUMNS, "assessment_date", "UserID")) -> list[str]:
    """Common columns that an assessment table lacks."""
    return [c for c in needed if c not in df.columns]


