"""Services with their enrolment, target item and funding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import normalise_labels
from ..functions.dates import as_day_text, as_time_text, day
from ..functions.text import contains_any
from ..operators.groups import count_by, distinct_keep_first, surrogate_id
from ..operators.guards import guarded_join
from ..operators.joins import interval_join, ns_join, semi_restrict
from ..operators.translate import rule_matrix_filter
from . import fixed


def service_items(items: DataFrame, spellings: Mapping[str, Sequence[str]] = fixed.ITEM_SPELLINGS) -> DataFrame:
    """Target items with one spelling per name, those without ids left out."""
    named = items.withColumn("ServiceItemName", normalise_labels(F.col("ServiceItemName"), spellings))
    return named.where(F.col("Target_ProgramID").isNotNull() & F.col("ServiceItemID").isNotNull())


def cohort_services(
    services: DataFrame, providers: DataFrame, clients: DataFrame, rules: Mapping[str, Sequence[str]] = fixed.SERVICE_RULES,
    empty: Sequence[str] = fixed.FEDERAL_SERVICE_COLUMNS, cutoff: str = "2014-06-01",
) -> DataFrame:
    """Active services of the cohort after (not on) the cut-off whose program type allows
    their code and that have no federal service type."""
    kept = services.where(F.col("active") & (F.col("provide_start_date") > day(cutoff)))
    for column in empty:
        kept = kept.where(F.col(column).isNull())
    codes = sorted({code for allowed in rules.values() for code in allowed})
    kept = kept.where(F.col("code").isin(*codes))
    kinds = providers.where(F.col("program_type_code").isin(*rules)).select("provider_id", "program_type_code")
    typed = ns_join(kept, kinds, [("provide_provider_id", "provider_id")], "inner", nulls_match=False)
    return semi_restrict(rule_matrix_filter(typed, rules, "program_type_code", "code"), clients, "client_id", nulls_match=False)


def connected_services(services: DataFrame, crosswalk: DataFrame, entries: DataFrame, as_of: Column) -> DataFrame:
    """Services joined to each enrolment of the same client and program that contains them."""
    prep = services.select(
        F.col("need_service_id").alias("ServicesID"),
        "need_service_group_id",
        F.col("client_id").alias("PersonalID"),
        F.col("provide_provider_id").alias("Legacy_ProgramID"),
        F.col("provide_start_date").alias("DateProvided"),
        F.col("date_added").alias("DateCreated"),
        F.col("date_updated").alias("DateUpdated"),
        F.col("user_creating_id").alias("UserID"),
        F.col("code").alias("sp_code"),
    )
    spans = entries.where(F.col("active")).select(
        F.col("entry_exit_id").alias("EnrollmentID"), "client_id", "provider_id", "entry_date", "exit_date"
    )
    inside = interval_join(
        prep, spans, [("PersonalID", "client_id"), ("Legacy_ProgramID", "provider_id")],
        "DateProvided", "entry_date", "exit_date", as_of,
    ).drop("entry_date", "exit_date")
    return guarded_join(inside, crosswalk, "Legacy_ProgramID", label="crosswalk")


def translated_services(connected: DataFrame, items: DataFrame, translator: DataFrame) -> DataFrame:
    """Services with the target item of the same program and translated name, each row once."""
    named = guarded_join(connected, translator, "sp_code", label="service translator")
    on = [("item_desc", "ServiceItemName"), "Target_ProgramName", "Target_ProgramID"]
    keep = items.select("Target_ProgramID", "Target_ProgramName", "ServiceItemName", "ServiceItemID")
    return ns_join(named, keep, on, "left").distinct()


def services_not_connecting(translated: DataFrame, integrated: Sequence[str] = fixed.INTEGRATED_PROGRAMS) -> DataFrame:
    """Services without an item, outside the programs whose services come another way."""
    lost = translated.where(F.col("ServiceItemID").isNull())
    return lost.where(~contains_any(F.col("Legacy_ProgramName"), integrated))


def services_not_coming(translated: DataFrame, integrated: Sequence[str] = fixed.INTEGRATED_PROGRAMS) -> DataFrame:
    """Services without an item, inside the programs whose services come another way."""
    lost = translated.where(F.col("ServiceItemID").isNull())
    return lost.where(contains_any(F.col("Legacy_ProgramName"), integrated))


def projects_not_done(translated: DataFrame, integrated: Sequence[str] = fixed.INTEGRATED_PROGRAMS) -> DataFrame:
    """Unconnected services counted by program and item, with whether that is expected."""
    lost = translated.where(F.col("ServiceItemID").isNull())
    counted = count_by(lost, ["Legacy_ProgramName", "sp_desc", "item_desc"])
    expected = contains_any(F.col("Legacy_ProgramName"), integrated)
    return counted.withColumn("ok", F.when(expected, "ok").otherwise("not ok"))


def fund_amounts(funds: DataFrame, cutoff: str = "2014-06-01") -> DataFrame:
    """Amount and source per service group."""
    return funds.where(
        F.col("active")
        & (F.col("date_added") >= day(cutoff))
        & (F.col("source") != fixed.FUND_SOURCE_SKIPPED)
        & F.col("last_action").isin(*fixed.FUND_ACTIONS)
    ).select("need_service_group_id", F.col("cost").alias("FAAmount"), "source")


def program_funds(funds: DataFrame) -> DataFrame:
    """Active target funds, the non-federal detail only where it applies."""
    other = F.col("FundingSourceID") == fixed.NON_FEDERAL_FUNDER
    return funds.where(F.col("Active") == "Yes").withColumns(
        {c: F.when(other, F.col(c)) for c in ("FundingOtherID", "FundingOther")}
    )


def funded_services(
    translated: DataFrame, amounts: DataFrame, changes: DataFrame, fund_codes: DataFrame, funds: DataFrame
) -> DataFrame:
    """Connected services with amount, corrected source and target fund.

    The amounts are those of a service's group, which its row carries; a group with several
    amounts gives a row for each, as in the source.
    ``changes``: Target_ProgramID, Target_ProgramName, source, NewSource.
    ``fund_codes``: source, funding_source, funding_source_other, FundingSource. Codes
    hold for the programs that have such a fund; others get neither code nor source text.
    """
    done = translated.where(F.col("ServiceItemID").isNotNull())
    paid = ns_join(done, amounts, "need_service_group_id", "left")
    changed = ns_join(paid, changes, ["Target_ProgramID", "Target_ProgramName", "source"], "left")
    changed = changed.withColumn("source", F.coalesce("NewSource", "source")).drop("NewSource")
    having = program_funds(funds).select("Target_ProgramID", "FundingSourceID", "FundingOtherID")
    codes = ns_join(fund_codes, having, [("funding_source", "FundingSourceID"), ("funding_source_other", "FundingOtherID")], "left").distinct()
    coded = ns_join(changed, codes, ["source", "Target_ProgramID"], "left")
    first = distinct_keep_first(
        program_funds(funds), ["FundingSourceID", "FundingOtherID", "Target_ProgramID"], ["TargetFundingSourceID"]
    ).select("Target_ProgramID", "FundingSourceID", "FundingOtherID", "TargetFundingSourceID", "FundingOther")
    return ns_join(
        coded, first,
        ["Target_ProgramID", ("funding_source", "FundingSourceID"), ("funding_source_other", "FundingOtherID")], "left",
    )


def custom_services(funded: DataFrame, numbered: bool = True) -> DataFrame:
    """Services in import form."""
    out = funded.select(
        F.col("ServicesID").alias("LegacyServicesID"),
        "PersonalID",
        F.col("Target_AgencyID").alias("AgencyID"),
        "EnrollmentID",
        "ServiceItemID",
        as_day_text(F.col("DateProvided")).alias("DateProvided"),
        F.col("TargetFundingSourceID").alias("FundingSourceID"),
        "FundingSource",
        "FundingOther",
        "FAAmount",
        as_time_text(F.col("DateCreated")).alias("DateCreated"),
        as_time_text(F.col("DateUpdated")).alias("DateUpdated"),
        "UserID",
    )
    if not numbered:
        return out.drop("LegacyServicesID")
    return surrogate_id(out, out.columns, "ServicesID").drop("LegacyServicesID")


def missing_funding(funded: DataFrame) -> DataFrame:
    """Services with a source but no target fund, counted by program and source."""
    lost = funded.where(F.col("source").isNotNull() & F.col("TargetFundingSourceID").isNull())
    return count_by(lost, ["Target_ProgramID", "Target_ProgramName", "source", "FundingSource"])
