"""Agency, site, funding, program, inventory, user and service tables for the import.

Column names are those of the import format; a dot in them becomes ``__`` here and is
put back by ``import_names`` when a table is written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import bed_flags, code_bucket, normalise_labels, recode_literal, threshold_by_type
from ..functions.dates import as_day_text, as_time_text, open_status
from ..functions.nulls import is_in, not_in, paste, tri_if
from ..functions.text import address_line, login_name, short_zip, squish_newlines, strip_suffix
from ..operators.groups import count_by, duplicate_groups, list_agg, nth_columns, surrogate_id
from ..operators.joins import anti_exclude, left_chain, lookup_join, ns_join, semi_restrict
from ..operators.reshape import separate, spread_numbered
from ..operators.shape import template_columns
from . import fixed

ADDRESS = ("Address1", "Address2", "City", "State", "ZIP")


def import_names(df: DataFrame) -> DataFrame:
    """Put the dots of the import format back into the column names."""
    return df.toDF(*[c.replace("__", ".") for c in df.columns])


def fixed_addresses(extras: DataFrame, fixes: Mapping[str, Mapping[str, str]] = fixed.ADDRESS_FIXES) -> DataFrame:
    """Provider addresses with the masked one replaced and ids in brackets cut off."""
    patched = {c: F.coalesce(recode_literal(F.col(c), m), F.col(c)) for c, m in fixes.items()}
    return extras.withColumns(patched | {"OrganizationName": strip_suffix(F.col("OrganizationName"), r"\(.*\)")})


def geocode_lookup(geocodes: DataFrame) -> DataFrame:
    """Geocodes by place name, and by county name without the word County."""
    counties = geocodes.where(F.col("Name").contains(" County")).select("Geocode", strip_suffix(F.col("Name"), " County").alias("Name"))
    return geocodes.select(F.col("Name").alias("Place"), F.lit(None).cast("string").alias("CountyName"), "Geocode").unionByName(
        counties.select(F.lit(None).cast("string").alias("Place"), F.col("Name").alias("CountyName"), "Geocode")
    )


def with_geocode(df: DataFrame, geocodes: DataFrame) -> DataFrame:
    """Geocode by city, where there is none by county."""
    lookup = geocode_lookup(geocodes)
    places = lookup.where(F.col("Place").isNotNull()).select(F.col("Place").alias("__name"), F.col("Geocode").alias("__city_code"))
    counties = lookup.where(F.col("CountyName").isNotNull()).select(F.col("CountyName").alias("__name"), F.col("Geocode").alias("__county_code"))
    joined = left_chain(df, (places, [("City", "__name")]), (counties, [("ProjectCounty", "__name")]))
    return joined.withColumn("geolocations__geocode", F.coalesce("__city_code", "__county_code")).drop("__city_code", "__county_code")


def agencies(
    organization: DataFrame, addresses: DataFrame, county_ids: DataFrame, geocodes: DataFrame, project: DataFrame, project_coc: DataFrame,
    areas: Sequence[str] = fixed.AREA_CODES,
) -> DataFrame:
    """Agency table. An agency in several areas gets the largest code; one in none keeps
    an empty area.

    ``county_ids``: ID, ProjectCounty. ``geocodes``: Geocode, Name.
    """
    base = organization.where(F.col("OrganizationName").isNotNull() & (F.col("OrganizationID") != 1)).select(
        F.col("OrganizationID").alias("id"), F.col("OrganizationName").alias("name"),
        F.col("VictimServicesProvider").alias("victim_service_provider"),
        F.col("DateCreated").alias("added_date"), F.col("DateUpdated").alias("last_updated"),
    )
    places = addresses.select("ProjectID", *ADDRESS, "ProjectCounty")
    counties = county_ids.select(F.col("ID").alias("__county"), strip_suffix(F.col("ProjectCounty"), " County").alias("ProjectCounty"))
    placed = left_chain(base, (places, [("id", "ProjectID")]), (counties, "ProjectCounty"))
    placed = with_geocode(placed, geocodes)
    away = F.col("id") == fixed.OUT_OF_STATE_AGENCY
    line = address_line(F.col("Address1"), F.col("Address2"), F.col("name"))
    placed = placed.select(
        "id", "name", "victim_service_provider", "added_date", "last_updated",
        line.alias("default_site_name"), line.alias("geolocations__address"),
        F.col("City").alias("geolocations__city"), F.col("State").alias("geolocations__state"),
        F.coalesce(F.col("__county"), F.when(away, 0)).alias("counties__id"),
        short_zip(F.col("ZIP")).alias("geolocations__zipcode"),
        F.coalesce("geolocations__geocode", F.when(away, fixed.OUT_OF_STATE_GEOCODE)).alias("geolocations__geocode"),
        F.col("name").alias("site__name"),
    )
    owners = project.select("ProjectID", F.col("OrganizationID").alias("id"))
    coc = ns_join(project_coc.where(F.col("CoCCode").isin(*areas)).select("ProjectID", "CoCCode"), owners, "ProjectID", "left")
    largest = coc.groupBy("id").agg(F.max("CoCCode").alias("coc"))
    constants = {
        "status": 1, "navigation_profiles__id": 1, "screens__name": 0, "home_screen": 1, "ref_looker_report_open_units": 0,
        "all_client_forms_enabled": 0, "department": 0, "clients": 2, "release_of_information": 1,
        "ref_coordinated_entry": 0, "ref_looker_report": 0, "send_referral_notifications": 1,
    }
    order = [
        "id", "name", "default_site_name", "geolocations__address", "geolocations__city", "geolocations__state", "counties__id",
        "geolocations__zipcode", "geolocations__geocode", "site__name", "coc", "status", "navigation_profiles__id", "screens__name",
        "home_screen", "ref_looker_report_open_units", "victim_service_provider", "all_client_forms_enabled", "added_date",
        "last_updated", "department", "clients", "release_of_information", "ref_coordinated_entry", "ref_looker_report",
        "send_referral_notifications",
    ]
    return template_columns(ns_join(placed, largest, "id", "left"), constants, order)


def missing_addresses(agency_table: DataFrame) -> DataFrame:
    return agency_table.where(F.col("geolocations__city").isNull())


def sites(
    agency_base: DataFrame, addresses: DataFrame, projects_orgs: DataFrame, geocodes: DataFrame, phones: DataFrame, as_of: Column
) -> DataFrame:
    """Addresses no agency uses, with the agency whose projects are there.

    ``agency_base``: id. ``phones``: ProjectID, ProjectTelPrimary, ProjectTelNo.
    """
    kept = [*ADDRESS, "ProjectCounty"]
    agency_addresses = ns_join(agency_base.select("id"), addresses.select("ProjectID", *ADDRESS), [("id", "ProjectID")], "left")
    free = anti_exclude(addresses.select(*kept).distinct(), agency_addresses, ADDRESS)
    at = ns_join(free, addresses.select("ProjectID", *ADDRESS), ADDRESS, "left")
    owned = ns_join(at, projects_orgs.select("ProjectID", "AgencyID", "AgencyName"), "ProjectID", "left")
    owned = owned.where(F.col("AgencyID").isNotNull() & F.col("City").isNotNull())
    owned = semi_restrict(owned, agency_base.select("id"), [("AgencyID", "id")]).drop("ProjectID").distinct()
    primary = phones.where(F.col("ProjectTelPrimary") == "Yes").select(
        F.col("ProjectID").try_cast("long").alias("__agency"), F.col("ProjectTelNo").alias("phone")
    )
    coded = ns_join(with_geocode(owned, geocodes), primary, [("AgencyID", "__agency")], "left")
    line = address_line(F.col("Address1"), F.col("Address2"), F.col("AgencyName"))
    now = as_time_text(as_of)
    out = coded.select(
        F.col("AgencyID").alias("ref_agency"),
        line.alias("name"), line.alias("geolocations__address"),
        F.col("City").alias("geolocations__city"), F.col("State").alias("geolocations__state"),
        short_zip(F.col("ZIP")).alias("geolocations__zipcode"),
        F.lit("").alias("ref_geography_type"), F.lit("").alias("location"), "phone",
        "geolocations__geocode",
        tri_if(F.col("ProjectCounty") != fixed.AREA_COUNTY, fixed.AREA_CODES[1], fixed.AREA_CODES[0]).alias("coc"),
        F.lit(1).alias("status"), as_day_text(as_of).alias("information_date"), now.alias("added_date"), now.alias("last_updated"),
    )
    order = ["ref_agency", "geolocations__zipcode", "geolocations__city", "name", "geolocations__geocode", "coc", "phone"]
    return surrogate_id(out, order, "id")


def shared_addresses(addresses: DataFrame) -> DataFrame:
    """Addresses that share ZIP and city with a different one, and the projects at each."""
    unique = addresses.select(*ADDRESS).distinct()
    repeated = duplicate_groups(unique, ["ZIP", "City"]).where(F.col("Address1").isNotNull())
    projects = ns_join(repeated.select(*ADDRESS), addresses.select("ProjectID", *ADDRESS), ADDRESS, "left")
    return list_agg(projects, list(ADDRESS), "ProjectID", "ProjectIDs", "ProjectCount")


def funder_number(other: Column, spellings=fixed.FUNDER_SPELLINGS, known: int | None = None) -> Column:
    numbers = {k: v for k, v in fixed.OTHER_FUNDERS.items() if known is None or v <= known}
    return recode_literal(normalise_labels(other, spellings), numbers)


def funding_sources(funder: DataFrame, specs: DataFrame, projects_orgs: DataFrame, as_of: Column) -> DataFrame:
    """Funding rows. ``specs``: DataElement, ReferenceNo, Description."""
    labels = specs.where(F.col("DataElement") == "FundingSource").select(
        F.expr("try_cast(ReferenceNo AS int)").alias("__no"), "Description"
    )
    joined = left_chain(
        funder, (labels, [("Funder", "__no")]), (projects_orgs.select("ProjectID", "ProjectName", "AgencyID"), "ProjectID")
    )
    return joined.select(
        F.col("FunderID").alias("id"),
        paste(F.col("ProjectName"), F.col("Description"), sep=": ").alias("name"),
        F.col("AgencyID").alias("ref_agency"),
        open_status(F.col("EndDate"), as_of).alias("status"),
        F.col("Funder").alias("funding_source"),
        funder_number(F.col("OtherFunder")).alias("funding_source_non_federal"),
        F.lit(0).alias("amount"),
        tri_if(F.col("GrantID") == "0", F.lit("N/A"), F.col("GrantID")).alias("grant_identifier"),
        F.col("StartDate").alias("start_date"), F.col("EndDate").alias("end_date"),
        F.col("DateCreated").alias("added_date"), F.col("DateUpdated").alias("last_updated"),
    )


def funder_bucket(project: Column, funder: Column, other: Column) -> Column:
    """Programme family of a funder row."""
    rules = [(project.isin(*[p for p, b in fixed.PROJECT_BUCKETS.items() if b == name]), name)
             for name in dict.fromkeys(fixed.PROJECT_BUCKETS.values())]
    rules += [(funder.isin(*numbers), name) for name, numbers in fixed.FUNDER_BUCKETS.items()]
    rules += [((funder == fixed.NON_FEDERAL_FUNDER) & (other == label), name) for label, name in fixed.OTHER_FUNDER_BUCKETS.items()]
    return code_bucket(rules, "Other", fixed.MERGED_BUCKETS)


def funder_buckets(funder: DataFrame) -> DataFrame:
    bucket = funder_bucket(F.col("ProjectID"), F.col("Funder"), F.col("OtherFunder"))
    return funder.select("ProjectID", bucket.alias("bucket")).distinct()


def funder_columns(funder: DataFrame, n: int = 3) -> DataFrame:
    """The first funders of a project side by side, in order of funder id; see ``programs_over_limit``."""
    rows = funder.select(
        "ProjectID", "FunderID", F.col("Funder").alias("funding_source"),
        funder_number(F.col("OtherFunder"), fixed.PROGRAM_FUNDER_SPELLINGS, fixed.PROGRAM_FUNDERS_KNOWN).alias("funding_source_non_federal"),
        F.lit(0).alias("amount"),
    )
    return spread_numbered(rows, ["ProjectID"], ["FunderID"], ["funding_source", "funding_source_non_federal", "amount"], n)


def programs(
    project: DataFrame, project_coc: DataFrame, funder: DataFrame, addresses: DataFrame, descriptions: DataFrame, extras: DataFrame,
    frozen_agencies: DataFrame, as_of: Column, related: Mapping[int, str] | None = None,
) -> DataFrame:
    """Program rows of the listed agencies; a project with several funder families gets
    one row each (see ``fanout_report``).

    ``frozen_agencies``: id. ``descriptions``: ProjectID, Description. ``related``:
    projects with a hand-written list of related projects.
    """
    kept = semi_restrict(project, frozen_agencies.select("id"), [("OrganizationID", "id")])
    joined = left_chain(
        kept,
        (project_coc.select("ProjectID", "Geocode").distinct(), "ProjectID"),
        (funder_buckets(funder), "ProjectID"),
        (addresses.select("ProjectID", "Address1", "Address2", "OrganizationName"), "ProjectID"),
        (funder_columns(funder), "ProjectID"),
        (descriptions.select("ProjectID", "Description"), "ProjectID"),
        (extras.select("ProjectID", F.col("ProjectName").alias("name"), F.col("ProjectAKA").alias("alias")), "ProjectID"),
    ).where(F.col("name").isNotNull())
    kind, bucket = F.col("ProjectType"), F.col("bucket")
    prevention = is_in(kind, (12, 13))
    template = code_template(kind, bucket, prevention)
    funders = [f"{v}_{i}" for v in ("funding_source", "funding_source_non_federal", "amount") for i in (1, 2, 3)]
    stay = threshold_by_type(kind)
    related_ids = F.coalesce(recode_literal(F.col("ProjectID"), related), F.lit("")) if related else F.lit("")
    values = {
        "id": F.col("ProjectID"), "ref_agency": F.col("OrganizationID"), "name": F.col("name"), "alias": F.col("alias"),
        "description": F.col("Description"), "ref_template": template,
        "availability_start": F.col("OperatingStartDate"), "availability_end": F.col("OperatingEndDate"),
        "status": 1, "cross_agency": 0,
        **{f: F.col(f) for f in funders}, "funding_source_1": F.coalesce("funding_source_1", F.lit(34)),
        "ref_category": kind, "aff_res_proj": tri_if(kind != 6, F.lit(0), F.col("ResidentialAffiliation")),
        "aff_res_proj_ids": related_ids, "program_applicability": kind, "continuum_project": F.col("ContinuumProject"),
        "geolocations__address": address_line(F.col("Address1"), F.col("Address2"), F.col("OrganizationName")),
        "programs__ref_target_b": F.coalesce("TargetPopulation", F.lit(4)), "tracking_method": F.col("TrackingMethod"),
        "ref_housing_type": F.coalesce("HousingType", F.lit(1)), "geocode": F.col("Geocode"),
        "hmis_participating_project": F.col("HMISParticipatingProject"),
        "public_listing": 2, "allow_goals": 0, "allow_autoservice_placement": 0, "eligibility_enabled": 1, "allow_history_link": 0,
        "enable_assessments": 1, "enable_notes": 1, "enable_files": 1, "enable_charts": 1, "enable_autoexit": 0,
        "autoexit_duration": "", "enable_cascade": 1, "cascade_threshold": stay, "enable_assessment_cascade": 1,
        "assessment_cascade_threshold": stay, "close_services": 1, "enrollment_age_warning": 1,
        "enrollment_age_warning_threshold": 17, "all_client_forms_enabled": 0, "added_date": as_of, "last_updated": as_of,
    }
    return joined.select(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in values.items()])


def code_template(kind: Column, bucket: Column, prevention: Column) -> Column:
    by_bucket = recode_literal(bucket, fixed.BUCKET_TEMPLATES)
    return (
        F.when(kind == 14, fixed.TEMPLATE_COORDINATED)
        .when(by_bucket.isNotNull(), by_bucket)
        .when((bucket == "CoC/ESG") & prevention, fixed.TEMPLATE_PREVENTION)
        .when(bucket == "CoC/ESG", fixed.TEMPLATE_HOUSING)
        .otherwise(0)
    )


def program_inventory(inventory: DataFrame) -> DataFrame:
    """Bed inventory; see ``bed_flags`` for the remainder rule."""
    beds = bed_flags()
    return inventory.select(
        F.col("InventoryID").alias("id"), F.col("ProjectID").alias("ref_program"),
        F.col("DateUpdated").alias("program_inventory__information_date"),
        F.col("InventoryStartDate").alias("program_inventory__start_date"),
        F.col("InventoryEndDate").alias("program_inventory__end_date"),
        F.col("CoCCode").alias("program_inventory__coc"), F.col("HouseholdType").alias("program_inventory__ref_household_type"),
        F.col("ESBedType").alias("program_inventory__ref_bed_type"), F.col("Availability").alias("program_inventory__availability"),
        *[c.alias(f"program_inventory__{n}") for n, c in beds.items()],
        F.col("UnitInventory").alias("program_inventory__unit_inventory"),
        F.col("DateCreated").alias("added_date"), F.col("DateUpdated").alias("last_updated"),
    )


def inventory_not_adding_up(table: DataFrame, prefix: str = "program_inventory__") -> DataFrame:
    """Inventory rows whose bed kinds still differ from the total."""
    kinds = [c for c in table.columns if c.startswith(f"{prefix}bed_") and c != f"{prefix}bed_inventory"]
    total = sum((F.col(c) for c in kinds), F.lit(0))
    return table.where(total != F.col(f"{prefix}bed_inventory"))


USER_AGENCIES, PROGRAM_FUNDERS = 8, 3  # how many the import form holds


def agencies_of_groups(group_projects: DataFrame, projects_orgs: DataFrame) -> DataFrame:
    """EDAGroup with each different project and agency that it reaches."""
    projects = group_projects.where(F.col("ProjectID").isNotNull()).select("ProjectID", "EDAGroup")
    owned = ns_join(projects, projects_orgs, "ProjectID", "left")
    owned = owned.where(F.col("AgencyID").isNotNull() & (F.col("AgencyID") != fixed.SYSTEM_AGENCY))
    return owned.select("EDAGroup", "ProjectName", "AgencyID", "AgencyName").distinct()


def agencies_of_users(user_groups: DataFrame, group_projects: DataFrame, projects_orgs: DataFrame, skip: Sequence[int] = fixed.ADMIN_USERS) -> DataFrame:
    """UserID, UserName, UserEmail with each project and agency that the user reaches."""
    return _reached(user_groups, agencies_of_groups(group_projects, projects_orgs), skip).distinct()


def _reached(user_groups: DataFrame, owned: DataFrame, skip: Sequence[int]) -> DataFrame:
    """Users with the projects of their groups, once for each group that reaches them."""
    members = user_groups.where(not_in(F.col("UserID"), skip)).select("UserID", "UserName", "UserEmail", "EDAGroupName").distinct()
    return ns_join(members, owned, [("EDAGroupName", "EDAGroup")], "inner").select("UserID", "UserName", "UserEmail", "ProjectName", "AgencyID", "AgencyName")


def _beyond(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Rows after the first ``n`` of their group, with their place; only groups that have such rows are ordered."""
    large = count_by(df, list(keys), "__n").where(F.col("__n") > n).drop("__n")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order]))
    return ns_join(df, large, list(keys), "left_semi").withColumn("place", place).where(F.col("place") > n)


def users_over_limit(user_groups: DataFrame, group_projects: DataFrame, projects_orgs: DataFrame, dedupe: bool = False, skip: Sequence[int] = fixed.ADMIN_USERS) -> DataFrame:
    """Agencies of users that ``users`` has no column for, with their place.

    Users with the same groups have the same agencies: these are put in order once for each set of groups.
    """
    ids = ["UserID", "UserName", "UserEmail"]
    group = F.struct(F.col("EDAGroupName").alias("EDAGroup"))  # a set leaves out nulls, but not what holds one
    people = user_groups.where(not_in(F.col("UserID"), skip)).groupBy(*ids).agg(F.sort_array(F.collect_set(group)).alias("groups"))
    sets = people.select("groups").distinct().select("groups", F.explode("groups").alias("of")).select("groups", "of.EDAGroup")
    rows = ns_join(sets, agencies_of_groups(group_projects, projects_orgs), ["EDAGroup"], "inner").drop("EDAGroup").distinct()
    rows = rows.select("groups", "AgencyID")
    beyond = _beyond(rows.distinct() if dedupe else rows, ["groups"], ["AgencyID"], USER_AGENCIES)
    return ns_join(people, beyond, ["groups"], "inner", nulls_match=False).select(*ids, "AgencyID", "place")


def programs_over_limit(funder: DataFrame) -> DataFrame:
    """Funders of projects that ``programs`` has no columns for, with their place."""
    return _beyond(funder.select("ProjectID", "FunderID", "Funder"), ["ProjectID"], ["FunderID"], PROGRAM_FUNDERS)


def users(user_groups: DataFrame, group_projects: DataFrame, projects_orgs: DataFrame, as_of: Column, dedupe: bool = False,
          skip: Sequence[int] = fixed.ADMIN_USERS, renamed: DataFrame | None = None) -> DataFrame:
    """User rows with up to eight agencies; ``users_over_limit`` lists what does not fit.

    An agency counts once per project unless ``dedupe``. No password is written.
    ``user_groups``: UserID, UserName ("Last, First"), UserEmail, EDAGroupName.
    ``renamed``: First, Last, NewLast of people whose logins would be alike.
    """
    ids = ["UserID", "UserName", "UserEmail"]
    # The first agencies of a user are among the first of each of their groups; no other row meets the users.
    owned = agencies_of_groups(group_projects, projects_orgs)
    owned = owned.dropDuplicates(["EDAGroup", "AgencyID"]) if dedupe else owned
    order = Window.partitionBy("EDAGroup").orderBy("AgencyID", "ProjectName", "AgencyName")
    first = owned.withColumn("__i", F.row_number().over(order)).where(F.col("__i") <= USER_AGENCIES).drop("__i")
    per_agency = _reached(user_groups, first, skip).distinct()
    wide = nth_columns(per_agency, ids, "AgencyID", USER_AGENCIES, "user_agencies", "NoAgencies", dedupe)
    split = separate(wide, "UserName", ["Last", "First"], ",")
    split = split.withColumns({"First": squish_newlines(F.col("First")), "Last": squish_newlines(F.col("Last"))})
    if renamed is not None:
        split = lookup_join(split, renamed, ["First", "Last"])
        split = split.withColumn("Last", F.coalesce("NewLast", "Last")).drop("NewLast")
    values = {
        "name": login_name(F.col("First"), F.col("Last")),
        "members__first_name": F.col("First"), "members__last_name": strip_suffix(F.col("Last"), "2"),
        "email": F.col("UserEmail"), "ref_user_group": "Agency Staff", "user_agencies__ref_agency": F.col("user_agencies1").cast("long"),
        "ref_user_status": 1, "members__auto_suggest": 1, "ref_profile_screen_name": "Agency Default", "users__ref_auth_option": 0,
        "members__force_password_change": 1, "members__is_warning": 1, "members__warning_days": "30 days",
        "members__last_policy_updated_date": "", **{f"user_agencies{i}": F.col(f"user_agencies{i}") for i in range(2, 9)},
        "members__home_screen": 1, "user_groups__ref_license": 1,
        "date": as_day_text(as_of), "added_date": as_time_text(as_of), "last_updated": as_time_text(as_of),
    }
    return split.select(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in values.items()])


def names_without_comma(user_groups: DataFrame) -> DataFrame:
    return user_groups.where(~F.col("UserName").contains(",")).select("UserName").distinct()


def shortest_login(table: DataFrame) -> DataFrame:
    return table.select("name", F.char_length("name").alias("length")).orderBy(F.col("length").asc_nulls_last(), "name").limit(1)


def duplicate_logins(table: DataFrame) -> DataFrame:
    return count_by(table.select("email", "name").distinct(), ["name"], "total").where("total > 1")


def special_logins(table: DataFrame) -> DataFrame:
    return table.where(F.col("name").rlike("[-',]")).select("name").distinct()


# Columns of the service table of the import, all blank.
SERVICE_COLUMNS = (
    "id", "ref_agency", "ref_program", "name", "ref_category", "ref_site", "ref_site_type", "status", "ref_program_usage",
    "added_date", "service_items__name", "servcie_items__si_cat1", "service_items__si_cat_2", "service_items__ref_delivery_type",
    "service_items__is_service", "service_items__attendance_history_assist", "service_items__default_intake_model",
    "service_items__roi_option", "service_items__allow_groups", "service_items__start_availability",
    "service_items__end_availability", "service_items__geocode", "enabled_on_customer_portal",
    "service_items__geolocation_is_enabled", "service_items_housing__information_date", "service_items_housing__ref_service_type",
    "service_items_housing__ref_household_type", "service_items_housing__inventory_type",
    "service_items_housing__youth_inventory_type", "service_items_housing__ref_bed_type", "service_items_housing__availability",
    "service_items_housing__beds_wo_children", "service_items_housing__beds_with_children",
    "service_items_housing__units_with_children", "service_items_housing__reservation", "service_items_housing__reservation_type",
    "service_items_housing__reservation_term", "service_items_housing__program_warning",
    "service_items_housing__allow_referred_reservations", "service_items__ref_funding", "service_items__default_amount",
    "service_items__expense_type", "service_items__adjustable", "service_items__charge_attendance",
    "service_items__enable_time_tracking", "service_items__default_tracking_hour", "service_items__default_tracking_minute",
    "service_items__time_tracking_type", "service_items__time_tracking_adjustable", "last_updated",
)


def service_template(services: DataFrame) -> DataFrame:
    """One blank service row per input row, ready to be filled in."""
    return template_columns(services, {c: "" for c in SERVICE_COLUMNS}, SERVICE_COLUMNS)
