"""Reports for manual entry and for choosing organisations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day
from ..functions.nulls import is_in, strict_agg, tri_if
from ..operators.groups import group_profile, list_agg
from ..operators.joins import anti_exclude, full_coalesce, left_chain, ns_join, semi_restrict
from ..operators.reshape import key_diff
from . import fixed


def access_points(
    providers: DataFrame, counties: DataFrame, service_codes: DataFrame, crosswalk: DataFrame,
    access_type: str = fixed.ACCESS_TYPE, services: Mapping[str, tuple[str, bool]] = fixed.ACCESS_SERVICES,
) -> DataFrame:
    """Service areas by kind, hours and site of every access point that has any of them.

    ``services``: service code to (column, whether a missing area is left out).
    """
    points = providers.where(F.col("program_type_code") == access_type)
    ids = points.select("provider_id")
    general = semi_restrict(counties.select("provider_id", "county").distinct(), ids, "provider_id")
    frames = [list_agg(general, ["provider_id"], "county", "general_service_area", "__n").drop("__n")]
    offered = semi_restrict(service_codes, ids, "provider_id")
    for code, (column, known_only) in services.items():
        rows = offered.where(F.col("service_code") == code)
        if known_only:
            rows = rows.where(F.col("service_area").isNotNull())
        frames.append(rows.select("provider_id", F.col("service_area").alias(column)))
    contact = points.where(F.col("hours").isNotNull() | F.col("website_address").isNotNull())
    frames.append(contact.select("provider_id", "hours", "website_address"))
    joined = left_chain(
        full_coalesce(frames, ["provider_id"]),
        (providers.select("provider_id", F.col("name").alias("SP_ProjectName")), "provider_id"),
        (crosswalk.select("Legacy_ProgramID", "Target_AgencyName", "Target_ProgramName"), [("provider_id", "Legacy_ProgramID")]),
    )
    front = ["SP_ProjectName", "Target_AgencyName", "Target_ProgramName"]
    rest = [c for c in joined.columns if c not in (*front, "provider_id")]
    return joined.select(*front, F.col("provider_id").alias("SP_ProjectID"), *rest)


INVENTORY_KEY = ("ProjectID", "HouseholdType", "InventoryStartDate", "InventoryEndDate", "UnitInventory", "BedInventory")


def inventory_diff(earlier: DataFrame, later: DataFrame, projects: DataFrame, keys: Sequence[str] = INVENTORY_KEY) -> tuple[DataFrame, DataFrame]:
    """Later inventory that the earlier snapshot lacks, and earlier inventory that was
    changed, with project names. Only projects of the final list count as earlier."""
    names = projects.select("ProjectID", "ProjectName")
    earlier = semi_restrict(earlier, projects, "ProjectID")
    missing, different = key_diff(later, earlier, keys)
    return ns_join(missing, names, "ProjectID", "left"), ns_join(different, names, "ProjectID", "left")


def project_flags(profile: DataFrame) -> DataFrame:
    """Flags per project: coordinated entry or the special word in its name, obsolete type."""
    special = F.col("Project").contains(fixed.SPECIAL_PROJECT_WORD) | (
        (F.col("ptc") == fixed.ACCESS_TYPE) & ~is_in(F.col("ProjectID"), fixed.SPECIAL_TYPE_EXEMPT)
    )
    kept = profile.where(F.col("ProjectID").isNotNull() & (F.col("ProjectID") != 1))
    return kept.withColumns({
        "OpenEEs": F.coalesce("OpenEEs", F.lit(0)),
        "operating": tri_if(F.col("operating") == "Yes", 1, 0),
        "participating": tri_if(F.col("participating") == "Yes", 1, 0),
        "ce_or_vash": tri_if(special, 1, 0),
        "obsolete_ptc": F.when(is_in(F.col("ptc"), fixed.OBSOLETE_TYPES), 1).otherwise(0),
    })


def org_profile(flags: DataFrame) -> DataFrame:
    """One row per organisation; a project without dates counts as the no-data day."""
    nothing = day(fixed.NO_DATA_DAY)
    return group_profile(flags, ["Org"], {
        "minEntry": F.min(F.coalesce("MinEntry", nothing)),
        "maxExit": F.max(F.coalesce("MaxExit", nothing)),
        "openEEs": F.sum("OpenEEs"),
        "maxOperating": strict_agg(F.max, F.col("operating")),
        "maxParticipating": strict_agg(F.max, F.col("participating")),
        "CEorVASH": F.max(F.coalesce("ce_or_vash", F.lit(0))),
    })


def org_classify(orgs: DataFrame, last_old_exit: str = fixed.LAST_OLD_EXIT) -> DataFrame:
    """Each organisation as not migrating, migrating inactive or migrating active."""
    quiet = (F.col("openEEs") == 0) & (F.col("maxParticipating") == 0) & (F.col("CEorVASH") == 0)
    gone = quiet & (F.col("maxOperating") == 0) & (F.col("maxExit") <= day(last_old_exit))
    status = F.when(gone, "not migrating").when(quiet, "migrating inactive").otherwise("migrating active")
    return orgs.withColumn("status", status)


def referral_orgs(profile: DataFrame, root: str, kind: str = "Administrating Agency") -> DataFrame:
    """Second-level providers below ``root`` that are nobody's organisation."""
    level2 = profile.where((F.col("Org") == root) & (F.col("ptc") == kind) & ~F.col("Project").startswith("zz"))
    return anti_exclude(level2.select(F.col("Project").alias("Org")), profile, "Org").orderBy("Org")


def mapping_gaps(new: DataFrame, original: DataFrame, keys: Sequence[str], found: str) -> DataFrame:
    """New mapping rows that the original mapping has no row for (or one without ``found``)."""
    return ns_join(new, original.select(*keys, found), list(keys), "left").where(F.col(found).isNull())


def name_drift(a: DataFrame, b: DataFrame, ids: Sequence[str], name: str) -> DataFrame:
    """Names that differ although all ids agree."""
    both = ns_join(a.select(*ids, name), b.select(*ids, name), list(ids), "inner")
    return both.where(F.col(f"{name}_x") != F.col(f"{name}_y"))


