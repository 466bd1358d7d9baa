"""Who is in scope."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import COHORT_START, day
from ..functions.nulls import not_in
from ..operators.joins import anti_exclude, semi_restrict
from ..operators.translate import build_projects
from . import fixed


def dump_projects(provider: DataFrame, moves: DataFrame, names: Mapping[int, str] = fixed.PROJECT_NAME_OVERRIDES, agencies: Mapping[int, str] = fixed.AGENCY_NAME_OVERRIDES) -> DataFrame:
    """Active projects of a dump with their agency, after the corrections to parents and names.

    ``moves``: Legacy_ProgramID, correct_Legacy_AgencyID.
    """
    return build_projects(provider, moves, names, agencies)


def client_cohort(entries: DataFrame, projects: DataFrame, clients: DataFrame, cutoff: str = COHORT_START, test_clients: Iterable[int] = fixed.TEST_CLIENTS) -> DataFrame:
    """Distinct clients with an active entry into a project in scope that is open or
    ended on or after the cut-off, without test clients and inactive clients.

    ``entries``: client_id, provider_id, exit_date, active. ``projects``: Legacy_ProgramID.
    """
    recent = entries.where(
        F.col("active")
        & not_in(F.col("client_id"), test_clients)
        & (F.col("exit_date").isNull() | (F.col("exit_date") >= day(cutoff)))
    )
    in_scope = semi_restrict(recent.select("client_id", "provider_id"), projects, [("provider_id", "Legacy_ProgramID")])
    inactive = clients.where(~F.col("active")).select("client_id")
    return anti_exclude(in_scope.select("client_id").distinct(), inactive, "client_id")
