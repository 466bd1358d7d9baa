"""Code translation and rule helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import is_in, not_in, tri_if

# Id numbers that are known to be made up.
FAKE_IDS = (
    "111111111", "222222222", "333333333", "444444444", "555555555", "777777777",
    "888888888", "123456789",
)

# Longest allowed stay in days by project type, and for all other types.
STAY_LIMITS = {3: 365, 9: 365, 2: 120}
STAY_LIMIT_OTHER = 30


def recode_literal(col: Column, mapping: Mapping) -> Column:
    """In-line value map; a value that is not listed becomes null."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), col)


def normalise_labels(col: Column, spellings: Mapping[str, Sequence[str]]) -> Column:
    """Replace listed spellings by their canonical label, keep all else."""
    flat = {spelling: label for label, group in spellings.items() for spelling in group}
    return F.coalesce(recode_literal(col, flat), col)


def code_bucket(rules: Sequence[tuple[Column, str]], default: str, merge: Mapping[str, Sequence[str]] | None = None) -> Column:
    """First rule that holds names the bucket; unknown conditions do not hold."""
    chain = F.lit(default)
    for cond, bucket in reversed(list(rules)):
        chain = F.when(cond, bucket).otherwise(chain)
    return normalise_labels(chain, merge) if merge else chain


def threshold_by_type(project_type: Column, limits: Mapping[int, int] = STAY_LIMITS, other: int = STAY_LIMIT_OTHER) -> Column:
    """Number of days that depends on the project type."""
    return F.coalesce(recode_literal(project_type, limits), F.lit(other))


def yes_no(col: Column, yes="Y", no="N") -> Column:
    """N to 0, Y to 1, all else null."""
    return F.when(col == no, 0).when(col == yes, 1)


def round_even(col: Column, scale: int = 0) -> Column:
    """Round half to even."""
    return F.bround(col, scale)


def ssn_class(number: Column, quality: Column) -> Column:
    """Classify an id number; ``ok`` stands for a number that passes all tests.

    A quality of 2 always counts as Invalid, so no number is ever called incomplete.
    """
    missing = (number.isNull() & not_in(quality, (8, 9))) | quality.isNull() | (quality == 99)
    malformed = (
        (F.char_length(number) != 9)
        | F.substring(number, 1, 3).isin("000", "666")
        | (F.substring(number, 1, 1) == "9")
        | (F.substring(number, 4, 2) == "00")
        | (F.substring(number, 6, 4) == "0000")
        | (quality == 2)
        | number.isin(*FAKE_IDS)
    )
    return (
        F.when(missing, "Missing").when(is_in(quality, (8, 9)), "DKR").when(malformed, "Invalid").otherwise("ok")
    )


# Inventory column, output name, and how its flag is tested.
BED_KINDS = (
    ("YouthVetBedInventory", "youth_veteran", "positive"),
    ("VetBedInventory", "other_veteran", "positive"),
    ("YouthBedInventory", "other_youth", "nonzero"),
    ("OtherBedInventory", "non_dedicated", "positive"),
    ("CHVetBedInventory", "ch_veteran", "positive"),
    ("CHYouthBedInventory", "ch_youth", "positive"),
    ("CHBedInventory", "ch_other", "positive"),
)


def bed_flags(total: str = "BedInventory", kinds=BED_KINDS) -> dict[str, Column]:
    """Flag and zero-filled count per bed kind, the remainder rule for non-dedicated beds.

    Where the kinds do not add up to the total, the total itself is written as
    non-dedicated; an unknown total gives an unknown count.
    """
    out: dict[str, Column] = {}
    filled = {name: F.coalesce(F.col(source), F.lit(0)) for source, name, _ in kinds}
    adds_up = sum(filled.values(), F.lit(0)) == F.col(total)
    for source, name, test in kinds:
        beds = filled[name]
        out[f"is_bed_{name}"] = ((beds > 0) if test == "positive" else (beds != 0)).cast("int")
        out[f"bed_{name}"] = tri_if(adds_up, beds, F.col(total)) if name == "non_dedicated" else beds
    out["bed_inventory"] = F.col(total)
    return out
