"""Compact type strings to Spark schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# One letter per column: number, text, day, time, logical, whole number.
LETTERS = {
    "n": T.DoubleType(), "c": T.StringType(), "D": T.DateType(),
    "T": T.TimestampType(), "l": T.BooleanType(), "i": T.IntegerType(),
}

# Type strings of the standard extract files.
EXTRACT_TYPES = {
    "Client": "nccccncnDnnnnnnnnnnnnnnnnnnnnnnTTcTn",
    "Disabilities": "cnnDnnnnnnnnnnTTnTn",
    "EmploymentEducation": "cnnDnnnnnnTTnTn",
    "Enrollment": "nnnDcnnnlnDnnnDDDnnnncccnnDnnnncnnnnnnnnnnnnnnnnnnnnnnnnnnnnnnnnnnTTnTn",
    "EnrollmentCoC": "cncnnDcnTTnTn",
    "Exit": "nnnDncnnnnnnnnnnnnnnnnnnnnnnnnnDnnnnnnTTnTn",
    "Export": "iicccccccTDDcciii",
    "Funder": "nnnccDDTTcTn",
    "HealthAndDV": "cnnDnnnnnnnDnTTnTn",
    "IncomeBenefits": "cnnDnnnnnnnnnnnnnnnnnnnnnnnnnnnnnnnncnnnnnnncnnnnnnnnnnnnnnnnnnnncnnnnnnTTnTn",
    "Inventory": "nncnnnnnnnnnnnnDDTTcTn",
    "Organization": "ncncTTnTn",
    "Project": "nnccDDnnnnnnnnTTcTn",
    "ProjectCoC": "nncnccccnnTTcTn",
}
CLIENT_WITHOUT_NAMES = "ncncnDnnnnnnnnnnnnnnnnnnnnnnTTcTn"


def schema_of(names: Sequence[str], letters: str, whole_ids: bool = True) -> T.StructType:
    """Schema from column names and one type letter each.

    A number column named like an id is read as a whole number: ids do not fit a
    double once they are long.
    """
    if len(names) != len(letters):
        raise ValueError(f"{len(names)} columns but {len(letters)} type letters")

    def kind(name: str, letter: str) -> T.DataType:
        if letter == "n" and whole_ids and name.endswith("ID"):
            return T.LongType()
        return LETTERS[letter]

    return T.StructType([T.StructField(n, kind(n, x)) for n, x in zip(names, letters)])


def client_letters(columns: Sequence[str]) -> str:
    """The client file comes with or without the name columns; their number tells which."""
    return EXTRACT_TYPES["Client"] if len(columns) == len(EXTRACT_TYPES["Client"]) else CLIENT_WITHOUT_NAMES
