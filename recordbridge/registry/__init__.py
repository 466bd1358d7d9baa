"""Every operator and job as a query on the test tables, with its check in SQL."""

from . import basics, files, grouping, imports, jobs, reconciling  # noqa: F401
from .base import ORACLE, QUERIES  # noqa: F401
