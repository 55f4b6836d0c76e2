"""All named queries and their SQL."""

from . import columns, models, storage  # noqa: F401  register their queries
from .catalog import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
