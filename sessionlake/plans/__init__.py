"""The queries over the driver's tables."""

from sessionlake.plans import collection, health, live, sessions, storage, sync, tables  # noqa: F401
from sessionlake.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
