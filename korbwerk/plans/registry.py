"""Registered queries, and the SQL that gives the same rows."""

from korbwerk.plans import batches, compared, exchange, listings, pages  # noqa: F401  they register their queries
from korbwerk.plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
