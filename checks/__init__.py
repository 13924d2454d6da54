"""Registered queries on the driver tables and their SQL counterparts."""

from checks.queries import ORACLE, QUERIES
from checks import storage, streams  # noqa: F401  (both register queries)

__all__ = ["ORACLE", "QUERIES"]
