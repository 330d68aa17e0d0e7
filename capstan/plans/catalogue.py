"""Import every query module so the registry is complete."""

from capstan.plans import archive, documents, reports, spool, streams  # noqa: F401
from capstan.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
