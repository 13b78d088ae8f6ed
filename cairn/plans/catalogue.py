"""The registered queries of the engine and their SQL."""

from cairn.plans import analytics, changes, reads, retrieval, values  # noqa: F401
from cairn.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
