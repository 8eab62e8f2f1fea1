"""Operators for preparing training text, their queries and their SQL equivalents."""

from valora.llm.registry import ORACLES, QUERIES
from valora.llm import queries  # noqa: F401  (registration on import)

__all__ = ["ORACLES", "QUERIES"]
