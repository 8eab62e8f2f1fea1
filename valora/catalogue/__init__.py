"""Operators applied to the driver's tables, each with an equivalent SQL text where SQL can say it."""

from valora.catalogue.registry import ORACLES, QUERIES
from valora.catalogue import (  # noqa: F401  (registration on import)
    exploration, features, joins, learning, reports, scalars, sources,
)

__all__ = ["ORACLES", "QUERIES"]
