"""The catalog of named queries."""

from riskweave.plans import aggregate, features, joins, ranking, rows, scoring, storage, streams, windows  # noqa: F401
from riskweave.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
