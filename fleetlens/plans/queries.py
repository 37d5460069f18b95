"""All registered queries."""

from __future__ import annotations

from fleetlens.plans import q_endpoints, q_logs, q_metrics, q_processes, q_streams  # noqa: F401
from fleetlens.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
