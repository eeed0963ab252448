"""The registered queries, each with the SQL that states its result."""

from workload import history, listings, loads, refresh, scans, structure  # noqa: F401
from workload.registry import REGISTRY

__all__ = ["REGISTRY"]
