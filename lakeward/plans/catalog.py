"""Import every query module so that the registry is complete."""

from __future__ import annotations

from lakeward.plans import audit, hierarchy, ingest, loads, production, ranking, relations, shaping, warehouse  # noqa: F401
from lakeward.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
