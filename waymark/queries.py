"""Registry of the place-analytics queries and their oracle SQL."""

from __future__ import annotations

from waymark.operators import addresses, bundles, detail_pages, details, enhance, entity, fields, grid, lifecycle, logs, menus, migrate, opening, quality, reports, search, stats, status_log, trailing, variants  # noqa: F401
from waymark.plans.registry import ORACLES, QUERIES
from waymark.sources import pages  # noqa: F401
from waymark.streaming import queries as streaming  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
