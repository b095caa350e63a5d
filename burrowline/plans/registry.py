"""Named queries over the given tables and the SQL that states the same result."""

from __future__ import annotations

from burrowline.plans import behaviour, catalogue, cohort, matching, recordings, sheets
from burrowline.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "behaviour", "catalogue", "cohort", "matching", "recordings", "sheets"]
