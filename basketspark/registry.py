"""Query registry of the package's own operators."""

from __future__ import annotations

from .plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
