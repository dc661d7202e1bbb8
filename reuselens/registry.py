"""Queries of the library's own operators, and the SQL they are held against."""

from __future__ import annotations

from .plans import annotation_queries, board_queries  # noqa: F401  they register their queries
from .plans.catalogue import ORACLE_SQL, QUERIES, flagship

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
