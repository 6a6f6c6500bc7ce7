"""All registered queries and, where SQL can express them, the SQL that gives the same rows."""

from __future__ import annotations

from . import analytics, calls, code, connectors, documents, errors, extraction, fixes, markdown, matching, portable, records, resolver, rules, snippets, sources, state, store_joins, store_reads  # noqa: F401  they register their queries
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
