"""All queries of the library, with the SQL that gives the same rows."""

from __future__ import annotations

from .plans import conversations, corpus, files, index, library, pages, quality, retrieval, schedule, state, store, usage  # noqa: F401
from .plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
