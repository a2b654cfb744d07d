"""Queries on the test tables, each beside the SQL that must give the same rows."""

from dimkeep.catalog import changes, days, extracts, jobs, keys, reductions, stored  # noqa: F401
from dimkeep.catalog.registry import oracles, queries

__all__ = ["oracles", "queries"]
