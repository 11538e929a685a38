"""Registered queries (Spark builders + DuckDB oracle SQL)."""

from . import batch, econ, enrich, jobs, joins, models, serving, streaming  # noqa: F401  (registers queries)
from .registry import QUERIES, Query, finish  # noqa: F401
