"""Queries over the test tables, each with the SQL that must give the same rows."""

from . import jobs, maintenance, operators  # noqa: F401  (they fill the registry)
from .base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
