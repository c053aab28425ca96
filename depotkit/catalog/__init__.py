"""Queries over the driver tables, each with the oracle SQL that checks it."""

from depotkit.catalog import checks, columns, metrics, models, raw, relations, scores, series  # noqa: F401
from depotkit.catalog.registry import QUERIES

__all__ = ["QUERIES"]
