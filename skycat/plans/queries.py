"""All registered queries."""

from __future__ import annotations

from . import queries_images, queries_objects, queries_sky, queries_sql, queries_survey  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
