"""All queries of the account and contact library, by name."""

from __future__ import annotations

from . import cycle, normalize, pages, report, sites, work  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
