"""Named queries over the given tables, each with an independent SQL text where one exists."""

from __future__ import annotations

from . import clusters, data, exploring, models, networks, validating  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
