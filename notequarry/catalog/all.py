"""Every registered query and its SQL."""

from __future__ import annotations

from notequarry.catalog import (  # noqa: F401  (importing registers)
    io_queries,
    mention_queries,
    text_queries,
    time_queries,
    variant_queries,
)
from notequarry.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
