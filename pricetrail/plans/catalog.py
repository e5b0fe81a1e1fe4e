"""Importing this module registers every query."""

from pricetrail.plans import (  # noqa: F401
    archive, events, ingest, movers, quality, series, texts, wide,
)
from pricetrail.plans.registry import QUERIES

__all__ = ["QUERIES"]
