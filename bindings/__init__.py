"""Queries over the given tables, each next to the SQL that must give the same rows."""

from bindings.registry import ORACLES, QUERIES
from bindings import (  # noqa: F401  (each module registers its queries)
    cleaning, conforming, files, indoor_feed, joining, quality_checks, reshaping, stored, streams, time_series,
    uplink_feed, water_feed,
)

__all__ = ["ORACLES", "QUERIES"]
