"""All registered queries."""

from pathloom.catalog import kind_queries, scene_queries, source_queries, synth_queries  # noqa: F401
from pathloom.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
