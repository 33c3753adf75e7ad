"""Registered queries over the test tables, each with the SQL that checks it."""

from eventide.catalogue import activity, lakehouse, models, streams, trust, upkeep  # noqa: F401
from eventide.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
