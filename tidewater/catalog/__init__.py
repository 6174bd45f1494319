"""Registered queries, each with the SQL that checks it."""

from tidewater.catalog import basics, dims, facts, io, logs, stored, streams, visits  # noqa: F401
from tidewater.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
