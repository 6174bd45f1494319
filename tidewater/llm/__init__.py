"""Operators for training-data pipelines; nothing else in the library imports them."""

from tidewater.llm import queries  # noqa: F401
from tidewater.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
