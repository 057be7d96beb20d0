"""All queries over the test tables."""

from . import queries_index, queries_io, queries_news, queries_text  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
