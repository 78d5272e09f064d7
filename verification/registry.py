"""Importing this module fills the catalogue."""

from verification import (  # noqa: F401
    queries_models,
    queries_posts,
    queries_recommend,
    queries_topics,
    queries_users,
)
from verification.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
