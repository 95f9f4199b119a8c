"""Registered queries: each name has a Spark callable and, where SQL can say it, an oracle."""

from registry.base import ORACLE, QUERIES
from registry import (  # noqa: F401  (importing registers the queries)
    bars, curves, engines, feats, feeds, scale, storage, tables,
)

__all__ = ["ORACLE", "QUERIES"]
