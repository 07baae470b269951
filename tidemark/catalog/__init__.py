"""Every operator as a named query over the driver's tables, next to the SQL it must agree with."""

from __future__ import annotations

from tidemark.catalog import datasets, declared, events, joins, requests, rows, streams, tables  # noqa: F401
from tidemark.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
