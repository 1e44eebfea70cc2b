"""Registered queries: each operator on the driver tables, with the SQL that gives the same rows."""

from __future__ import annotations

from airq.queries import features, geography, ingest, plans, quality, resampling, rows, series, stations, values
from airq.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "features", "geography", "ingest", "plans", "quality", "resampling", "rows", "series", "stations", "values"]
