"""Registered queries: each operator on the given tables, next to the SQL that must agree."""

from loadlens.catalog import metrics, requests, runs, scoring, storage, streams, text, timelines
from loadlens.catalog.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "metrics",
    "requests",
    "runs",
    "scoring",
    "storage",
    "streams",
    "text",
    "timelines",
]
