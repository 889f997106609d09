"""Registered queries: one Spark callable and, where SQL can say it, its oracle."""

from queryset import bulk, extraction, folders, ingest, jobs, search, selectors, sources, streams
from queryset.registry import REGISTRY

__all__ = [
    "REGISTRY", "bulk", "extraction", "folders", "ingest", "jobs", "search", "selectors",
    "sources", "streams",
]
