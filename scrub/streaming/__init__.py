"""Incremental runs on Structured Streaming."""

from .dedup import dedup_stream, latest_rows
from .ingest import clean_new_files, ingest_new
from .whole import Incremental, TypesChanged, clean_incrementally

__all__ = [
    "Incremental", "TypesChanged", "clean_incrementally", "clean_new_files", "dedup_stream", "ingest_new",
    "latest_rows",
]
