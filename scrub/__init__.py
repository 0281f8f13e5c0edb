"""Data cleaning and data quality on Spark DataFrames."""

from .operators import *  # noqa: F401,F403
from .operators import __all__ as _operators
from .plans import CleaningConfig, Result, plan, run
from .sources import (
    PublishConflict, drop_versions, materialize, read_published, read_table, write_metrics, write_quarantine, write_table,
)
from .streaming import (
    Incremental, TypesChanged, clean_incrementally, clean_new_files, dedup_stream, ingest_new, latest_rows,
)

__all__ = [
    *_operators, "CleaningConfig", "Incremental", "PublishConflict", "Result", "TypesChanged", "clean_incrementally",
    "clean_new_files", "dedup_stream", "drop_versions", "ingest_new", "latest_rows", "materialize", "plan", "read_published", "read_table", "run",
    "write_metrics", "write_quarantine", "write_table",
]
