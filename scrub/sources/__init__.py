"""Files in and out."""

from .publish import PublishConflict, drop_versions, publish, read_published
from .readers import read_table, repartition_by_rows, sample_rows
from .staging import materialize, release, scratch_path, shared_folder
from .writers import LOSSLESS_CSV, write_metrics, write_quarantine, write_table

__all__ = [
    "LOSSLESS_CSV", "PublishConflict", "drop_versions", "materialize", "publish", "read_published", "read_table",
    "release", "repartition_by_rows", "sample_rows", "scratch_path", "shared_folder", "write_metrics", "write_quarantine",
    "write_table",
]
