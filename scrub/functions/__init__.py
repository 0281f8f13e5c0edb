"""Column expressions: everything here takes and returns ``Column``."""

from .columns import AUDIT_COLUMNS, is_missing, missing_cells, ref
from .hashing import row_hash
from .parse import (
    DATE_FORMATS,
    TIMESTAMP_FORMATS,
    parse_boolean,
    parse_date,
    parse_decimal,
    parse_integer,
    parse_timestamp,
)
from .text import collapse_whitespace, keep_alphanumeric, title_case, trim_spaces

__all__ = [
    "AUDIT_COLUMNS", "DATE_FORMATS", "TIMESTAMP_FORMATS", "collapse_whitespace", "is_missing",
    "keep_alphanumeric", "missing_cells", "parse_boolean", "parse_date", "parse_decimal",
    "parse_integer", "parse_timestamp", "ref", "row_hash", "title_case", "trim_spaces",
]
