"""The settings of a cleaning run, read from a flat dictionary."""

from __future__ import annotations

import json
import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from ..functions.parse import DATE_FORMATS, TIMESTAMP_FORMATS
from ..functions.text import CASES
from ..operators.enrich import DerivedColumn
from ..operators.outliers import METHODS
from ..operators.rules import NO_DEFAULT, Action, Rule, Severity
from ..operators.schema import SchemaSpec
from ..operators.types import ConvertOptions
from ..sources.readers import (
    ROWS_PER_PARTITION,
    check_format,
)

# The accepted keys and the setting each one fills.
KEYS = {
    "S3_SOURCE_PATH": "source",
    "S3_TARGET_PATH": "target",
    "S3_QUARANTINE_PATH": "quarantine_path",
    "S3_METRICS_PATH": "metrics_path",
    "INPUT_FORMAT": "input_format",
    "OUTPUT_FORMAT": "output_format",
    "COMPRESSION": "compression",
    "CSV_DELIMITER": "csv_separator",
    "CSV_QUOTE_CHAR": "csv_quote",
    "CSV_ESCAPE_CHAR": "csv_escape",
    "CSV_HEADER": "csv_header",
    "CSV_INFER_SCHEMA": "csv_infer_schema",
    "ENABLE_SCHEMA_VALIDATION": "schema_validation",
    "ENABLE_DATA_PROFILING": "profiling",
    "ENABLE_ADVANCED_ANALYTICS": "advanced_analytics",
    "ENABLE_QUARANTINE": "quarantine",
    "MAX_RECORDS_PER_PARTITION": "rows_per_partition",
    "MIN_PARTITIONS": "min_partitions",
    "MAX_PARTITIONS": "max_partitions",
    "CRITICAL_NULL_COLUMNS": "critical_columns",
    "TYPE_CONVERSION_MAP": "type_map",
    "DROP_DUPLICATE_SUBSET": "dedup_subset",
    "REMOVE_NON_ALPHANUMERIC_FROM_COLUMNS": "alnum_columns",
    "FILL_NULL_STRINGS_WITH": "fill_strings",
    "FILL_NULL_NUMBERS_WITH": "fill_numbers",
    "FILL_NULL_DATES_WITH": "fill_dates",
    "FILL_NULL_BOOLEANS_WITH": "fill_booleans",
    "STANDARDIZE_STRING_CASE": "string_case",
    "TRIM_STRINGS": "trim",
    "REMOVE_EXTRA_SPACES": "collapse",
    "DATE_FORMATS_TO_TRY": "date_formats",
    "TIMESTAMP_FORMATS_TO_TRY": "timestamp_formats",
    "CUSTOM_VALIDATION_RULES_JSON": "rules",
    "CUSTOM_DERIVED_COLUMNS_JSON": "derived",
    "SCHEMA_VALIDATION_CONFIG": "schema",
    "NUMERIC_PRECISION": "precision",
    "NUMERIC_SCALE": "scale",
    "HANDLE_NUMERIC_OVERFLOW": "overflow",
    "ENABLE_OUTLIER_DETECTION": "outliers",
    "OUTLIER_METHOD": "outlier_method",
    "OUTLIER_THRESHOLD": "outlier_threshold",
    "ENABLE_SAMPLING": "sampling",
    "SAMPLE_FRACTION": "sample_fraction",
    "SAMPLE_SEED": "sample_seed",
    "JOB_NAME": "job_name",
    "JOB_RUN_ID": "job_run_id",
}


@dataclass(frozen=True)
class CleaningConfig:
    """Every switch of a cleaning run; the field names may be used as keys too."""

    source: str | None = None
    target: str | None = None
    quarantine_path: str | None = None
    metrics_path: str | None = None
    job_name: str = "cleaning"
    job_run_id: str = "unknown"
    input_format: str = "csv"
    output_format: str = "parquet"
    compression: str = "snappy"
    csv_separator: str = ","
    csv_quote: str = '"'
    csv_escape: str = "\\"
    csv_header: bool = True
    csv_infer_schema: bool = False
    csv_multiline: bool = True
    schema_validation: bool = False
    schema: SchemaSpec | None = None
    profiling: bool = True
    advanced_analytics: bool = False
    quarantine: bool = True
    rows_per_partition: int | None = None
    min_partitions: int | None = None
    max_partitions: int | None = None
    cache: bool = False
    critical_columns: tuple[str, ...] = ()
    type_map: Mapping[str, str] = field(default_factory=dict)
    infer: bool = True
    dedup_subset: tuple[str, ...] = ()
    alnum_columns: tuple[str, ...] = ()
    fill_strings: str | None = None
    fill_numbers: str | None = None
    fill_dates: str | None = None
    fill_booleans: str | None = None
    string_case: str = "none"
    trim: bool = True
    collapse: bool = True
    date_formats: tuple[str, ...] = DATE_FORMATS
    timestamp_formats: tuple[str, ...] = TIMESTAMP_FORMATS
    rules: tuple[Rule, ...] = ()
    derived: tuple[DerivedColumn, ...] = ()
    precision: int = 38
    scale: int = 10
    overflow: str = "truncate"
    outliers: bool = False
    outlier_method: str = "iqr"
    outlier_threshold: float = 3.0
    sampling: bool = False
    sample_fraction: float = 0.1
    sample_seed: int = 42
    # Estimate distinct values in profiles instead of moving them.
    approx_distinct: bool = False
    # What a drop_row rule makes of a row for which it is NULL: drop or pass.
    unknown: str = "drop"
    # Text that stands for NULL in row hashes; without one NULLs are left out.
    null_token: str | None = None
    # Give each row the path of its own file as its source; of copies in several files the smallest.
    true_source: bool = False
    # Write outputs as a version below the target that becomes visible in one step (``read_published``).
    versions: bool = False

    def __post_init__(self):
        check_format(self.input_format)
        check_format(self.output_format)
        _one_of("case mode", self.string_case, CASES)
        _one_of("overflow policy", self.overflow, ("truncate", "null", "string"))
        _one_of("outlier method", self.outlier_method, METHODS)
        _one_of("treatment of unknown conditions", self.unknown, ("drop", "pass"))

    @property
    def quarantine_target(self) -> str:
        """Beside the target, not inside it, so that reading the target back stays clean."""
        return self.quarantine_path or f"{(self.target or '').rstrip('/')}_quarantine"

    @property
    def metrics_target(self) -> str:
        return self.metrics_path or f"{(self.target or '').rstrip('/')}_metrics"

    @property
    def repartitions(self) -> bool:
        return any((self.rows_per_partition, self.min_partitions, self.max_partitions))

    @property
    def partition_bounds(self) -> tuple[int, int, int | None]:
        return (
            self.rows_per_partition or ROWS_PER_PARTITION,
            self.min_partitions or 1,
            self.max_partitions,
        )

    @property
    def convert_options(self) -> ConvertOptions:
        return ConvertOptions(
            self.date_formats, self.timestamp_formats, self.precision, self.scale, self.overflow
        )

    @property
    def csv_options(self) -> dict:
        return {
            "separator": self.csv_separator, "quote": self.csv_quote, "escape": self.csv_escape,
            "header": self.csv_header, "infer_schema": self.csv_infer_schema,
            "multiline": self.csv_multiline,
        }

    @classmethod
    def from_dict(cls, values: Mapping[str, Any]) -> CleaningConfig:
        """Read a dictionary of texts; lists may be comma-separated, nested settings may be JSON.

        Values that are already lists, numbers and so on are taken as they are. JSON that cannot
        be read is an error; a key nobody knows is a warning.
        """
        settings = {}
        for key, value in values.items():
            name = KEYS.get(key.lstrip("-"), key)
            if name not in cls.__dataclass_fields__:
                warnings.warn(f"unknown setting ignored: {key}")
            elif value is not None:
                settings[name] = _READERS.get(name, _text)(key, value)
        return cls(**{k: v for k, v in settings.items() if v is not None})


def _one_of(what: str, value: str, known) -> None:
    if value not in known:
        raise ValueError(f"unknown {what}: {value}; use one of {', '.join(known)}")


def _text(key: str, value: Any) -> Any:
    return value


def _word(key: str, value: Any) -> str:
    return str(value).lower()


def _switch(key: str, value: Any) -> bool:
    return value if isinstance(value, bool) else str(value).lower() == "true"


def _whole(key: str, value: Any) -> int:
    return int(value)


def _fraction(key: str, value: Any) -> float:
    return float(value)


def _names(key: str, value: Any) -> tuple[str, ...] | None:
    items = value.split(",") if isinstance(value, str) else value
    return tuple(i.strip() for i in items if i.strip()) or None


def _json(key: str, value: Any) -> Any:
    if not isinstance(value, str):
        return value
    try:
        return json.loads(value) if value.strip() else None
    except json.JSONDecodeError as error:
        raise ValueError(f"{key} is not valid JSON: {error}") from error


def _mapping(key: str, value: Any) -> dict:
    return dict(_json(key, value) or {})


def _records(key: str, value: Any) -> list:
    found = _json(key, value)
    if not found:
        return []
    if not isinstance(found, (list, tuple)):
        raise ValueError(f"{key} must be a list")
    return list(found)


def _rules(key: str, value: Any) -> tuple[Rule, ...]:
    return tuple(r if isinstance(r, Rule) else rule_from(r) for r in _records(key, value))


def rule_from(record: Mapping[str, Any]) -> Rule:
    """A rule from a record; a default of 0, "" or false is a default like any other."""
    default = record.get("default_value", record.get("default", NO_DEFAULT))
    expression = record.get("expression") or record.get("rule")
    if not expression:
        raise ValueError(f"rule without an expression: {dict(record)}")
    return Rule(
        column=record.get("column"),
        expression=expression,
        action=Action(record.get("action", "drop_row")),
        rule_name=record.get("rule_name", "unnamed_rule"),
        severity=Severity(record.get("severity", "medium")),
        default=default,
        message=record.get("error_message"),
        enabled=record.get("enabled", True),
    )


def _derived(key: str, value: Any) -> tuple[DerivedColumn, ...]:
    return tuple(
        d if isinstance(d, DerivedColumn) else DerivedColumn(
            d["name"], d["expression"], d.get("type") or d.get("data_type"),
            d.get("description"), tuple(d.get("dependencies") or ()),
        )
        for d in _records(key, value)
    )


def _schema(key: str, value: Any) -> SchemaSpec | None:
    if isinstance(value, SchemaSpec):
        return value
    found = _json(key, value)
    return SchemaSpec(**found) if found else None


_READERS = {
    **dict.fromkeys(
        ("csv_header", "csv_infer_schema", "csv_multiline", "schema_validation", "profiling",
         "advanced_analytics", "quarantine", "infer", "trim", "collapse", "outliers", "sampling",
         "cache", "approx_distinct", "true_source", "versions"),
        _switch,
    ),
    **dict.fromkeys(
        ("rows_per_partition", "min_partitions", "max_partitions", "precision",
         "scale", "sample_seed"),
        _whole,
    ),
    **dict.fromkeys(("outlier_threshold", "sample_fraction"), _fraction),
    **dict.fromkeys(
        ("critical_columns", "dedup_subset", "alnum_columns", "date_formats", "timestamp_formats"),
        _names,
    ),
    **dict.fromkeys(
        ("input_format", "output_format", "compression", "string_case", "overflow",
         "outlier_method", "unknown"),
        _word,
    ),
    "type_map": _mapping,
    "rules": _rules,
    "derived": _derived,
    "schema": _schema,
}
