"""Checks of a table's schema against a contract. Driver-side, no job runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from .types import ConvertOptions, same_type


@dataclass(frozen=True)
class SchemaSpec:
    required_columns: Sequence[str] = ()
    optional_columns: Sequence[str] = ()
    column_types: Mapping[str, str] = field(default_factory=dict)
    min_columns: int | None = None
    max_columns: int | None = None


@dataclass(frozen=True)
class Issue:
    """Outcome of one check. Only type mismatches are warnings, everything else is an error."""

    column: str | None
    check: str
    expected: str
    actual: str
    ok: bool


class SchemaError(ValueError):
    pass


def check_schema(
    df: DataFrame, spec: SchemaSpec, options: ConvertOptions = ConvertOptions()
) -> list[Issue]:
    """Every check of the contract with its outcome."""
    issues = []
    for name in spec.required_columns:
        here = name in df.columns
        issues.append(
            Issue(name, "required", "present", "present" if here else "missing", here)
        )
    width = len(df.columns)
    if spec.min_columns:
        issues.append(
            Issue(None, "min_columns", str(spec.min_columns), str(width), width >= spec.min_columns)
        )
    if spec.max_columns:
        issues.append(
            Issue(None, "max_columns", str(spec.max_columns), str(width), width <= spec.max_columns)
        )
    for name, wanted in spec.column_types.items():
        if name in df.columns:
            kind = df.schema[name].dataType
            issues.append(
                Issue(name, "type", wanted, kind.simpleString(), same_type(kind, wanted, options))
            )
    return issues


def validate_schema(
    df: DataFrame, spec: SchemaSpec, options: ConvertOptions = ConvertOptions()
) -> list[Issue]:
    """Raise on a missing column or a wrong number of columns; return the type mismatches."""
    failed = [i for i in check_schema(df, spec, options) if not i.ok]
    errors = [i for i in failed if i.check != "type"]
    if errors:
        raise SchemaError(
            "; ".join(f"{i.check} {i.column or 'count'}: expected {i.expected}, got {i.actual}"
                      for i in errors)
        )
    return failed


def schema_report(
    df: DataFrame, spec: SchemaSpec, options: ConvertOptions = ConvertOptions()
) -> DataFrame:
    """The outcome of every check as rows."""
    rows = [
        (i.column, i.check, i.expected, i.actual, i.ok) for i in check_schema(df, spec, options)
    ]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, check string, expected string, actual string, ok boolean"
    )
