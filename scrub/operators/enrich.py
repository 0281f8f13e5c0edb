"""Derived columns and audit columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import data_columns, lenient, ref
from ..functions.hashing import row_hash


@dataclass(frozen=True)
class DerivedColumn:
    name: str
    expression: str
    data_type: str | None = None
    description: str | None = None
    dependencies: tuple[str, ...] = ()


def derive(df: DataFrame, specs: Sequence[DerivedColumn]) -> DataFrame:
    """Add columns from Spark SQL expressions, in order; later ones may use earlier ones.

    One that names a dependency the table lacks, or does not fit the table, is left out;
    ``derive_report`` says which and why. Values an expression cannot take (a bad cast, a division by
    zero) give NULL.
    """
    return _derive(df, specs)[0]


def derive_report(df: DataFrame, specs: Sequence[DerivedColumn]) -> list[tuple[str, str]]:
    """(name, status) of every derived column; nothing is run."""
    return _derive(df, specs)[1]


def _derive(df: DataFrame, specs: Sequence[DerivedColumn]):
    with lenient(df):
        return _derived(df, specs)


def _derived(df: DataFrame, specs: Sequence[DerivedColumn]):
    report = []
    for spec in specs:
        absent = [d for d in spec.dependencies if d not in df.columns]
        if absent:
            report.append((spec.name, "missing: " + ", ".join(absent)))
            continue
        try:
            value = F.expr(spec.expression)
            if spec.data_type:
                value = value.try_cast(spec.data_type)
            wider = df.withColumn(spec.name, value)
            wider.schema
        except PySparkException as error:
            report.append((spec.name, "failed: " + str(error).splitlines()[0]))
        else:
            df = wider
            report.append((spec.name, "applied"))
    return df, report


def add_audit(
    df: DataFrame,
    job_id: str = "unknown",
    source: str | None = None,
    score: float | Column | None = None,
    null_token: str | None = None,
    true_source: bool = False,
    source_column: Column | None = None,
) -> DataFrame:
    """Add load time, job, source path and row hash; the quality score too when one is given.

    The hash covers all other columns. ``score`` may be a number or a column, such as a scalar
    subquery on the metrics. ``true_source`` takes each row's own file instead of ``source``;
    it needs a frame straight from files. ``source_column`` is a path that rows carry already.
    """
    path = F.col("_metadata.file_path") if true_source else F.lit(source).cast("string")
    if source_column is not None:
        path = source_column
    added = {
        "etl_load_timestamp": F.current_timestamp(),
        "etl_job_id": F.lit(job_id),
        "etl_source_path": path,
        "etl_row_hash": row_hash(df, data_columns(df), null_token),
    }
    if score is not None:
        value = score if isinstance(score, Column) else F.lit(float(score))
        added["etl_quality_score"] = value
    return df.withColumns(added)
