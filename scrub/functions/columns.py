"""Small helpers for naming and typing columns."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the audit columns every cleaned row may carry.
AUDIT_COLUMNS = (
    "etl_load_timestamp",
    "etl_job_id",
    "etl_source_path",
    "etl_row_hash",
    "etl_quality_score",
)

FRACTIONAL = (T.FloatType, T.DoubleType)
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def quoted(name: str) -> str:
    """A column's name as SQL text, safe for dots, spaces and backticks."""
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """Column by its exact name."""
    return F.col(quoted(name))


def data_columns(df: DataFrame) -> list[str]:
    """Columns that are not audit columns, in schema order."""
    return [c for c in df.columns if c not in AUDIT_COLUMNS]


def columns_of_type(df: DataFrame, *kinds: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, T.NumericType)


def is_missing(c: Column, kind: T.DataType) -> Column:
    """NULL, or NaN for the two binary floating types."""
    return (c.isNull() | F.isnan(c)) if isinstance(kind, FRACTIONAL) else c.isNull()


def nan_to_null(c: Column, kind: T.DataType) -> Column:
    return F.nanvl(c, F.lit(None).cast(kind)) if isinstance(kind, FRACTIONAL) else c


def missing_cells(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Number of missing values in one row, as an int."""
    wanted = data_columns(df) if columns is None else columns
    total = F.lit(0)
    for name in wanted:
        total = total + is_missing(ref(name), df.schema[name].dataType).cast("int")
    return total


def rows_from_one(df: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """Turn a one-row frame of aggregates into one output row per entry of ``rows``."""
    structs = [F.struct(*[v.alias(k) for k, v in row.items()]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


@contextmanager
def lenient(df: DataFrame):
    """Within, expressions given by users are analysed so that values they cannot take give NULL.

    Spark fixes this when it analyses an expression, so a bad row does not end a later job.
    """
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.ansi.enabled")
    conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        conf.set("spark.sql.ansi.enabled", before)
