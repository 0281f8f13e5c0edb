"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .readers import check_format


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    compression: str = "snappy",
    separator: str = ",",
    quote: str = '"',
    mode: str = "errorifexists",
    **options,
) -> None:
    """Write Parquet (with ``compression``), CSV (header, ``separator``, ``quote``) or JSON lines.

    Outer spaces are kept in CSV, and columns that are all NULL in JSON.

    A format it does not know is an error, and so is a failed write.
    """
    fmt = check_format(fmt)
    if fmt == "parquet":
        options = {"compression": compression} | options
    elif fmt == "csv":
        # Empty text is a pair of quotes; Spark would write "" whatever the quote character is.
        options = {
            "header": True, "sep": separator, "quote": quote, "emptyValue": quote * 2,
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
        } | options
    else:
        options = {"ignoreNullFields": False} | options
    df.write.format(fmt).mode(mode).options(**options).save(path)


# Options that make a CSV file give back exactly what was written: outer spaces stay, and NULL is
# told apart from empty text. Use them on both sides.
LOSSLESS_CSV = {
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "\\N",
}


def write_quarantine(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write rows that were moved aside, as Parquet."""
    write_table(df, path, "parquet", mode=mode)


def write_metrics(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the one-row metrics record, as JSON."""
    write_table(df, path, "json", mode=mode, ignoreNullFields=True)
