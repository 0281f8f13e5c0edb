"""Dropping rows without keys and filling gaps."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import AUDIT_COLUMNS, FRACTIONAL, TEMPORAL, is_missing, nan_to_null, ref
from ..functions.parse import DATE_FORMATS, TIMESTAMP_FORMATS


def any_missing(df: DataFrame, columns: Sequence[str]) -> Column | None:
    """True where one of the columns that exist is missing; None when none of them exists."""
    present = [c for c in columns if c in df.columns]
    tests = [is_missing(ref(c), df.schema[c].dataType) for c in present]
    return reduce(lambda a, b: a | b, tests) if tests else None


def drop_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a missing value in any of the columns; names that do not exist are ignored.

    Written as plain IS NOT NULL tests, which reach the scan.
    """
    for name in columns:
        if name in df.columns:
            df = df.filter(ref(name).isNotNull())
            if isinstance(df.schema[name].dataType, FRACTIONAL):
                df = df.filter(~F.isnan(ref(name)))
    return df


def fill_nulls(
    df: DataFrame,
    strings: str | None = None,
    numbers: str | float | None = None,
    dates: str | None = None,
    booleans: str | bool | None = None,
    skip: Sequence[str] = (),
    date_format: str = DATE_FORMATS[0],
    timestamp_format: str = TIMESTAMP_FORMATS[0],
) -> DataFrame:
    """Fill missing values by the kind of column, all in one projection.

    NaN is filled like NULL. ``dates`` may be ``current_timestamp``. A fill value that does not
    fit a column leaves the column as it is, with a warning. Whole numbers keep all their digits. ``skip`` and
    audit columns are left alone.
    """
    number = None
    if numbers is not None:
        try:
            number = _number(numbers)
        except ValueError:
            warnings.warn(f"not a number, numeric columns are not filled: {numbers!r}")
    filled = {}
    for field in df.schema.fields:
        name, kind, c = field.name, field.dataType, ref(field.name)
        if name in skip or name in AUDIT_COLUMNS:
            continue
        if isinstance(kind, T.StringType) and strings is not None:
            filled[name] = F.coalesce(c, F.lit(strings))
        elif isinstance(kind, T.NumericType) and number is not None:
            filled[name] = F.coalesce(nan_to_null(c, kind), F.lit(number).try_cast(kind), c)
        elif isinstance(kind, TEMPORAL) and dates is not None:
            moment = _moment(dates, kind, date_format, timestamp_format)
            # A constant: Spark folds it without a job.
            if df.sparkSession.sql("SELECT 1").select(moment.isNull()).first()[0]:
                warnings.warn(f"{dates!r} is no {kind.simpleString()}, NULL stays in {name}")
            filled[name] = F.coalesce(c, moment)
        elif isinstance(kind, T.BooleanType) and booleans is not None:
            filled[name] = F.coalesce(c, F.lit(str(booleans).lower() == "true"))
    return df.withColumns(filled) if filled else df


def _number(value: str | float) -> int | float | Decimal:
    """A whole number with all its digits, or a double."""
    try:
        whole = int(str(value))
    except ValueError:
        return float(value)
    return whole if abs(whole) < 2**63 else Decimal(whole)


def _moment(text: str, kind: T.DataType, date_format: str, timestamp_format: str) -> Column:
    if text.lower() == "current_timestamp":
        value = F.current_timestamp()
    elif isinstance(kind, T.DateType):
        value = F.try_to_date(F.lit(text), date_format)
    else:
        value = F.try_to_timestamp(F.lit(text), F.lit(timestamp_format))
    return value.cast(kind)
