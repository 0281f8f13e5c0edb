"""String cleaning of every top-level text column in one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions import text
from ..functions.columns import columns_of_type, ref


def clean_strings(
    df: DataFrame,
    trim: bool = True,
    collapse: bool = True,
    case: str = "none",
    alnum_columns: Sequence[str] = (),
) -> DataFrame:
    """Trim spaces, collapse white space, set the case, then drop other characters where asked."""
    if case not in text.CASES:
        raise ValueError(f"unknown case mode: {case}")
    cleaned = {}
    for name in columns_of_type(df, T.StringType):
        value = ref(name)
        if trim:
            value = text.trim_spaces(value)
        if collapse:
            value = text.collapse_whitespace(value)
        value = text.CASES[case](value)
        if name in alnum_columns:
            value = text.keep_alphanumeric(value)
        cleaned[name] = value
    return df.withColumns(cleaned) if cleaned else df
