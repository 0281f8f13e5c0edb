"""Outlier flags. Rows stay; every numeric column gains a boolean column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null, numeric_columns, ref
from .quantiles import EXACT_VALUES, quantiles

# Quantiles of the two quantile methods and the width of the IQR fence.
IQR_QUANTILES = (0.25, 0.75)
IQR_WIDTH = 1.5
TAIL_QUANTILES = (0.01, 0.99)
METHODS = ("iqr", "zscore", "isolation")


@dataclass(frozen=True)
class Limits:
    """Values below ``low`` or above ``high``, or scores above ``threshold``, are far from the rest."""

    low: float | None = None
    high: float | None = None
    mean: float | None = None
    deviation: float | None = None
    threshold: float = 3.0

    def flag(self, name: str) -> Column:
        value = ref(name)
        if self.mean is None:
            return (value < F.lit(self.low)) | (value > F.lit(self.high))
        score = F.abs((value.cast("double") - F.lit(self.mean)) / F.lit(self.deviation))
        return score > F.lit(float(self.threshold))


def limits_of(
    method: str,
    threshold: float = 3.0,
    mean: float | None = None,
    deviation: float | None = None,
    quantiles_: Sequence[float] | None = None,
) -> Limits | None:
    """The limits of a column by what is known of it, or None."""
    if method not in METHODS:
        raise ValueError(f"unknown outlier method: {method}")
    if method == "zscore":
        if deviation is None or not deviation > 0:
            return None
        return Limits(mean=mean, deviation=deviation, threshold=threshold)
    if quantiles_ is None or quantiles_[0] is None:
        return None
    low, high = quantiles_
    if method == "iqr":
        low, high = float(low), float(high)
        low, high = low - IQR_WIDTH * (high - low), high + IQR_WIDTH * (high - low)
    return Limits(low, high)


def flag_outliers(
    df: DataFrame,
    method: str = "iqr",
    threshold: float = 3.0,
    columns: Sequence[str] | None = None,
    exact: bool = False,
    relative_error: float | None = None,
    exact_values: int = EXACT_VALUES,
    limits: Mapping[str, Limits] | None = None,
) -> DataFrame:
    """Add ``{column}_outlier_{method}``: true for values far from the rest, false for NULL.

    ``iqr``: outside the quartiles by 1.5 times their distance. ``zscore``: more than ``threshold``
    sample standard deviations from the mean; no flag for a column whose deviation is zero or
    undefined. ``isolation``: outside the 1 % and 99 % quantiles. ``relative_error`` is that of the
    quantiles, 0.01 for ``iqr`` and 0.001 for ``isolation`` unless given.

    The limits of all columns come from one aggregate that runs at once (a few for ``exact``): two
    numbers per column, which also decide which flags exist. The flags are plain comparisons. With
    ``limits`` given, such as those of a larger table (``part_limits``), nothing runs.
    """
    if limits is None:
        wanted = numeric_columns(df) if columns is None else list(columns)
        limits = measured_limits(df, wanted, method, threshold, exact, relative_error, exact_values)
    named = {
        f"{c}_outlier_{method}": F.coalesce(own.flag(c), F.lit(False)) for c, own in limits.items()
    }
    return df.withColumns(named) if named else df


def measured_limits(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "iqr",
    threshold: float = 3.0,
    exact: bool = False,
    relative_error: float | None = None,
    exact_values: int = EXACT_VALUES,
) -> dict[str, Limits]:
    """The limits of the columns that have some, by name. Runs at once."""
    if method == "zscore":
        found = {
            c: limits_of(method, threshold, mean, deviation)
            for c, (mean, deviation) in _moments(df, columns).items()
        }
    elif method in ("iqr", "isolation"):
        shares, usual = (IQR_QUANTILES, 0.01) if method == "iqr" else (TAIL_QUANTILES, 0.001)
        error = usual if relative_error is None else relative_error
        known = quantiles(df, columns, shares, error, exact, exact_values)
        found = {c: limits_of(method, threshold, quantiles_=q) for c, q in known.items()}
    else:
        raise ValueError(f"unknown outlier method: {method}")
    return {c: own for c, own in found.items() if own is not None}


def _moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    if not columns:
        return {}
    aggs = []
    for i, name in enumerate(columns):
        value = nan_to_null(ref(name), df.schema[name].dataType).cast("double")
        aggs += [F.avg(value).alias(f"m{i}"), F.stddev(value).alias(f"s{i}")]
    stats = df.agg(*aggs).first()
    return {name: (stats[f"m{i}"], stats[f"s{i}"]) for i, name in enumerate(columns)}
