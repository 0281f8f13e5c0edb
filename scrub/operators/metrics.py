"""Quality scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import data_columns, missing_cells
from .dedup import dedup_counts, distinct_rows

# Weights of the overall score.
COMPLETENESS_WEIGHT, CONSISTENCY_WEIGHT, VALIDITY_WEIGHT = 0.4, 0.3, 0.3


def percent(part: Column, whole: Column, when_empty: float = 100.0) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(when_empty))


def completeness(df: DataFrame) -> DataFrame:
    """One row: records, cells, missing cells and the share of cells that hold a value.

    NaN is missing, audit columns do not count, an empty table is complete.
    """
    width = len(data_columns(df))
    counted = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(F.sum(missing_cells(df)), F.lit(0)).alias("missing_cells"),
    )
    cells = F.col("total_records") * width
    return counted.select(
        "total_records",
        cells.alias("total_cells"),
        "missing_cells",
        percent(cells - F.col("missing_cells"), cells).alias("completeness_score"),
    )


def consistency(df: DataFrame) -> DataFrame:
    """One row: records, distinct records and their share; audit columns do not count."""
    counted = dedup_counts(df, data_columns(df))
    return counted.select(
        "total_records",
        "distinct_records",
        percent(F.col("distinct_records"), F.col("total_records")).alias("consistency_score"),
    )


def validity_score(total: Column, failures: Column) -> Column:
    """Share of records without a failure, kept within 0 and 100."""
    score = percent(total - failures, total)
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))


def overall_score(completeness_: Column, consistency_: Column, validity_: Column) -> Column:
    return (
        completeness_ * COMPLETENESS_WEIGHT
        + consistency_ * CONSISTENCY_WEIGHT
        + validity_ * VALIDITY_WEIGHT
    )


def scores(df: DataFrame) -> DataFrame:
    """One row: records, completeness and consistency, out of a single grouping of the rows.

    Copies of a row miss the same cells, so missing cells are counted once per distinct row.
    """
    columns = data_columns(df)
    per_row = distinct_rows(df, columns)
    missing = missing_cells(per_row, columns)
    counted = per_row.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_records"),
        F.count(F.lit(1)).alias("distinct_records"),
        F.coalesce(F.sum(missing * F.col("copies")), F.lit(0)).alias("missing_cells"),
    )
    cells = F.col("total_records") * len(columns)
    return counted.select(
        "total_records",
        percent(cells - F.col("missing_cells"), cells).alias("completeness_score"),
        percent(F.col("distinct_records"), F.col("total_records")).alias("consistency_score"),
    )


def before_after(before: DataFrame, after: DataFrame, failures: Column | int = 0) -> DataFrame:
    """All scores of the raw and of the cleaned table, one row each.

    ``failures`` is how many records of the raw table broke a rule; the cleaned one holds none of them.
    """
    stages = []
    for stage, df, broken in (("before", before, failures), ("after", after, 0)):
        broken = broken if isinstance(broken, Column) else F.lit(broken)
        validity = validity_score(F.col("total_records"), broken)
        scored = scores(df).select(F.lit(stage).alias("stage"), "*", validity.alias("validity_score"))
        overall = overall_score(
            F.col("completeness_score"), F.col("consistency_score"), F.col("validity_score")
        )
        stages.append(scored.withColumn("overall_quality_score", overall))
    return stages[0].unionByName(stages[1])
