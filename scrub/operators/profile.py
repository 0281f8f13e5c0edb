"""Column profiles: one row per column, a fixed number of jobs whatever the width of the table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import TEMPORAL, quoted, ref, rows_from_one
from ..functions.hashing import short_key
from .quantiles import approx_quantiles, quantiles

QUARTILES = (0.25, 0.5, 0.75)
KEY_KINDS = ("long", "double", "string")
NUMERIC_KINDS = ("whole", "decimal", "float", "double")


def _for_kinds(sql: str, *kinds: str) -> str:
    names = ", ".join(f"'{k}'" for k in kinds)
    return f"CASE WHEN kind IN ({names}) THEN {sql} END"


def _number(sql: str) -> str:
    return _for_kinds(sql, *NUMERIC_KINDS)


def _value(end: str, exact: str) -> str:
    """Smallest or largest number as text, so that large integers and decimals keep all digits."""
    return f"""CASE kind WHEN 'whole' THEN CAST({end}_long AS STRING) WHEN 'decimal' THEN {exact}
    WHEN 'float' THEN CAST(CAST({end}_double AS FLOAT) AS STRING)
    WHEN 'double' THEN CAST({end}_double AS STRING) END"""


def _part(one: str) -> str:
    return _for_kinds(f"CASE WHEN yes + no > 0 THEN {one} / (yes + no) * 100 ELSE 0D END", "boolean")


# Output columns after the common ones, in order, as SQL over what the aggregates found. Statistics
# of other kinds of columns are NULL.
STATISTICS = {
    "min_length": "shortest",
    "max_length": "longest",
    "avg_length": _for_kinds("coalesce(round(usual_length, 2), 0D)", "text"),
    "empty_string_count": _for_kinds("empty", "text"),
    "whitespace_only_count": _for_kinds("blank", "text"),
    "min_value": _value("min", "least"),
    "max_value": _value("max", "most"),
    "mean": _number("coalesce(round(average, 4), 0D)"),
    "std_dev": _number("coalesce(round(sqrt(spread), 4), 0D)"),
    "variance": _number("coalesce(round(spread, 4), 0D)"),
    "q1": "quartiles[0]",
    "median": "quartiles[1]",
    "q3": "quartiles[2]",
    "zero_count": _number("zeros"),
    "negative_count": _number("negatives"),
    "nan_count": _number("nans"),
    "min_date": _for_kinds("least", "time"),
    "max_date": _for_kinds("most", "time"),
    "date_range_days": _for_kinds("coalesce(days, 0L)", "time"),
    "true_count": _for_kinds("yes", "boolean"),
    "false_count": _for_kinds("no", "boolean"),
    "true_percentage": _part("yes"),
    "false_percentage": _part("no"),
}
COUNTS = [
    "total_records", "known", "empty", "blank", "zeros", "negatives", "nans", "yes", "no",
    "unique_count",
]
COMMON = (
    "column_name", "ordinal", "data_type", "total_records", "null_count", "null_percentage",
    "unique_count", "uniqueness_percentage",
)


def table_profile(df: DataFrame) -> DataFrame:
    """One row: number of records and of columns."""
    return df.agg(F.count(F.lit(1)).alias("total_records")).withColumn(
        "total_columns", F.lit(len(df.columns))
    )


def profile(
    df: DataFrame,
    exact_quantiles: bool = False,
    relative_error: float = 0.01,
    approx_distinct: bool = False,
) -> DataFrame:
    """Profile every column.

    A few aggregates over the table, which can run side by side, whatever its width: counts and
    moments of all columns, extremes of those that have no common type, quartiles, and distinct
    values (NULL is one of them), which ``approx_distinct`` estimates without moving values around.
    All but the quartiles and extremes unfold the table into (column, value) pairs and so stay a
    few expressions: one aggregate over many columns is code too large for the JVM to compile.
    Statistics of other kinds of columns are NULL. NaN takes no part in numeric statistics; it is
    counted in ``nan_count``.
    """
    fields = df.schema.fields
    kinds = [kind_of(f.dataType) for f in fields]
    # Every part has at most one row per column of the profiled table.
    parts = [
        _statistics(df, kinds),
        _extremes(df, kinds),
        _quartiles(df, kinds, exact_quantiles, relative_error),
        approx_distinct_counts(df) if approx_distinct else distinct_counts(df),
    ]
    listed = df.sparkSession.range(len(kinds)).selectExpr("CAST(id AS INT) AS ordinal")
    joined = reduce(lambda a, b: a.join(b, "ordinal", "left"), parts, listed)
    return present(joined, df.schema)


def present(joined: DataFrame, schema: T.StructType) -> DataFrame:
    """A profile from what was measured by ordinal of the columns."""
    fields = schema.fields
    kinds = [kind_of(f.dataType) for f in fields]
    # The columns of an empty table have no counts to join.
    joined = joined.fillna(0, COUNTS)
    place = F.col("ordinal") + 1
    named = joined.withColumns(
        {
            "column_name": F.element_at(F.lit([f.name for f in fields]), place),
            "data_type": F.element_at(F.lit([f.dataType.simpleString() for f in fields]), place),
            "kind": F.element_at(F.lit(kinds), place),
            "null_count": F.expr("total_records - known"),
        }
    ).withColumns(
        {
            "null_percentage": _share("null_count"),
            "uniqueness_percentage": _share("unique_count"),
        }
    )
    return named.select(
        *COMMON, *[F.expr(sql).alias(name) for name, sql in STATISTICS.items()]
    )


def _share(part: str) -> Column:
    total = F.col("total_records")
    return F.when(total > 0, F.col(part) / total * 100).otherwise(F.lit(0.0))


def kind_of(kind: T.DataType) -> str:
    for name, types in (
        ("text", T.StringType), ("decimal", T.DecimalType), ("float", T.FloatType),
        ("double", T.DoubleType), ("whole", T.NumericType), ("time", TEMPORAL),
        ("boolean", T.BooleanType),
    ):
        if isinstance(kind, types):
            return name
    return "other"


def _unfold(df: DataFrame, cells: list[tuple[Column, Column, Column]]) -> DataFrame:
    """(ordinal, long, double, string) for every column of every row; see ``_cell``."""
    flat = [x for i, cell in enumerate(cells) for x in (F.lit(i), *cell)]
    return df.select(F.stack(F.lit(len(cells)), *flat).alias("ordinal", *KEY_KINDS))


def _cell(**values: Column) -> tuple[Column, Column, Column]:
    return tuple(values[k] if k in values else F.lit(None).cast(k) for k in KEY_KINDS)


def cell_of(c: Column, kind: str) -> tuple[Column, Column, Column]:
    """What the statistics of a column look at; a column of no particular kind is only counted."""
    if kind == "text":
        return _cell(string=c)
    if kind == "whole":
        return _cell(long=c.cast("long"), double=c.cast("double"))
    if kind in ("decimal", "float", "double"):
        return _cell(double=c.cast("double"))
    if kind == "boolean":
        return _cell(long=c.cast("long"))
    return _cell(long=F.when(c.isNotNull(), F.lit(1).cast("long")))


def _statistics(df: DataFrame, kinds: list[str]) -> DataFrame:
    """Counts and moments by ordinal. One aggregate of a few expressions, however wide the table."""
    pairs = _unfold(df, [cell_of(ref(c), k) for c, k in zip(df.columns, kinds)])
    pairs = pairs.withColumn("v", F.nanvl("double", F.lit(None).cast("double")))
    aggregates = {
        "total_records": "count(1)",
        "known": "count_if(long IS NOT NULL OR double IS NOT NULL OR string IS NOT NULL)",
        "shortest": "min(length(string))",
        "longest": "max(length(string))",
        "usual_length": "avg(length(string))",
        "empty": "count_if(string = '')",
        "blank": "count_if(NOT string RLIKE r'\\S')",
        "min_long": "min(long)",
        "max_long": "max(long)",
        "min_double": "min(v)",
        "max_double": "max(v)",
        "average": "avg(v)",
        "spread": "var_samp(v)",
        "zeros": "count_if(v = 0)",
        "negatives": "count_if(v < 0)",
        "nans": "count_if(isnan(double))",
        "yes": "count_if(long = 1)",
        "no": "count_if(long = 0)",
    }
    return pairs.groupBy("ordinal").agg(*[F.expr(x).alias(n) for n, x in aggregates.items()])


def _extremes(df: DataFrame, kinds: list[str]) -> DataFrame:
    """(ordinal, least, most, days) of decimals and times, which have no common type to unfold to."""
    aggregates, rows = [], []
    for i, kind in enumerate(kinds):
        if kind in ("decimal", "time"):
            c = quoted(df.columns[i])
            aggregates += [f"min({c}) AS lo{i}", f"max({c}) AS hi{i}"]
            days = f"timestampdiff(DAY, lo{i}, hi{i})" if kind == "time" else "CAST(NULL AS LONG)"
            rows.append(
                f"struct({i} AS ordinal, CAST(lo{i} AS STRING) AS least, "
                f"CAST(hi{i} AS STRING) AS most, {days} AS days)"
            )
    if not rows:
        return df.sparkSession.createDataFrame(
            [], "ordinal int, least string, most string, days long"
        )
    return df.selectExpr(*aggregates).selectExpr(f"inline(array({', '.join(rows)}))")


def _quartiles(
    df: DataFrame, kinds: list[str], exact: bool, relative_error: float
) -> DataFrame:
    """(ordinal, quartiles) of the numeric columns."""
    places = [i for i, kind in enumerate(kinds) if kind in NUMERIC_KINDS]
    columns = [df.columns[i] for i in places]
    if exact or not places:
        found = quantiles(df, columns, QUARTILES, exact=True)
        return df.sparkSession.createDataFrame(
            [(i, found[c] and [float(x) for x in found[c]]) for i, c in zip(places, columns)],
            "ordinal int, quartiles array<double>",
        )
    return approx_quantiles(df, columns, QUARTILES, relative_error).select(
        F.element_at(F.lit(places), F.col("place") + 1).alias("ordinal"),
        F.col("found").alias("quartiles"),
    )


def distinct_key(c: Column, kind: T.DataType) -> tuple[str, Column]:
    """One of the key kinds, and a key of that kind that is equal only for equal values.

    Long texts shrink to a hash, so the shuffle carries short keys however long the texts are.
    """
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return "long", c.cast("long")
    if isinstance(kind, T.DateType):
        return "long", F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampType):
        return "long", F.unix_micros(c)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "double", c.cast("double")
    if isinstance(kind, T.StringType):
        text = c
    elif isinstance(kind, T.BinaryType):
        text = F.hex(c)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(c)
    else:
        text = c.cast("string")
    return "string", short_key(text)


def distinct_counts(df: DataFrame) -> DataFrame:
    """(ordinal, unique_count) for every column; NULL counts as one value.

    Rows are unfolded into one (column, value) pair per column, which an aggregate makes distinct:
    repeated values collapse before the shuffle, so a value that fills a third of a column costs
    one pair per task.
    """
    keys = [distinct_key(ref(f.name), f.dataType) for f in df.schema.fields]
    pairs = _unfold(df, [_cell(**{kind: key}) for kind, key in keys])
    return pairs.distinct().groupBy("ordinal").agg(F.count(F.lit(1)).alias("unique_count"))


def approx_distinct_counts(df: DataFrame) -> DataFrame:
    """(ordinal, unique_count) estimated within five percent, in one aggregate without a shuffle of
    values."""
    counts, rows = [], []
    for i, field in enumerate(df.schema.fields):
        c = ref(field.name)
        estimate = F.approx_count_distinct(distinct_key(c, field.dataType)[1])
        counts.append((estimate + F.max(c.isNull().cast("long"))).alias(f"u{i}"))
        rows.append({"ordinal": F.lit(i), "unique_count": F.coalesce(f"u{i}", F.lit(0))})
    return rows_from_one(df.agg(*counts), rows)


def column_metrics(profiled: DataFrame) -> DataFrame:
    """A profile as one row holding one map from column name to its statistics."""
    body = [c for c in profiled.columns if c not in ("column_name", "ordinal")]
    entry = F.struct(F.col("column_name"), F.struct(*[F.col(c) for c in body]))
    return profiled.agg(F.map_from_entries(F.collect_list(entry)).alias("column_metrics"))
