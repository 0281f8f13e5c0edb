"""Type conversion that never fails on a value, type inference and the conversion report."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse
from ..functions.columns import columns_of_type, ref, rows_from_one

# Accepted names of the primitive targets.
INTEGER_NAMES = {"int": "int", "integer": "int", "long": "bigint", "bigint": "bigint"}
FLOAT_NAMES = {"float": "float", "real": "float", "double": "double", "float8": "double"}
DECIMAL_NAMES = ("decimal", "numeric")

# A column is inferred to have a type when more than this share of its values has.
BOOLEAN_SHARE = 0.95
NUMERIC_SHARE = 0.95
INTEGER_SHARE = 0.98
TIMESTAMP_SHARE = 0.90
DATE_SHARE = 0.90

# Fixed value: explicit conversions that keep less than this share of the values are reported.
LOW_SUCCESS = 0.8


@dataclass(frozen=True)
class ConvertOptions:
    date_formats: Sequence[str] = parse.DATE_FORMATS
    timestamp_formats: Sequence[str] = parse.TIMESTAMP_FORMATS
    precision: int = 38
    scale: int = 10
    overflow: str = "truncate"


@dataclass(frozen=True)
class Conversion:
    """What happens to one column; ``error`` is set when the target cannot be applied to it."""

    column: str
    target: str
    inferred: bool
    value: Column | None = None
    error: str | None = None


def target_type(target: str, options: ConvertOptions) -> T.DataType | None:
    """The Spark type a target name stands for, or None when it is not a type."""
    name = target.strip().lower()
    if name in DECIMAL_NAMES:
        return T.DecimalType(options.precision, options.scale)
    name = INTEGER_NAMES.get(name) or FLOAT_NAMES.get(name) or name
    try:
        return T.DataType.fromDDL(name)
    except PySparkException:
        return None


def same_type(current: T.DataType, target: str, options: ConvertOptions) -> bool:
    """True when a column already has the target type; a zone-less timestamp is a timestamp."""
    name = target.strip().lower()
    if name in DECIMAL_NAMES:
        return isinstance(current, T.DecimalType)
    if name == "timestamp":
        return isinstance(current, (T.TimestampType, T.TimestampNTZType))
    return target_type(target, options) == current


def _as_text(c: Column, kind: T.DataType) -> Column:
    return c if isinstance(kind, T.StringType) else c.cast("string")


def conversion_value(
    c: Column, kind: T.DataType, target: str, options: ConvertOptions, inferred: bool = False
) -> Column:
    """Expression that converts ``c`` of type ``kind``.

    Inferred numbers may hold thousands commas, because inference looked past them; numbers asked
    for by name may not.
    """
    name = target.strip().lower()
    is_text = isinstance(kind, T.StringType)
    if inferred and is_text and (name in INTEGER_NAMES or name in DECIMAL_NAMES):
        c = parse.without_commas(c)
    if name == "date":
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return c.try_cast("date")
        return parse.parse_date(_as_text(c, kind), options.date_formats)
    if name == "timestamp":
        if isinstance(kind, T.DateType):
            return c.try_cast("timestamp")
        return parse.parse_timestamp(_as_text(c, kind), options.timestamp_formats)
    if name == "boolean":
        return parse.parse_boolean(_as_text(c, kind))
    if name in DECIMAL_NAMES:
        return parse.parse_decimal(c, options.precision, options.scale, options.overflow)
    if name in INTEGER_NAMES:
        integer = INTEGER_NAMES[name]
        if inferred and is_text:
            # "1e3" and "7.0" were counted as whole numbers, so read them as such.
            return F.coalesce(c.try_cast(integer), c.try_cast("decimal(38,10)").try_cast(integer))
        return parse.parse_integer(c, integer) if is_text else c.try_cast(integer)
    if name in FLOAT_NAMES:
        return c.try_cast(FLOAT_NAMES[name])
    if re.fullmatch(r"decimal\(\s*\d+\s*\)", name):
        return c.try_cast(T.DecimalType(options.precision, options.scale))
    return c.try_cast(target)


def plan_conversions(
    df: DataFrame,
    mapping: Mapping[str, str],
    inferred: Mapping[str, str] | None = None,
    options: ConvertOptions = ConvertOptions(),
) -> list[Conversion]:
    """One entry per column that is to change. Analyses the expressions and runs nothing, but for the
    overflow policy ``string``: whether a column stays decimal or turns into text is known after one
    aggregate over the columns mapped to decimal.
    """
    plan = []
    for field in df.schema.fields:
        explicit = mapping.get(field.name)
        target = explicit or (inferred or {}).get(field.name)
        if not target or same_type(field.dataType, target, options):
            continue
        plan.append(_conversion(df, field, target, not explicit, options))
    return _keep_decimals_that_fit(df, _analysed(df, plan), options)


def _conversion(
    df: DataFrame, field: T.StructField, target: str, inferred: bool, options: ConvertOptions
) -> Conversion:
    try:
        value = conversion_value(ref(field.name), field.dataType, target, options, inferred)
    except PySparkException as problem:
        return _failed(Conversion(field.name, target, inferred), problem)
    return Conversion(field.name, target, inferred, value)


def _analysed(df: DataFrame, plan: list[Conversion]) -> list[Conversion]:
    """Mark the conversions that do not fit their column. Mostly all do: one look at all first."""
    def fits(conversions: list[Conversion]) -> PySparkException | None:
        try:
            df.select(*[p.value for p in conversions]).schema
        except PySparkException as problem:
            return problem
        return None

    hopeful = [p for p in plan if p.value is not None]
    if not hopeful or fits(hopeful) is None:
        return plan
    checked = []
    for p in plan:
        problem = None if p.value is None else fits([p])
        checked.append(p if problem is None else _failed(p, problem))
    return checked


def _failed(p: Conversion, problem: Exception) -> Conversion:
    return Conversion(p.column, p.target, p.inferred, error=str(problem).splitlines()[0])


def _keep_decimals_that_fit(
    df: DataFrame, plan: list[Conversion], options: ConvertOptions
) -> list[Conversion]:
    """Under the ``string`` policy only columns with values that do not convert turn into text."""
    doubtful = [
        p for p in plan
        if options.overflow == "string" and p.value is not None
        and p.target.strip().lower() in DECIMAL_NAMES
    ]
    if not doubtful:
        return plan
    strict = ConvertOptions(
        options.date_formats, options.timestamp_formats, options.precision, options.scale, "null"
    )
    values = {
        p.column: conversion_value(
            ref(p.column), df.schema[p.column].dataType, p.target, strict, p.inferred
        )
        for p in doubtful
    }
    lost = df.agg(
        *[
            F.count_if(ref(name).isNotNull() & value.isNull()).alias(f"lost_{i}")
            for i, (name, value) in enumerate(values.items())
        ]
    ).first()
    fits = {name: values[name] for name, n in zip(values, lost) if n == 0}
    return [
        Conversion(p.column, p.target, p.inferred, fits[p.column]) if p.column in fits else p
        for p in plan
    ]


def apply_conversions(df: DataFrame, plan: Sequence[Conversion]) -> DataFrame:
    """All conversions in one projection; columns whose conversion failed stay as they were."""
    values = {p.column: p.value for p in plan if p.value is not None}
    return df.withColumns(values) if values else df


def convert_types(
    df: DataFrame,
    mapping: Mapping[str, str] | None = None,
    infer: bool = True,
    options: ConvertOptions = ConvertOptions(),
) -> DataFrame:
    """Convert the mapped columns; infer and convert the text columns that are not mapped.

    Mapping a text column to ``string`` keeps it out of inference. With ``infer`` one aggregate
    over the unmapped text columns runs at once, as the result's schema depends on it.
    """
    mapping = mapping or {}
    inferred = infer_mapping(df, tuple(mapping), options) if infer else {}
    return apply_conversions(df, plan_conversions(df, mapping, inferred, options))


def conversion_report(
    df: DataFrame,
    mapping: Mapping[str, str] | None = None,
    inferred: Mapping[str, str] | None = None,
    options: ConvertOptions = ConvertOptions(),
) -> DataFrame:
    """One row per converted column: values before and after, success rate, low-success mark.

    All counts come from one aggregate.
    """
    plan = plan_conversions(df, mapping or {}, inferred, options)
    if not plan:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    counted = df.agg(*counts_before(plan), *counts_after(plan, converted=False))
    return report_of(counted, plan)


def counts_before(plan: Sequence[Conversion]) -> list[Column]:
    """Aggregates over the table before conversion: values of the i-th converted column as ``b<i>``."""
    return [F.count(ref(p.column)).alias(f"b{i}") for i, p in enumerate(plan)]


def counts_after(plan: Sequence[Conversion], converted: bool = True) -> list[Column]:
    """The same as ``a<i>`` of the converted table, or of the table before by converting in place."""
    return [
        F.count(ref(p.column) if converted or p.value is None else p.value).alias(f"a{i}")
        for i, p in enumerate(plan)
    ]


def report_of(counted: DataFrame, plan: Sequence[Conversion]) -> DataFrame:
    """The conversion report from one row of the counts before and after."""
    rows = []
    for i, p in enumerate(plan):
        before, kept = F.col(f"b{i}"), F.col(f"a{i}")
        rate = F.when(before > 0, kept / before).otherwise(F.lit(1.0))
        rows.append(
            {
                "column_name": F.lit(p.column),
                "target_type": F.lit(p.target),
                "inferred": F.lit(p.inferred),
                "failed": F.lit(p.error is not None),
                "before_count": before,
                "after_count": kept,
                "success_rate": rate,
                "low_success": (rate < LOW_SUCCESS) & F.lit(not p.inferred),
                "error": F.lit(p.error).cast("string"),
            }
        )
    return rows_from_one(counted, rows)


REPORT_SCHEMA = (
    "column_name string, target_type string, inferred boolean, failed boolean, "
    "before_count long, after_count long, success_rate double, low_success boolean, error string"
)

COUNTS_SCHEMA = (
    "column_name string, non_null_count long, boolean_count long, numeric_count long, "
    "integer_count long, decimal_count long, timestamp_count long, date_count long"
)


def infer_shares(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    options: ConvertOptions = ConvertOptions(),
) -> DataFrame:
    """``_shares`` without what only inference needs."""
    return _shares(type_counts(df, columns, options)).drop("decimal_share")


def _spread(df: DataFrame) -> DataFrame:
    """The rows over all cores, if they come in fewer files: a file may be a single row group, which one task reads."""
    files = len(df.inputFiles())
    return df.repartition(F.rand(0)) if 0 < files < df.sparkSession.sparkContext.defaultParallelism else df


PROBES = ("boolean", "numeric", "integer", "decimal", "timestamp", "date")


def type_counts(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    options: ConvertOptions = ConvertOptions(),
) -> DataFrame:
    """One row per text column: how many of its non-null values read as which type.

    Looks at all values of all columns in one aggregate; nothing is sampled. The columns are
    unfolded into (column, value) pairs, so the probes are one piece of code however wide the
    table is. Counts of parts of a table add up (``add_type_counts``). A table in fewer files than
    there are cores is dealt out to all of them first.
    """
    text_columns = columns_of_type(df, T.StringType)
    wanted = text_columns if columns is None else [c for c in text_columns if c in columns]
    spark = df.sparkSession
    if not wanted:
        return spark.createDataFrame([], COUNTS_SCHEMA)
    cells = [x for i, name in enumerate(wanted) for x in (F.lit(i), ref(name))]
    rows = _spread(df.select(*[ref(name) for name in wanted]))
    pairs = rows.select(F.stack(F.lit(len(wanted)), *cells).alias("place", "value"))
    c, size, shape = F.col("value"), F.col("size"), F.col("shape")
    formats = (*options.timestamp_formats, *options.date_formats)
    # Each step is worked out once per value, before the probes that share it.
    pairs = pairs.select("place", "value", parse.is_number(c).alias("number"), parse.shape_of(c, *formats).alias("shape"))
    pairs = pairs.withColumn("size", F.when(F.col("number"), parse.without_commas(c).try_cast("double")))
    probes = {
        "boolean": parse.boolean_word(c),
        "numeric": F.col("number"),
        "integer": parse.is_whole(size),
        "decimal": parse.is_within(size, options.precision, options.scale),
        "timestamp": parse.has_reading(c, options.timestamp_formats, shape),
        "date": parse.has_reading(c, options.date_formats, shape),
    }
    counted = pairs.groupBy("place").agg(
        F.count(c).alias("n"), *[F.count_if(probes[key]).alias(key) for key in PROBES]
    )
    # The columns of an empty table have no pairs, but are listed all the same.
    listed = spark.range(len(wanted)).select(F.col("id").cast("int").alias("place"))
    name = F.element_at(F.lit(wanted), F.col("place") + 1)
    return listed.join(counted, "place", "left").select(
        name.alias("column_name"),
        *[F.coalesce(k, F.lit(0)).alias(f"{v}_count") for k, v in (("n", "non_null"), *zip(PROBES, PROBES))],
    )


def add_type_counts(parts: DataFrame) -> DataFrame:
    """The counts of a table from those of its parts: sums, so neither order nor split matters."""
    counts = [f"{k}_count" for k in ("non_null", *PROBES)]
    return parts.groupBy("column_name").agg(*[F.sum(c).alias(c) for c in counts])


def _shares(counts: DataFrame) -> DataFrame:
    """Per column the share of its non-null values that reads as each type."""
    size = F.col("non_null_count")
    return counts.select(
        "column_name",
        size,
        *[F.when(size > 0, F.col(f"{k}_count") / size).otherwise(F.lit(0.0)).alias(f"{k}_share") for k in PROBES],
    )


def infer_types(
    df: DataFrame,
    skip: Sequence[str] = (),
    options: ConvertOptions = ConvertOptions(),
) -> DataFrame:
    """One row per text column not skipped: the type its values suggest.

    Tried in this order: boolean, long, decimal, timestamp, date. Nothing found, or no values at
    all: string. So a 0/1 column becomes boolean and a yyyyMMdd column becomes long; map such a
    column by name, or to ``string``, to say otherwise.
    """
    columns = [c for c in columns_of_type(df, T.StringType) if c not in skip]
    return types_of_counts(type_counts(df, columns, options))


def types_of_counts(counts: DataFrame) -> DataFrame:
    """(column_name, inferred_type) that the counts of whole columns suggest."""
    numeric = F.col("numeric_share") > NUMERIC_SHARE
    suggested = (
        F.when(F.col("boolean_share") > BOOLEAN_SHARE, "boolean")
        .when(numeric & (F.col("integer_share") > INTEGER_SHARE), "long")
        .when(F.col("decimal_share") > NUMERIC_SHARE, "decimal")
        .when(F.col("timestamp_share") > TIMESTAMP_SHARE, "timestamp")
        .when(F.col("date_share") > DATE_SHARE, "date")
        .otherwise("string")
    )
    return _shares(counts).select("column_name", suggested.alias("inferred_type"))


# What holds the values of both; any other pair of different types only meets in string.
WIDER = {frozenset(("long", "decimal")): "decimal", frozenset(("date", "timestamp")): "timestamp"}


def wider_type(one: str | None, other: str | None) -> str | None:
    """The narrowest inferred type that holds the values of both; None is the type of no values.

    Commutative, associative and idempotent, so the join of many types has no order.
    """
    if one is None or other is None or one == other:
        return other if one is None else one
    return WIDER.get(frozenset((one, other)), "string")


def infer_mapping(
    df: DataFrame, skip: Sequence[str] = (), options: ConvertOptions = ConvertOptions()
) -> dict[str, str]:
    """Inferred types by column name. Runs one job; its result has one row per column."""
    found = infer_types(df, skip, options).collect()
    return {r.column_name: r.inferred_type for r in found if r.inferred_type != "string"}
