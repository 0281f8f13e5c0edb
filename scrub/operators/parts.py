"""Column statistics that add up: each part of a table is measured once, and parts are merged at any time.

A part keeps, for every column, counts, extremes, the mean and the sum of squares around it, a quantile sketch
and a sketch of its distinct values: one row per column and part, however long the part is. Merged parts
give the profile of the whole table and the limits of outliers. Counts, extremes and moments are those of
one run; quantiles are off in rank by at most ``RANK_ERROR``, distinct counts have a standard error of 1.2 %,
whatever the number of parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.columns import ref, rows_from_one
from .outliers import IQR_QUANTILES, TAIL_QUANTILES, Limits, limits_of
from .profile import KEY_KINDS, NUMERIC_KINDS, QUARTILES, cell_of, distinct_key, kind_of, present

#: Size of the quantile sketches, and the error in rank that it keeps with 99 % confidence.
SKETCH_SIZE, RANK_ERROR = 800, 0.004
#: Size of the sketches of distinct values, as a power of two.
DISTINCT_BITS = 13

SUMS = ("total_records", "known", "texts", "empty", "blank", "zeros", "negatives", "nans", "yes", "no", "numbers")
LEAST, MOST = ("shortest", "min_long", "min_double"), ("longest", "max_long", "max_double")


def profile_part(df: DataFrame) -> DataFrame:
    """One row per column: what ``merge_profiles`` needs of this part of a table. Two aggregates."""
    fields = df.schema.fields
    kinds = [kind_of(f.dataType) for f in fields]
    cells = []
    for i, (f, kind) in enumerate(zip(fields, kinds)):
        key = distinct_key(ref(f.name), f.dataType)[1]
        cells += [F.lit(i), *cell_of(ref(f.name), kind), F.when(ref(f.name).isNotNull(), F.xxhash64(key))]
    pairs = df.select(F.stack(F.lit(len(fields)), *cells).alias("ordinal", *KEY_KINDS, "key"))
    pairs = pairs.withColumn("v", F.nanvl("double", F.lit(None).cast("double")))
    aggregates = {
        "total_records": "count(1)",
        "known": "count(key)",
        "texts": "count(string)",
        "empty": "count_if(string = '')",
        "blank": "count_if(NOT string RLIKE r'\\S')",
        "zeros": "count_if(v = 0)",
        "negatives": "count_if(v < 0)",
        "nans": "count_if(isnan(double))",
        "yes": "count_if(long = 1)",
        "no": "count_if(long = 0)",
        "numbers": "count(v)",
        "shortest": "min(length(string))",
        "min_long": "min(long)",
        "min_double": "min(v)",
        "longest": "max(length(string))",
        "max_long": "max(long)",
        "max_double": "max(v)",
        "letters": "sum(length(string))",
        "average": "avg(v)",
        "squares": "var_pop(v) * count(v)",
        "sketch": f"kll_sketch_agg_double(v, {SKETCH_SIZE})",
        "different": f"hll_sketch_agg(key, {DISTINCT_BITS})",
    }
    measured = pairs.groupBy("ordinal").agg(*[F.expr(x).alias(n) for n, x in aggregates.items()])
    return measured.join(_ends(df, kinds), "ordinal", "left")


def _ends(df: DataFrame, kinds: list[str]) -> DataFrame:
    """(ordinal, least, most) of decimals and times as text, as they have no common type."""
    places = [i for i, kind in enumerate(kinds) if kind in ("decimal", "time")]
    if not places:
        return df.sparkSession.createDataFrame([], "ordinal int, least string, most string")
    found = df.agg(
        *[F.min(ref(df.columns[i])).cast("string").alias(f"lo{i}") for i in places],
        *[F.max(ref(df.columns[i])).cast("string").alias(f"hi{i}") for i in places],
    )
    return rows_from_one(
        found, [{"ordinal": F.lit(i), "least": F.col(f"lo{i}"), "most": F.col(f"hi{i}")} for i in places]
    )


def _merged_ends(parts: DataFrame, schema: T.StructType, kinds: list[str]) -> DataFrame:
    """(ordinal, least, most, days): the texts are compared as values of their column's type."""
    places = [i for i, kind in enumerate(kinds) if kind in ("decimal", "time")]
    empty = parts.sparkSession.createDataFrame([], "ordinal int, least string, most string, days long")
    if not places:
        return empty
    found, rows = [], []
    for i in places:
        own = F.col("ordinal") == i
        kind = schema.fields[i].dataType
        found += [
            F.min(F.when(own, F.col("least")).cast(kind)).alias(f"lo{i}"),
            F.max(F.when(own, F.col("most")).cast(kind)).alias(f"hi{i}"),
        ]
        days = F.timestamp_diff("DAY", F.col(f"lo{i}"), F.col(f"hi{i}")) if kinds[i] == "time" else F.lit(None).cast("long")
        rows.append(
            {"ordinal": F.lit(i), "least": F.col(f"lo{i}").cast("string"), "most": F.col(f"hi{i}").cast("string"), "days": days}
        )
    return rows_from_one(parts.agg(*found), rows)


def merge_parts(parts: DataFrame) -> DataFrame:
    """Parts of one table, one row per column and part, to one such row per column."""
    own = Window.partitionBy("ordinal")
    numbers = F.sum("numbers").over(own)
    mean = F.sum(F.col("average") * F.col("numbers")).over(own) / numbers
    # Squares around the own mean become squares around the common one.
    around = F.col("squares") + F.col("numbers") * F.pow(F.col("average") - F.col("mean"), F.lit(2))
    spread = parts.withColumn("mean", F.when(numbers > 0, mean)).withColumn("around", around)
    return spread.groupBy("ordinal").agg(
        *[F.sum(c).alias(c) for c in (*SUMS, "letters")],
        *[F.min(c).alias(c) for c in LEAST],
        *[F.max(c).alias(c) for c in MOST],
        F.max("mean").alias("average"),
        F.sum("around").alias("squares"),
        F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch"),
        F.hll_union_agg("different").alias("different"),
    )


def _quantile(share: float):
    some = F.col("numbers") > 0
    return F.when(some, F.kll_sketch_get_quantile_double(F.when(some, F.col("sketch")), F.lit(share)))


def merge_profiles(parts: DataFrame, schema: T.StructType) -> DataFrame:
    """The profile (see ``profile``) of a table of this schema from the parts of ``profile_part``.

    No part at all is the profile of an empty table.
    """
    kinds = [kind_of(f.dataType) for f in schema.fields]
    merged = merge_parts(parts).withColumns(
        {
            "usual_length": F.expr("letters / nullif(texts, 0)"),
            "spread": F.expr("CASE WHEN numbers > 1 THEN squares / (numbers - 1) END"),
            "quartiles": F.when(F.col("numbers") > 0, F.array(*[_quantile(p) for p in QUARTILES])),
            "unique_count": F.hll_sketch_estimate("different") + F.when(F.col("known") < F.col("total_records"), 1).otherwise(0),
        }
    )
    listed = parts.sparkSession.range(len(kinds)).selectExpr("CAST(id AS INT) AS ordinal")
    joined = reduce(lambda a, b: a.join(b, "ordinal", "left"), [merged, _merged_ends(parts, schema, kinds)], listed)
    return present(joined, schema)


def part_limits(
    parts: DataFrame, schema: T.StructType, method: str = "iqr", threshold: float = 3.0, columns: Sequence[str] | None = None
) -> dict[str, Limits]:
    """Limits of outliers by column name for ``flag_outliers(limits=...)``, from merged parts.

    One small job; a column without values, or without a spread under ``zscore``, has none.
    """
    wanted = [f.name for f in schema.fields if kind_of(f.dataType) in NUMERIC_KINDS and (columns is None or f.name in columns)]
    shares = IQR_QUANTILES if method == "iqr" else TAIL_QUANTILES
    deviation = F.expr("CASE WHEN numbers > 1 THEN sqrt(squares / (numbers - 1)) END")
    found = merge_parts(parts).select(
        "ordinal", F.col("average").alias("mean"), deviation.alias("deviation"), *[_quantile(p).alias(f"q{i}") for i, p in enumerate(shares)]
    )
    limits = {}
    for r in found.collect():  # one row per column
        name = schema.fields[r.ordinal].name
        own = limits_of(method, threshold, r.mean, r.deviation, (r.q0, r.q1)) if name in wanted else None
        if own is not None:
            limits[name] = own
    return {c: limits[c] for c in wanted if c in limits}
