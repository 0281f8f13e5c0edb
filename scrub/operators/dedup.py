"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ref
from ..functions.hashing import short_key


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return False


def dedup(df: DataFrame, subset: Sequence[str] = ()) -> DataFrame:
    """Keep one row per distinct row, or per distinct value of the ``subset`` columns that exist.

    Of rows that agree on the subset, the one with the smallest remaining columns, in schema
    order and NULLs first, stays; so the result does not depend on how the rows are spread. It is
    an aggregate, not a window: copies of a key are merged before the shuffle, however many.
    """
    keys = [c for c in df.columns if c in subset]
    maps = [f.name for f in df.schema.fields if _holds_map(f.dataType)]
    if not keys:
        if not maps:
            return df.dropDuplicates()
        keys = [c for c in df.columns if c not in maps]
        keys = keys + [f"__key_{i}" for i in range(len(maps))]
        named = {f"__key_{i}": F.to_json(ref(c)) for i, c in enumerate(maps)}
        return _smallest(df.withColumns(named), keys, maps, []).select(*[ref(c) for c in df.columns])
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates()
    return _smallest(df, keys, rest, maps).select(*[ref(c) for c in df.columns])


def _smallest(df: DataFrame, keys: list[str], rest: list[str], maps: list[str]) -> DataFrame:
    """One row per key; maps cannot be ordered, so their JSON text takes their place."""
    whole = F.struct(*[ref(c) for c in rest])
    if any(_holds_map(df.schema[c].dataType) for c in rest):
        order = F.struct(
            *[F.to_json(ref(c)) if _holds_map(df.schema[c].dataType) else ref(c) for c in rest]
        )
        survivor = F.min_by(whole, order)
    else:
        survivor = F.min(whole)
    grouped = df.groupBy(*[ref(c) for c in keys]).agg(survivor.alias("__rest"))
    return grouped.select(
        *[ref(c) for c in keys], *[F.col("__rest").getField(c).alias(c) for c in rest]
    )


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per distinct value of the columns, with the number of its ``copies``.

    For counting only: long texts are replaced by hashes, so that the shuffle carries short keys.
    NULL stays NULL and equals NULL.
    """
    keys = [_key(ref(c), df.schema[c].dataType).alias(c) for c in columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def _key(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return short_key(c)
    if isinstance(kind, (T.ArrayType, T.StructType)) or _holds_map(kind):
        return short_key(F.to_json(c))
    return c


def dedup_counts(df: DataFrame, subset: Sequence[str] = ()) -> DataFrame:
    """One row: total_records, distinct_records, duplicate_records."""
    keys = [c for c in df.columns if c in subset] or df.columns
    return distinct_rows(df, keys).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_records"),
        F.count(F.lit(1)).alias("distinct_records"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_records"),
    )
