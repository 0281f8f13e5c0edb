"""Row fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import ref


# Texts of more bytes than this are told apart by their SHA-256, which takes one byte more.
SHORT_TEXT = 63


def short_key(text: Column) -> Column:
    """A text that is equal only for equal texts and never long: keeps shuffles of keys small."""
    short = F.octet_length(text) <= SHORT_TEXT
    return F.when(short, text).otherwise(F.sha2(text, 256))


def as_text(c: Column, kind: T.DataType) -> Column:
    """Text of any column; nested values as JSON."""
    if isinstance(kind, (T.MapType, T.StructType, T.ArrayType)):
        return F.to_json(c)
    return c.cast("string")


def row_hash(df: DataFrame, columns: Sequence[str], null_token: str | None = None) -> Column:
    """md5 of the columns' texts joined by a pipe; NULL when there are no columns.

    NULLs are left out of the joined text, so (a, NULL, b) and (a, b, NULL) hash alike unless
    ``null_token`` stands in for them.
    """
    if not columns:
        return F.lit(None).cast("string")
    parts = []
    for name in columns:
        kind = df.schema[name].dataType
        # An array of strings is joined with the same pipe as the row, everything else is one text.
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            part = F.concat_ws("|", ref(name)) if null_token is not None else ref(name)
            if null_token is not None:
                part = F.when(ref(name).isNull(), F.lit(null_token)).otherwise(part)
        else:
            part = as_text(ref(name), kind)
            if null_token is not None:
                part = F.coalesce(part, F.lit(null_token))
        parts.append(part)
    return F.md5(F.concat_ws("|", *parts))


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """128 bits that are the same for equal rows only: a short key in place of a wide row.

    NULL equals NULL, NaN equals NaN and -0.0 equals 0.0, as in grouping. Positions count, so a value
    in another column is another row.
    """
    texts = []
    for i, name in enumerate(df.columns if columns is None else columns):
        kind = df.schema[name].dataType
        c = ref(name)
        if isinstance(kind, T.TimestampType):
            c = F.unix_micros(c)
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            c = c + F.lit(0).cast(kind)
        elif isinstance(kind, T.BinaryType):
            c = F.hex(c)
        elif isinstance(kind, (T.MapType, T.StructType, T.ArrayType)):
            c = F.to_json(c, {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
        texts.append(c.cast("string").alias(f"c{i}"))
    return F.unhex(F.md5(F.to_json(F.struct(*texts), {"ignoreNullFields": "false"})))
