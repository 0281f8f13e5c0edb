"""Duplicates across batches, by keyed state that the streaming checkpoint keeps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ref
from ..functions.hashing import row_digest
from ..operators.dedup import dedup

DIGEST = "__row_digest"


def dedup_stream(stream: DataFrame, subset: Sequence[str] = ()) -> DataFrame:
    """The rows of ``dedup`` over all batches of a stream so far, as updates.

    Over whole rows, each different row comes once, in the first batch that has it; the state keeps 16 bytes
    for it. Over ``subset`` columns a batch gives the row that now stands for each key it has touched: the one with
    the smallest remaining columns of all batches, so a later row may take the place of an earlier one
    (``latest_rows``). The state then keeps one whole row for each key, and copies of a key are merged by each task
    before they meet it. Write it in update mode. Whole rows are dealt out by their digest, copies too: where
    one row may fill much of a batch, make batches distinct first, as ``clean_incrementally`` does.
    """
    keys = [c for c in stream.columns if c in subset]
    if keys and len(keys) < len(stream.columns):
        return dedup(stream, subset)
    kept = stream.withColumn(DIGEST, row_digest(stream)).dropDuplicates([DIGEST])
    return kept.drop(DIGEST)


def latest_rows(df: DataFrame, subset: Sequence[str], order: str = "batch") -> DataFrame:
    """Of the rows that agree on the ``subset`` columns the one of the last batch, without that column.

    Without a subset column in the table nothing is replaced, and all rows stay.
    """
    columns = [c for c in df.columns if c != order]
    keys = [c for c in columns if c in subset]
    rest = [c for c in columns if c not in keys]
    if not keys or not rest:
        return df.select(*[ref(c) for c in columns])
    last = F.max_by(F.struct(*[ref(c) for c in rest]), ref(order)).alias("__rest")
    grouped = df.groupBy(*[ref(c) for c in keys]).agg(last)
    return grouped.select(*[ref(c) if c in keys else F.col("__rest").getField(c).alias(c) for c in columns])
