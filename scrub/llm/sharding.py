"""Shards by jump consistent hashing, made of Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Jumps that are followed. Their number is about the logarithm of the shard count; that a key needs
#: more than this has a probability under 1e-40 even for a million shards, and it would be an error,
#: not a wrong shard. Up to this many shards it cannot happen at all.
MOST_JUMPS = 96
#: Rows that are numbered together at most, about.
ROWS_PER_GROUP = 2_000
#: Bytes that a row takes besides its text.
ROW_BYTES = 16


def jump_shards(key: Column, shards: int) -> Column:
    """(shard, grown): the shard of a key among ``shards``, and among one more.

    The key walks through growing shard counts; at each step a draw that depends on the key and the
    step alone says at which count it moves next. Its shard is the last stop below the count. So the
    two answers differ only for keys whose next stop is just the new shard. A NULL key is a key like
    any other.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")

    def follow(state: Column, step: Column) -> Column:
        at = state["next"]
        draw = F.shiftrightunsigned(F.xxhash64(key, step), 33).cast("double")
        onward = F.floor((at + 1).cast("double") * (F.lit(float(1 << 31)) / (draw + 1)))
        return F.when(
            at <= shards,
            F.struct(
                onward.alias("next"),
                F.when(at < shards, at).otherwise(state["shard"]).alias("shard"),
                at.alias("grown"),
            ),
        ).otherwise(state)

    zero = F.lit(0).cast("long")
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(min(shards + 1, MOST_JUMPS))),
        F.struct(zero.alias("next"), zero.alias("shard"), zero.alias("grown")),
        follow,
    )
    if shards + 1 <= MOST_JUMPS:
        return F.struct(walk["shard"].cast("int").alias("shard"), walk["grown"].cast("int").alias("grown"))
    ended = F.when(walk["next"] > shards, walk["shard"]).otherwise(
        F.raise_error(F.lit("a key needs more jumps than are followed"))
    )
    return F.struct(ended.cast("int").alias("shard"), walk["grown"].cast("int").alias("grown"))


def number_rows(df: DataFrame, group: str, order: list[str], rows: int, name: str) -> DataFrame:
    """Number the rows of each group from 0 without a gap, however large a group is.

    Rows of a group are spread by the hash of ``order`` over cells of about ``ROWS_PER_GROUP`` rows.
    Cells are counted, the counts summed up, and rows numbered inside their cell. Equal rows are in
    no order among themselves. Only a summed-up table of cells is ever seen as a whole, by group.
    """
    groups = max(1, -(-rows // ROWS_PER_GROUP))
    dealt = df.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(groups)).cast("int"))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy(group, "_cell").agg(F.count(F.lit(1)).alias("_n")).select(
        group, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy(group, "_cell").orderBy(*order)
    numbered = dealt.withColumn("_place", F.row_number().over(inside) - 1)
    return numbered.join(bases, [group, "_cell"]).withColumn(name, F.col("_base") + F.col("_place")).drop(
        "_cell", "_base", "_place"
    )


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, law, shard, slot, grown_shard.

    ``law`` is ``key``: the key and the shard count alone decide, so shards appended later take rows
    only into themselves (``grown_shard``). ``size`` is the UTF-8 length of the text plus 16, a NULL
    text having none. Rows that share a key share a shard; a NULL key is one key. ``slot`` numbers
    the rows of a shard from 0 without a gap. Other columns are left alone, whatever their names; an
    empty table gives an empty one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    placed = rows.withColumn("_to", jump_shards(F.col("key"), shards)).select(
        "key", "size", "text_crc32", F.lit("key").alias("law"),
        F.col("_to.shard").alias("shard"), F.col("_to.grown").alias("grown_shard"),
    )
    numbered = number_rows(placed, "shard", ["key", "text_crc32", "size"], rows.count(), "slot")
    return numbered.select(
        F.col("key").alias(key), "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
