"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import materialize


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the links (a, b); a component is named by its smallest node.

    Alternates two steps until nothing changes, which takes about the logarithm of the longest path:
    every node passes its larger neighbours to the smallest one (large star), then its smaller ones
    (small star). A step moves each link once and gathers no neighbourhood. Each is written to the
    shared folder, so that lost executors cost no earlier step.
    """
    links = materialize(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _state(links)
    while True:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("of")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("of")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a <> b").distinct(), "links")
        least = large.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m"))
        down = large.join(least, F.col("a") == F.col("of")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = materialize(
            down.unionByName(least.select(F.col("of").alias("a"), F.col("m").alias("b")))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links",
        )
        after = _state(links)
        if after == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = after
