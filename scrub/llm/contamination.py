"""Benchmark items inside documents: MinHash containment search by size class, then exact containment.

Jaccard similarity says little about a short item in a long document, so containment is searched for:
the share of the item's shingles that the document has. The signature of an item is its smallest
shingle hashes (bottom-k MinHash). Items are partitioned into size classes, and a class's k
follows from its largest item and the threshold: a document that misses no more than the allowed share
of the shingles must hold one of the k smallest. So the search loses nothing; longer items get longer
signatures instead of more chances of a miss. What it finds is verified on the shingles themselves.

Made of DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import materialize
from .quality import WORD

SHINGLE = 5
CONTAINED = 80
#: Signature rows that are broadcast at most (they are counted first); more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def words(text: str | Column) -> Column:
    """Lower-case words; a NULL text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))


def _places(array: str) -> Column:
    n = F.size(array) - SHINGLE
    return F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(array: str) -> Column:
    """A hash of every ``SHINGLE`` neighbouring word hashes."""
    return F.transform(_places(array), lambda i: F.xxhash64(*[F.get(F.col(array), i + k) for k in range(SHINGLE)]))


def shingle_texts(array: str) -> Column:
    return F.transform(_places(array), lambda i: F.array_join(F.slice(F.col(array), i + 1, SHINGLE), " "))


def _hashed(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, F.transform(words("text"), lambda w: F.xxhash64(w)).alias("_h"))


def signatures(items: DataFrame, percent: int = CONTAINED) -> DataFrame:
    """(item, hash): the bottom-k signature of each item, with the k of its size class."""
    hashes = _hashed(items, "item").select("item", F.explode(F.array_distinct(shingle_hashes("_h"))).alias("hash"))
    sets = hashes.groupBy("item").agg(F.sort_array(F.collect_set("hash")).alias("all"))
    sized = sets.withColumn("class", F.floor(F.log2(F.size("all"))).cast("int"))
    largest = sized.groupBy("class").agg(F.max(F.size("all")).alias("most"))
    k = F.floor(F.col("most") * (100 - percent) / 100).cast("int") + 1
    return sized.join(largest, "class").select("item", F.explode(F.slice("all", 1, k)).alias("hash"))


def find_contained(
    docs: DataFrame, items: DataFrame, percent: int = CONTAINED, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(key, item, n_shared, n_shingles): items of whose shingles a document holds ``percent`` or more.

    Shingles are five lower-case words, each counted once. Items and documents of fewer words have none
    and never appear. Rows that share an id are one document (or one item) with the shingles of all
    of them; a NULL id is an id like any other. Other columns play no part.
    """
    tests = items.select(F.col(item).alias("item"), F.col(item_text).alias("text"))
    bodies = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))

    signature = signatures(tests, percent)
    few = signature.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    probes = _hashed(bodies, "doc").select("doc", F.explode(shingle_hashes("_h")).alias("hash"))
    matches = probes.join(F.broadcast(signature) if few else signature, "hash").select("doc", "item").distinct()
    candidates = materialize(matches, "candidates")

    # Exact: the shingles of documents and items that have a candidate, as texts.
    suspects = candidates.select(F.col("doc").alias("_doc")).distinct()
    suspicious = bodies.join(suspects, F.col("doc").eqNullSafe(F.col("_doc")), "left_semi")
    split = suspicious.select("doc", words("text").alias("_w"))
    held = split.select("doc", F.explode(F.array_distinct(shingle_texts("_w"))).alias("shingle"))
    asked = tests.select("item", words("text").alias("_w")).select(
        "item", F.explode(F.array_distinct(shingle_texts("_w"))).alias("shingle")
    ).distinct()
    sizes = asked.groupBy(F.col("item").alias("_item")).agg(F.count(F.lit(1)).alias("n_shingles"))
    shared = (
        held.join(F.broadcast(asked) if few else asked, "shingle")
        .groupBy("doc", "item").agg(F.count_distinct("shingle").alias("n_shared"))
    )
    found = shared.join(sizes, F.col("item").eqNullSafe(F.col("_item"))).where(
        F.col("n_shared") * 100 >= F.col("n_shingles") * percent
    ).select(F.col("doc").alias("_doc"), F.col("item").alias("_item"), "n_shared", "n_shingles")
    sure = (F.col("doc").eqNullSafe(F.col("_doc"))) & (F.col("item").eqNullSafe(F.col("_item")))
    return found.join(candidates, sure, "left_semi").select(
        F.col("_doc").alias(key), F.col("_item").alias(item), "n_shared", "n_shingles"
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, unchanged, whatever their other columns are called."""
    bad = find_contained(docs, items, key=key, text=text).select(F.col(key)).distinct()
    return docs.join(bad, docs[key].eqNullSafe(bad[key]), "left_anti")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM d)),
items AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 4], ' ') AS s
          FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS k FROM i)),
n AS (SELECT item_id, count(*) AS n_shingles FROM items GROUP BY 1),
h AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN items USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_shared, n_shingles FROM h JOIN n USING (item_id) WHERE n_shared * 100 >= n_shingles * 80
"""
