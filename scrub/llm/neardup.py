"""Near duplicates by BagMinHash: weighted Jaccard similarity of the multisets of word shingles.

A shingle that occurs n times in a text has weight n. Weights are discretised into unit intervals, and
each pair (shingle, interval) starts a Poisson process of its own: points with rising times, each
falling on a random register. A register keeps the smallest time that falls on it, over all shingles
of the text up to their weights; two texts agree in a register with a probability equal to their
weighted Jaccard similarity. The tree of intervals that the processes are split along ends in the unit
intervals; as weights are counts, there are only as many of those as the text has shingles, so they are
walked at once, each as far as the largest register: later points cannot change anything.

Registers are banded. A band that two texts share makes them candidates; candidates are verified on the
whole multisets. Equal multisets are put together before anything else, so copies cost one row each.
Multisets have numbers of their own, and only those are compared; a key may have several, and which keys
their links connect is worked out at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import materialize
from . import kernels as K
from .components import components
from .repeats import NULL_ID

SHINGLE = 5
PERCENT = 80
#: At a similarity of 0.8, 20 bands of 4 registers miss a pair with a probability of 0.00003.
BANDS, ROWS = 20, 4
#: Rounds in which each bucket is compared with one of its texts. They only save work: whatever they
#: leave apart is compared in full.
STARS = 3
#: Ids of candidates that are broadcast at most (they are counted first); more are joined by a shuffle.
BROADCAST_ROWS = 500_000
_U = np.uint64


def bags(texts: K.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all (shingle, occurrence) pairs, their documents, and where each document's begin.

    A shingle is ``SHINGLE`` neighbouring words, or all words of a text that has fewer.
    """
    words = K.words_of(texts)
    values = K.word_values(texts, words)
    counts = np.diff(words.first)
    every = K.grams(values, SHINGLE)
    inside = np.flatnonzero(K.within(words.first, SHINGLE, len(values)))
    document = np.searchsorted(words.first, inside, "right") - 1
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    keys = np.append(every[inside], K.stretches(values, words.first[short], words.first[short + 1]))
    document = np.append(document, short)
    order = np.lexsort([keys, document])
    keys, document = keys[order], document[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (document[1:] != document[:-1])
    at = np.flatnonzero(new)
    occurrence = np.arange(len(keys)) - np.repeat(at, np.diff(np.append(at, len(keys))))
    leaves = K.mix(keys + occurrence.astype(np.uint64) * _U(K.BASES[1]))
    return leaves, document, np.searchsorted(document, np.arange(len(texts) + 1))


def bag_min_hash(leaves: np.ndarray, document: np.ndarray, documents: int, registers: int) -> np.ndarray:
    """The registers of each document: the earliest time that fell on each."""
    times = np.full(documents * registers, np.inf)
    key, owner, now, step = leaves, document, np.zeros(len(leaves)), 0
    while len(key):
        step += 1
        draw = K.mix(key + _U(step * K.BASES[0] & (1 << 64) - 1))
        now = now - np.log(((draw >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53)
        register = (K.mix(draw ^ _U(K.BASES[1])) % _U(registers)).astype(np.int64)
        np.minimum.at(times, owner * registers + register, now)
        last = times.reshape(documents, registers).max(axis=1)
        active = now < last[owner]
        key, owner, now = key[active], owner[active], now[active]
    return times.reshape(documents, registers)


def band_keys(times: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = times.reshape(len(times), bands, rows).view(np.uint64)
    place = np.arange(bands * rows, dtype=np.uint64).reshape(bands, rows) * _U(K.BASES[0])
    return K.mix(K.mix(bits + place).sum(axis=2, dtype=np.uint64))


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    sums = np.append(_U(0), np.cumsum(values))
    return sums[edges[1:]] - sums[edges[:-1]]


def _names(leaves: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of the multiset of each text."""
    return _sums(K.mix(leaves), edges), _sums(K.mix(leaves ^ _U(K.BASES[0])), edges)


def _signatures(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in K.chunks(batch):
                leaves, document, edges = bags(texts)
                times = bag_min_hash(leaves, document, len(texts), bands * rows)
                keys = band_keys(times, bands, rows).view(np.int64)
                one, two = _names(leaves, edges)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(np.diff(edges)),
                        pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(texts) + 1, dtype=np.int32) * bands), pa.array(keys.ravel())
                        ),
                    ],
                    ["id", "n", "bag1", "bag2", "bands"],
                )

    return run


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (rep, bag1, bag2, text): of equal multisets of an id, one of those in a slice."""
    for batch in batches:
        for part, texts in K.chunks(batch):
            leaves, _, edges = bags(texts)
            one, two = _names(leaves, edges)
            ids = np.asarray(part.column(0))
            order = np.lexsort([two, one, ids])
            new = np.ones(len(order), bool)
            new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in (ids, one, two)])
            kept = pa.array(order[new])
            columns = [part.column(0), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), part.column(1)]
            yield pa.RecordBatch.from_arrays([c.take(kept) for c in columns], ["rep", "bag1", "bag2", "text"])


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (leaf, id, seen): each key of a bag once, and how often it was seen (1 or 2 for more)."""
    for batch in batches:
        for part, texts in K.chunks(batch):
            leaves, document, _ = bags(texts)
            order = np.argsort(leaves, kind="stable")
            leaves, document = leaves[order], document[order]
            new = np.ones(len(leaves), bool)
            new[1:] = leaves[1:] != leaves[:-1]
            at = np.flatnonzero(new)
            seen = np.minimum(np.diff(np.append(at, len(leaves))), 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaves[at].view(np.int64)), part.column(0).take(pa.array(document[at])), pa.array(seen)],
                ["leaf", "id", "seen"],
            )


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, K.Texts, K.Texts]]:
    for part, left in K.chunks(batch, K.CHUNK_BYTES // 2):
        yield part, left, K.Texts(part.column(0), *K.buffer_of(part.column(2)))


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(c, text of a, text of b, d) to (c, d, both, either): sizes of the two multisets' meet and join."""
    for batch in batches:
        for part, one, two in _slices(batch):
            (x, dx, ex), (y, dy, ey) = bags(one), bags(two)
            key, pair = np.append(x, y), np.append(dx, dy)
            order = np.lexsort([key, pair])
            key, pair = key[order], pair[order]
            same = np.flatnonzero((key[1:] == key[:-1]) & (pair[1:] == pair[:-1]))
            both = np.bincount(pair[same], minlength=len(one))
            either = np.diff(ex) + np.diff(ey) - both
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(3), pa.array(both), pa.array(either)], ["c", "d", "both", "either"]
            )


def overlaps(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """(c, d, both, either) for pairs (a, b, c, d): sizes of the meet and the join of a's and b's multisets."""
    left = bodies.select(F.col("id").alias("a"), F.col("text").alias("one"))
    right = bodies.select(F.col("id").alias("b"), F.col("text").alias("two"))
    joined = pairs.join(left, "a").join(right, "b").select("c", "one", "two", "d")
    return joined.mapInArrow(_overlaps, "c long, d long, both long, either long")


def _differing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, text of center, center) to (id, center, leaf): the keys that one of the two multisets has."""
    for batch in batches:
        for part, one, two in _slices(batch):
            (x, dx, _), (y, dy, _) = bags(one), bags(two)
            key, pair = np.append(x, y), np.append(dx, dy)
            order = np.lexsort([key, pair])
            key, pair = key[order], pair[order]
            same = (key[1:] == key[:-1]) & (pair[1:] == pair[:-1])
            alone = np.ones(len(key), bool)
            alone[1:] &= ~same
            alone[:-1] &= ~same
            of = pa.array(pair[alone])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(of), part.column(3).take(of), pa.array(key[alone].view(np.int64))], ["id", "center", "leaf"]
            )


def alike(sizes: DataFrame, percent: int) -> DataFrame:
    return sizes.where(f"both * 100 >= {percent} * either").select(F.col("c").alias("a"), F.col("d").alias("b")).distinct()


def _texts(bodies: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, text): one text for each of ``nodes``, whose ``rep`` holds it."""
    reps = nodes.select("rep").distinct()
    few = nodes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    if few:
        bodies = bodies.join(F.broadcast(reps), bodies.id == reps.rep, "left_semi")
    named = bodies.mapInArrow(_named, "rep long, bag1 long, bag2 long, text string")
    held = named.join(F.broadcast(nodes) if few else nodes, ["rep", "bag1", "bag2"]).select("id", "text", "copies")
    held = materialize(held, "suspects")
    # A multiset that only one row has needs no further look.
    copied = held.where("copies > 1").groupBy("id").agg(F.min("text").alias("text"))
    return held.where("copies = 1").select("id", "text").unionByName(materialize(copied, "copied"))


def _own(texts: DataFrame) -> DataFrame:
    """(id, own): how many of its shingles no other of the texts has."""
    seen = texts.select("id", "text").mapInArrow(_shingles, "leaf long, id long, seen long")
    alone = seen.groupBy("leaf").agg(F.sum("seen").alias("seen"), F.min("id").alias("id")).where("seen = 1")
    return alone.groupBy("id").agg(F.count(F.lit(1)).alias("own"))


def _possible(members: DataFrame, percent: int) -> DataFrame:
    """Without the members that share too few shingles with any other text to be near any of their bucket.

    Of a pair of n and m shingles, P percent alike, P / (100 + P) of n + m are common, and m is at least
    P percent of n and at least the least of the bucket.
    """
    least = members.groupBy("band", "key").agg(F.min("n").alias("least"))
    m = F.greatest(F.col("least") * 100, F.col("n") * percent)
    enough = (F.col("n") - F.col("own")) * (100 * (100 + percent)) >= (F.col("n") * 100 + m) * percent
    return members.join(least, ["band", "key"]).where(enough).drop("least")


def _folded(members: DataFrame) -> DataFrame:
    """(id, n, own, places, component): one row per text, with its buckets, at most one per band."""
    return members.groupBy("id", "n", "own", "component").agg(F.collect_list(F.struct("band", "key", "center", "hub")).alias("places"))


def _unfolded(state: DataFrame) -> DataFrame:
    return state.select("id", "n", "own", "component", F.inline("places"))


def _centers(members: DataFrame, turn: int) -> DataFrame:
    """A text of each bucket that still is in several components.

    The first time that is a short text with few shingles of its own, the likeliest to be what the
    others were copied from; later any.
    """
    order = F.xxhash64("id", F.lit(turn))
    if turn == 0:
        order = (F.col("own") + F.col("n")) * (1 << 32) + F.pmod(order, F.lit(1 << 32))
    return members.groupBy("band", "key").agg(
        F.min_by("id", order).alias("b"), F.min_by("component", order).alias("d"),
        F.min("component").alias("low"), F.max("component").alias("high"),
    ).where("low <> high").select("band", "key", "b", "d")


def _star(members: DataFrame, centers: DataFrame) -> DataFrame:
    """Pairs of the center of each bucket with all texts of it that are in other components."""
    return members.join(centers, ["band", "key"]).where("component <> d").select(
        F.col("id").alias("a"), "b", F.col("component").alias("c"), "d"
    ).distinct()


def _around(members: DataFrame, percent: int) -> DataFrame:
    """(center, id, n, hub, rest, component, size, stray, need): texts around a first center that can be near a stray.

    A stray is not in the component of the center. Of what two texts and their center differ in, two near texts
    have the more in common the further they are from it; ``off`` is above 0 for all that are not near it. A text
    has to have ``need`` such shingles in common with a stray of those in question.
    """
    every = members.select("center", "id", "n", "hub", "own", "component").distinct()
    middle = F.col("id") == F.col("center")
    mixed = every.groupBy("center").agg(
        F.max(F.when(middle, F.col("n"))).alias("size"), F.max(F.when(middle, F.col("component"))).alias("home"),
        F.min("component").alias("low"), F.max("component").alias("high"),
    ).where("low <> high").drop("low", "high")
    every = every.join(mixed, "center").select(
        "center", "id", "n", "hub", "component", "size", F.greatest(F.col("n") - F.col("hub") - F.col("own"), F.lit(0)).alias("rest"),
        (F.col("component") != F.col("home")).alias("stray"),
        ((F.col("n") + F.col("size")) * percent - F.col("hub") * (100 + percent)).alias("off"),
    )
    least = every.where("stray").groupBy("center").agg(F.min("off").alias("least"))
    need = F.ceil((F.col("off") + F.col("least") + F.col("size") * (100 - percent)) / (100 + percent))
    enough = F.col("stray") | (F.col("size") - F.col("hub") + F.col("rest") >= F.col("need"))
    return every.join(least, "center").withColumn("need", need.cast("int")).where(enough).drop("off", "least")


def _apart(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """All pairs that share a first center, are in different components and can be alike.

    What two texts have in common is in the center, or is not; what they share with it (``hub``) and what they
    share with nobody bounds both parts. One of the two at least is a stray, so they must also agree in
    some of what each differs in from the center: of the rarest of those shingles, so many of one
    text that what is left is less than it needs, one is in the other text (prefix filter).
    """
    around = materialize(_around(members, percent), "around")
    left = texts.select("id", F.col("text").alias("one"))
    right = texts.select(F.col("id").alias("center"), F.col("text").alias("two"))
    bodies = around.select("id", "center").join(left, "id").join(right, "center").select("id", "one", "two", "center")
    differing = materialize(bodies.mapInArrow(_differing, "id long, center long, leaf long"), "differing")
    seen = differing.groupBy("center", "leaf").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1")
    leaves = differing.join(seen, ["center", "leaf"]).groupBy("center", "id").agg(
        F.sort_array(F.collect_list(F.struct("seen", "leaf"))).alias("leaves")
    )
    told = materialize(around.join(leaves, ["center", "id"]), "around")
    some = told.withColumn("some", F.size("leaves") - F.col("need") + 1).where("some > 0")
    one = told.where("stray").select(
        "center", F.explode("leaves.leaf").alias("leaf"), F.col("id").alias("a"), F.col("component").alias("c"),
        F.col("n").alias("n1"), F.col("hub").alias("h1"), F.col("rest").alias("r1"),
    )
    two = some.select(
        "center", F.explode(F.slice("leaves.leaf", F.lit(1), F.col("some"))).alias("leaf"), F.col("id").alias("b"),
        F.col("component").alias("d"), F.col("n").alias("n2"), F.col("hub").alias("h2"), F.col("rest").alias("r2"), "stray",
    )
    able = F.expr(
        f"c <> d AND (a < b OR NOT stray) AND (least(h1, h2) + least(r1, r2)) * {100 + percent} >= (n1 + n2) * {percent}"
    )
    return one.join(two, ["center", "leaf"]).where(able).select("a", "b", "c", "d").distinct()


def classes(
    docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, class_id) for each row of ``docs``; documents that are near duplicates share a class.

    Two documents are near duplicates when the multisets of their five-word shingles have a weighted
    Jaccard similarity of ``percent`` or more; classes join whatever such links connect, and are
    named by their smallest key. A text of one to four words is one shingle. A text without words
    (NULL, empty, blank) is alone in its class. Rows that share a key are one document, whose links
    are those of all its texts; a NULL key is one key, and the smallest. Other columns play no part.

    A bucket of many texts is not compared pair by pair to begin with: it is compared with one of its
    texts, in ``STARS`` rounds with different ones, and texts that have met in a component need no
    further comparison. Pairs that share a bucket, and so its first center, and are still apart then are
    compared directly, where they agree in some of what both differ in from that center.
    """
    bodies = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    signed = materialize(
        bodies.mapInArrow(_signatures(bands, rows), "id long, n long, bag1 long, bag2 long, bands array<long>"), "signatures"
    )
    some = signed.where("n > 0")
    distinct = materialize(
        some.groupBy("bag1", "bag2").agg(
            F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("n").alias("n"),
            F.any_value("bands").alias("bands"),
        ).withColumn("id", F.monotonically_increasing_id()), "bags",
    )
    copies = some.join(distinct.select("bag1", "bag2", "rep"), ["bag1", "bag2"]).where("id <> rep").select(
        F.col("id").alias("a"), F.col("rep").alias("b")
    )
    exploded = distinct.select("id", "n", F.posexplode("bands").alias("band", "key"))
    shared = exploded.groupBy("band", "key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    members = materialize(exploded.join(shared.select("band", "key"), ["band", "key"]), "buckets")
    nodes = distinct.join(members.select("id").distinct(), "id", "left_semi").select("id", "rep", "bag1", "bag2", "copies")
    nodes = materialize(nodes, "nodes")
    texts = _texts(bodies, nodes)
    own = members.join(_own(texts), "id", "left").select(
        "band", "key", "id", "n", F.coalesce("own", F.lit(0)).alias("own"), F.col("id").alias("component")
    )
    members = materialize(_possible(own, percent), "buckets")
    state = None
    for turn in range(STARS + 1):
        if state:
            members = _unfolded(state)
        if turn < STARS:
            centers = _centers(members, turn)
            pairs = _star(members, centers)
        else:
            pairs = _apart(members, texts, percent)
        sizes = overlaps(pairs, texts)
        if turn == 0:  # every text is a component of its own yet
            sizes = materialize(sizes, "sizes")
            hubs = members.join(centers, ["band", "key"]).join(
                sizes.select(F.col("c").alias("id"), F.col("d").alias("b"), "both"), ["id", "b"], "left"
            )
            hubs = hubs.withColumn("hub", F.coalesce("both", "n")).withColumnRenamed("b", "center")
            state = materialize(_folded(hubs), "buckets")
        links = materialize(alike(sizes, percent), "near")
        if not links.isEmpty():
            found = components(links)
            state = materialize(
                state.join(found, state.component == found.node, "left").select(
                    "id", "n", "own", "places", F.coalesce(found.component, state.component).alias("component")
                ), "buckets",
            )
    left, right = nodes.select("id", F.col("rep").alias("a")), nodes.select(F.col("id").alias("component"), F.col("rep").alias("b"))
    near = state.where("id <> component").select("id", "component").join(left, "id").join(right, "component").select("a", "b")
    found = components(near.unionByName(copies))
    return signed.select("id").distinct().join(found, F.col("id") == F.col("node"), "left").select(
        F.when(F.col("id") != NULL_ID, F.col("id")).alias(key),
        F.when(F.coalesce("component", "id") != NULL_ID, F.coalesce("component", "id")).alias("class_id"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose key is the smallest of their class, unchanged, whatever their other columns are
    called. Rows that share a key are one document, and stay or go together."""
    found = classes(docs, key=key, text=text, **options)
    extra = found.where(~F.col(key).eqNullSafe(F.col("class_id"))).select(F.col(key))
    return docs.join(extra, docs[key].eqNullSafe(extra[key]), "left_anti")
