"""Packing documents into sequences: dominance reduction first, best fit for what is left.

Only lengths matter for a packing, and there are at most as many different ones as a sequence has
tokens. So the number of pieces of each length (``capacity`` numbers, however large the corpus) is
packed as groups of equal sequences on the driver, and Spark deals out the pieces: numbered within
their length, a piece finds its sequence and its place there by the range that its number lies in.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import materialize
from . import kernels as K
from . import tokens
from .sharding import number_rows

CAPACITY = 2048
END = 0


@dataclass
class Group:
    """``count`` sequences that hold the same lengths, in this order."""

    count: int
    lengths: list[int] = field(default_factory=list)

    @property
    def size(self) -> int:
        return sum(self.lengths)


def reduce_by_dominance(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Group], dict[int, int]]:
    """Sequences that some best packing holds, after Martello and Toth, and the lengths that are left.

    For the longest piece j a set of partners dominates all others when any other set can be exchanged
    for it without needing more room. That holds when
    - nothing fits beside j: j stays alone;
    - only one piece fits beside j, or the longest that fits fills the sequence: that one;
    - at most two fit, and no two of them are longer together than the longest single one: that one.
    A piece without such a set is left for later; the next longest is looked at.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    fixed: list[Group] = []
    sizes = sorted(left)
    for j in sorted(left, reverse=True):
        while left.get(j, 0):
            room = capacity - j
            alone = left[j] == 1
            smallest = _smallest(sizes, left, j if alone else None, 3)
            at = bisect_right(sizes, room)
            while at and (left.get(sizes[at - 1], 0) == 0 or alone and sizes[at - 1] == j):
                at -= 1
            if not at:
                fixed.append(Group(left.pop(j), [j]))
                break
            best = sizes[at - 1]
            two_fit = len(smallest) > 1 and smallest[0] + smallest[1] <= room
            three_fit = len(smallest) > 2 and sum(smallest) <= room
            dominates = best == room or not two_fit
            if not dominates and not three_fit:
                dominates = best >= _longest_pair(sizes, left, room, j if alone else None)
            if not dominates:
                break
            if best == j:
                pairs = left[j] // 2
                left[j] -= 2 * pairs
            else:
                pairs = min(left[j], left[best])
                left[j] -= pairs
                left[best] -= pairs
            fixed.append(Group(pairs, [j, best]))
    return fixed, {s: n for s, n in left.items() if n}


def _smallest(sizes: list[int], left: dict[int, int], without: int | None, n: int) -> list[int]:
    found: list[int] = []
    for s in sizes:
        if s != without and left.get(s, 0):
            found += [s] * min(left[s], n - len(found))
            if len(found) == n:
                break
    return found


def _longest_pair(sizes: list[int], left: dict[int, int], room: int, without: int | None) -> int:
    """The most that two pieces take together within ``room``; 0 if no two fit."""
    usable = [s for s in sizes if left.get(s, 0) and s != without]
    best, low, high = 0, 0, len(usable) - 1
    while low <= high:
        both = usable[low] + usable[high]
        if both > room:
            high -= 1
        elif low == high:
            if left[usable[low]] > 1:
                best = max(best, both)
            break
        else:
            best = max(best, both)
            low += 1
    return max([best, *[2 * s for s in usable if left[s] > 1 and 2 * s <= room]])


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Best fit by falling length: every piece goes where the least room is left that takes it.

    Equal pieces are placed together: sequences with the same room fill up one after the other, so a
    group of them changes as a whole, and at most two new groups come up per length and room.
    """
    rooms: list[int] = []
    groups: dict[int, list[Group]] = {}

    def add(group: Group) -> None:
        room = capacity - group.size
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append(group)

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                group = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                each = capacity // size
                group, room = Group(-(-left // each)), capacity
            each = room // size
            whole = min(group.count, left // each)
            if whole:
                add(Group(whole, group.lengths + [size] * each))
            left -= whole * each
            rest = group.count - whole
            if rest and left and left < each:
                add(Group(1, group.lengths + [size] * left))
                left, rest = 0, rest - 1
            if rest:
                add(Group(rest, group.lengths))
    return [g for same in groups.values() for g in same if g.lengths]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """All sequences, as groups of equal ones."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def ranges(groups: list[Group]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from, to, each, sequence, offset): the pieces of that length numbered ``from`` up to
    ``to`` go, ``each`` to a sequence, into the sequences from ``sequence`` on, side by side from ``offset``.
    """
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for g in groups:
        offset = 0
        for size in dict.fromkeys(g.lengths):
            each = g.lengths.count(size)
            start = used.get(size, 0)
            used[size] = start + each * g.count
            rows.append((size, start, used[size], each, sequence, offset))
            offset += each * size
        sequence += g.count
    return rows


def _pieces(path: str, capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path).encode
        for batch in batches:
            for part, texts in K.chunks(batch):
                ids, offsets = encode(texts, end)
                sizes = np.diff(offsets)
                cuts = -(-sizes // capacity)
                of = np.repeat(np.arange(len(sizes)), cuts)
                number = np.arange(len(of)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start = number * capacity
                length = np.minimum(capacity, sizes[of] - start)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                at = 4 * (offsets[of] + start)
                crc = [zlib.crc32(raw[a:a + 4 * n]) for a, n in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(of)), pa.array(number.astype(np.int32)), pa.array(start),
                        pa.array(length), pa.array(crc, pa.int64()),
                    ],
                    ["key", "piece", "start", "length", "ids_crc32"],
                )

    return run


def cut_documents(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32. Only documents of more than
    ``capacity`` ids (with the end id) have more than one. A NULL text is empty."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = dict(docs.dtypes)[key]
    return rows.mapInArrow(
        _pieces(tokenizer, capacity, end), f"key {kind}, piece int, start long, length long, ids_crc32 long"
    ).withColumnRenamed("key", key)


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) with sequence_id and offset added.

    Reads ``pieces`` several times, so give a stored table. Sequences hold no gaps and at most
    ``capacity`` tokens. The plan that is broadcast has a row per group and length: a few per possible
    length, however many pieces there are. Equal pieces are in no order among themselves.
    """
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    spark = pieces.sparkSession
    rows = ranges(plan(counts, capacity))
    table = spark.createDataFrame(rows, "_length long, _from long, _to long, _each long, _sequence long, _offset long")
    numbered = number_rows(pieces, "length", order, sum(counts.values()), "_number")
    where = (F.col("length") == F.col("_length")) & F.col("_number").between(F.col("_from"), F.col("_to") - 1)
    place = F.col("_number") - F.col("_from")
    return numbered.join(F.broadcast(table), where).select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(place / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + place % F.col("_each") * F.col("length")).alias("offset"),
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """Cut, store and pack all documents: key, piece, start, length, ids_crc32, sequence_id, offset.

    Rows that share a key are documents of their own. Other columns play no part; an empty table
    gives an empty one.
    """
    pieces = materialize(cut_documents(docs, tokenizer, key, text, capacity, end), "pieces")
    return pack(pieces, [key, "piece", "ids_crc32"], capacity)
