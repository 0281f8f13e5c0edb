"""Maximal runs of repeated words inside documents, by seeds that are extended along diagonals.

A run of period q is a stretch in which words q apart are identical, and which no neighbour extends. Two copies
of a text, one shifted by q, agree along it: a diagonal of that lag. For a length of at least ``repeats * q`` the
diagonal is at least ``(repeats - 1) * q`` long, which is what the k-grams of an index may rely on. Lags are dealt
with in levels: the grams of level k find all periods from the k of the level before up to k, and are never longer
than the diagonals of these.

In a run whose period is not above k, a k-gram holds a whole period, so it comes again after exactly one period and not
before (two shifts below k would make their greatest common divisor a period). So the pairs that a document
needs are those of *neighbouring* occurrences of a gram: as many as it has words, however often a word is repeated.
Each pair is a seed on the diagonal of its lag; a table by lag of how far that diagonal is covered drops the seeds
inside a stretch that is known already, and only what is left is extended word by word. A gram that occurs once cannot be
the beginning of a longer one that occurs twice, so each level only looks at what the one before found again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .charmap import gather

MIN_WORDS, REPEATS = 24, 3
BLANK = 0x20
#: Words that are copied together.
WORDS_AT_ONCE = 1 << 17


def levels(n: int, min_words: int = MIN_WORDS, repeats: int = REPEATS) -> Iterator[tuple[int, int]]:
    """(gram size, smallest lag) of the levels that a document of ``n`` words needs.

    A diagonal of lag q is at least max(min_words - q, (repeats - 1) * q) long. A gram size k serves the lags up to k
    whose diagonals are all that long.
    """
    low = 1
    while low * repeats <= n and min_words <= n:
        k = min(max(min_words - q, (repeats - 1) * q) for q in range(low, low + min_words))
        yield k, low
        low = k + 1


def _again(values: np.ndarray, places: np.ndarray, document: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, next place) of the k-grams at ``places`` that occur again in their document.

    ``places`` ascend; their grams lie within one document each.
    """
    up, down = K.powers(K.BASES[0], len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    keys = K.mix((sums[places + k] - sums[places]) * down[places] + document.astype(np.uint64) * np.uint64(K.BASES[1]))
    order = np.argsort(keys, kind="stable")
    keys, places, document = keys[order], places[order], document[order]
    same = (keys[1:] == keys[:-1]) & (document[1:] == document[:-1])
    return places[:-1][same], places[1:][same]


def _agree(values: np.ndarray, a: int, b: int, limit: int, step: int) -> int:
    """How many words agree from ``a`` and ``b`` on (step 1) or before them (step -1), ``limit`` at most."""
    done, width = 0, 64
    while done < limit:
        n = min(width, limit - done)
        x, y = (values[p + done:p + done + n] if step > 0 else values[p - done - n:p - done][::-1] for p in (a, b))
        differ = np.flatnonzero(x != y)
        if len(differ):
            return done + int(differ[0])
        done, width = done + n, width * 4
    return done


def runs_of(values: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS, repeats: int = REPEATS) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of all runs, by start and period within each document.

    ``values`` are the words of all documents, document i has those from ``first[i]`` to ``first[i + 1]``.
    """
    sizes = np.diff(first)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(values))
    found: list[tuple[int, int, int, int]] = []
    for k, low in levels(int(sizes.max(initial=0)), min_words, repeats):
        places = places[(places + k <= first[owner[places] + 1]) & (sizes[owner[places]] >= low * repeats)]
        if len(places) < 2:
            break
        one, two = _again(values, places, owner[places], k)
        lag = two - one
        # Seeds of the next level: places whose gram occurs again or did before.
        held = np.zeros(len(values) + 1, bool)
        held[one] = held[two] = True
        places = np.flatnonzero(held)
        seeds = np.flatnonzero((lag >= low) & (lag <= k))
        order = np.lexsort([one[seeds], lag[seeds]])
        at, by = one[seeds][order], lag[seeds][order]
        # Neighbouring seeds of a lag lie on one stretch; its first one is extended.
        new = np.ones(len(at), bool)
        new[1:] = (by[1:] != by[:-1]) | (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
        covered: dict[int, int] = {}
        for i, q in zip(at[new].tolist(), by[new].tolist()):
            if i < covered.get(q, 0):
                continue
            document = int(owner[i])
            begin, end = int(first[document]), int(first[document + 1])
            right = i + _agree(values, i, i + q, end - i - q, 1)
            left = i - _agree(values, i, i + q, i - begin, -1)
            covered[q] = right
            length = right - left + q
            if length >= max(min_words, repeats * q):
                found.append((document, left - begin, length, q))
    return sorted(found, key=lambda r: (r[0], r[1], r[3]))


def _word_values(texts: K.Texts) -> tuple[np.ndarray, K.Words]:
    """Fingerprints of all words; of a long text by stretches that end at a blank."""
    words = K.words_of(texts)
    if len(texts.data) <= 2 * K.CHUNK_BYTES:
        return K.word_values(texts, words), words
    out, at = [], 0
    while at < len(words):
        to = max(at + 1, int(np.searchsorted(words.ends, words.starts[at] + K.CHUNK_BYTES, "right")))
        a, b = words.starts[at], words.ends[to - 1]
        out.append(K.stretches(K.byte_values(texts.data[a:b]), words.starts[at:to] - a, words.ends[at:to] - a))
        at = to
    return np.concatenate(out), words


def _collapsed(texts: K.Texts, words: K.Words, gone: np.ndarray) -> pa.Array:
    """The words that stay, joined by blanks."""
    data = np.append(texts.data, np.uint8(BLANK))
    kept = np.flatnonzero(~gone)
    sizes = words.ends[kept] - words.starts[kept] + 1
    out = []
    for at in range(0, len(kept), WORDS_AT_ONCE):
        size = sizes[at:at + WORDS_AT_ONCE]
        part = gather(data, words.starts[kept[at:at + WORDS_AT_ONCE]], size)
        part[np.cumsum(size) - 1] = BLANK
        out.append(part)
    edges = np.searchsorted(kept, words.first)
    ends = np.append(0, np.cumsum(sizes))[edges]
    some = np.diff(edges) > 0
    body = np.delete(np.concatenate([np.zeros(0, np.uint8), *out]), ends[1:][some] - 1)
    offsets = (ends - np.append(0, np.cumsum(some))).astype(np.int32)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes()))


def _finding(min_words: int, repeats: int):
    """A function for mapInArrow: (key, text) to (key, n_words, runs, collapsed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in K.chunks(batch):
                values, words = _word_values(texts)
                found = runs_of(values, words.first, min_words, repeats)
                edge = np.zeros(len(words) + 1, np.int64)
                for document, start, length, q in found:
                    edge[words.first[document] + start + q] += 1
                    edge[words.first[document] + start + length] -= 1
                gone = np.cumsum(edge)[:-1] > 0
                table = np.array(found, np.int64).reshape(-1, 4)
                offsets = np.searchsorted(table[:, 0], np.arange(len(texts) + 1)).astype(np.int32)
                runs = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.StructArray.from_arrays([pa.array(table[:, i]) for i in (1, 2, 3)], ["start", "length", "period"])
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(words.first)), runs, _collapsed(texts, words, gone)],
                    ["key", "n_words", "runs", "collapsed"],
                )

    return run


def find_runs(
    docs: DataFrame, min_words: int = MIN_WORDS, repeats: int = REPEATS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, ``runs`` (start, length, period), ``collapsed`` text.

    A word is what blanks and 0x09 to 0x0D separate. A run has at least ``min_words`` words and ``repeats`` (3 or
    more) times its smallest period; all of them are returned, by start, then period. ``collapsed`` is the text without the
    words that a run holds after its first period, joined by blanks. A NULL or empty text has no words. Keys of any
    type, NULL, repeated rows and ties come back as they are; other columns play no part; an empty table gives none.
    Words are compared by 64-bit fingerprints. A document is one row in one task; a very long one takes about 60
    bytes there for each of its words, and ten for each of its bytes.
    """
    if repeats < 3:
        raise ValueError("a run repeats its period at least three times")
    kind = docs.schema[key].dataType.simpleString()
    found = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(
        _finding(min_words, repeats),
        f"key {kind}, n_words long, runs array<struct<start long, length long, period long>>, collapsed string",
    )
    return found.select(F.col("key").alias(key), "n_words", "runs", "collapsed")


def strongest(runs):
    """The run of greatest length / period; of equal ones the first in order. NULL without a run."""
    better = lambda best, r: r.length * best.period > best.length * r.period
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(better(best, r), r).otherwise(best))
