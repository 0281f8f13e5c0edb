"""Spelling variants: words of the corpus that are one edit apart, and the form that each is a variant of.

Two words one edit apart share a beginning and an end that leave one place between them. With m the length of
the shorter one, their common prefix and suffix are m - 1 long together. So a vocabulary is dealt into lists by
(m, first t characters, last m - u characters) for a few stretches t to u of where the edit may be: each pair
is together in exactly one list whose stretch holds the end of their common prefix. A list is as large as the
words that differ only within a quarter of their characters, whatever the corpus.

Each list is sorted, and each of its words scans it: the rows of the edit matrix, three diagonals wide, are kept
for the prefix that the next word shares with the one before (their longest common prefix), and where the rows of
a prefix exceed one edit, all words that share it are skipped.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import materialize

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: Letters of a run: fixed values of the contract.
LETTERS = r"A-Za-zÀ-ÿ"
#: Stretches in which the edit of a pair may be.
STRETCHES = 4
#: Pairs that a task sends on together.
PAIRS_AT_ONCE = 20_000
FAR = 2


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text", at_least: int = 1) -> DataFrame:
    """(key, run): the maximal runs of letters in all texts, of ``at_least`` characters, in lower case for A to Z only."""
    found = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"([{LETTERS}]{{{at_least},}})"), F.lit(1))
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return docs.select(F.col(f"`{key}`").alias("key"), F.explode(found).alias("run")).select(
        "key", F.translate("run", upper, upper.lower()).alias("run")
    )


def vocabulary(words: DataFrame, word: str = "word", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; each task merges its own first."""
    counted = words.where(F.length(word) >= min_length).groupBy(F.col(f"`{word}`").alias("word"))
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _lists(vocabulary: DataFrame) -> DataFrame:
    """(list, middle, word, n, m, j, head) of all words: once for each stretch of their own length, and of one less."""
    length = F.length("word")
    size = F.explode(F.array(length, length - 1)).alias("m")
    edge = lambda j: F.floor(F.col("m") * j / STRETCHES).cast("int")
    stretch = F.explode(F.array(*[
        F.struct(F.lit(j).alias("j"), edge(j).alias("head"), (F.col("m") - edge(j + 1)).alias("tail")) for j in range(STRETCHES)
    ])).alias("s")
    rows = vocabulary.select("word", "n", size).where("m > 0").select("word", "n", "m", stretch).select("word", "n", "m", "s.*")
    first, last = F.expr("substr(word, 1, head)"), F.expr("substr(word, length(word) - tail + 1, tail)")
    return rows.select(
        F.xxhash64("m", "j", first, last).alias("list"), F.expr("substr(word, head + 1, length(word) - head - tail)").alias("middle"),
        "word", "n", "m", "j", "head",
    )


def near_one(words: list[str], common: list[int], query: str) -> Iterator[int]:
    """Places of the words in a sorted list that are exactly one edit away from ``query``.

    ``common[i]`` is how many characters word i shares with the one before at its beginning.
    """
    q, size = query + "\0\0\0", len(query)
    # Row d holds the distances of d characters of a word to d - 1, d and d + 1 characters of the query.
    rows = [(FAR, 0, 1)]
    i, n = 0, len(words)
    while i < n:
        word = words[i]
        del rows[common[i] + 1:]
        x, y, z = rows[-1]
        for d in range(len(rows) - 1, len(word)):
            c = word[d]
            x = min(x + (d == 0 or c != q[d - 1]), y + 1)
            y = min(y + (d >= size or c != q[d]), z + 1, x + 1)
            z = min(z + (d + 1 >= size or c != q[d + 1]), y + 1)
            if x > 1 and y > 1 and z > 1:
                i = bisect_right(words, word[:d + 1], i + 1, key=lambda w, k=d + 1: w[:k])
                break
            if d > size:  # longer than the query by two
                i = bisect_right(words, word[:d + 1], i + 1, key=lambda w, k=d + 1: w[:k])
                break
            rows.append((x, y, z))
        else:
            over = size - len(word)
            if -1 <= over <= 1 and (x, y, z)[over + 1] == 1:
                yield i
            i += 1


def shared(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _scan(rows: list[dict]) -> Iterator[tuple[str, str, int]]:
    """(word, near word, its n) of one list, which is sorted by ``middle``."""
    middles = [r["middle"] for r in rows]
    common = [0, *map(shared, middles, middles[1:])]
    for row in rows:
        word, m, head = row["word"], row["m"], row["head"]
        if len(word) > m:  # longer by one: found by the shorter one
            continue
        stretch = (m * (row["j"] + 1) // STRETCHES) - head
        tail = m - head - len(row["middle"])
        for i in near_one(middles, common, row["middle"]):
            other = rows[i]
            # The stretch holds the end of the common prefix, so no other list has this pair. Lists are named by a
            # hash: what a meeting of two names brings together is not alike around the middle.
            if row["j"] < STRETCHES - 1 and shared(row["middle"], middles[i]) >= stretch:
                continue
            that = other["word"]
            if (other["m"], other["j"]) != (m, row["j"]) or that[:head] != word[:head] or that[len(that) - tail:] != word[len(word) - tail:]:
                continue
            yield word, that, other["n"]
            if len(that) > m:
                yield that, word, row["n"]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by list and middle to (word, other, other_n); a list may go over several batches."""
    names = ["word", "other", "other_n"]
    out: list[tuple[str, str, int]] = []

    def full(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = batch.column(0).to_numpy()
        starts = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1)
        sizes = np.diff(np.append(starts, len(keys)))
        for a, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            for pair in _scan(batch.slice(a, n).to_pylist()):
                out.append(pair)
                if len(out) >= PAIRS_AT_ONCE:
                    yield sent()

    def sent() -> pa.RecordBatch:
        columns = list(zip(*out)) or [(), (), ()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], names)

    rest: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        keys = batch.column(0).to_numpy()
        edges = np.flatnonzero(keys[1:] != keys[:-1])
        whole = int(edges[-1]) + 1 if len(edges) else 0
        if whole:
            yield from full(batch.slice(0, whole))
        rest = batch.slice(whole)
    if rest is not None:
        yield from full(rest)
    yield sent()


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, other, other_n) of all ordered pairs of words one edit apart; ``vocabulary`` is (word, n)."""
    return _lists(vocabulary).repartition("list").sortWithinPartitions("list", "middle").mapInArrow(
        _pairs, "word string, other string, other_n long"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: forms are followed to the last by doubling.

    A form is ``RATIO`` times as frequent as its word, so chains are no longer than a logarithm of the corpus.
    """
    state = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        there = state.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = materialize(
            state.join(there, "root", "left").select(
                "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
            ), "roots",
        )
        state = step.drop("moved")
        if step.where("moved").isEmpty():
            return state


def variants(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Per word of ``vocabulary`` (word, n): word, form, root, n, n_near, form_n.

    Two words are near if they differ by one inserted, deleted or replaced code point. The form of a word is the near
    word of largest n (of equal ones the smallest in code-point order) if that is at least ``ratio`` (2 or more) times
    its own; root is where the forms end, the word itself without one. Words without near words have n_near 0
    and no form. Words are different, not empty and not NULL, nor is n; an empty table gives none; a word may be of any
    length.
    """
    if ratio < 2:
        raise ValueError("a form is at least twice as frequent as its word")
    words = materialize(vocabulary.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    frequent: Column = -F.col("best.less") >= F.col("n") * ratio
    found = materialize(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(frequent, F.col("best.form")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n"),
        ), "forms",
    )
    return found.join(_roots(found.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def with_typos(runs: DataFrame, every: int) -> DataFrame:
    """(word) of all ``runs`` (key, run): with h = crc32 of ``<key>:<run>``, code point h % length is deleted where ``every`` divides h.

    A NULL key counts as an empty one.
    """
    h = F.crc32(F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("")), "run"))
    at = (h % F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return runs.select(F.when(h % every == 0, less).otherwise(F.col("run")).alias("word"))
