"""Which windows of a corpus start earlier somewhere else: the common part of both exact deduplications.

A window is ``window`` neighbouring values (words or bytes) of one document. It is a repeat when the
same values also start earlier: in a document of a smaller id, or earlier in the same document.
Comparing all windows would shuffle the corpus many times over, so they are told apart in steps:

1. Each window chooses the smallest fingerprint of the ``gram`` values in it (its anchor). Equal
   windows choose the same anchor at the same place, whatever surrounds them. Neighbouring windows
   mostly share an anchor: they are a *phrase*, and only phrases are shuffled. A phrase whose anchor
   occurs nowhere else has no repeat, and is done.
2. The others are compared as a whole. A phrase that is not the first of its kind is all repeats. One
   that is the first, and the only kind around its anchor, has none.
3. What is left are phrases that agree in part with an earlier text: those at the ends of copied
   passages. They are cut into cells of ``cell`` windows, compared in the same two ways, and the
   cells that are left into windows.

Answers travel to documents, never along a key: a place is told that it is the *first* of its kind, or
*alone* with its key; what hears nothing is a repeat. So a text that fills a third of the corpus
costs a row per task, no join meets a hot key, and no key gathers its members.

Keys hold 64 bits where a chance meeting only costs a further look, and 128 bits where it would
remove text. Tasks find the same phrases again in each step from the text alone; the text is
shuffled by document once and that exchange serves all steps.

A document's id orders it, and a NULL id counts as the smallest. A document is an id and a text: copies
of a row are one document and get the same answer, and different texts of one id (above all of the
NULL id) are documents of their own, in the order of 128-bit fingerprints of the texts (``MARKS``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K

NULL_ID = -(1 << 63)
#: Fingerprints of the text; tables have them if an id has several texts.
MARKS = ("text1", "text2")
#: Stands for the place of a key that a task has seen more than once.
MANY = -1


@dataclass(frozen=True)
class Shape:
    """What a window is. ``cell`` 1: phrases are cut into windows at once."""

    unit: str
    window: int
    gram: int
    cell: int = 1

    def values(self, texts: K.Texts) -> tuple[np.ndarray, np.ndarray, K.Words | None]:
        """The values of all documents, where each document begins, and their words."""
        if self.unit == "byte":
            return K.byte_values(texts.data), texts.offsets, None
        words = K.words_of(texts)
        return K.word_values(texts, words), words.first, words


class Scan:
    """The phrases of some documents and what is known of them."""

    def __init__(self, shape: Shape, texts: K.Texts):
        self.shape, self.texts = shape, texts
        self.values, self.first, self.words = shape.values(texts)
        n, w = len(self.values), shape.window
        self.grams = K.grams(self.values, shape.gram)
        valid = K.within(self.first, w, n)
        self.anchor, self.start, self.end = K.minimizers(self.grams, w - shape.gram + 1, valid)

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, "right") - 1

    def flags(self, batch: pa.RecordBatch, name: str) -> np.ndarray:
        """Places that a list column names, as one flag per value."""
        on = np.zeros(len(self.values) + 1, bool)
        column = batch.column(batch.schema.get_field_index(name))
        if column.null_count < len(column):
            lists = column.drop_null()
            rows = np.flatnonzero(np.asarray(column.is_valid()))
            rows = np.repeat(rows, np.asarray(pc.list_value_length(lists)))
            places = np.asarray(lists.flatten())
            own = places < self.first[rows + 1] - self.first[rows]
            on[self.first[rows[own]] + places[own]] = True
        return on

    def stretch(self, a: np.ndarray, b: np.ndarray, base: int = 0) -> np.ndarray:
        return K.stretches(self.values, a, b, K.BASES[base])

    # What each step compares: a key, the whole, and where it starts.

    def phrases(self) -> tuple[np.ndarray, ...]:
        return self.grams[self.anchor], self.stretch(self.start, self.end + self.shape.window), self.start

    def cells(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last window of the cells of some phrases, and what all windows of a cell hold.

        Cells are laid out from the anchor, so that equal windows lie in cells of the same place.
        """
        c, w = self.shape.cell, self.shape.window
        anchor, start, end = self.anchor[phrases], self.start[phrases], self.end[phrases]
        low, high = (anchor - end) // c, (anchor - start) // c
        each = high - low + 1
        of = np.repeat(np.arange(len(phrases)), each)
        step = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each) + low[of]
        to = anchor[of] - step * c
        return np.maximum(to - (c - 1), start[of]), np.minimum(to, end[of]), to, to - (c - 1) + w

    def open_phrases(self, batch) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that need a closer look, and those that are all repeats."""
        seen = ~self.flags(batch, "alone0")[self.start]
        first = self.flags(batch, "first1")[self.start]
        alone = self.flags(batch, "alone1")[self.start]
        return np.flatnonzero(seen & first & ~alone), np.flatnonzero(seen & ~first)

    def open_spans(self, batch, deep: bool) -> tuple[np.ndarray, ...]:
        """(first, last) windows of the spans to compare window by window, and of spans of repeats.

        ``deep``: the answers about cells are there.
        """
        todo, repeats = self.open_phrases(batch)
        from_, to = self.start[todo], self.end[todo]
        gone_from, gone_to = self.start[repeats], self.end[repeats]
        if self.shape.cell > 1 and deep:
            from_, to, _, _ = self.cells(todo)
            first, alone = self.flags(batch, "first2")[from_], self.flags(batch, "alone2")[from_]
            gone_from, gone_to = np.append(gone_from, from_[~first]), np.append(gone_to, to[~first])
            left = first & ~alone
            from_, to = from_[left], to[left]
        return from_, to, gone_from, gone_to


def _each(from_: np.ndarray, to: np.ndarray) -> np.ndarray:
    sizes = to - from_ + 1
    return np.repeat(from_ - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def marks(columns: list[str]) -> list[str]:
    """The columns that tell documents apart, in the order of documents."""
    return ["id", *[c for c in MARKS if c in columns]]


def owners(part: pa.RecordBatch) -> list[np.ndarray]:
    return [np.asarray(part.column(part.schema.get_field_index(c))) for c in marks(part.schema.names)]


def least(keys, own: list[np.ndarray], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key the row of the first document and place, and how many rows have it."""
    order = np.lexsort([places, *own[::-1], *keys])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(order)))


def _rows(names: list[str], keys: list[np.ndarray], scan: Scan, part: pa.RecordBatch, places: np.ndarray) -> pa.RecordBatch:
    """A row for each key: the first place that has it."""
    document = scan.document(places)
    own, local = [c[document] for c in owners(part)], places - scan.first[document]
    kept, count = least(keys, own, local)
    if len(keys) == 1:
        local = np.where(count > 1, MANY, local[kept])
    else:
        local = local[kept]
    columns = [k[kept].view(np.int64) for k in keys] + [c[kept] for c in own] + [local.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*names, *marks(part.schema.names), "place"])


def _emit(shape: Shape, step: int):
    """A function for mapInArrow that gives the rows that step ``step`` compares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in (K.unzipped if step else K.chunks)(batch):
                scan = Scan(shape, texts)
                if step == 0:
                    key, _, places = scan.phrases()
                    yield _rows(["key"], [key], scan, part, places)
                elif step == 1:
                    key, whole, places = scan.phrases()
                    seen = ~scan.flags(part, "alone0")[places]
                    yield _rows(["key", "whole"], [key[seen], whole[seen]], scan, part, places[seen])
                elif step == 2:
                    todo, _ = scan.open_phrases(part)
                    from_, to, core, core_end = scan.cells(todo)
                    key, whole = scan.stretch(core, core_end), scan.stretch(from_, to + shape.window, 1)
                    yield _rows(["key", "whole"], [key, whole], scan, part, from_)
                else:
                    from_, to, _, _ = scan.open_spans(part, True)
                    places = _each(from_, to)
                    ends = places + shape.window
                    keys = [scan.stretch(places, ends), scan.stretch(places, ends, 1)]
                    yield _rows(["key", "whole"], keys, scan, part, places)

    return run


def repeat_windows(scan: Scan, part: pa.RecordBatch) -> np.ndarray:
    """Windows, by start, that are repeats, once all answers are there."""
    from_, to, gone_from, gone_to = scan.open_spans(part, True)
    places = _each(from_, to)
    places = places[~scan.flags(part, "first3")[places]]
    marks = np.zeros(len(scan.values) + 2, np.int32)
    np.add.at(marks, gone_from, 1)
    np.add.at(marks, gone_to + 1, -1)
    on = np.cumsum(marks)[:-1] > 0
    on[places] = True
    return on[:len(scan.values)]


def covered(windows: np.ndarray, window: int) -> np.ndarray:
    """Values that lie in one of the windows."""
    marks = np.zeros(len(windows) + window + 1, np.int32)
    starts = np.flatnonzero(windows)
    marks[starts] += 1
    marks[starts + window] -= 1
    return np.cumsum(marks)[:len(windows)] > 0


def first_places(rows: DataFrame) -> DataFrame:
    """The first place of each (key, whole). Rows of one document have one place per key, so none tie."""
    of = marks(rows.columns)
    if len(of) == 1:  # aggregates of numbers only are the cheaper ones
        return rows.groupBy("key", "whole").agg(F.min("id").alias("id"), F.min_by("place", "id").alias("place"))
    return rows.groupBy("key", "whole").agg(F.min(F.struct(*of, "place")).alias("at")).select("key", "whole", "at.*")


def _alone(rows: DataFrame) -> DataFrame:
    """Places whose key nothing else has."""
    columns = [F.min(c).alias(c) for c in [*marks(rows.columns), "place"]]
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *columns).where(f"n = 1 AND place <> {MANY}")


def by_document(docs: DataFrame, *told: tuple[str, DataFrame]) -> DataFrame:
    """``docs`` with the places told to each as list columns."""
    of = marks(docs.columns)
    for name, rows in told:
        lists = rows.select(*of, "place").repartition(*of).groupBy(*of).agg(F.collect_list("place").alias(name))
        docs = docs.join(lists.hint("shuffle_hash"), of, "left").select(*docs.columns, name)
    return docs


def unique_keys(docs: DataFrame, key: str) -> bool:
    """Whether no two rows have one key; reads the keys only."""
    return docs.groupBy(F.col(key).cast("long")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def documents(docs: DataFrame, key: str, text: str, *more) -> DataFrame:
    """(id, text, ...), with ``MARKS`` after the text if any id has several texts."""
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *more
    )
    if unique_keys(docs, key):
        return rows
    found = [F.xxhash64("text").alias(MARKS[0]), F.xxhash64(F.lit(MARKS[1]), "text").alias(MARKS[1])]
    ends = [f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in MARKS]
    several = " OR ".join(f"min_{c} <> max_{c}" for c in MARKS)
    if rows.select("id", *found).groupBy("id").agg(*ends).where(several).isEmpty():
        return rows
    return rows.select("id", "text", *found, *rows.columns[2:])


def typed(of: list[str]) -> str:
    """The types of the columns that tell documents apart."""
    return ", ".join(f"{c} long" for c in of)


def own_key(docs: DataFrame, key: str):
    """The key as it was, from ``id``."""
    return F.when(F.col("id") != NULL_ID, F.col("id")).cast(docs.schema[key].dataType).alias(key)


def with_answers(docs: DataFrame, shape: Shape, key: str, text: str) -> DataFrame:
    """(id, size, body, lists of places ...) from which ``repeat_windows`` reads the answer.

    All steps read the same columns, so the compressed texts have one exchange that they share.
    """
    source = documents(docs, key, text)
    of = marks(source.columns)
    phrases = source.mapInArrow(_emit(shape, 0), f"key long, {typed(of)}, place int")
    packed = source.mapInArrow(K.zipped, "id long, size long, body binary" + "".join(f", {c} long" for c in of[1:]))
    state = by_document(packed, ("alone0", _alone(phrases)))
    columns = ["id", "size", "body", *of[1:], "alone0"]

    def next_step(step: int, alone: bool) -> None:
        nonlocal state
        rows = state.select(*columns).mapInArrow(_emit(shape, step), f"key long, whole long, {typed(of)}, place int")
        first = first_places(rows)
        told = [(f"first{step}", first)]
        if alone:
            told.append((f"alone{step}", _alone(first)))
        state = by_document(state, *told)
        columns.extend(name for name, _ in told)

    next_step(1, True)
    if shape.cell > 1:
        next_step(2, True)
    next_step(3, False)
    return state
