"""Exact removal of repeated word passages by windows grouped around anchors.

Windows are grouped and compared by fingerprint in rounds (``repeats``). This is not relative
Lempel-Ziv parsing: no document is factored against a reference, and ``factors`` only names the
runs of words that the finished mask removes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from . import repeats

#: Words of an anchor. Fewer make fewer phrases, but more of them share an anchor by chance.
GRAM = 6
SCHEMA = "id long, n_words long, n_removed long, spans array<struct<first:int,words:int>>, kept string"


def factors(removed: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest runs of removed values, none across documents."""
    padded = np.zeros(len(removed) + 2, bool)
    padded[1:-1] = removed
    edge = np.zeros(len(removed) + 1, bool)
    edge[first] = True
    starts = np.flatnonzero(padded[1:] & (~padded[:-1] | edge))
    ends = np.flatnonzero(padded[:-1] & (~padded[1:] | edge))
    return starts, ends


def joined(texts: K.Texts, words: K.Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of each document with one blank between them: bytes and offsets."""
    data = np.append(texts.data, np.uint8(0x20))
    rank = np.append(0, np.cumsum(kept))
    last = rank[words.first[1:]]
    document = words.document
    blank = kept & (rank[1:] < last[document])
    marks = np.zeros(len(data) + 1, np.int32)
    marks[words.starts[kept]] += 1
    ends = words.ends + blank
    np.add.at(marks, ends[kept], -1)
    data[words.ends[blank]] = 0x20
    inside = np.cumsum(marks[:-1]) > 0
    sizes = np.append(0, np.cumsum(inside))
    return data[inside], sizes[texts.offsets]


def _answers(shape: repeats.Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in K.unzipped(batch):
                scan = repeats.Scan(shape, texts)
                removed = repeats.covered(repeats.repeat_windows(scan, part), shape.window)
                gone = np.append(0, np.cumsum(removed))
                starts, ends = factors(removed, scan.first)
                by = np.searchsorted(starts, scan.first)
                owner = scan.document(starts)
                spans = pa.StructArray.from_arrays(
                    [pa.array((starts - scan.first[owner]).astype(np.int32)), pa.array((ends - starts).astype(np.int32))],
                    ["first", "words"],
                )
                data, offsets = joined(texts, scan.words, ~removed)
                kept = pa.StringArray.from_buffers(
                    len(texts), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(scan.first)), pa.array(gone[scan.first[1:]] - gone[scan.first[:-1]]),
                        pa.ListArray.from_arrays(pa.array(by.astype(np.int32)), spans), kept,
                    ],
                    ["id", "n_words", "n_removed", "spans", "kept"],
                )

    return run


def remove_repeats(docs: DataFrame, window: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_removed, ``spans`` of removed words, ``kept`` text.

    A word is removed when one of the ``window``-word passages over it also starts earlier (smaller
    key, or same key and earlier start), judged on the input. ``kept`` joins the other words by one
    blank. A NULL or empty text has no words; texts under ``window`` words lose none. Copies of a row are
    one document; other texts of a key are documents of their own, in the order of their fingerprints. A
    NULL key is the smallest. Other columns play no part.
    """
    shape = repeats.Shape("word", window, min(GRAM, window))
    state = repeats.with_answers(docs, shape, key, text)
    found = state.mapInArrow(_answers(shape), SCHEMA)
    return found.select(repeats.own_key(docs, key), "n_words", "n_removed", "spans", "kept")
