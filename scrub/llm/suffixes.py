"""Exact removal of repeated byte strings by prefix doubling over sampled suffixes.

A suffix array sorts all suffixes; prefix doubling gets there by ranking the prefixes of length h of
every position and pairing ranks h apart, so that each round ranks longer prefixes, and positions
that have become unique drop out. For removing strings of ``length`` bytes it can stop once ranks
cover that many bytes. Done over every byte, each round would sort eight bytes of rank and eight
of position per byte of text, more than ten times the corpus. So three things differ:

- Rounds start at suffixes that the text itself picks (``repeats``), about one in 38 bytes; any two
  equal strings of ``length`` bytes are picked at the same places.
- A rank is a fingerprint of the prefix, which any task can form from the text in one step as the
  combination of the ranks of its parts, so lengths need not double: they grow from 24 (unique: out)
  to 92 (unique: out) to 100, the threshold.
- Rows are brought together by Spark's shuffle and aggregates on ranks rather than by one total
  order: only equality and the first place of a rank matter here, not which suffix is the smaller.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from . import repeats
from .substrings import factors

#: First prefix length, and how many neighbouring strings the second round takes together.
FIRST_LENGTH, TOGETHER = 24, 9
SCHEMA = "id long, n_bytes long, n_removed long, spans array<struct<first:int,bytes:int>>, kept binary"


def _answers(shape: repeats.Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in K.unzipped(batch):
                scan = repeats.Scan(shape, texts)
                removed = repeats.covered(repeats.repeat_windows(scan, part), shape.window)
                gone = np.append(0, np.cumsum(removed))
                lost = gone[texts.offsets[1:]] - gone[texts.offsets[:-1]]
                starts, ends = factors(removed, texts.offsets)
                by = np.searchsorted(starts, texts.offsets)
                spans = pa.StructArray.from_arrays(
                    [
                        pa.array((starts - texts.offsets[scan.document(starts)]).astype(np.int32)),
                        pa.array((ends - starts).astype(np.int32)),
                    ],
                    ["first", "bytes"],
                )
                offsets = texts.offsets - gone[texts.offsets]
                kept = pa.Array.from_buffers(
                    pa.binary(), len(texts),
                    [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(texts.data[~removed].tobytes())],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(np.diff(texts.offsets)),
                        pa.array(lost), pa.ListArray.from_arrays(pa.array(by.astype(np.int32)), spans), kept,
                    ],
                    ["id", "n_bytes", "n_removed", "spans", "kept"],
                )

    return run


def remove_repeated_bytes(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_removed, ``spans`` of removed bytes, ``kept`` bytes.

    A byte of the UTF-8 text is removed when one of the ``length``-byte strings over it also starts
    earlier (smaller key, or same key and earlier start), judged on the input; strings never cross
    documents, and may begin or end inside a character, so ``kept`` is binary. A NULL or empty text
    has no bytes. Copies of a row are one document; other texts of a key are documents of their own, in
    the order of their fingerprints. A NULL key is the smallest. Other columns play no part.
    """
    first = min(FIRST_LENGTH, max(1, length - TOGETHER + 1))
    shape = repeats.Shape("byte", length, first, min(TOGETHER, length - first + 1))
    state = repeats.with_answers(docs, shape, key, text)
    found = state.mapInArrow(_answers(shape), SCHEMA)
    return found.select(repeats.own_key(docs, key), "n_bytes", "n_removed", "spans", "kept")
