"""Numpy helpers that look at all texts of an Arrow batch at once; they run inside Spark's tasks.

A batch of texts is one array of bytes with the offsets of its documents. Fingerprints are
polynomials over 64-bit numbers: prefix sums give the one of any stretch in a few vector steps,
and a last mixing step spreads it over all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text that are looked at together. A longer document is looked at alone.
CHUNK_BYTES = 1 << 20
#: Odd multipliers of the two independent fingerprints.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all others (a one-to-one map)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number and of its inverse, modulo 2^64.

    A worker keeps one table per number, as long as its longest chunk of text.
    """
    up, down = _TABLES.get(base, (np.zeros(0, np.uint64),) * 2)
    if len(up) < n:
        size = max(n, CHUNK_BYTES + 1)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        up, down = _TABLES[base] = np.cumprod(up), np.cumprod(down)
    return up[:n], down[:n]


def stretches(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """Fingerprints of ``values[start:end]`` for each pair."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def grams(values: np.ndarray, size: int, base: int = BASES[0]) -> np.ndarray:
    """Fingerprints of all ``size`` neighbouring values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mix((sums[size:] - sums[:n]) * down[:n])


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


@dataclass
class Texts:
    """The texts of some documents: ``data[offsets[i]:offsets[i + 1]]`` is the i-th (NULL is empty)."""

    ids: pa.Array
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


@dataclass
class Words:
    """Words of ``Texts``: document i has the words ``first[i]`` up to ``first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; NULL is empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.dtype(np.int64 if wide else np.int32)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind.itemsize).astype(np.int64)
    size = int(offs[-1] - offs[0])
    bytes_ = np.frombuffer(data, np.uint8, size, int(offs[0])) if size else np.zeros(0, np.uint8)
    return bytes_, offs - offs[0]


def chunks(batch: pa.RecordBatch, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batch in slices of about ``limit`` bytes of text; columns are (id, text, ...)."""
    _, offsets = buffer_of(batch.column(1))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        part = batch.slice(at, to - at)
        yield part, Texts(part.column(0), *buffer_of(part.column(1)))
        at = to


@lru_cache(maxsize=1)
def _codec() -> pa.Codec:
    return pa.Codec("zstd", 3)


def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, ...) to (id, size, body, ...): the text compressed, for an exchange that is read many times."""
    for batch in batches:
        data, offsets = buffer_of(batch.column(1))
        at = offsets.tolist()
        bodies = [_codec().compress(data[a:b], asbytes=True) if b > a else b"" for a, b in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), pa.array(bodies, pa.binary()), *batch.columns[2:]],
            ["id", "size", "body", *batch.schema.names[2:]],
        )


def unzipped(batch: pa.RecordBatch, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The same slices as ``chunks``, of a batch (id, size, body, ...)."""
    ends = np.append(0, np.cumsum(np.asarray(batch.column(1))))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        part = batch.slice(at, to - at)
        sizes = np.diff(ends[at:to + 1]).tolist()
        texts = [_codec().decompress(b.as_buffer(), k, asbytes=True) if k else b"" for b, k in zip(part.column(2), sizes)]
        yield part, Texts(part.column(0), np.frombuffer(b"".join(texts), np.uint8), ends[at:to + 1] - ends[at])
        at = to


def words_of(texts: Texts) -> Words:
    """Runs of bytes that are neither a blank nor 0x09 to 0x0D."""
    n = len(texts.data)
    inside = np.zeros(n + 2, bool)
    np.logical_not(_SEPARATOR[texts.data], out=inside[1:-1])
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return Words(starts, ends, np.searchsorted(starts, texts.offsets))


def word_values(texts: Texts, words: Words) -> np.ndarray:
    """A 64-bit fingerprint of each word."""
    return stretches(byte_values(texts.data), words.starts, words.ends)


def minimizers(keys: np.ndarray, width: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of ``width`` neighbouring keys its smallest one (the first of equals).

    ``valid`` says which windows count. Returns for every run of neighbouring windows with the same
    smallest key: its place, the first and the last window. Equal windows choose the same place in
    themselves whatever surrounds them.
    """
    bits = max(1, int(len(keys)).bit_length())
    low = _U((1 << bits) - 1)
    packed = (keys & ~low) | np.arange(len(keys), dtype=np.uint64)
    least, reach = packed, 1
    while reach < width:
        step = min(reach, width - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    windows = np.flatnonzero(valid)
    if len(windows) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    chosen = least[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (windows[1:] != windows[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(windows)) - 1
    return (chosen[at] & low).astype(np.int64), windows[at], windows[last]


def within(first: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which windows of ``size`` values, by start, lie within one document."""
    n = total - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    good = np.ones(n, bool)
    for shift in range(1, size):
        at = first[1:-1] - shift
        good[at[(at >= 0) & (at < n)]] = False
    return good
