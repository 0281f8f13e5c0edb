"""Whole texts to the piece ids of a public SentencePiece model and back, with the bytes behind each piece.

A text is normalised by the model's compiled character map (``charmap``), which keeps for each byte of
the result the place of the source it stands for. The result is cut where no piece of the vocabulary can
reach across, before a space mark that follows another character; the words between are looked up
among those the task remembers, and new ones are segmented by the library under a model whose
normaliser does nothing. Ends of pieces in the normalised text lead back to bytes of the source.

The ids are those the library gives for the whole text: merges inside a word do not depend on what
stands around it, and none crosses the cuts. A vocabulary with a piece that does cross them is used
on uncut texts. A long text is looked at in stretches of about a megabyte; a word without an end, however
long, is one stretch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .charmap import SPACE_MARK, CharacterMap, Normalizer, gather

#: Different words that a task remembers at most, and their bytes. Beyond this it forgets all and starts anew.
REMEMBERED, REMEMBERED_BYTES = 250_000, 32 << 20
#: Words that the library gets in one call.
AT_ONCE = 4_000
#: Ids that are decoded together.
IDS_AT_ONCE = 200_000


class Codec:
    """A model that encodes with offsets and decodes."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as file:
            proto = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        said = proto.normalizer_spec
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with space marks behind words are not supported")
        self.normalizer = Normalizer(
            CharacterMap(said.precompiled_charsmap), said.add_dummy_prefix, said.remove_extra_whitespaces, said.escape_whitespaces
        )
        proto.normalizer_spec.Clear()
        proto.normalizer_spec.name = "identity"
        proto.normalizer_spec.add_dummy_prefix = False
        proto.normalizer_spec.remove_extra_whitespaces = False
        proto.normalizer_spec.escape_whitespaces = self.normalizer.escape
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        mark = SPACE_MARK.decode()
        pieces = [p.piece for p in proto.pieces]
        if any(p.type == p.USER_DEFINED for p in proto.pieces) and self.normalizer.map:
            raise ValueError("models with symbols that bypass the character map are not supported")
        self.splits = self.normalizer.escape and not any(mark in p.lstrip(mark) for p in pieces)
        plain = proto.pieces[0].NORMAL
        self.plain = np.array([p.type == plain for p in proto.pieces])
        self.bytes = np.array([len(p.piece.encode()) for p in proto.pieces], np.int32)
        #: Pieces before which ids may be cut for decoding: one mark, then something else.
        self.opens = np.array([p.type == plain and p.piece[:1] == mark and p.piece[1:2] not in ("", mark) for p in proto.pieces])
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.weight = 0
        self.sizes, self.starts = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        #: Of all remembered pieces: id, first byte and end in the word.
        self.pieces = np.zeros((3, 1 << 18), np.int32)
        self.used = 0

    def _segment(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of words in pieces, and (id, begin, end) of these."""
        ids = self.segmenter.encode(words, num_threads=1)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
        width = self.bytes[flat]
        ends = np.cumsum(width)
        before = np.append(0, np.cumsum(sizes))
        lead = np.repeat(np.append(0, ends)[before[:-1]], sizes)
        found = np.stack([flat, ends - width - lead, ends - lead]).astype(np.int32)
        # Bytes of a character without a piece, and unknown pieces, are not as long as their names.
        odd = np.unique(np.searchsorted(before, np.flatnonzero(~self.plain[flat]), "right") - 1)
        if len(odd):
            told = self.segmenter.encode([words[i] for i in odd.tolist()], return_type="offset_mapping", num_threads=1)
            places = gather(np.arange(len(flat)), before[odd], sizes[odd])
            found[1:, places] = np.array(list(chain.from_iterable(x["offsets"] for x in told)), np.int32).T
        return sizes, found

    def learn(self, words: list[bytes]) -> None:
        for at in range(0, len(words), AT_ONCE):
            part = words[at:at + AT_ONCE]
            sizes, found = self._segment(part)
            n, total = len(self.known), found.shape[1]
            while n + len(part) > len(self.sizes):
                self.sizes, self.starts = np.resize(self.sizes, 2 * len(self.sizes)), np.resize(self.starts, 2 * len(self.starts))
            while self.used + total > self.pieces.shape[1]:
                self.pieces = np.concatenate([self.pieces, np.zeros_like(self.pieces)], axis=1)
            self.sizes[n:n + len(part)] = sizes
            self.starts[n:n + len(part)] = self.used + np.cumsum(sizes) - sizes
            self.pieces[:, self.used:self.used + total] = found
            self.used += total
            self.known.update(zip(part, range(n, n + len(part))))
            self.weight += sum(map(len, part))

    def _cuts(self, normal) -> np.ndarray:
        """Where words begin in the normalised texts."""
        data = normal.data
        begin = np.zeros(len(data) + 1, bool)
        if self.splits and len(data) > 2:
            mark = np.frombuffer(SPACE_MARK, np.uint8)
            is_mark = (data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2])
            begin[:-3][is_mark] = True
            after = np.flatnonzero(is_mark) + 3
            begin[after] = False  # a mark that follows a mark
        begin[normal.offsets] = True
        return np.flatnonzero(begin[:-1])

    def encode(self, data: np.ndarray, offsets: np.ndarray, head: np.ndarray | None = None, tail: np.ndarray | None = None):
        """Pieces of texts: ids, begins and ends in ``data``, and where the pieces of each text begin."""
        normal = self.normalizer.normalize(data, offsets, head, tail)
        starts = self._cuts(normal)
        ends = np.append(starts[1:], len(normal.data))[:len(starts)]
        buffer = normal.data.tobytes()
        words = [buffer[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        if len(self.known) > REMEMBERED or self.weight > REMEMBERED_BYTES:
            self.forget()
        self.learn(list(set(words).difference(self.known)))
        which = np.fromiter(itemgetter(*words, words[0])(self.known), np.int64, len(words) + 1)[:-1] if words else np.zeros(0, np.int64)
        sizes = self.sizes[which]
        at = np.repeat(self.starts[which] - (np.cumsum(sizes) - sizes), sizes)
        at += np.arange(len(at))
        ids, begin, end = (row[at] for row in self.pieces)
        lead = np.repeat(starts, sizes)
        before = np.append(0, np.cumsum(sizes))[np.searchsorted(starts, normal.offsets)]
        # A piece ends where the next unit of the source begins, the last one where its text ends.
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
        stop = lead + end
        last = stop >= normal.offsets[text + 1] if len(text) else np.zeros(0, bool)
        source = np.append(normal.source, 0)
        begins = source[lead + begin]
        ends_ = np.where(last, normal.final[text], source[np.minimum(stop, len(normal.source))]) if len(text) else begins
        return ids, begins, ends_, before

    def parts(self, data: np.ndarray) -> np.ndarray:
        """Offsets of the stretches in which a document is looked at."""
        cuts, at = [0], 0
        while self.splits and len(data) - at > K.CHUNK_BYTES:
            to, high = -1, at + K.CHUNK_BYTES
            while True:
                to = self.normalizer.safe_cut(data, max(at, high - K.CHUNK_BYTES), high)
                if to < high or high >= len(data):
                    break
                high = min(len(data), high + K.CHUNK_BYTES)
            if to <= at or to >= len(data):
                break
            cuts.append(to)
            at = to
        return np.array([*cuts, len(data)])

    def decode(self, ids: np.ndarray) -> str:
        """What the library's ``decode`` gives for the ids, in parts that it decodes alike.

        A part begins with a mark that decoding takes away at the beginning of a text, and gives back here.
        """
        if len(ids) <= IDS_AT_ONCE:
            return self.model.decode(ids.tolist())
        cuts, at = [0], IDS_AT_ONCE
        may = np.flatnonzero(self.opens[ids])
        while at < len(ids):
            i = np.searchsorted(may, at)
            if i == len(may):
                break
            cuts.append(int(may[i]))
            at = cuts[-1] + IDS_AT_ONCE
        out = []
        for a, b in zip(cuts, [*cuts[1:], len(ids)]):
            part = self.model.decode(ids[a:b].tolist())
            drops = self.normalizer.dummy_prefix or self.normalizer.remove_extra
            out.append(" " + part if a and drops else part)
        return "".join(out)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per Python worker, which serves all its tasks."""
    return Codec(path)


def _lists(before: np.ndarray, *values: np.ndarray) -> list[pa.ListArray]:
    offsets = pa.array(before.astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in values]


def _encoding(path: str):
    """A function for mapInArrow: (key, text) to (key, n_bytes, ids, begins, ends)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part, texts in K.chunks(batch):
                if len(texts) == 1 and len(texts.data) > K.CHUNK_BYTES:
                    cuts = own.parts(texts.data)
                    found = []
                    for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                        ids, begins, ends, _ = own.encode(
                            texts.data[a:b], np.array([0, b - a]), np.array([a == 0]), np.array([b == len(texts.data)])
                        )
                        found.append((ids, begins.astype(np.int32) + np.int32(a), ends.astype(np.int32) + np.int32(a)))
                    ids, begins, ends = (np.concatenate(x) for x in zip(*found))
                    before = np.array([0, len(ids)])
                else:
                    ids, begins, ends, before = own.encode(texts.data, texts.offsets)
                    shift = np.repeat(texts.offsets[:-1], np.diff(before))
                    begins, ends = begins - shift, ends - shift
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(texts.offsets)), *_lists(before, ids, begins, ends)],
                    ["key", "n_bytes", "ids", "begins", "ends"],
                )

    return run


def _decoding(path: str):
    """A function for mapInArrow: (..., ids, ...) with the text of the ids behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            offsets = np.append(0, np.cumsum(ids.value_lengths())).tolist()
            flat = ids.flatten().to_numpy()
            texts = [own.decode(flat[a:b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return run


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes long, and of all its pieces ids, begins, ends (array<int>).

    With ``decoded`` also the text that the ids decode to, by the same worker.

    Piece i stands for the bytes ``begins[i]`` to ``ends[i]`` of the text in UTF-8. Spans follow each other without a
    gap, but for what normalisation takes away; the bytes of a character without a piece share its span, which the
    last of them holds; the space mark put before a text has an empty one. A NULL text is empty and has no pieces.
    Keys of any type, NULL, repeated rows and ties come back as they are; other columns play no part; an empty table
    gives none. A very long text is looked at in stretches, and its row holds 12 bytes a piece.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_bytes long, ids array<int>, begins array<int>, ends array<int>"
    wanted = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    if decoded:
        found = wanted.mapInArrow(lambda batches: _decoding(path)(_encoding(path)(batches)), f"{schema}, decoded string")
    else:
        found = wanted.mapInArrow(_encoding(path), schema)
    return found.select(F.col("key").alias(key), *found.columns[1:])


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows of ``encoded`` with the text of their ids as ``decoded`` (NULL ids: an empty text).

    A column of that name is replaced. Ids come from the model; others are an error of the library.
    """
    rest = [c for c in encoded.columns if c not in (ids, "decoded")]
    held = encoded.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest") if rest else F.lit(None).cast("int").alias("rest"),
        F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>")).alias("ids"),
    )
    found = held.mapInArrow(_decoding(path), f"rest {held.schema['rest'].dataType.simpleString()}, ids array<int>, decoded string")
    return found.select(*[F.col(f"rest.`{c}`") for c in rest], F.col("ids").alias(ids), "decoded")


@F.pandas_udf(T.StringType())
def digest(ids: pd.Series) -> pd.Series:
    """sha256 of the decimal ids joined by commas, as hexadecimal digits."""
    out = []
    for row in ids:
        state = hashlib.sha256()
        for at in range(0, len(row), IDS_AT_ONCE):
            state.update(("," * (at > 0) + ",".join(map(str, row[at:at + IDS_AT_ONCE].tolist()))).encode())
        out.append(state.hexdigest())
    return pd.Series(out, dtype=object)
