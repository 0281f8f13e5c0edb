"""Token ids as Arrow files of equal-length sequences and masks, and random access to them.

A file is Arrow's file format of the stream: record batches with the columns ``ids``
(fixed_size_list<uint16>[length], uint32 for vocabularies over 65 536) and ``mask`` (fixed_size_list<bool>[length]). Every sequence has the same
width, so the i-th lies at a computed place of a computed batch and is read without a copy where
the file can be mapped. A file holds the documents of one range of keys in order, end to end; only
its last sequence is padded, with id 0 and mask 0.

Files are written by the tasks, under names that hold the attempt, so that a repeated task never
touches another's file. The index (one row per document) is a Parquet table that Spark commits; files
that it does not name do not count.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import scratch_path
from . import kernels as K
from . import tokens

LENGTH = 2048
SEQUENCES_PER_BATCH = 256
END = 1


def schema(length: int, vocabulary: int) -> pa.Schema:
    """The narrowest ids that hold the vocabulary."""
    kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


def file_system(uri: str):
    """The file system of a folder or file name, and the name within it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class Writer:
    """Appends ids to a file, cut into sequences."""

    def __init__(self, uri: str, length: int, vocabulary: int):
        self.length, self.schema = length, schema(length, vocabulary)
        self.kind = self.schema.field("ids").type.value_type.to_pandas_dtype()
        system, name = file_system(uri)
        system.create_dir(name.rpartition("/")[0], recursive=True)
        self.sink = system.open_output_stream(name)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.count = self.total = 0

    def append(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.count += len(ids)
        self.total += len(ids)
        block = self.length * SEQUENCES_PER_BATCH
        if self.count >= block:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // block * block
            for at in range(0, whole, block):
                self._batch(ids[at:at + block], block)
            self.waiting, self.count = [ids[whole:]], len(ids) - whole

    def _batch(self, ids: np.ndarray, size: int) -> None:
        padded, mask = np.zeros(size, self.kind), np.zeros(size, bool)
        padded[:len(ids)], mask[:len(ids)] = ids, True
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (padded, mask)]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.count:
            ids = np.concatenate(self.waiting)
            self._batch(ids, -(-len(ids) // self.length) * self.length)
        self.file.close()
        self.sink.close()


class Reader:
    """Random access to the sequences, and to the ids end to end, of one file."""

    def __init__(self, uri: str):
        system, name = file_system(uri)
        self.source = pa.memory_map(name) if system.type_name == "local" else system.open_input_file(name)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.at, self.batch = -1, None

    def _load(self, number: int) -> pa.RecordBatch:
        if number != self.at:
            self.batch, self.at = self.file.get_batch(number), number
        return self.batch

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of the i-th sequence."""
        batch, row = self._load(i // SEQUENCES_PER_BATCH), i % SEQUENCES_PER_BATCH
        cut = slice(row * self.length, (row + 1) * self.length)
        ids, mask = (batch.column(c).flatten()[cut] for c in (0, 1))
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def pieces(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, a batch at a time."""
        block = self.length * SEQUENCES_PER_BATCH
        while n > 0:
            ids = np.asarray(self._load(start // block).column(0).flatten())
            part = ids[start % block:start % block + n]
            if not len(part):
                raise ValueError("the file ends before the document")
            yield part
            start, n = start + len(part), n - len(part)

    def close(self) -> None:
        self.batch = self.file = None
        self.source.close()


def _write(folder: str, path: str, length: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        vocabulary = max(encoder.tokenizer.get_vocab_size(), end + 1)
        context = TaskContext.get()
        uri = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.arrow"
        writer = None
        for batch in batches:
            for part, texts in K.chunks(batch):
                writer = writer or Writer(uri, length, vocabulary)
                ids, offsets = encoder.encode(texts, end)
                starts = writer.total + offsets[:-1]
                writer.append(ids)
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(np.full(n, context.partitionId(), np.int32)),
                        pa.array([uri] * n), pa.array(starts), pa.array(np.diff(offsets)),
                    ],
                    ["key", "part", "file", "start", "n_tokens"],
                )
        if writer:
            writer.close()

    return run


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text",
    length: int = LENGTH, end: int = END,
) -> DataFrame:
    """Write the ids of all documents, each followed by ``end``, in ascending order of ``key``.

    ``folder`` must be one that all executors share. Returns the index, one row per row of ``docs``:
    key, part, file, start (place in the file), n_tokens. A NULL text is empty and still gets its end
    id. A NULL key comes first; rows of one key come in the order of their texts. An empty table
    writes an empty index. Other columns play no part.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), body.alias("text"), F.xxhash64(body).alias("tie"))
    ordered = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie", "text")
    kind = dict(docs.dtypes)[key]
    index = ordered.select("key", "text").mapInArrow(
        _write(folder, tokenizer, length, end), f"key {kind}, part int, file string, start long, n_tokens long"
    )
    index.write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(index.schema).parquet(f"{folder}/index")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, name = None, None
    for batch in batches:
        crcs = []
        for row in batch.select(["file", "start", "n_tokens"]).to_pylist():
            if row["file"] != name:
                if reader:
                    reader.close()
                name = row["file"]
                reader = Reader(name)
            crc = 0
            for ids in reader.pieces(row["start"], row["n_tokens"]):
                crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"), crc)
            crcs.append(crc)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(batch.schema.get_field_index(c)) for c in ("key", "part", "start", "n_tokens")], pa.array(crcs, pa.int64())],
            ["key", "part", "start", "n_tokens", "ids_crc32"],
        )
    if reader:
        reader.close()


def read_tokens(index: DataFrame, key: str = "doc_id") -> DataFrame:
    """Read all files of an index back: key, start (ids of all documents before), n_tokens, ids_crc32."""
    kind = dict(index.dtypes)["key"]
    rows = index.repartition("file").sortWithinPartitions("file", "start").mapInArrow(
        _read, f"key {kind}, part int, start long, n_tokens long, ids_crc32 long"
    )
    # One row per file: this is summed up in one place.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    bases = sizes.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return rows.join(bases, "part").select(
        F.col("key").alias(key), (F.col("_base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_folder(spark: SparkSession) -> str:
    """A new folder for token files under the one that the session's executors share."""
    return scratch_path(spark, "tokens")
