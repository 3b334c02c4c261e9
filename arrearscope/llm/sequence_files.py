"""Token ids as Arrow files of equally long sequences.

A file holds a range of documents in ascending order, their ids one after the other, cut into sequences of one length. It is
in Arrow's random-access format: record batches with two fixed-size-list columns, ``ids`` (unsigned, 16 bits if they hold the
vocabulary, else 32) and ``mask`` (a bit, set for an id, not for padding, which only a file's last sequence has). Because lists
of a fixed size have no offsets, the values of a batch are one flat buffer, and any sequence, run of sequences or document inside a
batch of a memory-mapped file is a view into it, without a copy. Next to it an index file, in the same format, says where each document
begins. ``SequenceFile`` reads both.

Spark cuts the documents into ranges of doc_id and sorts each; every task writes its files under names of
its own, and returns one row about them. The stored table of these rows is the data set's list of files: what a failed or repeated
attempt has left behind isn't in it. Tasks read the files back by it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.llm.token_pieces import Encoder
from arrearscope.sources.storage import scratch_path, stored

#: Ids of a sequence, and sequences of a record batch.
LENGTH, BATCH = 2_048, 256
#: Tasks that read files back, at most.
READERS = 20_000
#: Documents of a record batch of the index.
INDEX_BATCH = 65_536
#: The id after each document.
END_ID = 2
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
FILES = "part int, sequences string, documents string, n_documents long, n_ids long"


def id_type(greatest: int) -> type[np.unsignedinteger]:
    """The narrower of the two unsigned types that hold the ids."""
    return np.uint16 if greatest < 2**16 else np.uint32


def sequence_schema(length: int, kind: type[np.unsignedinteger] = np.uint32) -> pa.Schema:
    return pa.schema([
        pa.field("ids", pa.list_(pa.field("item", pa.from_numpy_dtype(kind), False), length), False),
        pa.field("mask", pa.list_(pa.field("item", pa.bool_(), False), length), False),
    ], {b"length": str(length).encode()})


class SequenceWriter:
    """Writes one file and its index; holds one record batch of ids at most, and one document."""

    def __init__(self, folder: str, name: str, length: int = LENGTH, batch: int = BATCH, kind: type[np.unsignedinteger] = np.uint32):
        self.files, path = arrow_fs.FileSystem.from_uri(folder)
        self.files.create_dir(path, recursive=True)
        self.paths = (f"{folder}/{name}.sequences.arrow", f"{folder}/{name}.documents.arrow")
        self.sinks = [self.files.open_output_stream(f"{path}/{p.rsplit('/', 1)[1]}") for p in self.paths]
        self.length, self.room = length, length * batch
        self.schema = sequence_schema(length, kind)
        self.sequences, self.index = pa.ipc.new_file(self.sinks[0], self.schema), pa.ipc.new_file(self.sinks[1], INDEX)
        self.held = np.empty(self.room, kind)
        self.used = self.n_ids = self.n_documents = 0
        self.rows: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.rows.append((doc_id, self.n_ids, len(ids)))
        self.n_documents += 1
        self.n_ids += len(ids)
        while len(ids):
            n = min(len(ids), self.room - self.used)
            self.held[self.used:self.used + n] = ids[:n]
            self.used += n
            ids = ids[n:]
            if self.used == self.room:
                self._write()
        if len(self.rows) == INDEX_BATCH:
            self._write_index()

    def _write(self) -> None:
        rows = -(-self.used // self.length)
        values = np.zeros(rows * self.length, self.held.dtype)
        values[:self.used] = self.held[:self.used]
        mask = np.arange(rows * self.length) < self.used
        self.sequences.write_batch(pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(pa.array(values), type=self.schema.field(0).type),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schema.field(1).type),
        ], schema=self.schema))
        self.used = 0

    def _write_index(self) -> None:
        columns = zip(*self.rows) if self.rows else ((), (), ())
        self.index.write_batch(pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=INDEX))
        self.rows.clear()

    def close(self) -> None:
        if self.used:
            self._write()
        self._write_index()
        for part in (self.sequences, self.index, *self.sinks):
            part.close()


class SequenceFile:
    """Random access to one file of sequences: views where memory can be mapped, else reads of the batches asked for."""

    def __init__(self, sequences: str, documents: str | None = None):
        self.source = pa.ipc.open_file(_opened(sequences))
        self.length = int(self.source.schema.metadata[b"length"])
        self.index = pa.ipc.open_file(_opened(documents)) if documents else None
        self._last: tuple[int, pa.RecordBatch] | None = None
        # all batches but the last are equally long
        self.batch = self.source.get_batch(0).num_rows if self.source.num_record_batches else 0

    def __len__(self) -> int:
        n = self.source.num_record_batches
        return (n - 1) * self.batch + self._batch(n - 1).num_rows if n else 0

    def _batch(self, i: int) -> pa.RecordBatch:
        if self._last is None or self._last[0] != i:
            self._last = i, self.source.get_batch(i)
        return self._last[1]

    def _values(self, i: int) -> np.ndarray:
        return self._batch(i).column(0).flatten().to_numpy(zero_copy_only=True)

    def ids(self, i: int) -> np.ndarray:
        """The ids of sequence ``i``, padding included; not a copy."""
        at = i % self.batch * self.length
        return self._values(i // self.batch)[at:at + self.length]

    def mask(self, i: int) -> pa.BooleanArray:
        """Which ids of sequence ``i`` are not padding; not a copy, so packed bits."""
        return self._batch(i // self.batch).column(1).flatten().slice(i % self.batch * self.length, self.length)

    def run(self, start: int, length: int) -> Iterator[np.ndarray]:
        """The ids from place ``start`` of the file on, a view for each batch that they lie in."""
        room = self.batch * self.length
        while length:
            at = start % room
            piece = self._values(start // room)[at:at + length]
            yield piece
            start, length = start + len(piece), length - len(piece)

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """(doc_id, start, length) of all documents, in the file's order."""
        for i in range(self.index.num_record_batches):
            yield from zip(*(c.to_pylist() for c in self.index.get_batch(i).columns))


def _opened(uri: str):
    files, path = arrow_fs.FileSystem.from_uri(uri)
    return pa.memory_map(path) if isinstance(files, arrow_fs.LocalFileSystem) else files.open_input_file(path)


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def _writer(folder: str, tokenizer: str, end_id: int, length: int):
    """For ``mapInArrow``: sorted (doc_id, text) to a row about the files that the task has written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = encoder = None
        part, end = TaskContext.get().partitionId(), np.array([end_id], np.uint32)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                encoder = encoder or Encoder(tokenizer)
                writer = writer or SequenceWriter(
                    folder, f"{part:06d}-{uuid.uuid4().hex}", length, kind=id_type(max(encoder.exact.get_vocab_size(), end_id + 1) - 1))
                writer.add(doc_id, np.concatenate([np.frombuffer(encoder.ids(text.as_py()), "<u4"), end]))
        if writer:
            writer.close()
            row = (part, *writer.paths, writer.n_documents, writer.n_ids)
            kinds = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, kinds)], names=["part", "sequences", "documents", "n_documents", "n_ids"])

    return run


def write_sequences(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """Write ``docs`` (doc_id, text) to files below ``folder``; the stored table of the files, with ``before``, the ids in those before.

    ``folder`` is one that all executors reach, by default a new one in the session's shared folder.
    Documents are ordered by doc_id, then by a hash of the text and their place in the table, so rows that share a doc_id can be
    dealt over several files. Null text is empty, null doc_id comes first. Without rows there are no files.
    """
    folder = _uri(folder or scratch_path(docs.sparkSession, "sequences"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row")).withColumn("hash", F.xxhash64("text"))
    ranges = rows.repartitionByRange("doc_id", "hash", "row").sortWithinPartitions("doc_id", "hash", "row")
    files = stored(ranges.select("doc_id", "text").mapInArrow(_writer(folder, tokenizer, end_id, length), FILES), "files")
    # one row a file, and a file is a whole partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: (sequences, documents, before) to (doc_id, start, n_tokens, ids_crc32) read from the files."""
    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*found)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    for batch in batches:
        for sequences, documents, before in zip(*(c.to_pylist() for c in batch.columns)):
            file, found = SequenceFile(sequences, documents), []
            for doc_id, start, length in file.documents():
                crc = 0
                for piece in file.run(start, length):
                    crc = zlib.crc32(piece.astype("<u4"), crc)
                found.append((doc_id, before + start, length, crc))
                if len(found) == INDEX_BATCH:
                    yield rows(found)
                    found = []
            if found:
                yield rows(found)


def _spread(files: DataFrame) -> DataFrame:
    """A file a task, up to ``READERS`` tasks: the rows are few and short, so that Spark would read all files in one."""
    return files.repartition(max(1, min(files.count(), READERS)))


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of every document in ``files``."""
    return _spread(files.select("sequences", "documents", "before")).mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_sequences(files: DataFrame) -> DataFrame:
    """file, sequence (from 0 in the file), ids and mask (lists of one length, 1 for an id) of every sequence in ``files``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                file, n = SequenceFile(uri), 0
                for i in range(file.source.num_record_batches):
                    one = file.source.get_batch(i)
                    ends = pa.array(np.arange(0, (one.num_rows + 1) * file.length, file.length, dtype=np.int32))
                    ids, mask = (pa.ListArray.from_arrays(ends, c.flatten()) for c in one.columns)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([uri] * one.num_rows), pa.array(range(n, n + one.num_rows), pa.int64()),
                        ids.cast(pa.list_(pa.int64())), mask.cast(pa.list_(pa.int32()))], names=["file", "sequence", "ids", "mask"])
                    n += one.num_rows

    return _spread(files.select("sequences")).mapInArrow(run, "file string, sequence long, ids array<long>, mask array<int>")


def tokenised_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row of ``docs``, read back from the files written.

    Only doc_id and text are read, so further columns can't clash; see ``write_sequences`` for nulls and repeated rows.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return read_documents(write_sequences(docs, tokenizer))
