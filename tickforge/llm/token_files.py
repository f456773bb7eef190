"""Token ids in Arrow files of equal-length sequences with masks."""

from __future__ import annotations

import uuid
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import local_form, stored
from tickforge.session import scratch_path

LENGTH = 1024
SEQUENCES = 256
END_ID = 1
WRITTEN = "shard int, path string, documents long, tokens long"

_encoders: dict = {}


def encoder(path: str):
    """The worker's encoder of a vocabulary; its caches serve all tasks of the worker."""
    if path not in _encoders:
        from tickforge.llm.subwords import WordBPE

        _encoders[path] = WordBPE(path)
    return _encoders[path]


class SequenceFile:
    """Writes a stream of ids as fixed-size lists, and the documents' places beside it."""

    def __init__(self, fs, path: str, id_type: pa.DataType, key_type: pa.DataType, length: int, sequences: int):
        self.length, self.sequences, self.id_type, self.key_type = length, sequences, id_type, key_type
        self.schema = pa.schema([("ids", pa.list_(id_type, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.index = pa.schema([("doc_id", key_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.streams = [fs.open_output_stream(f"{path}.{kind}") for kind in ("arrow", "docs.arrow")]
        self.ids_file = pa.ipc.new_file(self.streams[0], self.schema)
        self.docs_file = pa.ipc.new_file(self.streams[1], self.index)
        self.waiting, self.held, self.keys, self.starts, self.counts = [], 0, [], [], []
        self.tokens = self.documents = 0

    def add(self, key, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.starts.append(self.tokens)
        self.counts.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        self.tokens += len(ids)
        self.documents += 1
        if self.held >= self.length * self.sequences:
            self._write(False)
        if len(self.keys) >= 10_000:
            self._write_index()

    def _write(self, last: bool) -> None:
        flat = np.concatenate(self.waiting)
        step = self.length * self.sequences
        whole = len(flat) // step * step
        for i in range(0, whole, step):
            self._batch(flat[i: i + step], step)
        rest = flat[whole:]
        if last and len(rest):
            padded = np.zeros(-(-len(rest) // self.length) * self.length, flat.dtype)
            padded[: len(rest)] = rest
            self._batch(padded, len(rest))
        self.waiting, self.held = [rest], len(rest)

    def _batch(self, flat: np.ndarray, valid: int) -> None:
        mask = np.arange(len(flat)) < valid
        self.ids_file.write_batch(pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(pa.array(flat, self.id_type), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def _write_index(self) -> None:
        self.docs_file.write_batch(pa.RecordBatch.from_arrays([
            pa.array(self.keys, self.key_type), pa.array(self.starts, pa.int64()), pa.array(self.counts, pa.int64())],
            schema=self.index))
        self.keys, self.starts, self.counts = [], [], []

    def close(self) -> None:
        if self.held:
            self._write(True)
        if self.keys:
            self._write_index()
        self.ids_file.close()
        self.docs_file.close()
        for s in self.streams:
            s.close()


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID,
    length: int = LENGTH, sequences: int = SEQUENCES,
) -> DataFrame:
    """Encodes whole texts and writes the ids, in ascending key order, to one file per task.

    A file holds record batches of ``sequences`` fixed-size lists of ``length`` ids with a mask
    that is false on padding; padding occurs only at a file's end.  A second file lists the
    documents' places.  The result lists the files of committed tasks; files of lost attempts
    have other names and are not in it.  Texts are moved once, ids never.

    Every document ends with ``end_id``, an empty or null text is that id alone.  Null keys come
    first, equal keys in the order of a hash of their texts; other columns are dropped.
    """
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")) \
        .withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        fs, root = local_form(folder)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        shard = task.partitionId() if task else 0
        path = f"{root}/{shard:06d}-{uuid.uuid4().hex}"
        coder = encoder(vocabulary)
        end = np.array([end_id], coder.dtype)
        out = None
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                if out is None:
                    id_type = pa.uint32() if coder.wide else pa.uint16()
                    out = SequenceFile(fs, path, id_type, to_arrow_type(kind), length, sequences)
                out.add(k, np.concatenate([coder.encode(t.as_py()), end]))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([path]), pa.array([out.documents], pa.int64()),
                pa.array([out.tokens], pa.int64())], ["shard", "path", "documents", "tokens"])

    return stored(rows.mapInArrow(write, WRITTEN), "token-files")


class SequenceReader:
    """Random access to the ids of one file; local files are mapped, not read."""

    def __init__(self, path: str):
        fs, inner = local_form(path)
        self.fs, self.inner = fs, inner
        self.file = pa.ipc.open_file(self._open(f"{inner}.arrow"))
        self.at, self.flat = -1, None
        if self.file.num_record_batches:
            first = self.file.get_batch(0)
            self.length, self.step = first.schema.field("ids").type.list_size, len(first.column(0))

    def _open(self, path: str):
        return pa.memory_map(path) if self.fs.type_name == "local" else self.fs.open_input_file(path)

    def documents(self):
        """Record batches of doc_id, start and n_tokens."""
        index = pa.ipc.open_file(self._open(f"{self.inner}.docs.arrow"))
        for i in range(index.num_record_batches):
            yield index.get_batch(i)

    def _batch_ids(self, i: int) -> np.ndarray:
        if i != self.at:
            column = self.file.get_batch(i).column("ids")
            self.at, self.flat = i, column.values.to_numpy(zero_copy_only=True)
        return self.flat

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``; the ids are a view of the file."""
        batch, row = divmod(i, self.step)
        ids = self._batch_ids(batch)[row * self.length: (row + 1) * self.length]
        mask = self.file.get_batch(batch).column("mask").slice(row, 1).flatten().to_numpy(zero_copy_only=False)
        return ids, mask

    def span(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count`` of the file's stream."""
        size, parts = self.length * self.step, []
        while count > 0:
            batch, inner = divmod(start, size)
            part = self._batch_ids(batch)[inner: inner + count]
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def read_tokens(files: DataFrame, key_type: T.DataType, ids: bool = True) -> DataFrame:
    """Documents read back from the listed files: doc_id, start, n_tokens, ids_crc32, and ids on demand.

    ``start`` counts the ids of all documents before; the driver only adds up one total per file.
    """
    spark = files.sparkSession
    listed = files.orderBy("shard").select("path", "tokens").collect()
    before = [0, *accumulate(r["tokens"] for r in listed)]
    places = spark.createDataFrame(
        [(r["path"], b) for r, b in zip(listed, before)], "path string, base long").repartition(max(1, len(listed)))
    fields = [T.StructField("doc_id", key_type)] + [T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] if ids else []

    def read(batches):
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns)):
                reader = SequenceReader(path)
                for index in reader.documents():
                    for part in (index.slice(i, 500) for i in range(0, len(index), 500)):
                        places_of = zip(part.column(1).to_pylist(), part.column(2).to_pylist())
                        spans = [reader.span(s, n) for s, n in places_of]
                        columns = [
                            part.column(0), pa.array([base + s for s in part.column(1).to_pylist()], pa.int64()), part.column(2),
                            pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in spans], pa.int64()),
                        ]
                        if ids:
                            columns.append(pa.array([x.astype("int32") for x in spans], pa.list_(pa.int32())))
                        yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return places.mapInArrow(read, T.StructType(fields))


def token_files(docs: DataFrame, vocabulary: str, folder: str | None = None, key: str = "doc_id", **options) -> DataFrame:
    """Writes the files to ``folder`` (default: a new shared one) and reads the documents back."""
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    files = write_tokens(docs, folder, vocabulary, key=key, **options)
    return read_tokens(files, docs.schema[key].dataType, ids=False)
