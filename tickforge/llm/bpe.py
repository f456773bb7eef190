"""Byte-level BPE encoding and decoding of whole texts, with content-defined chunk reuse."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import fresh

_coders: dict = {}


def coder(path: str):
    """The worker's encoder of a vocabulary; its chunk cache serves all tasks of the worker."""
    if path not in _coders:
        import public_tokenizers

        from tickforge.llm.subwords import ChunkedBPE

        _coders[path] = ChunkedBPE(path, public_tokenizers.PATTERN)
    return _coders[path]


def encode_texts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """Adds ``ids`` (array of int) to all columns; a null text counts as empty.

    The ids are those of the tokenizers library without added special tokens.  If the name is
    taken the new column gets underscores.
    """
    name = fresh(docs, "ids")
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])

    def encode(batches):
        for batch in batches:
            ids = [coder(vocabulary).encode(t or "").astype("int32") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.list_(pa.int32()))], [*batch.schema.names, name])

    return docs.mapInArrow(encode, schema)


def decode_ids(rows: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded`` to all columns: the text of the ids, special tokens included."""
    name = fresh(rows, "decoded")
    at = rows.columns.index(ids)
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())])

    def decode(batches):
        import numpy as np

        for batch in batches:
            texts = [coder(vocabulary).decode(np.array(i or [], np.int64)) for i in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name])

    return rows.mapInArrow(decode, schema)


def encoding_digests(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document n_tokens and the SHA-256 of ids (little-endian 32 bit) and of the decoded text.

    Null and empty texts have no tokens.  Keys pass as they are, also null or repeated; other
    columns are dropped; an empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def digest(batches):
        for batch in batches:
            found = [coder(vocabulary).digest(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([f[0] for f in found], pa.int64()),
                pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.string()),
            ], schema.names)

    return rows.mapInArrow(digest, schema)
