"""Encoding of a whole corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintara.functions.common import ship, spread
from vintara.llm.bpe import encoder


def token_ids(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """(key, ids): the token ids of each text, without special tokens, their strings taken as ordinary text.

    One row for each row of documents, in no order. An empty or null text has an empty list. Whole texts of any length
    are encoded. Rows are not shuffled, unless they come in fewer partitions than there are cores; repeated rows and null keys come out as they went in. Other columns are not read.
    """
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches):
        enc = encoder(vocabulary)
        for b in batches:
            got = [enc.encode(t) if t else b"" for t in b.column(1).to_pylist()]
            ends = np.zeros(len(got) + 1, np.int64)
            np.cumsum([len(g) // 4 for g in got], out=ends[1:])
            ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(got))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)], names=["key", "ids"])

    return spread(documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def token_counts(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """(key, n_tokens bigint) of each text as token_ids has it: 0 for an empty or null text."""
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches):
        enc = encoder(vocabulary)
        for b in batches:
            n = pa.array([enc.size(t) if t else 0 for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n], names=["key", "n_tokens"])

    return spread(documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))).mapInArrow(run, f"key {kind}, n_tokens bigint").withColumnRenamed("key", key)
