"""Packing by power-of-two decomposition.

A document of n ids (its tokens and one end id) is cut at the binary digits of n: as many pieces
of ``max_length`` as fit, then one piece for each set bit of the rest, longest first. A piece is a
sequence of its own, so no sequence crosses documents and none is padded: its length is a power of
two, and the pieces of one length form one bucket, from which a trainer draws whole batches.

One pass over the rows, no shuffle: memory is bounded by one Arrow batch and a slice of ``SLICE_BYTES`` of text. Defined results: a null or
empty text is the end id alone (one piece of length 1); repeated rows and ties give their own
pieces; an empty table gives no piece; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.kernels import slices
from stellate.llm.vocab import piece_ids

MAX_LENGTH = 2048
END_ID = 1
SLICE_BYTES = 1 << 22


def cuts(n: int, max_length: int = MAX_LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; ``max_length`` is a power of two."""
    out = [(s, max_length) for s in range(0, n - max_length + 1, max_length)]
    start = len(out) * max_length
    bit = max_length >> 1
    while start < n:
        if (n - start) & bit:
            out.append((start, bit))
            start += bit
        bit >>= 1
    return out


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         max_length: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id, start, length (its bucket), ids (little-endian unsigned 32-bit,
    binary), doc_tokens, sequence_id, offset.

    ``sequence_id`` numbers pieces by input partition and place in it, so a repeated task gives the
    same number again.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        table = piece_ids(tokenizer_path)
        for batch in batches:
            for lo, data, offsets in slices(batch.column(1), SLICE_BYTES):
                ids, first = table.batch(data, offsets)
                ids = np.insert(ids, first[1:], end_id)
                n = np.diff(first) + 1
                places = [cuts(x, max_length) for x in n.tolist()]
                doc = np.repeat(np.arange(len(n)), [len(x) for x in places])
                start, length = np.array([x for p in places for x in p], np.int64).reshape(-1, 2).T
                # pieces follow each other as their ids do
                edges = np.concatenate([[0], np.cumsum(4 * length)])
                column = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(edges), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(n)).take(pa.array(doc)), pa.array(np.ascontiguousarray(start)),
                     pa.array(np.ascontiguousarray(length)), column.cast(pa.binary()), pa.array(n[doc])],
                    ["id", "start", "length", "ids", "doc_tokens"])

    pieces = rows.mapInArrow(run, f"id {id_type}, start long, length long, ids binary, doc_tokens long")
    return pieces.select(F.col("id").alias(id_col), "start", "length", "ids", "doc_tokens",
                         F.monotonically_increasing_id().alias("sequence_id"),
                         F.lit(0).cast("long").alias("offset"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the packed pieces with one folder per length."""
    pieces.write.mode("overwrite").partitionBy("length").parquet(path)
