"""Substring dedup: repeated windows of words, by Rabin-Karp hashes counted in Spark.

A window is ``WINDOW`` consecutive words of one document; words are runs of bytes other than 0x20 and
0x09-0x0D, unchanged. Words covered by a window whose words also start elsewhere (the same document
included) are removed; windows are judged on the input. Every hash is a Rabin-Karp hash over word
hashes, taken from prefix sums. ``repeats`` counts the hashes of anchors and contexts, and the hashes of
all windows where an anchor stands in different contexts, so counts of repeated windows are complete;
repeated windows are merged into maximal intervals.

Defined results: null and empty texts have no words; texts under ``WINDOW`` words lose nothing; repeated
rows count as different places; an empty table gives no row; other columns are carried along only on
request. Memory: a group of texts (or one long text) per task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.kernels import slices, word_hashes, words
from stellate.llm.repeats import Units, count_windows, covered, repeated_windows

WINDOW = 35
GRAM = 8


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words(data, offsets)
    return word_hashes(data, starts, ends), first


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """id, n_words, n_removed, spans (maximal removed runs of words), kept_text (kept words joined by one
    space)."""
    units = Units(window, min(GRAM, window), word_units)
    found = repeated_windows(docs.select(id_col, text_col), units, lambda o, b: count_windows(o, b, units), id_col, text_col)
    id_type = found.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for row, data, offsets in slices(batch.column(1)):
                starts, ends, first = words(data, offsets)
                ranges = batch.column(2).slice(row, len(offsets) - 1).to_pylist()
                texts, removed, spans = [], [], []
                for i, r in enumerate(ranges):
                    lo, hi = int(first[i]), int(first[i + 1])
                    text = data[offsets[i]:offsets[i + 1]].tobytes().split()
                    gone = covered(r, window)
                    at, kept = 0, []
                    for s, e in gone:
                        kept += text[at:s]
                        at = e
                    kept += text[at:]
                    texts.append(b" ".join(kept))
                    removed.append(hi - lo - len(kept))
                    spans.append(gone)
                n = len(ranges)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), pa.array(np.diff(first)), pa.array(removed, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(texts, pa.binary())],
                    ["id", "n_words", "n_removed", "spans", "kept"])

    out = found.select("id", "text", "ranges").mapInArrow(
        run, f"id {id_type}, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", "spans", F.col("kept").cast("string").alias("kept_text"))
