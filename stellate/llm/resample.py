"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

The target is the labelled documents of good quality that are not toxic; raw text is all documents.
Tokens (runs of letters, digits and non-ASCII, or of signs; A-Z lower-cased) and their pairs are hashed
into ``BUCKETS`` each and counted for both; a bucket's log ratio is ln (target + s) / (expected + s),
where expected is its raw count scaled to the target's size and s shrinks rare buckets to no evidence.
A document's log weight is the sum over its n-grams, i.e. the log of target over raw probability of the
text. Adding Gumbel noise (from a hash of the id) and taking the k largest keys draws k documents without
replacement with probability in proportion to their weights. Unless given, k is the labelled documents'
share of targets, of all documents.

Raw counts cover all documents, target counts all labelled targets up to ``target_rows`` of them (then a
share of about that many, drawn by hash); both are added up per task before the shuffle; the models are fixed-size arrays
(``BUCKETS`` entries an order), so what is collected and broadcast does not grow. The k-th largest key is
found by counting keys in ever narrower ranges; keys never meet in one place.

Defined results: null and empty texts have weight 0 (even odds); documents whose keys tie with the k-th
are all kept; repeated rows have equal keys; without labels or targets all weights are 0 and every document
is kept; an empty table gives no row; a document counts as labelled once, by its worst label.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.kernels import LOWER_VALUES, mix, slices, tokens, word_hashes
from stellate.llm.staging import stage

BUCKETS = 1 << 18
# Labelled target documents that the target model is fitted on, about: all of them up to here, else a
# share drawn by hash. Their ids are broadcast, so texts are never shuffled to meet labels.
TARGET_ROWS = 1 << 17
# s of single tokens and of pairs
SHRINK = (2.0, 32.0)
SEED = 7


def ngrams(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of each token, and of each pair of tokens."""
    starts, ends, first = tokens(data, offsets)
    h = word_hashes(data, starts, ends, LOWER_VALUES)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    pair = mix(h[:-1] * np.uint64(3) + h[1:])
    same = text[1:] == text[:-1]
    size = np.uint64(BUCKETS)
    return [((h % size).astype(np.int64), text), ((pair % size).astype(np.int64)[same], text[1:][same])]


def targets(labels: DataFrame) -> DataFrame:
    """(doc_id, target): one row per labelled document."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
            .agg(F.min(F.coalesce(good, F.lit(False)).cast("int")).alias("target")))


def log_ratios(docs: DataFrame, labelled: DataFrame, target_rows: int = TARGET_ROWS) -> np.ndarray:
    """The fitted log ratio of every bucket, a row per order; targets are counted on about ``target_rows`` of the
    labelled ones at most."""
    known = labelled.where("target = 1").select("doc_id")
    share = min(1.0, target_rows / max(known.count(), 1))
    ids = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(
        F.broadcast(ids.withColumn("good", F.lit(True))), "doc_id", "left").select(F.coalesce("good", F.lit(False)).alias("good"), "text")

    def run(batches):
        total = np.zeros((2, 2, BUCKETS), np.int64)
        for batch in batches:
            good = batch.column(0).to_numpy(zero_copy_only=False)
            for row, data, offsets in slices(batch.column(1)):
                for order, (bucket, text) in enumerate(ngrams(data, offsets)):
                    total[0, order] += np.bincount(bucket, minlength=BUCKETS)
                    total[1, order] += np.bincount(bucket[good[row + text]], minlength=BUCKETS)
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0].ravel()[some]), pa.array(total[1].ravel()[some])],
                                         ["bucket", "raw", "good"])

    counts = rows.mapInArrow(run, "bucket long, raw long, good long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("good").alias("good")).toArrow()
    raw, good = np.zeros((2, BUCKETS)), np.zeros((2, BUCKETS))
    at = counts.column("bucket").to_numpy()
    raw.ravel()[at], good.ravel()[at] = counts.column("raw").to_numpy(), counts.column("good").to_numpy()
    if not good.any():
        return np.zeros((2, BUCKETS))
    expected = raw * (good.sum(1) / np.maximum(raw.sum(1), 1))[:, None]
    s = np.array(SHRINK)[:, None]
    return np.log((good + s) / (expected + s))


def log_weights(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens and log_weight of every document."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        for batch in batches:
            for row, data, offsets in slices(batch.column(1)):
                n = len(offsets) - 1
                found = ngrams(data, offsets)
                weight = sum(np.bincount(text, r[bucket], minlength=n) for r, (bucket, text) in zip(shared.value, found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), pa.array(np.bincount(found[0][1], minlength=n)), pa.array(np.asarray(weight, np.float64))],
                    ["id", "n_tokens", "log_weight"])

    return rows.mapInArrow(run, f"id {id_type}, n_tokens long, log_weight double").withColumnRenamed("id", id_col)


def kth_largest(df: DataFrame, col: str, k: int, parts: int = 4096, few: int = 4096) -> float | None:
    """The exact k-th largest value of a column (None if there are fewer), by counting in ranges."""
    values = df.select(F.col(col).alias("x")).where("x IS NOT NULL")
    lo, hi, n = values.agg(F.min("x"), F.max("x"), F.count("x")).first()
    if k < 1 or n < k:
        return None
    while lo < hi:
        inside = values.where(F.col("x").between(lo, hi))
        if n <= few:
            return sorted((r["x"] for r in inside.collect()), reverse=True)[k - 1]
        part = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit((hi - lo) / parts)), F.lit(parts - 1))
        counts = inside.groupBy(part.alias("part")).agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        for r in sorted(counts.collect(), key=lambda r: -r["part"]):
            if k <= r["n"]:
                lo, hi, n = r["lo"], r["hi"], r["n"]
                break
            k -= r["n"]
    return lo


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED,
             target_rows: int = TARGET_ROWS) -> DataFrame:
    """Every document with n_tokens, log_weight, its Gumbel key and whether it is ``selected``."""
    labelled = targets(labels)
    scored = log_weights(docs, log_ratios(docs, labelled, target_rows))
    bits = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11).cast("double")
    uniform = (bits + F.lit(0.5)) * F.lit(2.0 ** -53)
    scored = stage(scored.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform))), "log-weights")
    if k is None:
        n = scored.count()
        share = labelled.agg(F.avg("target")).first()[0]
        k = round(share * n) if share else n
    least = kth_largest(scored, "key", k)
    chosen = F.lit(k > 0) if least is None else F.col("key") >= F.lit(least)
    return scored.withColumn("selected", chosen)
