"""Quality rules whose cutoffs come from mergeable quantile sketches per language and source.

``measure`` counts words, characters, symbols, repeated lines and repeated words of every text (one pass, no
shuffle). ``sketch`` turns the documents of each (lang, source) into quantile sketches of four ratios. A sketch
is a set of rows (metric, bucket, documents): a value's bucket is the value cut to ``BITS`` binary digits, so a
quantile is known to one part in 2^(BITS - 1), and sketches merge by adding the documents of equal buckets
(``merge``), in any order and with the same result: yesterday's table and today's load give the sketch of both.
``cutoffs`` reads the quantiles of each group; a group of under ``least`` documents takes those of its language's
merged sketch, and a language of under ``least`` those of all documents. ``judge`` joins cutoffs to documents.

A document passes its group's rules if every ratio is at most q90 + REACH * max(q90 - q50, tolerance), and its
mean word length also at least q10 - REACH * max(q50 - q10, tolerance), never below 0. So the rules follow
each group's own spread, and take out what lies far beyond it, not a fixed share.

Scale: sketches are pre-aggregated before the shuffle and hold at most 2^BITS * 64 buckets a metric and group,
however many documents a group has; cutoffs are one row a group; the join of documents to cutoffs carries counts,
not texts, and adaptive execution splits a hot group.

Defined results: a null or empty text has no words: all counts 0, ``base_failed``, no part in sketches; null lang
and null source are groups like any other; repeated rows count each time; an empty table gives no row; columns
other than the four named ones are not read by ``measure`` and kept as they are by ``keep``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.kernels import numbered, slices, words
from stellate.llm.staging import stage

# Fixed values of the base rules.
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 10
REPEAT_PERCENT = 20

BITS = 7
LEAST = 200
REACH = 3
# Ratios in millionths, and the spread that each may have at least.
SCALE = 1_000_000
TOLERANCE = {"word_length": 600_000, "symbol_rate": 100_000, "dup_line_rate": 150_000, "repeat_rate": 50_000}
TWO_SIDED = ("word_length",)

SLICE_BYTES = 1 << 21
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A dense number for each pair of numbers."""
    key = left * (int(right.max()) + 1 if len(right) else 1) + right
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    number = np.empty(len(key), np.int64)
    number[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])[:len(key)]
    return number


def counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The six counts of consecutive texts."""
    n = len(offsets) - 1
    starts, ends, first = words(data, offsets)
    doc = np.repeat(np.arange(n), np.diff(first))
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = np.bincount(doc, heads[ends] - heads[starts], n)
    signs = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    # lines: a text's edges and \n
    line = np.zeros(len(data) + 1, bool)
    line[np.flatnonzero(data == 0x0A) + 1] = True
    line[offsets] = True
    begins = np.flatnonzero(line[:-1]) if len(data) else np.zeros(0, np.int64)
    stops = np.append(begins[1:], len(data))[:len(begins)]
    stops = stops - (data[stops - 1] == 0x0A) if len(stops) else stops
    worded = np.searchsorted(starts, stops) > np.searchsorted(starts, begins)
    begins, stops = begins[worded], stops[worded]
    of = np.searchsorted(offsets, begins, "right") - 1
    key = _paired(of, numbered(data, begins, stops)[0])
    again = np.ones(len(key), bool)
    again[np.unique(key, return_index=True)[1]] = False
    # windows of words: numbers of 2, 4 and 5 words, within the text
    repeated = np.zeros(len(starts), bool)
    if len(starts) >= WINDOW:
        one = _paired(doc, numbered(data, starts, ends)[0])
        two = _paired(one[:-1], one[1:])
        four = _paired(two[:-2], two[2:])
        five = _paired(four[:-1], one[4:])
        inside = doc[4:] == doc[:-4]
        met = np.bincount(five[inside], minlength=len(five) + 1) > 1
        at = np.flatnonzero(inside & met[five])
        step = np.zeros(len(starts) + 1, np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + WINDOW, -1)
        repeated = np.cumsum(step[:-1]) > 0
    return [np.diff(first), chars, np.diff(signs[offsets]), np.bincount(of[again], minlength=n), np.bincount(of, minlength=n),
            np.bincount(doc[repeated], minlength=n)]


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """id, lang, source and the counts n_words, word_chars, n_symbols, n_dup_lines, n_lines (with a word),
    n_repeat_words of each row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                       F.col(text_col).cast("binary").alias("text"))
    kept = rows.drop("text")
    schema = kept.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ", 3)

    def run(batches):
        for batch in batches:
            for lo, data, offsets in slices(batch.column(3), SLICE_BYTES):
                same = [batch.column(i).slice(lo, len(offsets) - 1) for i in range(3)]
                yield pa.RecordBatch.from_arrays(same + [pa.array(x.astype(np.int64)) for x in counts(data, offsets)],
                                                 ["id", "lang", "source", *_COUNTS])

    found = rows.mapInArrow(run, schema + "".join(f", {c} long" for c in _COUNTS))
    return found.select(F.col("id").alias(id_col), "lang", "source", *_COUNTS)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def ratios() -> dict[str, Column]:
    """The four ratios in millionths; null without words."""
    def per(part, whole):
        return F.expr(f"CASE WHEN {whole} > 0 THEN {SCALE} * {part} div {whole} END")
    return {"word_length": per("word_chars", "n_words"), "symbol_rate": per("n_symbols", "n_words"),
            "dup_line_rate": per("n_dup_lines", "n_lines"), "repeat_rate": per("n_repeat_words", "n_words")}


def bucket(value: Column) -> Column:
    """The value cut to its first BITS binary digits."""
    size = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, size), size)


def sketch(measured: DataFrame) -> DataFrame:
    """lang, source, metric, bucket, docs: the sketches of every (lang, source)."""
    values = F.array(*[F.struct(F.lit(k).alias("metric"), bucket(v).alias("bucket")) for k, v in ratios().items()])
    rows = measured.where("n_words > 0").select("lang", "source", F.explode(values).alias("v"))
    return rows.groupBy("lang", "source", F.col("v.metric").alias("metric"), F.col("v.bucket").alias("bucket")).agg(F.count("*").alias("docs"))


def merge(*sketches: DataFrame) -> DataFrame:
    """The sketch of all documents behind the given ones."""
    both = sketches[0]
    for s in sketches[1:]:
        both = both.unionByName(s)
    return both.groupBy("lang", "source", "metric", "bucket").agg(F.sum("docs").alias("docs"))


def _quantiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """keys, metric, docs, q10, q50, q90: the first bucket that at least that share of the documents reaches."""
    merged = sketches.groupBy(*keys, "metric", "bucket").agg(F.sum("docs").alias("docs"))
    w = Window.partitionBy(*keys, "metric")
    rows = merged.withColumn("upto", F.sum("docs").over(w.orderBy("bucket"))).withColumn("all", F.sum("docs").over(w))
    found = [F.min(F.when(100 * F.col("upto") >= q * F.col("all"), F.col("bucket"))).alias(f"q{q}") for q in (10, 50, 90)]
    return rows.groupBy(*keys, "metric").agg(F.first("all").alias("docs"), *found)


def cutoffs(sketches: DataFrame, least: int = LEAST) -> DataFrame:
    """One row a (lang, source): docs, level (the sketch used: source, lang or all), <metric>_high, <metric>_low."""
    levels = {"source": ["lang", "source"], "lang": ["lang"], "all": []}
    rows = None
    for level, keys in levels.items():
        q = _quantiles(sketches, keys)
        bounds = []
        for m, t in TOLERANCE.items():
            v = [F.max(F.when(F.col("metric") == m, F.col(f"q{x}"))) for x in (10, 50, 90)]
            bounds.append((v[2] + REACH * F.greatest(v[2] - v[1], F.lit(t))).alias(f"{m}_high"))
            if m in TWO_SIDED:
                bounds.append(F.greatest(v[0] - REACH * F.greatest(v[1] - v[0], F.lit(t)), F.lit(0)).alias(f"{m}_low"))
        one = q.groupBy(*keys).agg(F.max("docs").alias("docs"), *bounds)
        names = [c for c in one.columns if c not in (*keys, "docs")]
        one = one.select(*[F.col(k).alias(f"{level}_{k}") for k in keys], F.struct("docs", F.lit(level).alias("level"), *names).alias(f"{level}_cut"))
        if rows is None:
            rows = one.withColumnsRenamed({"source_lang": "lang", "source_source": "source"})
        elif keys:
            rows = rows.join(one, F.col("lang").eqNullSafe(F.col("lang_lang")), "left").drop("lang_lang")
        else:
            every = one.first()  # the one row of all documents
            parts = [F.lit(every[0][n] if every else None).cast(one.schema["all_cut"].dataType[n].dataType).alias(n) for n in ("docs", "level", *names)]
            rows = rows.withColumn("all_cut", F.struct(*parts))
    use = F.when(F.col("source_cut.docs") >= least, F.col("source_cut")).when(F.col("lang_cut.docs") >= least, F.col("lang_cut")).otherwise(F.col("all_cut"))
    return rows.select("lang", "source", F.col("source_cut.docs").alias("docs"), use.alias("use")).select("lang", "source", "docs", "use.level", *[f"use.{n}" for n in names])


def judge(measured: DataFrame, cuts: DataFrame) -> DataFrame:
    """The measured rows with base_failed, failed (the broken rules) and kept; a group without cutoffs breaks none."""
    broken = []
    for m, v in ratios().items():
        broken.append(F.when(v > F.col(f"c.{m}_high"), F.lit(f"{m} high")))
        if m in TWO_SIDED:
            broken.append(F.when(v < F.col(f"c.{m}_low"), F.lit(f"{m} low")))
    d, c = measured.alias("d"), cuts.alias("c")
    joined = d.join(c, F.col("d.lang").eqNullSafe(F.col("c.lang")) & F.col("d.source").eqNullSafe(F.col("c.source")), "left")
    rows = joined.select("d.*", base_failed().alias("base_failed"), F.array_compact(F.array(*broken)).alias("failed"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                least: int = LEAST) -> DataFrame:
    """Measure, sketch, cut and judge one table."""
    measured = stage(measure(docs, id_col, text_col, lang_col, source_col), "quality-counts")
    return judge(measured, cutoffs(stage(sketch(measured), "quality-sketches"), least))
