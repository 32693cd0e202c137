"""Language identification by prediction by partial matching (PPM) over bytes.

Each language has a variable-order context tree: counts of the byte that follows each context of up
to ``ORDER`` bytes. A byte's probability is taken in the longest context kept; bytes never seen there
are reached by escapes to the context one byte shorter (escape weight = number of different bytes
seen, seen bytes excluded below), down to a uniform choice. After training the statistics are frozen,
so a text's code length in a language is the sum of one table entry per byte. The language with the
shortest code wins; the score is its share of the probability all languages give the text.

Training reads a bounded sample: per language ``ROWS`` different labelled whole texts, first those of at
most ``MAX_TRAIN_BYTES`` bytes with the smallest hashes, then, where these are fewer, the shortest longer ones as
far as all stay within ROWS * MAX_TRAIN_BYTES bytes (a language's only text whatever its length). Counting is a
Spark aggregation, whose result is bounded by the sample. All languages and all contexts of the sample are
modelled; the model broadcast holds an entry for each byte met in a context of a language, so it grows with the
number of languages. Scoring is one pass, bounded by one group of texts.

Defined results: null texts and texts without a letter are ``und`` with score 0, so is everything if
nothing can be learned; equal code lengths go to the language first in order; repeated rows give a row
each; an empty table gives no row; columns other than id, text and (for training) lang are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from stellate.llm.kernels import SLICE_BYTES, slices

ORDER = 3
ROWS = 400
# Name of the column that carries the verdict beside a row's own columns.
JUDGED = "__language"
MAX_TRAIN_BYTES = 1 << 16
# Contexts whose probabilities are worked out at a time.
GROUP = 1 << 12
# Code lengths are stored in steps of 1/2048 bit.
STEP = 2048
_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_texts(docs: DataFrame, rows: int = ROWS, max_bytes: int = MAX_TRAIN_BYTES) -> DataFrame:
    """(lang, text as bytes) of the bounded sample of labelled documents."""
    fit = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
           .select("lang", F.col("text").cast("binary").alias("text"))
           .where(F.octet_length("text") > 0)
           .withColumn("h", F.xxhash64("text")))
    # texts over max_bytes come after all others, the shortest first
    size = F.octet_length("text").cast("long")
    first = Window.partitionBy("lang").orderBy("over", "h")
    upto = first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # identical texts share h: one of them stands for all before texts are ranked, so copies take no places
    chosen = (fit.groupBy("lang", "h").agg(F.min(size).alias("size"))
              .withColumn("over", F.when(F.col("size") > max_bytes, F.col("size")).otherwise(0))
              .withColumn("r", F.row_number().over(first)).where(F.col("r") <= rows)
              .withColumn("sum", F.sum("size").over(upto))
              .where((F.col("r") == 1) | (F.col("over") == 0) | (F.col("sum") <= rows * max_bytes))
              .select("lang", "h"))
    return fit.join(F.broadcast(chosen), ["lang", "h"]).dropDuplicates(["lang", "h"]).select("lang", "text")


def _grams(batches):
    """Counts of (ORDER + 1)-byte strings by language, each text led by ORDER zero bytes."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lo, data, offsets in slices(batch.column(1)):
            by_lang: dict[str, list[np.ndarray]] = {}
            for i in range(len(offsets) - 1):
                # a long text is counted a stretch at a time
                for start in range(offsets[i], offsets[i + 1], SLICE_BYTES):
                    end = min(start + SLICE_BYTES, offsets[i + 1])
                    before = data[max(start - ORDER, offsets[i]):start]
                    b = np.concatenate([np.zeros(ORDER - len(before), np.int64), before, data[start:end]]).astype(np.int64)
                    code = b[:-ORDER] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]
                    if len(code) < SLICE_BYTES:
                        by_lang.setdefault(langs[lo + i], []).append(code)
                    else:
                        yield _counted(langs[lo + i], code)
            for lang, codes in by_lang.items():
                yield _counted(lang, np.concatenate(codes))


def _counted(lang: str, codes: np.ndarray) -> pa.RecordBatch:
    gram, n = np.unique(codes, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram), pa.array(n)], ["lang", "gram", "n"])


class Costs:
    """One language's code lengths, for bytes met in a context and for escapes from it only: code lengths
    of other bytes are the escape's and those of the context one byte shorter, and so on."""

    def __init__(self, classes: int, parent: np.ndarray, keys: np.ndarray, bits: np.ndarray):
        # a key is node * (classes + 1) + class; the class after the last one is the escape
        order = np.argsort(keys)
        self.classes, self.parent, self.keys, self.bits = classes, parent, keys[order], bits[order]

    def found(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, self.bits[at]

    def __getitem__(self, entry) -> np.ndarray:
        """Code lengths, in steps, of entries node * classes + class."""
        node, sym = np.divmod(np.asarray(entry, np.int64).ravel(), self.classes)
        total, open_ = np.zeros(len(node)), np.arange(len(node))
        for _ in range(ORDER + 1):
            first = node * (self.classes + 1)
            met, bits = self.found(first + sym)
            total[open_[met]] += bits[met]
            open_, node, sym, first = open_[~met], node[~met], sym[~met], first[~met]
            known, bits = self.found(first + self.classes)
            total[open_] += np.where(known, bits, 0.0)
            root = node == 0
            total[open_[root]] += np.log2(self.classes)
            open_, node, sym = open_[~root], self.parent[node[~root]].astype(np.int64), sym[~root]
        return np.minimum(np.rint(total * STEP), 65535).astype(np.int64).reshape(np.shape(entry))


class Model:
    """Frozen code lengths: ``node`` gives the longest context any language has of the last three bytes' classes,
    ``cost`` for every language the code lengths of a class in a node."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.langs = langs
        seen = np.unique(gram & 0xFF)
        self.classes = len(seen) + 1  # the last one: bytes not seen in training, and what is before a text
        self.other = self.classes - 1
        self.of_byte = np.full(256, self.other, np.int64)
        self.of_byte[seen] = np.arange(len(seen))
        A = self.classes
        # zero bytes stand for the edge of a text unless they were seen as a byte
        sym = [self.of_byte[(gram >> s) & 0xFF] for s in (24, 16, 8, 0)]
        context = (sym[0] * A + sym[1]) * A + sym[2]
        three = np.unique(context)
        two = np.unique(three % (A * A))
        one = np.unique(two % A)
        first = [0, 1, 1 + len(one), 1 + len(one) + len(two)]  # first node of each order
        nodes = first[3] + len(three)
        node1 = np.zeros(A, np.int32)
        node1[one] = first[1] + np.arange(len(one))
        node2 = np.tile(node1, A)
        node2[two] = first[2] + np.arange(len(two))
        self.node = np.tile(node2, A)
        self.node[three] = first[3] + np.arange(len(three))
        parent = np.zeros(nodes, np.int32)
        parent[first[2]:first[3]] = node1[two % A]
        parent[first[3]:] = node2[three % (A * A)]
        by_lang = np.argsort(lang, kind="stable")
        ends = np.searchsorted(lang[by_lang], np.arange(len(langs) + 1))
        self.cost = [self._costs(parent, first, context[mine], sym[3][mine], n[mine], node1, node2)
                     for mine in (by_lang[lo:hi] for lo, hi in zip(ends[:-1], ends[1:]))]

    def _costs(self, parent, first, context, sym, n, node1, node2) -> Costs:
        """A language's code lengths from its counts, contexts of one order in groups of some thousand."""
        A = self.classes
        keys, bits = [], []
        p = np.full((1, A), 1.0 / A)  # of all classes in the nodes of the lower orders
        for order in range(ORDER + 1):
            at = [np.zeros(len(context), np.int64), node1[context % A], node2[context % (A * A)], self.node[context]][order]
            known, place = np.unique(at, return_inverse=True)
            by_node = np.argsort(place, kind="stable")
            ends = np.searchsorted(place[by_node], np.arange(0, len(known) + GROUP, GROUP))
            if 0 < order < ORDER:
                p = np.concatenate([p, p[parent[first[order]:first[order + 1]]]])
            for k, (lo, hi) in enumerate(zip(ends[:-1], ends[1:])):
                node = known[k * GROUP:(k + 1) * GROUP].astype(np.int64)
                mine = by_node[lo:hi]
                counts = np.bincount((place[mine] - k * GROUP) * A + sym[mine], n[mine], minlength=len(node) * A).reshape(-1, A)
                below = p[parent[node]]
                here = _escaped(counts, below)
                if order < ORDER:
                    p[node] = here
                row, met = np.nonzero(counts)
                keys += [node[row] * (A + 1) + met, node * (A + 1) + A]
                bits += [-np.log2(here[row, met]), np.log2(below[:, -1]) - np.log2(here[:, -1])]
        return Costs(A, parent, np.concatenate(keys), np.concatenate(bits))

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of each text in each language, a stretch of bytes at a time."""
        A = self.classes
        bits = np.zeros((len(offsets) - 1, len(self.langs)))
        for lo in range(0, len(data), SLICE_BYTES):
            hi = min(lo + SLICE_BYTES, len(data))
            s = self.of_byte[data[max(0, lo - ORDER):hi]]
            lead = min(lo, ORDER)  # bytes read only as context
            starts, ends = np.clip(offsets[:-1], lo, hi) - lo, np.clip(offsets[1:], lo, hi) - lo
            before = np.full((ORDER, hi - lo), self.other, np.int64)
            for k in range(1, ORDER + 1):
                have = max(0, k - lead)
                before[k - 1, have:] = s[lead + have - k:len(s) - k]
                for j in range(k):  # a text's first bytes see its edge
                    at = offsets[:-1] + j - lo
                    at = at[(at >= 0) & (at < hi - lo) & (offsets[:-1] + j < offsets[1:])]
                    before[k - 1, at] = self.other
            entry = self.node[(before[2] * A + before[1]) * A + before[0]] * np.int64(A) + s[lead:]
            place, met = pd.factorize(entry)  # each different entry is looked up once
            for i, cost in enumerate(self.cost):
                sums = np.concatenate([[0], np.cumsum(cost[met][place])])
                bits[:, i] += sums[ends] - sums[starts]
        return bits / STEP


def _escaped(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Probabilities in a context from its counts and those of the shorter context."""
    total = counts.sum(1, keepdims=True)
    seen = counts > 0
    distinct = seen.sum(1, keepdims=True)
    unseen = np.where(seen, 0.0, below)
    left = unseen.sum(1, keepdims=True)
    escape = np.where(left > 0, distinct, 0)
    size = np.maximum(total + escape, 1)
    p = np.where(seen, counts / size, unseen / np.where(left > 0, left, 1.0) * (escape / size))
    return np.where(total > 0, p, below)


def train(docs: DataFrame, rows: int = ROWS, max_bytes: int = MAX_TRAIN_BYTES) -> Model | None:
    """Learn from ``docs`` (doc_id, text, lang); None if no language can be learned."""
    grams = (training_texts(docs, rows, max_bytes).mapInArrow(_grams, "lang string, gram long, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    found = grams.toArrow()
    langs = sorted(found.column("lang").unique().to_pylist())
    if not langs:
        return None
    column = found.column("lang").combine_chunks().dictionary_encode()
    rank = np.array([langs.index(v) for v in column.dictionary.to_pylist()], np.int64)
    lang = rank[column.indices.to_numpy()]
    return Model(langs, lang, found.column("gram").to_numpy(), found.column("n").to_numpy())


def _judged(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct JUDGED of lang_pred, score, bits_per_byte. Only texts go to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [] if model is None else model.langs

    @F.arrow_udf("struct<lang_pred:string,score:double,bits_per_byte:double>")
    def judge(texts: pa.Array) -> pa.Array:
        m = shared.value
        n = len(texts)
        pred, score, rate = np.full(n, len(names), np.int64), np.zeros(n), np.zeros(n)
        for lo, data, offsets in slices(texts) if m is not None else ():
            bits = m.lengths(data, offsets)
            best = bits.argmin(1)
            low = bits[np.arange(len(best)), best]
            share = 1.0 / np.exp2(np.minimum(low[:, None] - bits, 0.0)).sum(1)
            ok, at = _lettered(data, offsets), slice(lo, lo + len(best))
            pred[at] = np.where(ok, best, len(names))
            score[at] = np.where(ok, share, 0.0)
            rate[at] = np.where(ok, low / np.maximum(np.diff(offsets), 1), 0.0)
        lang = pa.array([*names, "und"], pa.string()).take(pa.array(pred))
        return pa.StructArray.from_arrays([lang, pa.array(score), pa.array(rate)], ["lang_pred", "score", "bits_per_byte"])

    # not to be evaluated once for a filter and again for its rows
    return docs.withColumn(JUDGED, judge.asNondeterministic()(F.col(text_col).cast("binary")))


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``bits_per_byte`` (of the language found) beside its own
    columns, which these three replace where a name clashes; one pass, no join."""
    judged = _judged(docs, model, text_col)
    return judged.withColumns({c: F.col(f"{JUDGED}.{c}") for c in ("lang_pred", "score", "bits_per_byte")}).drop(JUDGED)


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _lettered(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter (of any script)."""
    count = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    has = count[offsets[1:]] > count[offsets[:-1]]
    for i in np.flatnonzero(~has & (offsets[1:] > offsets[:-1])):
        has[i] = _LETTER.search(data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")) is not None
    return has


def identify(docs: DataFrame, rows: int = ROWS, max_bytes: int = MAX_TRAIN_BYTES) -> DataFrame:
    """Train on the labelled documents that are not held out and predict every document:
    doc_id, lang_pred, score, bits_per_byte."""
    return predict(docs.select("doc_id", "text"), train(docs, rows, max_bytes)).drop("text")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, whose language is identified; a null ``lang`` is filled with it.

    Rejected is only what the operator calls ``und``: texts without a letter, and all if nothing can be learned.
    Short texts that several languages explain about as well stay.
    """
    judged = _judged(docs, train(docs)).where(F.col(f"{JUDGED}.lang_pred") != "und")
    return judged.withColumn("lang", F.coalesce("lang", f"{JUDGED}.lang_pred")).drop(JUDGED)
