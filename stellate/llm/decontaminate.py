"""Benchmark decontamination by an FM-index per training shard.

The phrases to find are all windows of ``WINDOW`` consecutive words of the benchmark items (a shorter
item is one window). Each task turns a group of whole texts (a shard) into an FM-index over words and
searches all phrases in it at once: backward search narrows each phrase's suffix range one word at a
time with wavelet-matrix ranks, the occurrences in the final ranges are located by walking to the
nearest sampled suffix position, and the word spans they cover are merged per document.

Only words that can be part of an occurrence enter the index: stretches of benchmark words in which
each neighbouring pair is also a neighbouring pair of the benchmark, at least as long as the shortest
phrase. That leaves every occurrence in place, and the index small where texts are clean.

Scale: one pass over the documents, no shuffle. The benchmark is broadcast in blocks of at most
``BLOCK_BYTES`` of text (its phrases are about 20 times that), one after the other if it is larger; rows are staged
between blocks, and each block's spans join those found before. A task holds one group of texts (or one long text) and its index.

Words: A-Z lower-cased, then runs of bytes other than 0x00-0x2F, 0x3A-0x60, 0x7B-0x7F. Defined
results: null and empty texts have no words and are clean; items without words have no phrase;
repeated items give one id; a null item_id is the empty string; an empty benchmark leaves every
document clean; columns other than ids and texts are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.kernels import LOWER_VALUES, runs, slices, spread, word_hashes, words
from stellate.llm.staging import stage

WINDOW = 13
BLOCK_BYTES = 1 << 23
# A text is contaminated if at least one word in SHARE is covered.
SHARE = 20
SHARD_BYTES = 1 << 22
SAMPLE = 8
# Names of the columns that carry the text and the findings beside a row's own columns.
TEXT, FOUND = "__decontaminate_text", "__decontaminate_found"

SEPARATORS = np.zeros(256, bool)
SEPARATORS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


class Phrases:
    """The different windows of a block of benchmark items, over dense word numbers 1..sigma."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        data = np.frombuffer(b"\x00".join(t for _, t in items), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for _, t in items])]).astype(np.int64)
        offsets[-1] = len(data)
        starts, ends, first = words(data, offsets, SEPARATORS)
        self.vocabulary, ids = np.unique(word_hashes(data, starts, ends, LOWER_VALUES), return_inverse=True)
        ids = (ids + 1).astype(np.int32)
        self.sigma = len(self.vocabulary)
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.vocabulary >> np.uint64(42)] = True
        pair = ids[:-1].astype(np.int64) * (self.sigma + 1) + ids[1:]
        self.pairs = np.unique(np.delete(pair, first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(ids))] - 1))
        # windows as rows of word numbers, the last word first, zeros after a short item's words
        size = np.minimum(np.diff(first), window)
        count = np.where(size > 0, np.diff(first) - size + 1, 0)
        owner = np.repeat(np.arange(len(items)), count)
        start, length = spread(count, first[:-1]), size[owner]
        rows = np.zeros((len(start), window), np.int32)
        for k in range(window):
            here = length > k
            rows[here, k] = ids[(start + length - 1 - k)[here]]
        if len(rows):
            _, at, phrase = np.unique(rows.view(np.dtype((np.void, rows.itemsize * window))).ravel(), return_index=True, return_inverse=True)
            rows = rows[at]
        else:
            phrase = np.zeros(0, np.int64)
        self.back = np.ascontiguousarray(rows.T)
        self.size = (rows > 0).sum(1)
        self.least = int(self.size.min()) if len(rows) else 0
        # the items of each phrase, by name
        self.names, name = np.unique(np.array([n for n, _ in items], object), return_inverse=True)
        owners = np.unique(phrase * max(len(self.names), 1) + name[owner])
        self.owners = (owners % max(len(self.names), 1)).astype(np.int32)
        self.owned = np.searchsorted(owners // max(len(self.names), 1), np.arange(len(rows) + 1))

    def items(self, phrases: np.ndarray) -> list[str]:
        """The names of the items that hold any of these phrases, sorted."""
        phrases = np.unique(phrases)
        found = self.owners[spread(self.owned[phrases + 1] - self.owned[phrases], self.owned[phrases])]
        return self.names[np.unique(found)].tolist()

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Dense number of each word, 0 if it is not in the benchmark."""
        out = np.zeros(len(hashes), np.int64)
        at = np.flatnonzero(self.seen[hashes >> np.uint64(42)])
        place = np.minimum(np.searchsorted(self.vocabulary, hashes[at]), self.sigma - 1)
        hit = self.vocabulary[place] == hashes[at]
        out[at[hit]] = place[hit] + 1
        return out


class WaveletMatrix:
    """Ranks and symbols of a sequence of numbers, one bit plane a level."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.ones, self.zeros, self.bits = [], [], []
        for shift in range(max(int(sigma).bit_length(), 1) - 1, -1, -1):
            bit = (symbols >> shift) & 1
            self.bits.append(bit)
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(len(bit) - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.levels = len(self.bits)

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` arrives after all levels; differences for one symbol are its ranks."""
        for k in range(self.levels):
            one = self.ones[k][at]
            bit = (symbol >> (self.levels - 1 - k)) & 1
            at = np.where(bit == 1, self.zeros[k] + one, at - one)
        return at

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, arrival) of each position."""
        symbol = np.zeros(len(at), np.int64)
        for k in range(self.levels):
            bit = self.bits[k][at]
            one = self.ones[k][at]
            at = np.where(bit == 1, self.zeros[k] + one, at - one)
            symbol = symbol << 1 | bit
        return symbol, at


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling; zeros separate and are told apart by their place."""
    n = len(symbols)
    gaps = symbols == 0
    rank = np.where(gaps, np.cumsum(gaps) - 1, symbols + int(gaps.sum()))
    order, step = np.argsort(rank, kind="stable"), 1
    while True:
        sorted_rank = rank[order]
        new = np.concatenate([[0], np.cumsum(sorted_rank[1:] != sorted_rank[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        key = rank * (n + 1)
        key[:-step] += rank[step:] + 1
        order, step, rank = np.argsort(key, kind="stable"), step * 2, key


class FmIndex:
    """FM-index of a sequence of words in which zeros separate stretches; it ends with a zero."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        order = suffix_array(symbols)
        self.before = WaveletMatrix(symbols[order - 1], sigma)
        counts = np.bincount(symbols, minlength=sigma + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        # where each symbol's rank 0 arrives in the wavelet matrix
        self.base = self.before.descend(np.arange(sigma + 1), np.zeros(sigma + 1, np.int64))
        # sampled places: every SAMPLE-th, and the starts of stretches, so that a walk never leaves one
        start = np.concatenate([[True], symbols[:-1] == 0])
        kept = (np.arange(len(symbols)) % SAMPLE == 0) | start
        self.sampled = np.where(kept[order], order, -1)
        self.n = len(symbols)

    def search(self, back: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range [lo, hi) of each phrase (columns of ``back``, last word first)."""
        lo, hi = np.zeros(len(size), np.int64), np.full(len(size), self.n, np.int64)
        alive = np.arange(len(size))
        for k in range(len(back)):
            alive = alive[(size[alive] > k) & (lo[alive] < hi[alive])]
            if not len(alive):
                break
            c = back[k, alive]
            lo[alive] = self.first[c] + self.before.descend(c, lo[alive]) - self.base[c]
            hi[alive] = self.first[c] + self.before.descend(c, hi[alive]) - self.base[c]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix row."""
        out = np.empty(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            known = self.sampled[rows]
            done = known >= 0
            out[left[done]] = known[done] + steps
            left, rows = left[~done], rows[~done]
            symbol, arrival = self.before.access(rows)
            rows = self.first[symbol] + arrival - self.base[symbol]
            steps += 1
        return out


def find(phrases: Phrases, data: np.ndarray, offsets: np.ndarray):
    """Per text of a shard: its word count; and (text, first word, end word, phrase) of all occurrences."""
    starts, ends, first = words(data, offsets, SEPARATORS)
    count = np.diff(first)
    none = np.zeros(0, np.int64)
    if not len(starts) or not phrases.least:
        return count, none, none, none, none, starts, ends, first
    ids = phrases.numbers(word_hashes(data, starts, ends, LOWER_VALUES))
    linked = np.zeros(len(ids), bool)  # word i and the next one may be neighbours in a phrase
    near = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    if len(near) and len(phrases.pairs):
        pair = ids[near] * (phrases.sigma + 1) + ids[near + 1]
        place = np.minimum(np.searchsorted(phrases.pairs, pair), len(phrases.pairs) - 1)
        linked[near] = phrases.pairs[place] == pair
    linked[first[1:][first[1:] > 0] - 1] = False
    # stretches of linked words; a word linked to nothing is a stretch of one
    edge = np.flatnonzero(~linked)
    lo, hi = np.concatenate([[0], edge[:-1] + 1]), edge + 1
    good = (hi - lo >= phrases.least) & (ids[lo] > 0)
    lo, hi = lo[good], hi[good]
    if not len(lo):
        return count, none, none, none, none, starts, ends, first
    size = hi - lo + 1
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
    gap = np.cumsum(size) - 1
    symbols = ids[np.minimum(at, len(ids) - 1)]
    symbols[gap] = 0
    index = FmIndex(symbols, phrases.sigma)
    a, b = index.search(phrases.back, phrases.size)
    hits = np.flatnonzero(b > a)
    n = (b - a)[hits]
    phrase = np.repeat(hits, n)
    rows = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a[hits], n)
    word = at[index.locate(rows)]
    return count, np.searchsorted(first, word, "right") - 1, word, word + phrases.size[phrase], phrase, starts, ends, first


def _merged(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(zip(lo.tolist(), hi.tolist())):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], e)
        else:
            out.append((s, e))
    return out


_SPAN = pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("first_byte", pa.int64()), ("end_byte", pa.int64())])
_FOUND = ("struct<n_words:long,items:array<string>,spans:array<struct<first_word:long,end_word:long,first_byte:long,end_byte:long>>>")


def _findings(texts: pa.Array, old: pa.Array | None, phrases: Phrases) -> pa.Array:
    """n_words, items and spans of each text, with those of ``old`` (earlier blocks)."""
    counts, items, full = [np.zeros(0, np.int64)], [], []
    for row, data, offsets in slices(texts, SHARD_BYTES):
        n = len(offsets) - 1
        count, doc, lo, hi, phrase, starts, ends, first = find(phrases, data, offsets)
        names, spans = [[] for _ in range(n)], [[] for _ in range(n)]
        order = np.argsort(doc, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1) if len(order) else ():
            d = int(doc[part[0]])
            names[d] = phrases.items(phrase[part])
            spans[d] = _merged(lo[part] - first[d], hi[part] - first[d])
        if old is not None:
            for d, was in enumerate(old.slice(row, n).to_pylist()):
                names[d] = sorted({*names[d], *was["items"]})
                both = spans[d] + [(s["first_word"], s["end_word"]) for s in was["spans"]]
                spans[d] = _merged(np.array([s for s, _ in both], np.int64), np.array([e for _, e in both], np.int64))
        counts.append(count)
        items += names
        full += [[(s, e, int(starts[first[d] + s] - offsets[d]), int(ends[first[d] + e - 1] - offsets[d])) for s, e in v]
                 for d, v in enumerate(spans)]
    return pa.StructArray.from_arrays([pa.array(np.concatenate(counts), pa.int64()), pa.array(items, pa.list_(pa.string())),
                                       pa.array(full, pa.list_(_SPAN))], ["n_words", "items", "spans"])


def _marked(rows: DataFrame, phrases: Phrases, again: bool) -> DataFrame:
    """``rows`` with one block's findings; ``again``: they already carry those of earlier blocks. Only texts go to
    Python, and only findings come back."""
    shared = rows.sparkSession.sparkContext.broadcast(phrases)
    text = F.col(TEXT).cast("binary")
    if again:
        @F.arrow_udf(_FOUND)
        def mark(texts: pa.Array, old: pa.Array) -> pa.Array:
            return _findings(texts, old, shared.value)
        return rows.withColumn(FOUND, mark.asNondeterministic()(text, F.col(FOUND)))

    @F.arrow_udf(_FOUND)
    def mark_first(texts: pa.Array) -> pa.Array:
        return _findings(texts, None, shared.value)
    # not to be evaluated once for a filter and again for its rows
    return rows.withColumn(FOUND, mark_first.asNondeterministic()(text))


def benchmark_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES):
    """The benchmark's (id, text) lists of about ``block_bytes`` each."""
    items = benchmark.where(F.octet_length(text_col) > 0).select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("binary").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    for i in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        yield [(r["item"], bytes(r["text"])) for r in part.collect()]


def _all_blocks(rows: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """``rows`` (with a column TEXT) and the findings of all blocks, staged between blocks so that one block's
    phrases are broadcast at a time."""
    again = False
    for items in benchmark_blocks(benchmark, block_bytes=block_bytes):
        rows = _marked(stage(rows, "decontaminated") if again else rows, Phrases(items, window), again)
        again = True
    return rows if again else _marked(rows, Phrases([], window), False)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, n_words, n_hit (covered words), items (sorted ids of items with occurring windows), spans
    (merged, in words and bytes of the text), contaminated."""
    rows = _all_blocks(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias(TEXT)), benchmark, window, block_bytes)
    return rows.select(F.col("id").alias(id_col), f"{FOUND}.n_words", n_hit().alias("n_hit"), f"{FOUND}.items", f"{FOUND}.spans",
                       contaminated(F.col(f"{FOUND}.n_words"), n_hit()).alias("contaminated"))


def n_hit() -> Column:
    return F.aggregate(f"{FOUND}.spans", F.lit(0).cast("long"), lambda s, x: s + x["end_word"] - x["first_word"])


def contaminated(n_words: Column, n_hit: Column) -> Column:
    return (n_hit > 0) & (n_hit * SHARE >= n_words)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that are not contaminated. Rows stay in the JVM."""
    rows = _all_blocks(docs.withColumn(TEXT, F.col("text")), benchmark, WINDOW, BLOCK_BYTES)
    return rows.where(~contaminated(F.col(f"{FOUND}.n_words"), n_hit())).drop(TEXT, FOUND)
