"""Windows of ``width`` units (words or bytes) whose content starts in more than one place.

The work is cut down to the places where a decision is open, and every cut is exact:

1. *Anchors.* In each window the ``gram`` units with the smallest hash (the leftmost of equal ones) are
   its anchor, so equal windows have equal anchors at equal offsets. Consecutive windows share anchors;
   each stretch of windows with one anchor is a *context*, known by its anchor's hash h, a digest c of
   its units and its place. About one anchor comes on (width - gram) / 2 units.
2. *Counts.* Anchors that occur once in the corpus cannot belong to a repeated window: their contexts
   go. Of the rest, a context whose digest occurs twice is repeated whole.
3. *Open contexts* remain where one anchor stands in different contexts. One copy of each different
   context is cut from its document and handed to the caller's method, which says which of its windows
   start in another context too (``decide``).
4. Decisions go back by (h, c) to all occurrences and from there to the documents.

Skew: counts are combined before the shuffle, a context that occurs millions of times is decided once,
and joins on (h, c) or h are plain joins that AQE splits. Nothing is gathered per anchor here.

Rows are known by (id, hash of the text): rows that are equal in both share their findings and count as
two places. Digests are 64 bits beside the 64 bits of the anchor's hash; both must agree.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.kernels import mix, prefix_sums, slices, spans_hash, window_min
from stellate.llm.staging import drop_staged, stage

_U64 = np.uint64
# Units worked on at a time; places within a stretch take 24 bits of a key.
STRETCH = 1 << 20
_PLACE = (1 << 24) - 1
# bits of the packed place of a context: its units before the anchor and its number of windows
_LO, _N = 12, 12


@dataclass(frozen=True)
class Units:
    """How texts become units: ``values(data, offsets)`` gives the hash value of each unit and the first
    unit of each text (and the end)."""
    width: int
    gram: int
    values: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def contexts(values: np.ndarray, first: np.ndarray, units: Units):
    """Contexts of consecutive texts: (text, first window, units before the anchor, windows, h, c)."""
    out = []
    for lo in range(0, max(len(values) - units.width + 1, 0), STRETCH):
        hi = min(lo + STRETCH + units.width - 1, len(values))
        out.append(_contexts(values[lo:hi], lo, first, units))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.astype(_U64), z.astype(_U64)
    return tuple(np.concatenate(c) for c in zip(*out))


def _contexts(v: np.ndarray, base: int, first: np.ndarray, units: Units):
    w, q = units.width, units.gram
    sums = prefix_sums(v)
    at = np.arange(len(v) - q + 1)
    grams = spans_hash(sums, at, at + q)
    keys = (grams & ~_U64(_PLACE)) | at.astype(_U64)
    anchor = (window_min(keys, w - q + 1) & _U64(_PLACE)).astype(np.int64)
    # windows that lie in one text
    delta = np.zeros(len(anchor) + 1, np.int32)
    begin, end = first[:-1] - base, first[1:] - base - w + 1
    some = (end > begin) & (end > 0) & (begin < len(anchor))
    np.add.at(delta, np.maximum(begin[some], 0), 1)
    np.add.at(delta, np.minimum(end[some], len(anchor)), -1)
    p = np.flatnonzero(np.cumsum(delta[:-1]) > 0)
    if not len(p):
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.astype(_U64), z.astype(_U64)
    a = anchor[p]
    start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)]))
    n = np.diff(np.append(start, len(p)))
    p0, a = p[start], a[start]
    before = a - p0
    digest = mix(spans_hash(sums, p0, p0 + n - 1 + w) ^ (before * 4096 + n).astype(_U64))
    text = np.searchsorted(first, p0 + base, "right") - 1
    return text, p0 + base - first[text], before, n, grams[a], digest


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, text as bytes and, if there are others, row: the other columns)."""
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"),
                       *([F.struct(*others).alias("row")] if others else []))


def _survey(base: DataFrame, units: Units) -> DataFrame:
    """(h, c, id, th, place) of every context; place packs its first window, units before the anchor and
    number of windows."""
    id_type = base.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for row, data, offsets in slices(batch.column(2)):
                values, first = units.values(data, offsets)
                text, p0, before, n, h, c = contexts(values, first, units)
                place = (p0 << (_LO + _N)) | (before << _N) | n
                pick = pa.array(text + row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), batch.column(0).take(pick),
                     batch.column(1).take(pick), pa.array(place)], ["h", "c", "id", "th", "place"])

    return base.select("id", "th", "text").mapInArrow(run, f"h long, c long, id {id_type}, th long, place long")


def first_window(place):
    return F.shiftright(place, _LO + _N)


def before_anchor(place):
    return F.shiftright(place, _N).bitwiseAND((1 << _LO) - 1)


def windows(place):
    return place.bitwiseAND((1 << _N) - 1)


def repeated_windows(docs: DataFrame, units: Units, decide: Callable[[DataFrame, DataFrame], DataFrame],
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row as (id, text as bytes, ranges and, if it has other columns, row: a struct of them):
    ``ranges`` are pairs (first, last) of windows, by their first unit in the text, that start elsewhere
    too; null if none.

    ``decide(open, base)`` gets the open contexts (h, c, id, th, place, contexts: how many share h) and
    returns (h, c, first, last): ranges of repeated windows counted from the context's first window.
    """
    base = _base(docs, id_col, text_col)
    # staged, so that both sides of the next join are plain shuffles, which AQE can split at a hot anchor
    counted = stage(_survey(base, units).groupBy("h").agg(F.count(F.lit(1)).alias("places")).where("places > 1").select("h"),
                    "repeated-anchors")
    found = stage(_survey(base, units).join(counted, "h", "left_semi"), "contexts")
    drop_staged(counted)
    kinds = found.groupBy("h", "c").agg(F.count(F.lit(1)).alias("copies"), F.first("id").alias("id"),
                                        F.first("th").alias("th"), F.first("place").alias("place"))
    kinds = stage(kinds, "context-kinds")
    whole = kinds.where("copies > 1").select("h", "c", F.lit(0).cast("long").alias("first"),
                                             (windows(F.col("place")) - 1).alias("last"))
    shared = stage(kinds.groupBy("h").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1"), "shared-anchors")
    open_ = kinds.join(shared, "h")
    decided = whole.unionByName(decide(open_, base))
    start = first_window(F.col("place"))
    ranges = (found.join(decided, ["h", "c"])
              .select("id", "th", F.struct((start + F.col("first")).alias("first"), (start + F.col("last")).alias("last")).alias("range"))
              .groupBy("id", "th").agg(F.collect_set("range").alias("ranges")))  # equal rows have equal ranges
    ranges = stage(ranges, "ranges")
    drop_staged(found, kinds, shared)
    b, r = base.alias("b"), ranges.alias("r")
    return (b.join(r, F.col("b.id").eqNullSafe(F.col("r.id")) & (F.col("b.th") == F.col("r.th")), "left")
            .select("b.id", "b.text", "r.ranges", *_carried(base)))


def _carried(base: DataFrame) -> list[str]:
    return ["b.row"] if "row" in base.columns else []


def with_texts(open_: DataFrame, base: DataFrame) -> DataFrame:
    """(text, cuts): each document with open contexts, and (h, c, place, contexts, copies) of those to cut
    from it. Other columns come along only so that this join and the last one read one shuffle of the texts."""
    cuts = open_.groupBy("id", "th").agg(F.collect_list(F.struct("h", "c", "place", "contexts", "copies")).alias("cuts")).alias("o")
    b = base.alias("b")
    return (b.join(cuts, F.col("b.id").eqNullSafe(F.col("o.id")) & (F.col("b.th") == F.col("o.th")))
            .select("b.text", "o.cuts", *_carried(base)))


def count_windows(open_: DataFrame, base: DataFrame, units: Units) -> DataFrame:
    """``decide`` by counting hashes in Spark, of blocks of windows first and of windows where those differ.

    The windows of a context are dealt into blocks by their distance to the anchor. All windows of a block
    hold the block's core (the units common to them), so contexts with different cores share none of them:
    a core met once settles the block. Blocks that are equal as a whole are repeated as a whole. Only where
    one core stands in different blocks are the windows themselves counted; those met twice are repeated.
    A block is about the square root of a context's usual number of windows, which makes the blocks of a
    context and the windows of its one or two open blocks fewest.
    """
    size = max(1, isqrt((units.width - units.gram + 1) // 2))

    def run(batches):
        for batch in batches:
            for row, data, offsets in slices(batch.column(0)):
                values, first = units.values(data, offsets)
                cuts = batch.column(1).slice(row, len(offsets) - 1)
                flat = cuts.flatten()
                per = np.diff(np.asarray(cuts.offsets))
                if not len(flat):
                    continue
                h, c, place = (flat.field(k).to_numpy() for k in range(3))
                n, before = place & ((1 << _N) - 1), (place >> _N) & ((1 << _LO) - 1)
                start = np.repeat(first[:-1], per) + (place >> (_LO + _N))
                context = np.repeat(np.arange(len(n)), n)
                k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                at = start[context] + k
                block = (before[context] - k) // size
                new = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (block[1:] != block[:-1])]))
                last = np.append(new[1:], len(k)) - 1
                of = context[new]
                anchor = start[of] + before[of]
                core = span_hashes(values, anchor - size * block[new], anchor - size * block[new] - size + 1 + units.width)
                place_in = ((before[of] - k[new]) * 4096 + (last - new)).astype(_U64)
                digest = mix(span_hashes(values, at[new], at[last] + units.width) ^ place_in)
                hashes = span_hashes(values, at, at + units.width).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[of]), pa.array(c[of]), pa.array(block[new]), pa.array(core.view(np.int64)),
                     pa.array(digest.view(np.int64)), pa.array(k[new]),
                     pa.ListArray.from_arrays(pa.array(np.append(new, len(k)).astype(np.int32)), pa.array(hashes))],
                    ["h", "c", "block", "core", "digest", "first", "w"])

    blocks = stage(with_texts(open_, base).mapInArrow(
        run, "h long, c long, block long, core long, digest long, first long, w array<long>"), "blocks")
    core = ["h", "block", "core"]
    kinds = stage(blocks.groupBy(*core, "digest").agg(F.count(F.lit(1)).alias("copies"), F.min("c").alias("c")), "block-kinds")
    again = kinds.where("copies > 1").select(*core, "digest")
    whole = blocks.join(again, [*core, "digest"]).select("h", "c", "first", (F.col("first") + F.size("w") - 1).alias("last"))
    mixed = kinds.groupBy(*core).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*core)
    # One block of each kind takes part in the count of windows. Equal windows have equal anchors at equal
    # offsets, so the hashes of anchor and window stand for their block and core too.
    chosen = kinds.join(mixed, core).select(*core, "digest", "c", (F.col("copies") == 1).alias("single"))
    rows = stage(blocks.join(chosen, [*core, "digest", "c"]).select("h", "c", "digest", "first", "single", "w"), "mixed-blocks")
    windows_ = rows.select("h", "c", "digest", "single", "first", F.posexplode("w").alias("i", "w"))
    counted = (windows_.groupBy("h", "w").agg(F.min("digest").alias("least"), F.max("digest").alias("most"))
               .where("least <> most").select("h", "w"))
    at = (F.col("first") + F.col("i")).cast("long")
    single = windows_.where("single").join(counted, ["h", "w"]).select("h", "c", at.alias("first"), at.alias("last"))
    out = stage(whole.unionByName(single), "repeated-blocks")
    drop_staged(blocks, kinds, rows)
    return out


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of spans of units, a stretch of units at a time."""
    out = np.empty(len(starts), _U64)
    order = np.argsort(starts, kind="stable")
    ordered = starts[order]
    i = 0
    while i < len(order):
        lo = ordered[i]
        j = int(np.searchsorted(ordered, lo + STRETCH, "right"))
        some = order[i:j]
        sums = prefix_sums(values[lo:ends[some].max()])
        out[some] = spans_hash(sums, starts[some] - lo, ends[some] - lo)
        i = j
    return out


def covered(ranges: list[dict] | None, width: int) -> list[tuple[int, int]]:
    """Maximal runs [start, end) of units covered by ranges of windows."""
    out: list[tuple[int, int]] = []
    for r in sorted((r["first"], r["last"] + width) for r in ranges or ()):
        if out and r[0] <= out[-1][1]:
            if r[1] > out[-1][1]:
                out[-1] = out[-1][0], r[1]
        else:
            out.append(r)
    return out
