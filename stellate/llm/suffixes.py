"""Suffix-array dedup: repeated byte strings, by a common-prefix-aware distributed merge sort.

Bytes covered by a ``LENGTH``-byte string that also starts elsewhere (the same document included) are
removed; strings are judged on the input and never cross documents.

The suffixes that are sorted start at anchors (see ``repeats``): every string of that length holds one,
at the same offset wherever it occurs. Where an anchor stands in different contexts, each task sorts the
suffixes it cut (from the anchor to the context's end), writes them as front-coded runs (length of the
prefix shared with the suffix before, and the rest) and sends each run to the task of its bucket, the
hash of the anchor's bytes. That task merges the runs with a loser tree whose players know how many bytes
they share with the suffix last put out: the longer shared prefix wins without a look at the bytes, and
equal ones are compared only behind it. The merge yields the sorted suffixes with their common prefix
lengths (LCP). Around a suffix, neighbours that share R bytes forward (a running minimum of LCPs) and L
bytes backward share all strings that begin at most L bytes before the anchor and end at most R bytes
behind its start; the walk stops where R is too short for any string.

Skew: equal contexts are counted, not sent; an anchor with over ``CROWD`` different contexts is decided by
counting window hashes in Spark instead of in one bucket, so a bucket holds few suffixes per anchor.

Defined results: null texts are empty; texts under ``LENGTH`` bytes lose nothing; repeated rows count as
different places; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.kernels import BYTE_VALUES, slices
from stellate.llm.repeats import _LO, _N, Units, count_windows, covered, repeated_windows, with_texts

LENGTH = 200
GRAM = 40
CROWD = 64
_RUN = "bucket long, h binary, c binary, copies binary, shared binary, size binary, before binary, rest binary, backward binary"


def byte_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_VALUES[data], offsets


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[start:n]) ^ int.from_bytes(b[start:n])
    return n - (x.bit_length() + 7 >> 3)


class Suffix:
    """A suffix from its anchor on, the bytes before the anchor (reversed), and its context."""
    __slots__ = ("h", "c", "copies", "forward", "backward", "windows")

    def __init__(self, h, c, copies, forward, backward, windows):
        self.h, self.c, self.copies, self.forward, self.backward, self.windows = h, c, copies, forward, backward, windows


def front_coded(suffixes: list[Suffix]) -> tuple[bytes, ...]:
    """A sorted run as columns: what each suffix shares with the one before, and the rest."""
    shared, rest, last = [], [], b""
    for s in suffixes:
        k = common(last, s.forward)
        shared.append(k)
        rest.append(s.forward[k:])
        last = s.forward
    pack = lambda v, kind: np.array(v, kind).tobytes()
    return (pack([s.h for s in suffixes], "<i8"), pack([s.c for s in suffixes], "<i8"), pack([s.copies for s in suffixes], "<i8"),
            pack(shared, "<u2"), pack([len(s.forward) for s in suffixes], "<u2"), pack([len(s.backward) for s in suffixes], "<u2"),
            b"".join(rest), b"".join([s.backward for s in suffixes]))


def decoded(h: bytes, c: bytes, copies: bytes, shared: bytes, size: bytes, before: bytes, rest: bytes, backward: bytes, length: int):
    """(LCP with the one before, suffix) of a front-coded run, in order."""
    last, at, back = b"", 0, 0
    for hv, cv, n, k, m, b in zip(*(np.frombuffer(v, kind).tolist() for v, kind in (
            (h, "<i8"), (c, "<i8"), (copies, "<i8"), (shared, "<u2"), (size, "<u2"), (before, "<u2")))):
        last = last[:k] + rest[at:at + m - k]
        at += m - k
        # windows start from ``before`` bytes ahead of the anchor and end within the suffix
        yield k, Suffix(hv, cv, n, last, backward[back:back + b], b + m - length + 1)
        back += b


def merged(runs: list):
    """(LCP with the one before, suffix) over all runs in order, by a loser tree.

    ``lcp[r]`` is what the head of run r shares with the suffix last put out (for a beaten head: with the
    head that beat it, which comes first and shares no less with what was put out before)."""
    k = 1
    while k < len(runs):
        k *= 2
    heads, lcp = [None] * k, [0] * k

    def advance(r: int) -> None:
        got = next(runs[r], None) if r < len(runs) else None
        lcp[r], heads[r] = got if got is not None else (-1, None)

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs, whose values are relative to the same suffix before them."""
        if heads[a] is None or heads[b] is None:
            return (b, a) if heads[a] is None else (a, b)
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        x, y = heads[a].forward, heads[b].forward
        n = common(x, y, lcp[a])
        if x[n:n + 1] <= y[n:n + 1]:
            lcp[b] = n
            return a, b
        lcp[a] = n
        return b, a

    for r in range(k):
        advance(r)
    losers = [0] * k
    winners = [*[0] * k, *range(k)]
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if k > 1 else 0
    while heads[top] is not None:
        yield lcp[top], heads[top]
        advance(top)
        node = top + k >> 1
        while node:
            top, losers[node] = play(top, losers[node])
            node >>= 1


def repeated_in(group: list[Suffix], lcps: list[int], length: int):
    """(suffix, first, last): ranges of windows, counted from its context's first, that another suffix of
    the group has too. The group is sorted; lcps[i] is shared by i-1 and i."""
    for i, s in enumerate(group):
        if s.copies > 1:
            continue  # repeated whole already
        before = len(s.backward)
        least = before - s.windows + 1  # bytes before the anchor of its last window
        every, found = (1 << s.windows) - 1, 0  # bit k: window k
        for step in (-1, 1):
            j, r = i, len(s.forward)
            while found != every:
                k = j if step < 0 else j + 1
                j += step
                if j < 0 or j >= len(group):
                    break
                r = min(r, lcps[k])
                if r + before < length:
                    break
                low, high = max(length - r, least), min(common(s.backward, group[j].backward), before)
                if low <= high:
                    found |= (1 << high - low + 1) - 1 << before - high
        at = 0
        while found:
            skip = (found & -found).bit_length() - 1
            run = (~(found >> skip) & (found >> skip) + 1).bit_length() - 1
            yield s, at + skip, at + skip + run - 1
            at += skip + run
            found >>= skip + run


def sorted_runs(open_: DataFrame, base: DataFrame, buckets: int, length: int) -> DataFrame:
    """The front-coded runs of the open contexts, one row per task batch and bucket."""

    def run(batches):
        for batch in batches:
            for row, data, offsets in slices(batch.column(0)):
                cuts = batch.column(1).slice(row, len(offsets) - 1)
                flat = cuts.flatten()
                if not len(flat):
                    continue
                text = data.tobytes()
                start = np.repeat(offsets[:-1], np.diff(np.asarray(cuts.offsets))).tolist()
                by_bucket: dict[int, list[Suffix]] = {}
                h, c, place, copies = (flat.field(k).to_pylist() for k in (0, 1, 2, 4))
                for hv, cv, p, n_copies, s in zip(h, c, place, copies, start):
                    first, before, n = s + (p >> (_LO + _N)), (p >> _N) & ((1 << _LO) - 1), p & ((1 << _N) - 1)
                    a = first + before
                    by_bucket.setdefault(hv % buckets, []).append(
                        Suffix(hv, cv, n_copies, text[a:first + n - 1 + length], text[first:a][::-1], n))
                cols = [[] for _ in range(9)]
                for bucket, found in by_bucket.items():
                    found.sort(key=lambda s: s.forward)
                    for col, v in zip(cols, (bucket, *front_coded(found))):
                        col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(v, pa.binary()) for v in cols[1:])],
                                                 ["bucket", "h", "c", "copies", "shared", "size", "before", "rest", "backward"])

    return with_texts(open_, base).mapInArrow(run, _RUN)


def merge_runs(runs: DataFrame, buckets: int, gram: int, length: int) -> DataFrame:
    """Merge each bucket's runs and decide its contexts: (h, c, first, last)."""

    def decide(run_rows):
        out = ([], [], [], [])
        group, lcps = [], []

        def close():
            if len(group) > 1:
                for s, first, last in repeated_in(group, lcps, length):
                    for col, v in zip(out, (s.h, s.c, first, last)):
                        col.append(v)

        for lcp, s in merged([decoded(*r, length) for r in run_rows]):
            if lcp < gram:
                close()
                group, lcps = [], []
            group.append(s)
            lcps.append(lcp)
        close()
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], ["h", "c", "first", "last"])

    def run(batches):
        now, rows = None, []
        for batch in batches:
            for bucket, *cols in zip(*(batch.column(k).to_pylist() for k in range(9))):
                if bucket != now and rows:
                    yield decide(rows)
                    rows = []
                now = bucket
                rows.append(cols)
        if rows:
            yield decide(rows)

    dealt = runs.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "h long, c long, first long, last long")


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                crowd: int = CROWD, whole_characters: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, spans (maximal removed runs of bytes), kept (bytes) and, if there are other
    columns, row (a struct of them). With ``whole_characters``, what is left of characters that were cut goes from ``kept`` too."""
    units = Units(length, min(GRAM, length), byte_units)
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)

    def decide(open_, base):
        few, many = open_.where(F.col("contexts") <= crowd), open_.where(F.col("contexts") > crowd)
        by_merge = merge_runs(sorted_runs(few, base, buckets, length), buckets, units.gram, length)
        return by_merge.unionByName(count_windows(many, base, units))

    found = repeated_windows(docs, units, decide, id_col, text_col)
    rest = ["row"] if "row" in found.columns else []
    types = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in ["id", *rest])

    def run(batches):
        for batch in batches:
            kept, spans, size = [], [], []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                gone = covered(ranges, length)
                size.append(len(text))
                if gone:
                    edges = [0, *(x for span in gone for x in span), len(text)]
                    text = b"".join([text[s:e] for s, e in zip(edges[::2], edges[1::2])])
                    if whole_characters:
                        text = text.decode("utf-8", "ignore").encode()
                kept.append(text)
                spans.append(gone)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(batch.column(3) for _ in rest), pa.array(size, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary())], ["id", *rest, "n_bytes", "spans", "kept"])

    out = found.mapInArrow(run, f"{types}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(F.col("id").alias(id_col), "n_bytes", removed.alias("n_removed"),
                      "spans", "kept", *rest)


def keep_new_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs``, all their columns, with repeated bytes cut from their texts (what is left of a character
    that was cut goes too) and ``n_chars`` counted anew; null texts become empty."""
    done = dedup_bytes(docs, length=length, whole_characters=True)
    text = F.col("kept").cast("string")
    new = {"doc_id": F.col("doc_id"), "text": text.alias("text"), "n_chars": F.char_length(text).cast("long").alias("n_chars")}
    return done.select(*[new.get(c, F.col(f"row.`{c}`")) for c in docs.columns])
