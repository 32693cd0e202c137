"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints are 64 bits: bit b is set if it is set in over half of the XXH64 hashes (seed 42, UTF-8)
of a text's word shingles. Fingerprints that differ in at most ``max_bits`` (0-2) bits are linked and
the classes are the connected components.

Links are found among the *different* fingerprints, so copies never multiply. The 64 bits are dealt
into 4 blocks of 16; two fingerprints within 2 bits agree on at least 2 blocks, so for each of the 6
pairs of blocks the fingerprints are re-ordered with that pair in front and sorted by Gray rank
(neighbours in that order differ in few bits). Equal leading pairs form a group, the top node of the
index; below it, runs of neighbours are joined level by level to nodes that hold the bits all their
members share (mask and pattern). A search takes pairs of nodes from the top and drops a whole pair
once the differences over their common mask exceed ``max_bits``, or once everything in it is already
one component. Only a spanning set of links leaves a task, at most one per member.

Skew: a group is a set of different fingerprints with 32 equal bits. Groups beyond ``LARGE_GROUP``
members are dealt again by pairs of the 4 blocks of 8 bits that remain, which leaves at most 2^16
members in any group whatever the data (``max_bits`` still spans 2 equal blocks). Components are
found by alternating large-star and small-star steps on the links, with each round staged.

Defined results: null and empty texts have no words and fingerprint zero, linked like any other; a
text of fewer words than a shingle is one shingle; repeated rows link; an empty table gives no row;
columns other than id and text are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.components import components
from stellate.llm.staging import stage

SHINGLE = 3
MAX_BITS = 2
SEED = 42
LARGE_GROUP = 4096
LEAF = 8
_U64 = np.uint64
# shingles hashed before their bits are added up, which bounds memory for any text
_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one text (UTF-8 bytes), A-Z lower-cased."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    total, count = np.zeros(64, np.int64), n - shingle + 1
    digest = xxhash.xxh64_intdigest
    for lo in range(0, count, _CHUNK):
        hi = min(lo + _CHUNK, count)
        h = np.array([digest(line[s:e], SEED) for s, e in zip(starts[lo:hi], ends[lo + shingle - 1:hi + shingle - 1])], "<u8")
        total += _set_bits(h)
    set_bits = np.flatnonzero(2 * total > count)
    return sum(1 << int(b) for b in set_bits)


def _set_bits(h: np.ndarray) -> np.ndarray:
    """How many of the values have each of the 64 bits set."""
    bits = np.unpackbits(h.view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little")
    out = np.zeros(64, np.int64)
    for lo in range(0, len(bits), 255):  # sums of up to 255 fit a byte
        out += bits[lo:lo + 255].sum(0, dtype=np.uint8)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed 64-bit value."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                fps = np.array([fingerprint(t, shingle) if t else 0 for t in part.column(1).to_pylist()], _U64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(run, f"id {id_type}, fp long").withColumnRenamed("id", id_col)


# The orders of 16-bit blocks that put each pair of them in front, and of 8-bit blocks in the rest.
_PAIRS = [[*p, *(b for b in range(4) if b not in p)] for p in combinations(range(4), 2)]


def _dealt(fps: DataFrame, column: str, orders, width: int, kept: int) -> DataFrame:
    """A row for each order: ``word`` with its blocks in that order behind ``kept`` leading bits."""
    words = []
    for order in orders:
        low = F.col(column) if not kept else F.col(column).bitwiseAND((1 << (64 - kept)) - 1)
        out = F.shiftrightunsigned(F.col(column), 64 - kept) if kept else F.lit(0).cast("long")
        for block in order:
            out = F.shiftleft(out, width).bitwiseOR(F.shiftrightunsigned(low, width * (3 - block)).bitwiseAND((1 << width) - 1))
        words.append(out)
    return fps.select("*", F.posexplode(F.array(*words)).alias("deal", "word"))


def links(fps: DataFrame, max_bits: int = MAX_BITS, large: int = LARGE_GROUP) -> DataFrame:
    """(u, v), u > v: links that span the components of different fingerprints (column ``fp``)
    within ``max_bits``."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits is 0, 1 or 2")
    dealt = (_dealt(fps.select("fp"), "fp", _PAIRS, 16, 0)
             .withColumn("front", F.shiftrightunsigned("word", 32)))
    sizes = dealt.groupBy("deal", "front").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.where(F.col("size") > 1)
    grouped = dealt.join(sizes, ["deal", "front"])
    plain = grouped.where(F.col("size") <= large).select("fp", "word", F.xxhash64("deal", "front").alias("group"))
    again = (_dealt(grouped.where(F.col("size") > large).select("fp", F.col("deal").alias("deal0"), F.col("word").alias("word0")),
                    "word0", _PAIRS, 8, 32)
             .select("fp", "word", F.xxhash64("deal0", "deal", F.shiftrightunsigned("word", 16)).alias("group")))
    rows = plain.unionByName(again)
    n = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = rows.repartition(n, "group").sortWithinPartitions("group")

    def run(batches):
        rest = None
        for batch in batches:
            part = np.stack([batch.column(2).to_numpy(), batch.column(1).to_numpy(), batch.column(0).to_numpy()])
            if rest is not None and rest.shape[1]:
                part = np.concatenate([rest, part], axis=1)
            cut = int(np.searchsorted(part[0], part[0, -1])) if part.shape[1] else 0
            rest = part[:, cut:]  # the last group may go on in the next batch
            yield from _linked(part[:, :cut], max_bits)
        if rest is not None:
            yield from _linked(rest, max_bits)

    return rows.mapInArrow(run, "u long, v long").distinct()


def gray_rank(words: np.ndarray) -> np.ndarray:
    """Place of each word in the reflected binary Gray code."""
    out = words.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> _U64(shift)
    return out


def _linked(part: np.ndarray, max_bits: int):
    if part.shape[1] < 2:
        return
    group, words, fps = part[0], part[1].view(_U64), part[2]
    order = np.lexsort((gray_rank(words), group))
    group, words, fps = group[order], words[order], fps[order]
    u, v = near_links(words, group, max_bits)
    if len(u):
        a, b = fps[u], fps[v]
        yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["u", "v"])


class _Level:
    """Nodes over consecutive words: [lo, hi), the bits all members share and their pattern."""

    def __init__(self, lo, hi, all_set, any_set):
        self.lo, self.hi, self.all_set, self.any_set = lo, hi, all_set, any_set
        self.mask, self.pattern = ~(all_set ^ any_set), all_set


def gray_index(words: np.ndarray, group: np.ndarray) -> list[_Level]:
    """Levels from leaves (up to LEAF neighbours of a group) to one node per group."""
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, len(words)))
    lo = np.concatenate([[0], np.cumsum(-(-sizes // LEAF))[:-1]])
    leaf_starts = np.repeat(starts, -(-sizes // LEAF)) + LEAF * (np.arange(int((-(-sizes // LEAF)).sum())) - np.repeat(lo, -(-sizes // LEAF)))
    ends = np.append(leaf_starts[1:], len(words))
    levels = [_Level(leaf_starts, ends, np.bitwise_and.reduceat(words, leaf_starts), np.bitwise_or.reduceat(words, leaf_starts))]
    owner = group[leaf_starts]
    while len(levels[-1].lo) > len(starts):
        low = levels[-1]
        new = np.concatenate([[True], owner[1:] != owner[:-1]])
        place = np.arange(len(owner)) - np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(owner))))
        heads = np.flatnonzero(place % LEAF == 0)
        levels.append(_Level(low.lo[heads], np.append(low.lo[heads][1:], len(words)),
                             np.bitwise_and.reduceat(low.all_set, heads), np.bitwise_or.reduceat(low.any_set, heads)))
        low.parent_first = heads
        owner = owner[heads]
    return levels


def near_links(words: np.ndarray, group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (places u, v) of the words of each group within ``max_bits``; words come sorted
    by group and Gray rank."""
    root = np.arange(len(words))
    out_u, out_v = [], []

    def union(u, v):
        """Join components for candidate links, keep the links that joined something."""
        nonlocal root
        while len(u):
            a, b = root[u], root[v]
            apart = a != b
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            if not len(u):
                return
            hi, lo = np.maximum(a, b), np.minimum(a, b)
            # each root takes one smaller root at a time, so every kept link joins two components
            _, first = np.unique(hi, return_index=True)
            root[hi[first]] = lo[first]
            out_u.append(u[first])
            out_v.append(v[first])
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up

    near = np.flatnonzero((group[1:] == group[:-1]) & (np.bitwise_count(words[1:] ^ words[:-1]) <= max_bits))
    union(near + 1, near)
    levels = gray_index(words, group)
    # pairs of nodes of a level still to be searched; a group of one leaf starts at the bottom
    stack = [(len(levels) - 1, np.arange(len(levels[-1].lo)), np.arange(len(levels[-1].lo)))]
    while stack:
        k, x, y = stack.pop()
        if len(x) > 4096:
            stack.append((k, x[4096:], y[4096:]))
            x, y = x[:4096], y[:4096]
        level = levels[k]
        apart = np.bitwise_count((level.pattern[x] ^ level.pattern[y]) & level.mask[x] & level.mask[y]) <= max_bits
        x, y = x[apart], y[apart]
        # a node pair that is one component already holds nothing new
        least, most = np.minimum.reduceat(root, level.lo), np.maximum.reduceat(root, level.lo)
        open_ = (np.minimum(least[x], least[y]) != np.maximum(most[x], most[y]))
        x, y = x[open_], y[open_]
        if not len(x):
            continue
        if k == 0:
            u, v = _cross(level.lo, level.hi, x, y)
            ok = (u > v) & (root[u] != root[v])
            u, v = u[ok], v[ok]
            ok = np.bitwise_count(words[u] ^ words[v]) <= max_bits
            union(u[ok], v[ok])
        else:
            first = levels[k - 1].parent_first
            end = np.append(first[1:], len(levels[k - 1].lo))
            cx, cy = _cross(first, end, x, y)
            ok = cx >= cy
            stack.append((k - 1, cx[ok], cy[ok]))
    if not out_u:
        none = np.zeros(0, np.int64)
        return none, none
    return np.concatenate(out_u), np.concatenate(out_v)


def _cross(lo: np.ndarray, hi: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (child of x, child of y) for pairs of nodes, children being [lo, hi)."""
    nx, ny = hi[x] - lo[x], hi[y] - lo[y]
    n = nx * ny
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    width = np.repeat(ny, n)
    return np.repeat(lo[x], n) + at // width, np.repeat(lo[y], n) + at % width


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """id, fp, component_id (smallest id reachable over links, itself included), copies (rows of the
    same fingerprint)."""
    marked = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    fps = marked.groupBy("fp").agg(F.min(id_col).alias("least"), F.count(F.lit(1)).alias("copies"))
    found = components(links(fps, max_bits))
    classes = (fps.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left")
               .withColumn("root", F.coalesce("root", "fp")))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = classes.join(least, "root").select("fp", "component_id", "copies")
    return marked.join(by_fp, "fp").select(id_col, "fp", "component_id", "copies")


def keep_representatives(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs``, all their columns, with one row of each class: the smallest doc_id (null first), by text
    hash where ids repeat, and once where whole rows repeat."""
    held = docs.select(F.struct("*").alias("row"), "text", F.struct("doc_id", F.xxhash64("text").alias("text")).alias("key"))
    chosen = (near_duplicates(held, "key", "text", shingle, max_bits)
              .where(F.col("key").eqNullSafe(F.col("component_id"))).select(F.col("key").alias("kept")).distinct())
    same = F.col("key").eqNullSafe(F.col("kept"))
    return held.join(chosen, same, "left_semi").dropDuplicates(["key"]).select("row.*")
