"""Alignment of two tokenizers over a corpus, with an identity-map fast path.

Both vocabularies are turned into the bytes that each id stands for, and an array maps every id of A to
the id of B with the same bytes. Where a group (the stretch between two byte offsets at which tokens of
both end) is one token of A and its image in that array, it is counted in a vector as long as A's
vocabulary; only the links of the other, irregular groups become (A id, B id) pairs and are shuffled.

Steps: (1) texts are taken in slices of about ``SLICE_BYTES``; a slice's parts (see
``vocab.part_starts``) are numbered, each different part is encoded and aligned once, and a slice becomes
a few rows: documents with their different links and how often each has them, and the slice's different
irregular pairs with their counts. Each task adds one row with its identity vector. (2) Pair counts are
summed with map-side combine; the vectors are summed by position. (3) Each slice gets the totals of its
own pairs back and turns them into sums per document.

Scale: texts are encoded once and not shuffled; shuffles carry a slice's *different* irregular pairs and,
once, its documents' different links. A pair that every slice has is one row a slice, in a join that adaptive
execution splits. Only vectors as long as the vocabularies reach the driver and are broadcast. Memory is
bounded by a slice in Python (a longer text is a slice of its own) and, in the JVM, by the different links
of ``ROW_LINKS`` links or of one text: rows of a megabyte or more make its heap grow to its limit.

Defined results: a text that is null or empty, or whose tokens of A or B do not give back a space and the
text (such as one with U+2581), has zeros and an empty ``groups_sha256``; repeated rows count each time
and give a row each; a null id stays null; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache
from itertools import zip_longest

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stellate.llm.kernels import slices, spread
from stellate.llm.staging import stage
from stellate.llm.vocab import byte_letters, dictionary, part_starts

SLICE_BYTES = 1 << 22
# Different parts are encoded together in texts of about so many bytes.
TOGETHER_BYTES = 1 << 16
# Tokens (of A and B) that are aligned together, about.
BLOCK_TOKENS = 1 << 17
# A row holds at most so many texts, and texts of about so many links; and at most so many pairs.
ROW_TEXTS, ROW_LINKS, ROW_PAIRS = 1 << 10, 1 << 17, 1 << 13
# A pair is one number: A id * _B + B id. An identity link of A id a is -1 - a.
_B = 1 << 24


class Aligner:
    """Two vocabularies and the identity map between them."""

    def __init__(self, path_a: str, path_b: str):
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = {letter: i for i, letter in enumerate(byte_letters())}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes([byte[c] for c in token]) if all(c in byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        single = [self.b.is_byte(i) for i in range(len(pieces))]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if s else p.replace("▁", " ").encode() for p, s in zip(pieces, single)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # pieces before single-byte fallbacks, lower ids first
        ids: dict[bytes, int] = {}
        for i in sorted(range(len(pieces)), key=lambda i: (single[i], i)):
            if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i)):
                ids.setdefault(self.bytes_b[i], i)
        self.same = np.array([ids.get(x, -1) for x in self.bytes_a], np.int64)
        self.space = self.b.piece_to_id("▁")
        # a piece with a space after another character could run over the edge of a part
        self.by_parts = not any("▁" in p.lstrip("▁") for p in pieces)
        # an id as text, within its group and at the end of its side
        self.text = [b"%d" % i + end for n, last in ((len(self.bytes_a), b"|"), (len(self.bytes_b), b";"))
                     for i in range(n) for end in (b",", last)]
        self.text_size = np.array([len(x) for x in self.text], np.int64)

    def tokens(self, spaced: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids by A and by B of a text that begins with a space; None if they do not give it back."""
        text = spaced.decode()
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:]) if len(text) > 1 else [self.space]
        if b"".join([self.bytes_a[i] for i in a]) != spaced or b"".join([self.bytes_b[i] for i in b]) != spaced:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def encode(self, parts: list[bytes], alone: bool):
        """Lists of numbers of parts, each with the parts' tokens by A and B; parts whose tokens do not give them
        back are left out. Unless ``alone``, parts that may stand one after the other are encoded together."""
        if not alone:
            data = np.frombuffer(b"".join(parts), np.uint8)
            ends = np.cumsum([len(p) for p in parts])
            starts, _ = part_starts(data, np.array([0, len(data)]))
            closed = np.isin(ends, np.append(starts, len(data)))
            closed[-1:] = False
            together, size = [], 0
            for k in [*np.flatnonzero(closed).tolist(), None]:
                if together and (k is None or size > TOGETHER_BYTES):
                    both = self.tokens(b"".join([parts[i] for i in together]))
                    if both is None:
                        closed[together] = False
                    else:
                        yield together, both
                    together, size = [], 0
                if k is not None:
                    together.append(k)
                    size += len(parts[k])
            rest = np.flatnonzero(~closed).tolist()
        else:
            rest = range(len(parts))
        for k in rest:
            both = self.tokens(parts[k])
            if both is not None:
                yield [k], both

    def slice(self, data: np.ndarray, offsets: np.ndarray) -> Slice:
        """The alignment of consecutive texts; a text without tokens has no part."""
        full = offsets[1:] > offsets[:-1]
        data = np.insert(data, offsets[:-1][full], 0x20)
        offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        if self.by_parts:
            starts, first = part_starts(data, offsets)
        else:
            starts = offsets[:-1][full]
            first = np.searchsorted(starts, offsets)
        codes, keys = dictionary(data, starts)
        place = np.full(len(keys), -1, np.int64)
        found = Parts(self)
        for numbers, both in self.encode(keys, not self.by_parts):
            place[numbers] = found.add([len(keys[k]) for k in numbers], *both)
        codes = place[codes]
        if (codes < 0).any():
            # the whole text decides
            lists = np.split(codes, first[1:-1])
            for d in np.unique(np.searchsorted(first, np.flatnonzero(codes < 0), "right") - 1).tolist():
                whole = data[offsets[d]:offsets[d + 1]].tobytes()
                both = self.tokens(whole)
                lists[d] = np.array([] if both is None else found.add([len(whole)], *both), np.int64)
            codes = np.concatenate(lists)
            first = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        return Slice(codes, first, found)


class Parts:
    """Aligned parts, numbered as they are added: token and group counts, links (one a group, as no token is empty)
    and groups as text."""

    def __init__(self, table: Aligner):
        self.table, self.size = table, 0
        self.counts, self.links, self.groups = [], [], []
        self.waiting, self.n_waiting = [], 0

    def add(self, sizes: list[int], a: np.ndarray, b: np.ndarray) -> range:
        """The numbers of parts of these sizes and, one after the other, these tokens."""
        self.size += len(sizes)
        self.waiting.append((sizes, a, b))
        self.n_waiting += len(a) + len(b)
        if self.n_waiting > BLOCK_TOKENS:
            self.align()
        return range(self.size - len(sizes), self.size)

    def align(self) -> None:
        """Align the parts that wait."""
        table, none = self.table, np.zeros(0, np.int64)
        sizes, a, b = (np.concatenate([none, *[np.asarray(x[k], np.int64) for x in self.waiting]]) for k in range(3))
        self.waiting, self.n_waiting = [], 0
        ends_a, ends_b, ends = np.cumsum(table.size_a[a]), np.cumsum(table.size_b[b]), np.cumsum(sizes)
        cuts, last_a, last_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        upto = [np.concatenate([[0], np.searchsorted(x, ends) + 1]) for x in (ends_a, ends_b, cuts)]
        self.counts.append(np.array([np.diff(x) for x in upto]))
        link_a, link_b = a[last_a], b[last_b]
        alone = (np.diff(last_a, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1)
        self.links.append(np.where(alone & (table.same[link_a] == link_b), -1 - link_a, link_a * _B + link_b))
        # ids as text, in the order of the groups: A's of a group, then B's
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        order = np.empty(len(a) + len(b), np.int64)
        closes = np.zeros(len(a), np.int64)
        closes[last_a] = 1
        order[np.arange(len(a)) + np.concatenate([[0], last_b + 1])[group_a]] = 2 * a + closes
        closes = np.zeros(len(b), np.int64)
        closes[last_b] = 1
        order[np.arange(len(b)) + last_a[group_b] + 1] = 2 * (len(table.bytes_a) + b) + closes
        text = b"".join([table.text[k] for k in order.tolist()])
        edges = np.concatenate([[0], np.cumsum(table.text_size[order])])[upto[0] + upto[1]].tolist()
        self.groups += [text[lo:hi] for lo, hi in zip(edges[:-1], edges[1:])]


class Slice:
    """Aligned texts: part numbers ``codes``, texts' first places ``first``, and per part token and group counts,
    groups as text and links (``links[link_first[i]:link_first[i + 1]]``)."""

    def __init__(self, codes: np.ndarray, first: np.ndarray, found: Parts):
        self.codes, self.first = codes, first
        found.align()
        self.n_a, self.n_b, self.n_groups = np.concatenate(found.counts, axis=1)
        self.link_first = np.concatenate([[0], np.cumsum(self.n_groups)])
        self.links = np.concatenate(found.links)
        self.groups = found.groups

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups; empty for a text without tokens."""
        lists = (self.codes[lo:hi].tolist() for lo, hi in zip(self.first[:-1], self.first[1:]))
        return [hashlib.sha256(b"".join([self.groups[c] for c in x])[:-1]).hexdigest() if x else "" for x in lists]


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[i]:first[i + 1]]."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers under 2^32, most of them small, as bytes."""
    return zlib.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


_SLICES = ("slice long, ids array<{}>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, "
           "links binary, pairs array<long>, counts array<long>, vector array<long>")


def _slice_rows(table: Aligner, number: int, ids: pa.Array, data: np.ndarray, offsets: np.ndarray, vector: np.ndarray):
    """The slice's rows. ``links`` of a row: per text how many different links it has, the links (A id of an identity
    link, len(vector) + place among the slice's pairs of another; steps from one to the next), and how often each."""
    found = table.slice(data, offsets)
    used = np.bincount(found.codes, minlength=len(found.n_a)).astype(np.int64)
    weight = np.repeat(used, found.n_groups)
    plain = found.links < 0
    vector += np.bincount(-1 - found.links[plain], weight[plain], len(vector)).astype(np.int64)
    pairs, at = np.unique(found.links[~plain], return_inverse=True)
    counts = np.bincount(at, weight[~plain], len(pairs)).astype(np.int64)
    links = -1 - found.links
    links[~plain] = len(vector) + at
    per_text = [sums(x[found.codes], found.first) for x in (found.n_a, found.n_b, found.n_groups)]
    sha256 = found.digests()
    upto = np.concatenate([[0], np.cumsum(per_text[2])])
    cuts = [0]
    while cuts[-1] < len(ids):
        lo = cuts[-1]
        hi = int(np.searchsorted(upto, upto[lo] + ROW_LINKS, "right")) - 1
        cuts.append(min(max(hi, lo + 1), lo + ROW_TEXTS, len(ids)))
    texts = list(zip(cuts[:-1], cuts[1:]))
    for t, p in zip_longest(texts, range(0, len(pairs), ROW_PAIRS)):
        lo, hi = t or (0, 0)
        p = slice(0, 0) if p is None else slice(p, p + ROW_PAIRS)
        yield [number, ids.slice(lo, hi - lo), *[pa.array(x[lo:hi]) for x in per_text], pa.array(sha256[lo:hi], pa.string()),
               _text_links(found, links, lo, hi, len(vector) + len(pairs)), pa.array(pairs[p]), pa.array(counts[p]), None]


def _text_links(found: Slice, links: np.ndarray, lo: int, hi: int, most: int) -> bytes:
    """Different links (under ``most``) of the texts lo to hi, as in a row."""
    codes = found.codes[found.first[lo]:found.first[hi]]
    text = np.repeat(np.arange(hi - lo), np.diff(found.first[lo:hi + 1]))
    n = found.n_groups[codes]
    every, times = np.unique(np.repeat(text * most, n) + links[spread(n, found.link_first[codes])], return_counts=True)
    text, every = np.divmod(every, most)
    steps = np.diff(every, prepend=0)
    begins = np.diff(text, prepend=-1) > 0
    steps[begins] = every[begins]
    return packed(np.concatenate([np.bincount(text, minlength=hi - lo), steps, times]))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): per document id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256;
    per linked id pair a, b and its count over the corpus."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def encode(batches):
        table = aligner(path_a, path_b)
        vector = np.zeros(len(table.same), np.int64)
        number = TaskContext.get().partitionId() << 32
        schema = None
        for batch in batches:
            if schema is None:
                longs = pa.list_(pa.int64())
                schema = pa.schema([("slice", pa.int64()), ("ids", pa.list_(batch.schema.field(0).type)), ("n_a", longs), ("n_b", longs), ("n_groups", longs),
                                    ("groups_sha256", pa.list_(pa.string())), ("links", pa.binary()), ("pairs", longs), ("counts", longs), ("vector", longs)])
            for lo, data, offsets in slices(batch.column(1), SLICE_BYTES):
                for row in _slice_rows(table, number, batch.column(0).slice(lo, len(offsets) - 1), data, offsets, vector):
                    yield _one_row(schema, row)
                number += 1
        if schema is not None:
            yield _one_row(schema, [None] * 9 + [pa.array(vector)])

    held = stage(rows.mapInArrow(encode, _SLICES.format(id_type)), "aligned-slices")
    vectors = held.where(F.col("vector").isNotNull()).select(F.posexplode("vector").alias("a", "n")).groupBy("a").agg(F.sum("n").alias("n"))
    identity = np.zeros(len(aligner(path_a, path_b).same), np.int64)
    for r in vectors.where("n > 0").collect():  # at most A's vocabulary
        identity[r["a"]] = r["n"]
    same = aligner(path_a, path_b).same
    own = held.where(F.col("vector").isNull()).select("slice", F.explode(F.arrays_zip("pairs", "counts")).alias("p")) \
        .select(F.col("slice").alias("of"), F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    totals = stage(own.groupBy("pair").agg(F.sum("n").alias("total")), "aligned-pairs")
    best = np.zeros(aligner(path_a, path_b).b.get_piece_size(), np.int64)
    for r in totals.groupBy((F.col("pair") % _B).alias("b")).agg(F.max("total").alias("n")).collect():  # at most B's vocabulary
        best[r["b"]] = r["n"]
    met = identity > 0
    np.maximum.at(best, same[met], identity[met])
    is_best = identity == best[np.maximum(same, 0)]

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        # the slice's own pairs, in the order of their numbers in it
        pairs, total = right.column("pair").to_numpy(), right.column("total").to_numpy()
        order = np.argsort(pairs)
        pairs, total = pairs[order], total[order]
        count = np.concatenate([identity, total])
        top = np.concatenate([is_best, total == best[pairs % _B]])
        out = [[np.zeros(0, np.int64)] for _ in range(3)]
        for ids, links in zip(left.column("ids"), left.column("links")):
            n, links = len(ids), unpacked(links.as_py())
            first = np.concatenate([[0], np.cumsum(links[:n])])
            steps, times = np.split(links[n:], 2)
            upto = np.concatenate([[0], np.cumsum(steps)])
            link = upto[1:] - np.repeat(upto[first[:-1]], links[:n])
            for x, values in zip(out, (times, times * top[link], times * count[link])):
                x.append(sums(values, first))
        flat = {k: left.column(k).combine_chunks().flatten() for k in ("ids", "n_a", "n_b", "n_groups", "groups_sha256")}
        return pa.table([flat["ids"], flat["n_a"], flat["n_b"], flat["n_groups"], *[pa.array(np.concatenate(x)) for x in out], flat["groups_sha256"]],
                        names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    texts = held.where(F.col("vector").isNull()).drop("pairs", "counts", "vector")
    back = own.select("of", "pair").join(totals, "pair").select("of", "pair", "total")
    found = texts.groupBy("slice").cogroup(back.groupBy("of")).applyInArrow(
        judge, f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    images = docs.sparkSession.createDataFrame([(int(a), int(same[a]), int(identity[a])) for a in np.flatnonzero(met)], "a long, b long, n long")
    pairs = totals.select(F.expr(f"pair div {_B}").alias("a"), (F.col("pair") % _B).alias("b"), F.col("total").alias("n")).unionAll(images)
    return found.withColumnRenamed("id", id_col), pairs


def _one_row(schema: pa.Schema, values: list) -> pa.RecordBatch:
    cells = []
    for field, v in zip(schema, values):
        if isinstance(v, pa.Array):
            cells.append(pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v, type=field.type))
        else:
            cells.append(pa.array([v], field.type))
    return pa.RecordBatch.from_arrays(cells, schema=schema)
