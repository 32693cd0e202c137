"""Token counts by prefix dynamic programming.

For every prefix of a text the table holds the exact number of tokens the tokenizer gives for that
prefix, as the difference to the prefix one code point shorter (one signed byte a code point; -128 and
four bytes for a difference beyond 127).
Counting, truncating and budgeting then read the table and never encode again.

The table of a piece (a word, number or run of signs; a BPE never merges across pieces) comes from
a dynamic program over its prefixes: the encoding of a prefix ends in the one vocabulary token whose
removal leaves a shorter prefix that ends in a *compatible* token, i.e. the two tokens stay two when
encoded together. So each prefix needs its last token and its count and nothing is encoded anew. Prefixes
and whole pieces that were met before are looked up, and pieces' tables are strung together per text.

Parts of a text with characters outside ASCII and Latin-1 letters, control characters or '<|' go through
the same program, piece by piece; there the library normalises and cuts, the program counts. Code points that
normalisation can join with the one before (combining marks, jamo) are normalised in groups, and prefixes that end
inside a group one by one; the program goes on from what a prefix shares with the prefix before, so only
normalising and cutting see a long group's prefixes whole. A special string is one
token from its last code point on and ordinary text before. No text is left to the library's encoder.

Defined results: null and empty texts have 0 tokens and an empty table; repeated rows and ties give a row
each; an empty table gives no row; other columns are not looked at. Memory is bounded by one Arrow batch
and the piece lookup.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.vocab import CACHE_LENGTH, Lookup, Unusual, byte_letters, tokenizer, usual, word_pieces

# Prefixes (twice as many with those of the last lookup) and pairs of tokens kept per process.
CACHE_STATES = 1 << 18


@lru_cache(maxsize=1)
def groups() -> re.Pattern:
    """Cuts a text into code points with those after them that normalisation (NFC) can join to them."""
    joins = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    points = [chr(c) for c in range(sys.maxunicode + 1)]
    for c in points:
        parts = unicodedata.decomposition(c)
        if parts and parts[0] != "<":
            joins.update(chr(int(x, 16)) for x in parts.split()[1:])
    joins = {c for c in points if c in joins or unicodedata.combining(c)}
    joins |= {c for c in points if unicodedata.decomposition(c) and unicodedata.normalize("NFD", c)[0] in joins}
    return re.compile(f"(?s:.)[{''.join(map(re.escape, sorted(joins)))}]*")


class PieceTables:
    """For each code point of a text, the change of the token count of the prefix that ends there, packed. Built by the dynamic program above from the vocabulary file's merges."""

    def __init__(self, path: str):
        self.pieces = Lookup(self.piece)
        self.parts = Lookup(self.cut)
        self.odd_parts = Lookup(self.cut_odd)
        tok = tokenizer(path)
        self.normal = tok.normalizer.normalize_str
        self.forms = Lookup(self.normal)
        self.pre_tokens = tok.pre_tokenizer.pre_tokenize_str
        file = json.load(open(path))
        model = file["model"]
        special = sorted((t["content"] for t in file["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        self.end = model["end_of_word_suffix"] or ""
        self.letters = byte_letters()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.made: dict[str, tuple[int, tuple[str, str]]] = {}  # token -> the merge that makes it
        for i, (a, b) in enumerate(merges):
            self.made.setdefault(a + b, (i, (a, b)))
        self.stays: dict[tuple[str, str], bool] = {}
        # letters of a prefix -> last token and count inside a word, count as a whole word
        self.states: dict[str, tuple[str, int, int]] = {}
        self.last_states: dict[str, tuple[str, int, int]] = {}
        # the last long piece that ``total`` was asked for, and its prefixes' last tokens and counts
        self.long, self.long_path = "", [("", 0, 0)]
        # tokens that encode to themselves: letters, and merges of two compatible parts
        self.vocab = {t: t for t in model["vocab"] if t not in self.made or self.reached(t)}
        self.longest = max(map(len, self.vocab))

    def table(self, text: str) -> bytes:
        # white space has no tokens, so a text falls apart at its spaces, each a zero in the table
        try:
            return b"\0".join(map(self.parts.__getitem__, text.lower().split(" ")))
        except Unusual:
            return b"\0".join(map(self.odd_parts.__getitem__, text.split(" ")))

    def cut(self, part: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, word_pieces(part)))

    def piece(self, piece: str) -> bytes:
        if not usual(piece):
            raise Unusual
        if piece.isspace():
            return bytes(len(piece))
        counts = self.counts(piece)
        return packed([b - a for a, b in zip([0, *counts], counts)])

    def cut_odd(self, part: str) -> bytes:
        """The table of a part with any characters."""
        if usual(part):
            return self.parts[part.lower()]
        counts, at = [0], 0
        for special in self.special.finditer(part):
            first, end = special.span()
            before = counts[-1]
            counts += [before + n for n in self.prefixes(part[at:end - 1])]
            counts.append(counts[first] + 1)
            at = end
        before = counts[-1]
        counts += [before + n for n in self.prefixes(part[at:])]
        return packed(np.diff(counts).tolist())

    def prefixes(self, text: str) -> list[int]:
        """Tokens of each prefix of a text without special strings, one entry a code point."""
        found = groups().findall(text)
        forms = [self.forms[g] for g in found]
        whole, normal = "".join(forms), self.normal(text)
        if whole != normal and whole.replace(" ", "") != normal.replace(" ", ""):
            # code points that the library joins and Python's tables do not know
            found, forms, whole = [text], [normal], normal
        starts, counts = [], [0]  # of pieces; of each prefix of the normalised text
        for start, end in self.cuts(whole):
            counts += [counts[-1]] * (start + 1 - len(counts))
            before = counts[-1]
            counts += [before + n for n in self.counts(whole[start:end])]
            starts.append(start)
        counts += [counts[-1]] * (len(whole) + 1 - len(counts))
        out, n = [], 0
        for group, form in zip(found, forms):
            if len(group) > 1:
                # the two last pieces so far ("'" and "re" can become one)
                i = bisect_left(starts, n)
                tail = starts[max(i - 2, 0)] if i else 0
                for k in range(1, len(group)):
                    upto = whole[tail:n] + self.forms[group[:k]]
                    out.append(counts[tail] + sum(self.total(upto[a:b]) for a, b in self.cuts(upto)))
            n += len(form)
            out.append(counts[n])
        return out

    def cuts(self, normal: str) -> list[tuple[int, int]]:
        """Where the library's pieces of a normalised text start and end."""
        return [span for _, span in self.pre_tokens(normal)]

    def counts(self, piece: str) -> list[int]:
        """Tokens of each prefix of a piece, one entry a code point."""
        letters, states = self.letters, self.states
        data = piece.encode()
        symbols = "".join([letters[b] for b in data])
        if len(states) >= CACHE_STATES:
            self.last_states, self.states = states, {}
            states = self.states
        last_states = self.last_states
        path = [("", 0, 0)]
        for k in range(1, len(symbols) + 1):
            if k > CACHE_LENGTH:
                last, n = self.step(symbols, k, "", path)
                path.append((last, n, self.step(symbols, k, self.end, path)[1]))
                continue
            prefix = symbols[:k]
            state = states.get(prefix)
            if state is None:
                state = last_states.get(prefix)
                if state is None:
                    last, n = self.step(symbols, k, "", path)
                    state = last, n, self.step(symbols, k, self.end, path)[1]
                states[prefix] = state
            path.append(state)
        if len(data) == len(piece):
            return [state[2] for state in path[1:]]
        # the byte prefixes that are whole code points: the next byte does not continue one
        return [path[k][2] for k in range(1, len(data) + 1) if k == len(data) or data[k] & 0xC0 != 0x80]

    def total(self, piece: str) -> int:
        """Tokens of a piece. A long one takes over what it shares with the long one before it."""
        if len(piece) <= CACHE_LENGTH:
            return self.counts(piece)[-1]
        symbols = piece.encode().decode("latin-1").translate(self.letters)
        path, before = self.long_path, self.long
        if symbols.startswith(before):
            shared = len(before)
        else:
            shared = bisect_left(range(1, min(len(before), len(symbols)) + 1), True,
                                 key=lambda k: not symbols.startswith(before[:k]))
        del path[shared + 1:]
        for k in range(shared + 1, len(symbols) + 1):
            path.append((*self.step(symbols, k, "", path), 0))
        self.long = symbols
        return self.step(symbols, len(symbols), self.end, path)[1]

    def step(self, symbols: str, k: int, end: str, path: list[tuple[str, int, int]]) -> tuple[str, int]:
        """Last token and count of the first k symbols, given those of the shorter prefixes (the inside of
        a word, or with ``end`` a whole word)."""
        vocab, stays = self.vocab, self.stays
        lo = k - self.longest if k > self.longest else 0
        upto = symbols[lo:k] + end
        for j in range(lo, k):
            last = vocab.get(upto[j - lo:])
            if last is not None:
                if j == 0:
                    return last, 1
                before, n, _ = path[j]
                stay = stays.get((before, last))
                if stay or stay is None and self.compatible(before, last):
                    return last, n + 1
        raise ValueError(f"no token ends {upto!r}")

    def reached(self, token: str) -> bool:
        """Whether a token's two parts meet, unmerged, until the merge that makes the token."""
        merge, (a, b) = self.made[token]
        limit = merge
        while True:
            ra, left = self.made.get(a, (-1, None))
            rb, right = self.made.get(b, (-1, None))
            if max(ra, rb) >= merge:
                return False
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, left[1]
            else:
                limit, b = rb + 1, right[0]
            if self.rank.get((a, b), limit) < limit:
                return False

    def compatible(self, a: str, b: str) -> bool:
        """Whether two tokens side by side stay as they are. Their merges are undone from the last
        one; at each point in time the two parts that meet must not merge before one of them grows."""
        key = (a, b)
        if (known := self.stays.get(key)) is not None:
            return known
        limit = len(self.rank)
        rank, made = self.rank, self.made
        while True:
            if rank.get((a, b), limit) < limit:
                result = False
                break
            ra, left = made.get(a, (-1, None))
            rb, right = made.get(b, (-1, None))
            if ra < 0 and rb < 0:
                result = True
                break
            if ra > rb:
                limit, a = ra, left[1]
            else:  # of two equal merges the left one comes first
                limit, b = rb + 1, right[0]
        if len(self.stays) >= CACHE_STATES:
            self.stays.clear()
        self.stays[key] = result
        return result


def packed(steps: list[int]) -> bytes:
    """Steps of the count as stored."""
    if max(steps, default=0) <= 127 and min(steps, default=0) >= -127:
        return bytes([s & 0xFF for s in steps])
    return b"".join([bytes([s & 0xFF]) if -127 <= s <= 127 else b"\x80" + s.to_bytes(4, "little", signed=True) for s in steps])


def steps_of(table: bytes) -> np.ndarray:
    """The steps of a stored table."""
    steps = np.frombuffer(table, np.int8)
    if b"\x80" not in table:
        return steps
    parts, at = [], 0
    while (wide := table.find(b"\x80", at)) >= 0:
        parts += [steps[at:wide], np.frombuffer(table, "<i4", 1, wide + 1)]
        at = wide + 5
    return np.concatenate([*parts, steps[at:]])


@lru_cache(maxsize=4)
def piece_tables(path: str) -> PieceTables:
    return PieceTables(path)


def prefix_table(path: str, text: str) -> bytes:
    """The table of one text (``steps_of`` reads it)."""
    return piece_tables(path).table(text)


def counts_of(table: bytes) -> np.ndarray:
    """Token counts of all prefixes, the empty one first."""
    steps = steps_of(table)
    out = np.zeros(len(steps) + 1, np.int64)
    np.cumsum(steps, dtype=np.int64, out=out[1:])
    return out


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 tables: bool = True) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens and, if ``tables``, prefix_table (binary) of every text."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, n_bytes long, n_tokens long" + ", prefix_table binary" * tables

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            for lo in range(0, batch.num_rows, 256):
                part = texts.slice(lo, 256)
                found = [prefix_table(tokenizer_path, t) if t else b"" for t in part.to_pylist()]
                sizes = [0 if v is None else v for v in pc.binary_length(part).to_pylist()]
                cols = [batch.column(0).slice(lo, 256), pa.array(sizes, pa.int64()),
                        pa.array([int(steps_of(t).sum(dtype=np.int64)) for t in found], pa.int64())]
                if tables:
                    cols.append(pa.array(found, pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, ["id", "n_bytes", "n_tokens", "prefix_table"][:len(cols)])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def budget_cuts(counted: DataFrame, budget: int, id_col: str = "doc_id") -> DataFrame:
    """From stored tables: the longest prefix (code points) of at most ``budget`` tokens, and its
    tokens. A budget under 0 gives the empty prefix."""
    rows = counted.select(F.col(id_col).alias("id"), "prefix_table")
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            chars, tokens = [], []
            for table in batch.column(1).to_pylist():
                n = counts_of(table or b"")
                fits = np.flatnonzero(n <= budget)
                chars.append(int(fits[-1]) if len(fits) else 0)
                tokens.append(int(n[chars[-1]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chars, pa.int64()), pa.array(tokens, pa.int64())],
                                             ["id", "n_chars_kept", "n_tokens_kept"])

    return rows.mapInArrow(run, f"id {id_type}, n_chars_kept long, n_tokens_kept long").withColumnRenamed("id", id_col)
