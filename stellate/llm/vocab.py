"""Tokenizer files turned into lookups that a task fills as it meets words.

A BPE tokenizer never merges across its pre-token pieces, so a text's ids are the ids of its parts (see
``part_starts``) one after the other, and a batch of texts needs a lookup per different part. Parts of ASCII and
Latin-1 letters are cut into pieces by one compiled pattern; any other part (other scripts, combining marks,
control characters, special strings) is left to the tokenizer library.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from stellate.llm.kernels import SPACE, spread

# Entries of a lookup (see ``Lookup``).
CACHE_PIECES = 1 << 18
# Longer pieces are not kept.
CACHE_LENGTH = 64

_L = "A-Za-zÀ-ÖØ-öø-ÿ"
_S = "\t\n\x0b\x0c\r "
_P = r"!-/:-@\[-`{-~"
# The pre-token patterns of the two vocabularies, fixed values, over the usual characters; the last
# alternative of each meets the other characters.
_BYTE_BPE = re.compile(rf" ?[{_L}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[{_P}]+|[{_S}]+(?![^{_S}])|[{_S}]+|[^{_S}]")
_WORD_BPE = re.compile(rf"[{_L}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[{_P}]+|[{_S}]+|[^{_S}]")
_USUAL = re.compile(rf"[{_S} -~{_L}]*")

class Unusual(Exception):
    """A text that only the library can cut."""


def usual(piece: str) -> bool:
    """Whether the compiled patterns cut this as the library does."""
    return "<|" not in piece and _USUAL.fullmatch(piece) is not None


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte value."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in kept}
    spare = iter(range(0x100, 0x200))
    return [letters.get(b) or chr(next(spare)) for b in range(256)]


class Lookup(dict):
    """key -> value of ``make(key)`` for up to twice ``most`` short keys: when full, the lookup starts afresh
    and takes back the keys of the last one that are asked for again, so frequent keys stay."""

    def __init__(self, make, most: int = CACHE_PIECES):
        super().__init__()
        self.make, self.most, self.last = make, most, {}

    def __missing__(self, key):
        value = self.last.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > CACHE_LENGTH:
                return value
        if len(self) >= self.most:
            self.last = dict(self)
            self.clear()
        self[key] = value
        return value


@lru_cache(maxsize=8)
def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, loaded once per process, without truncation or padding."""
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class PieceIds:
    """Ids of texts (byte-level vocabulary)."""

    def __init__(self, path: str):
        self.tok = tokenizer(path)
        self.letters = byte_letters()
        self.pieces = Lookup(self.piece)
        self.parts = Lookup(self.part)

    def piece(self, piece: str) -> bytes:
        if not usual(piece):
            raise Unusual
        found = self.tok.model.tokenize("".join([self.letters[b] for b in piece.encode()]))
        return b"".join([t.id.to_bytes(4, "little") for t in found])

    def part(self, part: bytes) -> bytes:
        """Ids of a part of a text as little-endian unsigned 32-bit bytes."""
        text = part.decode()
        try:
            return b"".join(map(self.pieces.__getitem__, _BYTE_BPE.findall(text)))
        except Unusual:
            return encoded(self.tok, text)

    def ids(self, text: str) -> bytes:
        """Ids of one text as little-endian unsigned 32-bit bytes."""
        data = np.frombuffer(text.encode(), np.uint8)
        return self.batch(data, np.array([0, len(data)]))[0].tobytes()

    def batch(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of consecutive texts one after the other, and each text's first id and the end. Different
        parts are looked up once."""
        starts, first = part_starts(data, offsets, True)
        codes, keys = dictionary(data, starts)
        found = [self.parts[k] for k in keys]
        size = np.array([len(x) for x in found], np.int64) >> 2
        pool = np.frombuffer(b"".join(found), "<u4")
        lengths = size[codes]
        ids = pool[spread(lengths, (np.cumsum(size) - size)[codes])]
        return ids, np.concatenate([[0], np.cumsum(lengths)])[first]


def encoded(tok: Tokenizer, text: str) -> bytes:
    ids = tok.encode(text, add_special_tokens=False).ids
    return b"".join([i.to_bytes(4, "little") for i in ids])


@lru_cache(maxsize=8)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


def word_pieces(part: str) -> list[str]:
    """All of a lower-cased usual text in order: pieces and the white space between them."""
    return _WORD_BPE.findall(part)


# Last bytes of the white space beyond ASCII, fixed values: (byte two before, byte before, last bytes).
_WIDE_SPACE = ((None, 0xC2, (0x85, 0xA0)), (0xE1, 0x9A, (0x80,)), (0xE2, 0x80, (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)),
               (0xE2, 0x81, (0x9F,)), (0xE3, 0x80, (0x80,)))


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
# Signs that end a word and stand in no special string.
_ENDING = np.zeros(256, bool)
_ENDING[list(b",.;:!?)")] = True


def part_starts(data: np.ndarray, offsets: np.ndarray, byte_bpe: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the parts of consecutive texts, and the first part of each text and the end.

    A part begins with its text or with a space after a printing character. No piece of the three
    vocabularies runs over such a place, so a text's ids are its parts' ids one after the other. With
    ``byte_bpe`` a part also begins with any white space after a printing character, and with a sign
    after a letter, over which no piece of the byte-level pattern runs.
    """
    at = np.flatnonzero(SPACE[data]) if byte_bpe else np.flatnonzero(data == 0x20)
    at = at[at > 0]
    last = data[at - 1]
    solid = (last > 0x20) & (last != 0x7F)
    high = np.flatnonzero(last >= 0x80)
    if len(high):
        place = at[high]
        two, three = data[np.maximum(place - 2, 0)], data[np.maximum(place - 3, 0)]
        for first, second, lasts in _WIDE_SPACE:
            wide = (two == second) & np.isin(last[high], lasts)
            if first is not None:
                wide &= three == first
            solid[high[wide]] = False
    begins = np.zeros(len(data), bool)
    begins[at[solid]] = True
    if byte_bpe:
        begins[1:] |= _LETTER[data[:-1]] & _ENDING[data[1:]]
    begins[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, offsets)


def dictionary(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The parts as numbers, and the different parts by number (equal bytes only)."""
    if not len(starts):
        return np.zeros(0, np.int64), []
    ends = np.append(starts, len(data)).astype(np.int64)
    column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    coded = column.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
