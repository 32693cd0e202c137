"""Array helpers for tasks that read Arrow batches of whole texts as bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

# Texts are worked on in groups of about so many bytes (a longer text is a group of its own).
SLICE_BYTES = 1 << 20

_U64 = np.uint64


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of groups of consecutive binary values; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32, n + 1, column.offset * (8 if wide else 4))
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    offsets = offsets.astype(np.int64)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        hi = min(hi, n)
        yield lo, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix finaliser)."""
    h = h ^ (h >> _U64(30))
    h = h * _U64(0xBF58476D1CE4E5B9)
    h ^= h >> _U64(27)
    h *= _U64(0x94D049BB133111EB)
    h ^= h >> _U64(31)
    return h


BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)


class Powers:
    """Powers of the hash base and of its inverse modulo 2^64, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, _U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", BASE), ("down", _INVERSE)):
                p = np.full(size, base, _U64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up, self.down


POWERS = Powers()
# One random value a byte, so that texts of few bytes hash well.
BYTE_VALUES = mix(np.arange(1, 257, dtype=_U64) * _U64(0x9E3779B97F4A7C15))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Rabin-Karp prefix sums S, S[i] = sum of values[j] * B^j for j < i (modulo 2^64)."""
    up, _ = POWERS.upto(len(values) + 1)
    out = np.zeros(len(values) + 1, _U64)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def spans_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of each span [start, end), from its prefix sums, scrambled with its length."""
    _, down = POWERS.upto(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U64))


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    if not len(inside):
        z = np.zeros(0, np.int64)
        return z, z
    turn = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.concatenate([[0], turn, [len(inside)]])
    first = 0 if inside[0] else 1
    return edges[:-1][first::2], edges[1:][first::2]


# Bytes that separate words in the white-space rule: 0x09-0x0D and 0x20.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE):
    """(starts, ends, first word of each text and the end) of the words of consecutive texts; a text's
    edges end words."""
    inside = ~separators[data]
    # a word that runs over the edge of a text is cut there
    starts, ends = runs(inside)
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    if len(inner):
        cut = np.unique(inner[inside[inner] & inside[inner - 1]])
        if len(cut):
            starts = np.sort(np.concatenate([starts, cut]))
            ends = np.sort(np.concatenate([ends, cut]))
    return starts, ends, np.searchsorted(starts, offsets)


def spread(lengths: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """begins[i], begins[i] + 1, ... (lengths[i] of them) for each i, one after the other."""
    total = np.cumsum(lengths)
    return np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - lengths - begins, lengths)


def numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each stretch of bytes, and the different stretches by number (equal bytes only)."""
    size = ends - starts
    edges = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(data[spread(size, starts)])])
    coded = column.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


# Kinds of bytes for tokens that tell words from signs: 0 white space, 1 letters, digits and all of
# non-ASCII, 2 the rest.
KINDS = np.full(256, 2, np.int8)
KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
KINDS[SPACE] = 0


def tokens(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, first token of each text and the end): runs of words or of signs."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    kind = KINDS[data]
    turn = np.zeros(len(data), bool)
    turn[1:] = kind[1:] != kind[:-1]
    turn[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(turn)
    ends = np.append(starts[1:], len(data))
    some = kind[starts] > 0
    starts, ends = starts[some], ends[some]
    return starts, ends, np.searchsorted(starts, offsets)


# Byte values with A-Z and a-z taken as equal.
LOWER_VALUES = np.arange(256, dtype=np.uint8)
LOWER_VALUES[65:91] += 32


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """XXH3 hash of each word, its bytes taken through ``values`` if given. (A polynomial modulo 2^64 would give
    equal hashes to long words made of two letters in the Thue-Morse order and its complement.)"""
    out = np.empty(len(starts), _U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + 4 * SLICE_BYTES, "right")))
        part, base = data[starts[i]:ends[j - 1]], starts[i]
        codes, different = numbered(part if values is None else values[part], starts[i:j] - base, ends[i:j] - base)
        out[i:j] = np.fromiter(map(xxhash.xxh3_64_intdigest, different.to_pylist()), _U64, len(different))[codes]
        i = j
    return out


def window_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive keys."""
    step, out = 1, keys
    while 2 * step <= width:
        out = np.minimum(out[:len(out) - step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out
