"""Word shingles of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at a time; a longer text is hashed alone.
PIECE = 1 << 20

#: A word is hashed as a polynomial modulo each of these primes at a random place. (Modulo a power of two, some pairs of long words would have
#: the same hash at every place.)
_PRIMES = (2147483647, 2147483629)
#: From so many bytes on, terms are reduced before they are added.
_LONG = 1 << 22

_rng = np.random.default_rng(20240611)
_BASES = tuple(int(_rng.integers(1 << 24, p - 1)) for p in _PRIMES)
_BYTE = np.arange(1, 257, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_LOWER = _BYTE.astype(np.uint16)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[tuple[int, bool], np.ndarray] = {}


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finalizer."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(k: int, n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of a base, or of its inverse, modulo its prime."""
    prime = _PRIMES[k]
    base = pow(_BASES[k], -1, prime) if inverse else _BASES[k]
    found = _powers.get((k, inverse), np.ones(1, dtype=np.uint64))
    while len(found) < n:
        found = np.concatenate([found, found * np.uint64(pow(base, len(found), prime)) % np.uint64(prime)])
    _powers[k, inverse] = found if len(found) <= _LONG else found[:1]  # those of a very long text are not kept
    return found[:n]


@dataclass
class Sets:
    """Sorted distinct shingle hashes of texts first .. first + len(sizes) - 1, one after the other."""

    first: int
    sizes: np.ndarray
    hashes: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, the number of words of each text, and where words begin and end; offsets are relative to data."""
    n = len(data)
    solid = ~_WHITE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:n]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    words = (ends - starts).astype(np.uint64)
    total = np.zeros(n + 1, dtype=np.uint64)
    for k, prime in enumerate(np.array(_PRIMES, dtype=np.uint64)):
        terms = _BYTE[data] * _power(k, n)
        np.cumsum(terms % prime if n > _LONG else terms, out=total[1:])
        part = (total[ends] - total[starts]) % prime * _power(k, n, True)[starts] % prime
        words = mixed(words + (part << np.uint64(32)) + part, k)
    return words, np.diff(np.searchsorted(starts, offsets)), starts, ends


def words_collide(texts: pa.Array) -> bool:
    """Whether two different words of a string array have the same hash: all words that share one are compared byte by byte."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return False
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    words, _, starts, ends = _word_hashes(data, offsets - offsets[0])
    order = np.argsort(words, kind="stable")
    same = np.flatnonzero(words[order][1:] == words[order][:-1])
    one, other = order[same], order[same + 1]
    size = (ends - starts)[one]
    if (size != (ends - starts)[other]).any():
        return True
    low = _LOWER[data]
    for lo, hi in _cut(size):
        inside = np.arange(int(size[lo:hi].sum())) - np.repeat(np.cumsum(size[lo:hi]) - size[lo:hi], size[lo:hi])
        if (low[np.repeat(starts[one[lo:hi]], size[lo:hi]) + inside] != low[np.repeat(starts[other[lo:hi]], size[lo:hi]) + inside]).any():
            return True
    return False


def _cut(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of words with about PIECE bytes."""
    upto, lo = np.cumsum(size), 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PIECE, side="right")))
        yield lo, hi
        lo = hi


def shingle_sets(texts: pa.Array, width: int = 5) -> Iterator[Sets]:
    """The shingle sets of a string array, a bounded piece of it at a time. A null has the empty set."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    every = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, side="right")) - 1)
        own = offsets[first:last + 1]
        yield _sets(first, every[own[0]:own[-1]], own - own[0], width)
        first = last


def _sets(first: int, data: np.ndarray, offsets: np.ndarray, width: int) -> Sets:
    texts = len(offsets) - 1
    if not len(data):
        return Sets(first, np.zeros(texts, np.int64), np.zeros(0, np.uint64))
    words, counts, _, _ = _word_hashes(data, offsets)
    begins = np.concatenate([[0], np.cumsum(counts)])
    made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    into = np.concatenate([[0], np.cumsum(made)])
    hashes = np.zeros(int(into[-1]), dtype=np.uint64)
    if len(words) >= width:
        rolled = sum(words[k:len(words) - width + 1 + k] * _PLACE[k] for k in range(width))
        long = np.flatnonzero(counts >= width)
        take = np.repeat(begins[long] - into[long], made[long]) + np.concatenate(
            [np.arange(into[t], into[t + 1]) for t in long] or [np.zeros(0, np.int64)])
        hashes[take - np.repeat(begins[long] - into[long], made[long])] = rolled[take]
    for t in np.flatnonzero((counts > 0) & (counts < width)):
        own = words[begins[t]:begins[t + 1]]
        hashes[into[t]] = (own * _PLACE[:len(own)]).sum() + np.uint64(len(own) * 0x51ED270B7A3F + 7)
    hashes = mixed(hashes)
    for t in range(texts):
        if made[t] > 1:
            hashes[into[t]:into[t + 1]].sort()
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[into[:-1][made > 0]] = True
    sizes = np.add.reduceat(np.append(new, False).astype(np.int64), np.minimum(into[:-1], len(new))) if texts else made
    sizes[made == 0] = 0
    return Sets(first, sizes, hashes[new])
