"""Words, word hashes and shingles of many texts at once, in numpy.

A word is a longest run of bytes other than space and 0x09-0x0D. These bytes are
ASCII, so words can be cut from UTF-8 without decoding it. Hashes have 64 bits
and depend on nothing but the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_RADIX = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTE = np.random.Generator(np.random.PCG64(20240601)).integers(1, 2**63, 256, dtype=np.uint64)
_powers = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one-to-one)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers)), _RADIX, dtype=np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers


class Words:
    """The words of a list of texts.

    ``doc[i]`` is the text that word i is in, ``start`` and ``end`` are its bytes
    in ``data`` (lower-cased if asked for), ``bounds`` the bytes of the texts.
    ``between`` marks the bytes that separate words.
    """

    def __init__(self, texts: pa.Array, lower: bool, between: np.ndarray = SPACE):
        raw, bounds = text_bytes(texts)
        self.n_docs = len(texts)
        self.bounds = bounds
        self.data = LOWER[raw] if lower else raw
        solid = ~between[self.data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        inside = bounds[:-1][bounds[:-1] < bounds[1:]]
        first[inside] = solid[inside]
        last[inside[1:] - 1] = solid[inside[1:] - 1]
        self.solid = solid
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.doc = np.searchsorted(bounds, self.start, "right") - 1
        self.counts = np.bincount(self.doc, minlength=self.n_docs)

    def hashes(self) -> np.ndarray:
        lengths = self.end - self.start
        if not len(lengths):
            return np.zeros(0, dtype=np.uint64)
        at = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum(), dtype=np.int64) - np.repeat(at, lengths)
        values = _BYTE[self.data[self.solid]] * _powers_to(int(lengths.max()))[place]
        return mix(np.add.reduceat(values, at) + lengths.astype(np.uint64))

    def prefixes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The words longer than ``size`` bytes and hashes of their first ``size`` bytes."""
        longer = np.flatnonzero(self.end - self.start > size)
        total = np.full(len(longer), size, dtype=np.uint64)
        powers = _powers_to(size + 1)
        for k in range(size):
            total += _BYTE[self.data[self.start[longer] + k]] * powers[k]
        return longer, mix(~total)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and where each begins; a null is an empty text."""
    texts = texts.fill_null("") if texts.null_count else texts
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(texts: pa.Array, most: int = 2 << 20, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts, about ``most`` bytes and at most ``rows`` texts each.

    A text longer than ``most`` is alone. Bounds the memory of one step of work.
    """
    _, bounds = text_bytes(texts)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + most, "right")) - 1)
        end = min(end, begin + rows, len(texts))
        yield begin, end
        begin = end


def windows(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each window of ``width`` words within one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    # hashes are random numbers already: an odd factor for each place keeps their order
    total = hashes[:n].copy()
    for k in range(1, width):
        total *= _RADIX
        total += hashes[k : k + n]
    at = np.flatnonzero(doc[:n] == doc[width - 1 :])
    return mix(total[at]), at


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text: (text, hash), sorted by both.

    A text with fewer words than ``width`` has its whole sequence as one shingle,
    a text without words none.
    """
    hashes = words.hashes()
    found, at = windows(hashes, words.doc, width)
    doc = words.doc[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        first = np.searchsorted(words.doc, short)
        total = mix(np.full(len(short), 0x5851F42D4C957F2D, dtype=np.uint64) + words.counts[short].astype(np.uint64))
        for k in range(width - 1):
            more = words.counts[short] > k
            total[more] = mix(total[more] + hashes[first[more] + k])
        place = np.searchsorted(doc, short)
        found, doc = np.insert(found, place, total), np.insert(doc, place, short)
    return distinct_in_runs(doc, found)


def distinct_in_runs(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like ``distinct_in_group`` for groups that are runs in ascending order.

    Short runs are sorted one by one, which is much faster than one sort by both.
    """
    cuts = np.flatnonzero(group[1:] != group[:-1]) + 1
    value = value.copy()
    for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(value)], strict=True):
        value[begin:end].sort()
    return _first_of_equal(group, value)


def distinct_in_group(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((value, group))
    return _first_of_equal(group[order], value[order])


def _first_of_equal(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(group):
        new = np.ones(len(group), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (value[1:] != value[:-1])
        group, value = group[new], value[new]
    return group, value
