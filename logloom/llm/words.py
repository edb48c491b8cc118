"""Word and shingle hashes of whole texts, many texts at once in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased.  Nothing is kept
between batches: a word's hash comes from its bytes, eight at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are hashed at once; a longer text goes through by itself.
SLICE_BYTES = 1 << 19
#: Longer words are hashed one by one.
LONG_WORD = 64
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_MIX1, _MIX2, _SHIFT = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _SHIFT)) * _MIX1
    x = (x ^ (x >> _SHIFT)) * _MIX2
    return x ^ (x >> _SHIFT)


def copy_of(data: bytes | pa.Buffer) -> int:
    """A hash that tells apart the texts of rows with one doc_id."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(data)).view(np.int64))


@dataclass(frozen=True)
class Words:
    """The words of some texts in order.

    ``data`` holds the texts' bytes, lower-cased, one after another; a word is
    ``data[start:end]`` of text number ``text``, and text t has the words
    ``bounds[t]`` to ``bounds[t + 1]``.
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sizes = ends - starts
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), shape=(len(padded) - 7,), strides=(1,))
    hashes = mix(sizes.astype(np.uint64) * _MULTIPLIERS[0] + (eight[starts] & _MASKS[np.minimum(sizes, 8)]) * _MULTIPLIERS[1])
    rows = np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD))
    for at in range(8, LONG_WORD, 8):
        rows = rows[sizes[rows] > at]
        if not len(rows):
            break
        part = eight[starts[rows] + at] & _MASKS[np.minimum(sizes[rows] - at, 8)]
        hashes[rows] = mix(hashes[rows] * _MULTIPLIERS[2] + part * _MULTIPLIERS[3])
    for i in np.flatnonzero(sizes > LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return hashes


def words_in(texts: pa.Array) -> Words:
    """The words of an Arrow column of strings or bytes; null counts as empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"") if len(texts) else pa.array([], pa.large_binary())
    _, offsets, values = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    low, n = int(offsets[0]), int(offsets[-1] - offsets[0])
    data = _LOWER[np.frombuffer(values, dtype=np.uint8)[low : low + n]] if n else np.empty(0, np.uint8)
    offsets = offsets - low
    inside = ~_SPACE[data]
    first, last = inside.copy(), np.concatenate([[False], inside])
    first[1:] &= ~inside[:-1]
    last[1:-1] &= ~inside[1:]
    # a text's end ends its last word
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts] = inside[cuts]
    last[cuts] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    bounds = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    return Words(data, starts, ends, text, bounds, word_hashes(data, starts, ends))


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Parts of a column with at most ``SLICE_BYTES`` of text (or one text), and where they start."""
    sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(sizes[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, side="right")))
        yield at, texts.slice(at, end - at)
        at = end


def shingles_in(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of ``k`` words of a text, and the bounds of each text's.

    A text of fewer words has one run, all of it; one without words has none.
    """
    counts = np.diff(words.bounds)
    bounds = np.concatenate([[0], np.cumsum(np.where(counts >= k, counts - k + 1, counts > 0))])
    out = np.empty(bounds[-1], dtype=np.uint64)
    n = len(words.hashes) - k + 1
    if n > 0:
        whole = words.text[:n] == words.text[k - 1 :]
        total = np.full(n, k, dtype=np.uint64)
        for i in range(k):
            total = mix(total * _MULTIPLIERS[0] + words.hashes[i : n + i] * _MULTIPLIERS[1])
        at = np.flatnonzero(whole)
        text = words.text[at]
        out[bounds[text] + at - words.bounds[text]] = total[at]
    for size in range(1, k):
        short = np.flatnonzero(counts == size)
        total = np.full(len(short), size, dtype=np.uint64)
        for i in range(size):
            total = mix(total * _MULTIPLIERS[0] + words.hashes[words.bounds[short] + i] * _MULTIPLIERS[1])
        out[bounds[short]] = total
    return out, bounds


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and their bounds."""
    values, bounds = shingles_in(words, k)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a > 1:
            values[a:b].sort()
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[new], np.concatenate([[0], np.cumsum(np.bincount(text[new], minlength=len(bounds) - 1))])


def sets_of(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    for _, part in slices(pa.array(texts, pa.large_binary())):
        values, bounds = shingle_sets(words_in(part), k)
        out += [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    return sets_of([(text or "").encode("utf-8", "surrogatepass")], k)[0]


class MinHasher:
    """``count`` minima of sets under mixed multiplicative hash functions."""

    def __init__(self, count: int, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.scale = draw.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shift = draw.integers(0, 2**63, count, dtype=np.uint64)

    def minima(self, values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """The minima of each part of ``values``, a row a part; parts start at ``firsts``."""
        best = np.empty((len(firsts), len(self.scale)), dtype=np.uint64)
        if len(firsts):
            for j, (scale, shift) in enumerate(zip(self.scale, self.shift)):
                x = values * scale
                x += shift
                x ^= x >> np.uint64(29)
                best[:, j] = np.minimum.reduceat(x, firsts)
        return best


def signatures(hasher: MinHasher, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The minima of each text's values; the greatest number for a text without any."""
    out = np.full((len(bounds) - 1, len(hasher.scale)), np.iinfo(np.uint64).max, dtype=np.uint64)
    some = np.flatnonzero(np.diff(bounds) > 0)
    out[some] = hasher.minima(values, bounds[some])
    return out


class PassageHashes:
    """A hash of any run of words from prefix sums: sum of word * base^place, modulo 2^64."""

    def __init__(self, hashes: np.ndarray, seed: int = 0):
        base = (0x9E3779B97F4A7C15 + 0x632BE59BD9B4E01A * seed) % 2**64 | 1
        n = len(hashes)
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, dtype=np.uint64)]), dtype=np.uint64)
        self.inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, pow(base, -1, 2**64), dtype=np.uint64)]), dtype=np.uint64)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers[:n], dtype=np.uint64)])

    def of(self, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
        total = (self.sums[starts + sizes] - self.sums[starts]) * self.inverse[starts]
        return mix(total + np.asarray(sizes, dtype=np.uint64) * _MULTIPLIERS[4])


def common_count(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())
