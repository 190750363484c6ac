"""Words of whole texts as 64-bit hashes, in NumPy, a block of texts at a time.

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D`` (in UTF-8, the
same as ``[^\\x20\\x09-\\x0D]+`` on code points), with ``A-Z`` lower-cased.
Two words get the same hash only by a 64-bit collision.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240611)
BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
SPAN = 1 << 14
POWER = np.cumprod(np.full(SPAN, 0x9E3779B97F4A7C15 | 3, dtype=np.uint64), dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
del _rng


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def hash_words(texts: list[bytes], lower: bool = True, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, in order, and for each text the index
    of its first word, followed by the number of words (``len(texts) + 1``
    bounds). Empty texts have no word. With ``prefixes``, hashes are rows of
    the word's and then its first so many bytes' (0 for a shorter word)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    b = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    begin = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(sizes + 1, out=begin[1:])  # one space between texts
    if lower:
        b = LOWER[b]
    at = np.flatnonzero(~SPACE[b])
    if not len(at):
        none = np.empty((0, 1 + len(prefixes)), np.uint64)
        return none if prefixes else none.ravel(), np.zeros(len(texts) + 1, np.int64)
    first = np.empty(len(at), dtype=bool)
    first[0] = True
    np.not_equal(at[1:], at[:-1] + 1, out=first[1:])
    start = np.flatnonzero(first)
    length = np.diff(np.append(start, len(at)))
    place = np.arange(len(at)) - np.repeat(start, length)
    value = BYTE[b[at]] * POWER[place % SPAN]
    h = mix(np.add.reduceat(value, start) + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    if prefixes:
        h = np.column_stack([h, *(np.where(length > k, mix(np.add.reduceat(np.where(place < k, value, np.uint64(0)), start) + np.uint64(k)), np.uint64(0)) for k in prefixes)])
    return h, np.searchsorted(at[start], begin)


def in_chunks(texts: list[bytes], most: int = 1 << 20):
    """(first, last) ranges of texts of about ``most`` bytes (a longer text is
    a range of its own), to keep the arrays of ``hash_words`` small."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= most):
            size += len(texts[j])
            j += 1
        yield i, j
        i = j
