"""Words and word shingles of raw UTF-8 texts as 64-bit hashes, computed with numpy over whole batches.

Words are maximal runs of bytes other than space and \\x09-\\x0D, with A-Z lower-cased.
White space and A-Z are single bytes in UTF-8, so the texts never need decoding: pass
them to Python as binary.  A word's hash is a polynomial in its bytes modulo 2**64 (one
prefix sum for a whole batch of texts), finished by a 64-bit mixer; a shingle's hash mixes
its words' hashes in order.  The same text always gives the same numbers, in any process.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5  # words in a shingle, unless a caller says otherwise
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (multiply and xor-shift rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base & MASK, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, in order, and each text's word count.

    Null and empty texts have no words.
    """
    joined = b" ".join([t or b"" for t in texts]) + b" "
    raw = np.frombuffer(joined.lower(), dtype=np.uint8)
    lengths = np.fromiter((len(t or b"") + 1 for t in texts), dtype=np.int64, count=len(texts))
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate([[True], gap]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(MULTIPLIER, len(raw)), dtype=np.uint64)])
    back = powers(pow(MULTIPLIER, -1, 1 << 64), len(raw) + 1)  # moves each word to position 0
    words = mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    counts = np.diff(np.concatenate([[0], np.searchsorted(starts, np.cumsum(lengths))]))
    return words, counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word shingles of all texts, in order, and each text's number of them.

    A text with 1 to width-1 words has one shingle, its whole word sequence; one without words has none.
    """
    n = len(words)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    n_shingles = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    rolled = np.full(n, np.uint64(width), dtype=np.uint64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    for k in range(width):
        rolled = mix(rolled * np.uint64(MULTIPLIER) + padded[k:k + n])
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        rolled[first[i]] = short_hash(words[first[i]:first[i] + counts[i]])
    keep = np.arange(n) - np.repeat(first, counts) < np.repeat(n_shingles, counts)
    return rolled[keep], n_shingles


def short_hash(words: np.ndarray) -> np.uint64:
    """Hash of a whole word sequence shorter than a shingle (its length is part of it)."""
    h = np.array([len(words)], dtype=np.uint64)
    for w in words:
        h = mix(h * np.uint64(MULTIPLIER) + w)
    return h[0]


def shingle_sets(texts: list[bytes | None], width: int = WIDTH) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    words, counts = word_hashes(texts)
    hashes, n = shingle_hashes(words, counts, width)
    cuts = np.cumsum(n)[:-1]
    return [np.unique(x) for x in np.split(hashes, cuts)]
