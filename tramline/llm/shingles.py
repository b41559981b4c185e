"""Word shingles as 64-bit hashes, for one text at a time inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
MOST = 200_000
#: Where ``str.split`` parts words; Java's \\s and trim know fewer.
WHITE_SPACE = "".join(c for c in map(chr, range(0x10000)) if c.isspace())
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hash of a word, remembered; emptied when it grows past ``MOST`` words
    (some 40 MB of a worker)."""

    def __missing__(self, word: str) -> int:
        if len(self) > MOST:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, words: WordHashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (ascending) and their counts. Words are split
    at white space and lower-cased; a text of fewer words than ``size`` has
    one shingle of them all, a text without words has none."""
    tokens = (text or "").lower().split()
    if not tokens:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    width = min(size, len(tokens))
    n = len(tokens) - width + 1
    total = np.full(n, width, np.uint64)
    for j in range(width):
        total += h[j:j + n] * _ODD[j]
    return np.unique(mix(total), return_counts=True)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of minimum counts over sum of maximum counts; 0 if both are empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    high = int(a[1].sum() + b[1].sum()) - low
    return low / high if high else 0.0
