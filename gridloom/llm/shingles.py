"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np

#: Words whose hash a task keeps, in each of two generations.
KEPT_WORDS = 150_000
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of a text's shingles: ASCII letters in lower case, words cut at ASCII white space."""

    def __init__(self, words: int):
        self.words = words
        self.kept: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def word_hashes(self, text: str) -> np.ndarray:
        import xxhash

        words = text.encode("utf-8", "replace").lower().split()
        found = list(map(self.kept.get, words))
        if None in found:
            if len(self.kept) > KEPT_WORDS:
                self.old, self.kept = self.kept, {}
            for i, h in enumerate(found):
                if h is None:
                    w = words[i]
                    h = self.kept.get(w) or self.old.get(w) or xxhash.xxh3_64_intdigest(w)
                    self.kept[w] = found[i] = h
        return np.array(found, np.uint64)

    def shingles(self, text: str) -> np.ndarray:
        """Hashes of all shingles in order; a text with fewer words is one shingle, one without words none."""
        h = self.word_hashes(text)
        if not len(h):
            return h
        n = min(self.words, len(h))
        rolled = np.zeros(len(h) - n + 1, np.uint64)
        for i in range(n):
            rolled = (rolled + h[i : len(h) - n + 1 + i]) * M1
            rolled ^= rolled >> np.uint64(29)
        return mixed(rolled)
