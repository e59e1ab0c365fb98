"""Sets of word shingles as hashed numpy arrays, inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from odotrack.llm.held import held

WORDS = 5
#: Odd multipliers of a rolling hash; hashes are modulo 2 ** 64.
_STEP, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_POWERS = [np.uint64(pow(_STEP, k, 1 << 64)) for k in range(WORDS + 1)]
MAX_WORDS = 1 << 18


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value



def mix(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(_MIX)
    return values ^ (values >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    known = held("shingles", _WordHashes)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct runs of five words of a text in lower case (A to Z
    only), of all words as one run if they are fewer, none without words."""
    hashes = word_hashes((text or "").encode("utf-8", "surrogatepass").lower().split())
    n = len(hashes)
    if not n:
        return hashes
    length = min(n, WORDS)
    runs = np.full(n - length + 1, length, np.uint64)
    for k in range(length):
        runs = runs + hashes[k : n - length + 1 + k] * _POWERS[length - k]
    return np.unique(mix(runs))


def resemble(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * |a & b| >= percent * |a | b|, for sorted sets that are not empty."""
    small, large = sorted((len(a), len(b)))
    if not small or 100 * small < percent * large:
        return False
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)
