"""Hashes of words and n-grams and a table of numbers by hash, inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from odotrack.llm.held import held

#: The seed of Spark's xxhash64.
SEED = 42
REMEMBERED = 1 << 18
_STEP = 0x9E3779B97F4A7C15


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value



def word_ids(text: str) -> np.ndarray:
    """``xxhash64`` of each word, as Spark computes it."""
    found = text.encode("utf-8", "surrogatepass").split()
    known = held("word ids", _Ids)
    return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))


def combine(*columns: np.ndarray) -> np.ndarray:
    """One hash of the n-grams whose words these columns hold."""
    out = np.full(len(columns[0]), len(columns), np.uint64)
    for column in columns:
        out = (out ^ (out >> np.uint64(31))) * np.uint64(_STEP) + column
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


class HashTable:
    """Numbers by 64-bit key: open addressing over arrays, for looking up many at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.rows = keys, values  # the places are laid out where they are first needed
        self.probes = -1

    def _build(self, keys: np.ndarray, values: np.ndarray) -> None:
        size = 1 << max(4, int(len(keys) * 2 - 1).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys, self.used = np.zeros(size, np.uint64), np.zeros(size, bool)
        self.values = np.zeros(size, values.dtype)
        self.probes, rest = 0, np.arange(len(keys))
        while len(rest):
            spots = (keys[rest] + np.uint64(self.probes)) & self.mask
            free = ~self.used[spots]
            _, first = np.unique(spots, return_index=True)  # one key a spot
            wins = np.zeros(len(rest), bool)
            wins[first] = True
            wins &= free
            put = rest[wins]
            self.keys[spots[wins]], self.values[spots[wins]] = keys[put], values[put]
            self.used[spots[wins]] = True
            rest = rest[~wins]
            self.probes += 1

    def get(self, keys: np.ndarray, default: float) -> np.ndarray:
        if self.probes < 0:
            self._build(*self.rows)
            self.rows = None
        out = np.full(len(keys), default)
        rest, places = keys, np.arange(len(keys))
        for probe in range(self.probes):
            spots = (rest + np.uint64(probe)) & self.mask
            used = self.used[spots]
            hit = used & (self.keys[spots] == rest)
            out[places[hit]] = self.values[spots[hit]]
            on = used & ~hit
            if not on.any():
                break
            rest, places = rest[on], places[on]
        return out
