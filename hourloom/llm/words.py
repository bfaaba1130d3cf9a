"""Words, hashes and shingles inside a task."""

from __future__ import annotations

import numpy as np
import xxhash

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Words a task remembers the hash of, in each of two generations.
REMEMBERED = 150_000


class WordHashes(dict):
    """Word to 64-bit hash, kept for words that come again in this generation or the next."""

    older: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        found = self.older.get(word)
        if found is None:
            found = xxhash.xxh64_intdigest(word)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


def split_words(text: bytes | None, lower: bool = False) -> list[bytes]:
    """Runs of characters other than space and \\t to \\r, of a text in UTF-8.

    These are ASCII, so the bytes can be split, and A-Z be lower-cased in them.
    """
    if not text:
        return []
    return (text.translate(LOWER) if lower else text).split()


def hashed(words: list[bytes], memory: WordHashes) -> np.ndarray:
    return np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every ``n`` consecutive word hashes, in order; none if there are fewer."""
    count = len(hashes) - n + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    mixed = np.full(count, n, np.uint64)
    for i in range(n):
        mixed = (mixed ^ hashes[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def winnowed(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions of the minimum of every ``width`` consecutive hashes, the rightmost of equal
    ones; of fewer hashes, of all. Ascending, each once."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    # The position, counted from the right, breaks ties in the low bits.
    low = np.uint64(0xFFFFFFFF)
    keyed = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    least = sliding_min(keyed, min(width, len(hashes)))
    at = (low - (least & low)).astype(np.int64)
    return at[np.concatenate([[True], at[1:] != at[:-1]])]
