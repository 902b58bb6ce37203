"""Word shingles of texts as 64-bit hashes, for whole Arrow batches at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

#: Words whose hash a Python worker remembers, and bytes of the longest of them (so some 60 MB at most); beyond
#: it the memory is emptied, not the result.
REMEMBERED_WORDS, REMEMBERED_BYTES = 500_000, 48
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """word -> 64-bit hash, computed on the first look-up."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = h
        return h


_HASHES = WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    """Hash of each word, A-Z in lower case; bytes.split() cuts at exactly U+0020 and U+0009-U+000D."""
    if not text:
        return np.empty(0, np.uint64)
    found = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; a shorter text is one shingle of all its words."""
    h = word_hashes(text)
    if not len(h):
        return h
    n = min(k, len(h))
    acc = np.full(len(h) - n + 1, n, np.uint64)
    for j in range(n):
        acc = acc * _MULT + h[j : len(h) - n + 1 + j]
    return np.unique(mix64(acc))


def grouped(sets: Iterator[np.ndarray], most: int) -> Iterator[list[np.ndarray]]:
    """Lists of consecutive sets of about ``most`` elements in all (one larger set alone)."""
    group, n = [], 0
    for x in sets:
        if group and n + len(x) > most:
            yield group
            group, n = [], 0
        group.append(x)
        n += len(x)
    if group:
        yield group
