"""Word shingles as 64-bit hashes.

Words are maximal runs of bytes outside space, tab to carriage return; A-Z is lower-cased, nothing else.
A word's hash is XXH3; five of them in a row are mixed into the shingle's hash."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_M = np.uint64(0x9E3779B97F4A7C15)
_N = np.uint64(0xD6E8FEB86659FD93)
_S = np.uint64(32)


class WordHashes(dict):
    """Word to hash, remembered; emptied when it holds most entries."""

    most = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _N
    x = (x ^ (x >> _S)) * _N
    return x ^ (x >> _S)


def hashed(ws: list[bytes], seen: WordHashes) -> np.ndarray:
    return np.fromiter(map(seen.__getitem__, ws), np.uint64, len(ws))


def windows(h: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hash of each window of so many words, in order; of fewer words, one for all of them."""
    n = len(h)
    if n == 0:
        return h
    if n < width:
        out = np.array([n], np.uint64)
        for k in range(n):
            out = (out ^ (out >> _S)) * _M + h[k : k + 1]
        return mixed(out)
    out = h[: n - width + 1].copy()
    for k in range(1, width):
        out = (out ^ (out >> _S)) * _M + h[k : n - width + 1 + k]
    return mixed(out)


def shingle_set(text: str | None, seen: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Distinct shingle hashes, sorted."""
    return np.unique(windows(hashed(words(text), seen), width))
