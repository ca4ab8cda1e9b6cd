"""Words and word shingles as 64-bit hashes, for use inside tasks.

Words are the runs of ``[^\\x20\\x09-\\x0D]`` of a text (what ``bytes.split()`` gives); a bounded
per-worker cache maps a word to its hash. It is emptied when full, which changes no result.
"""

from __future__ import annotations

import numpy as np
import xxhash

CACHE_WORDS = 100_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASH = _WordHash()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASH.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words; of the whole sequence where it is shorter."""
    n = min(n, len(words))
    if n == 0:
        return words
    out = mix64(words[: len(words) - n + 1])
    for k in range(1, n):
        out = mix64(out * _STEP + words[k : len(words) - n + 1 + k])
    return out


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes (63 bits) of a text, A-Z lower-cased."""
    return np.unique(ngram_hashes(word_hashes(text.lower().split()), n) >> np.uint64(1)).view(np.int64)
