"""Words of whole texts as arrays of stable 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Words whose hash is remembered in each task before the memory is emptied.
REMEMBERED = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches cut to fewer rows, so that what Python makes of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class WordHashes(dict):
    """Hashes of the words of texts; words stand between ASCII white space, as ``bytes.split`` has them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers, after splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, in order; of shorter texts none."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            h = h * _ODD + words[i : i + count]
        return mix(h + np.uint64(n))


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Hashes of the shingles of a text; a text of fewer than ``n`` words is one shingle, one without words has none."""
    return ngrams(words, n if len(words) >= n else max(1, len(words)))
