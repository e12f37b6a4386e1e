"""Words of text batches as 64-bit hashes in one numpy array."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from xxhash import xxh64_intdigest

from hirelens.llm.common import as_binary

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def split_words(column: pa.Array, lower: bool = False) -> list[list[bytes]]:
    """Words of each row: runs without the six ASCII white-space characters; null has none. ``lower`` maps A-Z only."""
    rows = as_binary(column).to_pylist()
    return [row.lower().split() for row in rows] if lower else [row.split() for row in rows]


def word_hashes(rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words behind each other, and where each row begins (one entry more than rows)."""
    offsets = np.cumsum([0, *map(len, rows)])
    return np.fromiter(map(xxh64_intdigest, chain.from_iterable(rows)), np.uint64, int(offsets[-1])), offsets


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the run of ``length`` words that begins at each word (runs cross row borders; callers leave those out)."""
    count = max(len(words) - length + 1, 0)
    code = np.full(count, length, dtype=np.uint64)
    for k in range(length):
        code = mix(code * MULTIPLIER + words[k:k + count])
    return code
