"""Word handling shared by the operators.

A word is a maximal run of characters other than U+0020 and U+0009..U+000D. ``bytes.split``
splits on exactly these six characters, so words are taken from the UTF-8 form of a text.
"""

from __future__ import annotations

import numpy as np

MASK64 = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def numbered(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Distinct words in order of first use, and each word's index among them."""
    seen = dict.fromkeys(words)
    for i, w in enumerate(seen):
        seen[w] = i
    return list(seen), np.fromiter(map(seen.__getitem__, words), np.int64, len(words))


def texts_of(column):
    """The strings of an Arrow column one after the other, null as None, without holding
    them all as Python objects at once."""
    for start in range(0, len(column), 256):
        yield from column.slice(start, 256).to_pylist()
