"""A packed R-tree over count vectors, for similarity joins of sets.

A set's elements are hashed into groups; the counts of its groups are a point. Two sets
share at most the sum over the groups of the lesser count, so a node whose greatest counts
cannot reach the overlap that a query needs holds no partner of it.
"""

from __future__ import annotations

import numpy as np

LEAF, FANOUT = 16, 8
#: A group is named by the first bits of a hash: so many that it holds 4 to 8 elements of a
#: set, within these limits. The fewer elements in a group, the closer the bound.
LEAST_BITS, MOST_BITS, GROUP_ELEMENTS = 6, 16, 4
#: Bits of the vectors that are compared many against many.
TABLE_BITS = 12


def bits_of(size):
    """Bits that name the groups of sets of these sizes."""
    bits = np.floor(np.log2(np.maximum(size, 1) / GROUP_ELEMENTS))
    return np.clip(bits, LEAST_BITS, MOST_BITS).astype(np.int64)


def count_vector(elements: np.ndarray, bits: int | None = None) -> np.ndarray:
    """Group counts of sorted distinct 64-bit hashes."""
    bits = int(bits_of(len(elements))) if bits is None else bits
    return np.bincount((elements >> np.uint64(64 - bits)).astype(np.int64),
                       minlength=1 << bits).astype(np.uint32)


def packed(elements: np.ndarray) -> bytes:
    """A set's count vector in as many bytes a count as its largest count takes."""
    counts = count_vector(elements)
    return (counts.astype(np.uint8) if counts.max(initial=0) < 256 else counts).tobytes()


def folded(vectors: list[bytes], sizes: np.ndarray, bits: int) -> np.ndarray:
    """Packed vectors of sets of these sizes as a matrix of 2^bits groups, none of which may
    have fewer; neighbouring groups are added up."""
    out = np.empty((len(vectors), 1 << bits), np.int32)
    own = bits_of(np.asarray(sizes))
    wide = np.array([len(v) for v in vectors]) > (1 << own)
    for b in np.unique(own).tolist():
        for kind, flag in ((np.uint8, False), (np.uint32, True)):
            at = np.flatnonzero((own == b) & (wide == flag))
            if len(at):
                x = np.frombuffer(b"".join(vectors[i] for i in at.tolist()), kind)
                out[at] = x.reshape(len(at), 1 << bits, -1).sum(axis=2, dtype=np.int32)
    return out


def need(a, b, percent: int):
    """Least overlap of sets of sizes a and b whose similarity reaches ``percent``."""
    return -((-percent * (a + b)) // (100 + percent))


class PackedTree:
    """Points sorted by size and first counts are packed into leaves, these into nodes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points.astype(np.int64), sizes.astype(np.int64)
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        self.levels = []  # from leaves to root: greatest counts, least and greatest size
        top, low, high = self.points[self.order], self.sizes[self.order], self.sizes[self.order]
        width = LEAF
        while True:
            at = np.arange(0, len(low), width)
            top = np.maximum.reduceat(top, at, axis=0)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((top, low, high))
            if len(low) == 1:
                break
            width = FANOUT

    def partners(self, points: np.ndarray, sizes: np.ndarray, percent: int):
        """(query, point) index pairs whose overlap bound reaches what they need. The needed
        overlap grows with a partner's size, so a node asks for its least admissible size."""
        points, sizes = points.astype(np.int64), sizes.astype(np.int64)
        query, node = np.arange(len(sizes)), np.zeros(len(sizes), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[level]
            least = -((-percent * sizes[query]) // 100)
            fits = (high[node] >= least) & (percent * low[node] <= 100 * sizes[query])
            query, node, least = query[fits], node[fits], least[fits]
            wanted = need(sizes[query], np.maximum(low[node], least), percent)
            fits = self._bound(points, query, top, node) >= wanted
            query, node = query[fits], node[fits]
            below = len(self.levels[level - 1][1]) if level else len(self.sizes)
            width = FANOUT if level else LEAF
            query = np.repeat(query, width)
            node = (node[:, None] * width + np.arange(width)).ravel()
            inside = node < below
            query, node = query[inside], node[inside]
        found = self.order[node]
        wanted = need(sizes[query], self.sizes[found], percent)
        fits = self._bound(points, query, self.points, found) >= wanted
        return query[fits], found[fits]

    @staticmethod
    def _bound(points, query, top, node, step: int = 1 << 15) -> np.ndarray:
        out = np.empty(len(query), np.int64)
        for s in range(0, len(query), step):
            part = slice(s, s + step)
            out[part] = np.minimum(points[query[part]], top[node[part]]).sum(axis=1)
        return out
