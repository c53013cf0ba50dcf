"""Burkhard-Keller trees over bit fingerprints, many at once, level by level in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Pairs of a query and a node that are compared at once, up to the children of one node; it bounds the memory of a search.
FRONTIER = 1 << 16


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances between the rows of two (n, words) arrays of unsigned 64-bit words."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


class BKForest:
    """One tree for each run of equal values in ``tree``; children are keyed by their distance to the parent.

    The first item of a tree is its root. All trees grow together: in each step every item that is not placed yet is
    compared with the node it has come to, and the first of those with the same distance becomes the child there.
    """

    def __init__(self, prints: np.ndarray, tree: np.ndarray):
        self.prints, self.reach = prints, prints.shape[1] * 64 + 1
        n = len(prints)
        first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if n else np.empty(0, dtype=np.int64)
        self.root = dict(zip(tree[first].tolist(), first.tolist(), strict=True))
        slots, nodes = [], []
        rest = np.setdiff1d(np.arange(n), first, assume_unique=True)
        at = np.repeat(first, np.diff(np.r_[first, n]) - 1)
        while len(rest):
            slot = at * self.reach + distance(prints[rest], prints[at])
            order = np.argsort(slot, kind="stable")
            slot, rest = slot[order], rest[order]
            opens = np.r_[True, slot[1:] != slot[:-1]]
            slots.append(slot[opens])
            nodes.append(rest[opens])
            at = rest[opens][np.cumsum(opens) - 1][~opens]
            rest = rest[~opens]
        slot = np.concatenate(slots) if slots else np.empty(0, dtype=np.int64)
        order = np.argsort(slot, kind="stable")
        self.slot = slot[order]
        self.node = np.concatenate(nodes)[order] if nodes else np.empty(0, dtype=np.int64)

    def search(self, prints: np.ndarray, tree: np.ndarray, radius: int, block: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, item) index pairs within ``radius``; only edges within the radius of the distance are followed.

        Edges to follow wait as ranges, in pieces of ``FRONTIER`` children, and the last piece is opened first.
        """
        start = np.fromiter((self.root.get(t, -1) for t in tree.tolist()), dtype=np.int64, count=len(tree))
        for low in range(0, len(prints), block):
            asked = np.arange(low, min(low + block, len(prints)))
            asked = asked[start[asked] >= 0]
            waiting = [(asked, start[asked])]
            while waiting:
                asked, at, *ends = waiting.pop()
                if ends:
                    left, count = at, ends[0]
                    asked = np.repeat(asked, count)
                    at = self.node[np.repeat(left - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())]
                far = distance(prints[asked], self.prints[at])
                hit = far <= radius
                yield asked[hit], at[hit]
                left = np.searchsorted(self.slot, at * self.reach + np.maximum(far - radius, 0), "left")
                right = np.searchsorted(self.slot, at * self.reach + np.minimum(far + radius, self.reach - 1), "right")
                count = right - left
                inner = np.flatnonzero(count)
                cut = np.flatnonzero(np.diff(np.cumsum(count[inner]) // FRONTIER)) + 1
                waiting += [(asked[piece], left[piece], count[piece]) for piece in np.split(inner, cut) if len(piece)]
