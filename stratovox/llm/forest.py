"""A union-find over integer positions, used inside one task to emit a spanning forest instead of all pairs."""

from __future__ import annotations

import numpy as np


class Forest:
    """Disjoint sets over hashable keys."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    def join(self, x, y) -> bool:
        """Unite the sets of x and y; false if they were one already."""
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        if y < x:
            x, y = y, x
        self.parent[y] = x
        self.parent.setdefault(x, x)
        return True

    def edges(self):
        """(node, root) for all nodes but the roots."""
        return [(x, self.find(x)) for x in self.parent if self.find(x) != x]


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int, same: bool, step: int = 256):
    """Index pairs of two uint64 tiles at no more than ``radius`` differing bits, in blocks of bounded memory."""
    for i in range(0, len(a), step):
        part = a[i : i + step, None]
        for j in range(i if same else 0, len(b), 2048):
            x, y = np.nonzero(np.bitwise_count(part ^ b[None, j : j + 2048]) <= radius)
            if len(x):
                x, y = x + i, y + j
                if same:
                    keep = x < y
                    x, y = x[keep], y[keep]
                yield x, y


def thinned(x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among nodes 0..n-1 with the same components as the pairs (x, y), at most one for each node."""
    if len(x) < 4 * n or len(x) < 2000:
        return x, y
    label = np.arange(n)
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label = label[label]
        if (label == before).all():
            break
    moved = np.nonzero(label != np.arange(n))[0]
    return moved, label[moved]
