"""A forest of BK-trees over 64-bit fingerprints, held in numpy arrays.

A child hangs on its parent by an edge labelled with their Hamming distance. A search of radius r compares the query
with a node at distance d and follows only the edges labelled d - r to d + r; the triangle inequality rules out the
rest. Many trees are built and searched side by side, one level at a time.
"""

from __future__ import annotations

import numpy as np

#: (query, node) pairs that are compared at a time.
FRONTIER = 1 << 20


class Forest:
    """One tree per distinct value of ``tree``; the points are distinct within a tree."""

    def __init__(self, tree: np.ndarray, points: np.ndarray):
        """``tree``: tree of each point, ascending."""
        self.points = points.astype(np.uint64)
        n = len(points)
        self.roots = np.flatnonzero(np.concatenate(([True], tree[1:] != tree[:-1]))) if n else np.zeros(0, np.int64)
        self.labels = tree[self.roots] if n else tree
        parents, edges, children = [], [], []
        at = np.repeat(self.roots, np.diff(np.append(self.roots, n))) if n else np.zeros(0, np.int64)
        rest = np.setdiff1d(np.arange(n), self.roots, assume_unique=True)
        at = at[rest]
        while len(rest):
            edge = np.bitwise_count(self.points[rest] ^ self.points[at]).astype(np.int64)
            order = np.lexsort((rest, edge, at))
            rest, at, edge = rest[order], at[order], edge[order]
            first = np.concatenate(([True], (at[1:] != at[:-1]) | (edge[1:] != edge[:-1])))
            child = rest[first]
            parents.append(at[first])
            edges.append(edge[first])
            children.append(child)
            at = np.repeat(child, np.diff(np.append(np.flatnonzero(first), len(rest))))[~first]
            rest = rest[~first]
        # Edges in order of (parent, label): the wanted labels of a node are one slice.
        parent = np.concatenate(parents) if parents else np.zeros(0, np.int64)
        label = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        order = np.lexsort((label, parent))
        self.children = (np.concatenate(children) if children else np.zeros(0, np.int64))[order]
        self.keys = parent[order] * 65 + label[order]

    def near(self, tree: np.ndarray, queries: np.ndarray, radius: int):
        """Yields (index of the query, index of the point) for all points within the radius in the query's tree."""
        where = np.searchsorted(self.labels, tree)
        known = where < len(self.labels)
        known[known] = self.labels[where[known]] == tree[known]
        todo = [(np.flatnonzero(known), self.roots[where[known]])]
        queries = queries.astype(np.uint64)
        while todo:
            q, node = todo.pop()
            if len(q) > FRONTIER:
                todo += [(q[FRONTIER:], node[FRONTIER:])]
                q, node = q[:FRONTIER], node[:FRONTIER]
            distance = np.bitwise_count(queries[q] ^ self.points[node]).astype(np.int64)
            hit = distance <= radius
            if hit.any():
                yield q[hit], node[hit]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(distance - radius, 1))
            high = np.searchsorted(self.keys, node * 65 + np.minimum(distance + radius, 64), side="right")
            width = np.maximum(high - low, 0)
            total = int(width.sum())
            if total:
                offsets = np.arange(total) - np.repeat(np.cumsum(width) - width, width)
                todo.append((np.repeat(q, width), self.children[np.repeat(low, width) + offsets]))
