"""BK-trees over 64-bit fingerprints, as arrays: many small trees are built and searched at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

_EDGES = 65  # distances 0 to 64 below one parent


class Forest:
    """One BK-tree per group. A child hangs below its parent under their Hamming distance.

    ``group`` and ``fingerprint`` are arrays of equal length; equal fingerprints of a group share a
    node. Edges are kept sorted by (parent, distance), so the children of a node whose distance lies
    in an interval are one slice.
    """

    def __init__(self, group: np.ndarray, fingerprint: np.ndarray):
        order = np.lexsort((fingerprint, group))
        g, f = group[order], fingerprint[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (f[1:] != f[:-1])
        self._rows, self._first = order, np.append(np.flatnonzero(new), len(g))
        g, f = g[new], f[new]
        self.groups, label = np.unique(g, return_inverse=True)
        # Sorted fingerprints would make lopsided trees; a multiplicative hash mixes them.
        rest = np.lexsort((f * np.uint64(0x9E3779B97F4A7C15), label))
        label = label[rest]
        point, keys, children, base = [], [], [], 0
        parents = None
        while len(rest):
            first = np.ones(len(rest), bool)
            first[1:] = label[1:] != label[:-1]
            node = base + np.cumsum(first) - 1
            point.append(rest[first])
            if parents is not None:
                keys.append(parents[first])
                children.append(node[first])
            base = int(node[-1]) + 1
            owner, below = rest[first][np.cumsum(first) - 1][~first], rest[~first]
            distance = np.bitwise_count(f[owner] ^ f[below]).astype(np.int64)
            key = node[~first] * _EDGES + distance
            turn = np.argsort(key, kind="stable")
            rest, parents = below[turn], key[turn]
            label = parents
        self._point = np.concatenate(point) if point else np.zeros(0, np.int64)
        self._node_fp = f[self._point]
        self._key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self._child = np.concatenate(children) if children else np.zeros(0, np.int64)

    def search(self, group: np.ndarray, fingerprint: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) within ``radius``; rows index the arrays the forest was built from."""
        root = np.searchsorted(self.groups, group)
        query = np.arange(len(group))
        known = root < len(self.groups)
        known[known] = self.groups[root[known]] == group[known]
        query, node = query[known], root[known]  # the roots are the first nodes, in group order
        found_query, found_node = [], []
        while len(query):
            distance = np.bitwise_count(fingerprint[query] ^ self._node_fp[node]).astype(np.int64)
            near = distance <= radius
            found_query.append(query[near])
            found_node.append(node[near])
            low = np.searchsorted(self._key, node * _EDGES + np.maximum(distance - radius, 0))
            high = np.searchsorted(self._key, node * _EDGES + np.minimum(distance + radius, _EDGES - 1), "right")
            query, edge = _spread(query, low, high)
            node = self._child[edge]
        if not found_query:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        query, point = np.concatenate(found_query), self._point[np.concatenate(found_node)]
        query, place = _spread(query, self._first[point], self._first[point + 1])
        return query, self._rows[place]


def _spread(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Repeat each value for every integer from its low to its high, exclusive."""
    count = high - low
    total = int(count.sum())
    start = np.repeat(low - (np.cumsum(count) - count), count)
    return np.repeat(values, count), start + np.arange(total)


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Unite the classes of a[i] and b[i]; a label is the smallest member of its class."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
    return label


def link_rows(
    group: np.ndarray,
    fingerprint: np.ndarray,
    is_query: np.ndarray,
    radius: int,
    similar: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
    most_pairs: int = 1 << 20,
) -> np.ndarray:
    """Class label of each row when rows of a group within ``radius`` are united.

    Rows with ``is_query`` search the tree of their group but are not in it. Searches run in blocks
    that can meet ``most_pairs`` rows; pairs that are united already are skipped before ``similar``
    looks at the rest, so a dense group costs little more than its first rows.
    """
    label = np.arange(len(group))
    for label in link_steps(group, fingerprint, is_query, radius, similar, most_pairs):  # noqa: B007
        pass
    return label


def link_steps(
    group: np.ndarray,
    fingerprint: np.ndarray,
    is_query: np.ndarray,
    radius: int,
    similar: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
    most_pairs: int = 1 << 20,
) -> Iterator[np.ndarray]:
    """The labels of :func:`link_rows` after each of its blocks; those of the last are final."""
    label = np.arange(len(group))
    nodes = np.flatnonzero(~is_query)
    if not len(nodes):
        return
    forest = Forest(group[nodes], fingerprint[nodes])
    size = np.bincount(np.searchsorted(forest.groups, group[nodes]), minlength=len(forest.groups))
    place = np.minimum(np.searchsorted(forest.groups, group), len(forest.groups) - 1)
    load = np.where(forest.groups[place] == group, size[place], 0)
    for block in _blocks(load, most_pairs):
        query, row = forest.search(group[block], fingerprint[block], radius)
        a, b = block[query], nodes[row]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
        if similar is None:
            label = merge(label, a, b)
            yield label
            continue
        for start in range(0, len(a), 8192):
            x, y = a[start : start + 8192], b[start : start + 8192]
            apart = label[x] != label[y]
            x, y = x[apart], y[apart]
            if len(x):
                good = similar(x, y)
                label = merge(label, x[good], y[good])
        yield label


def _blocks(load: np.ndarray, most: int) -> Iterator[np.ndarray]:
    total = np.cumsum(load)
    start = 0
    while start < len(load):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + most, "right")))
        yield np.arange(start, end)
        start = end
