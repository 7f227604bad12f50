"""Cover trees over unit vectors, and their dual traversal for all pairs within a distance.

A node holds a centre, its points and their covering radius; its children cover the points with half
the radius. Two nodes whose centres are farther apart than both radii and the distance together
hold no pair, so they are left at once. What remains is compared point by point: the pairs are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

WIDEST = 2.0
LEAF = 48
# Pairs of single points whose vectors are gathered at a time.
PAIRS = 1 << 15
# Rounding of a distance that is computed from a product of unit vectors.
SLACK = 1e-6


@dataclass
class Node:
    """`points` are positions in the tree's vectors; the first is the centre."""

    points: np.ndarray
    radius: float
    children: list[Node] = field(default_factory=list)
    centres: np.ndarray | None = None
    radii: np.ndarray | None = None


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def reach(cosine: float) -> float:
    """The distance of unit vectors with that cosine, and what rounding may add."""
    return float(np.sqrt(2.0 - 2.0 * cosine)) + SLACK


def build(vectors: np.ndarray) -> Node:
    """The tree of unit vectors, at least one."""
    points = np.arange(len(vectors))
    radius = float(distances(vectors[:1], vectors)[0].max())
    return _split(vectors, Node(points, radius), WIDEST)


def _split(vectors: np.ndarray, node: Node, level: float) -> Node:
    if len(node.points) <= LEAF or node.radius <= SLACK:
        return node
    level = min(level, 2.0 ** np.ceil(np.log2(node.radius)))
    while True:
        level /= 2
        children, rest = [], node.points
        while len(rest):
            away = distances(vectors[rest[:1]], vectors[rest])[0]
            near = away <= level
            near[0] = True
            children.append(Node(rest[near], float(away[near].max())))
            rest = rest[~near]
        if len(children) > 1:
            break
        node = children[0]
        if node.radius <= SLACK:
            return node
    node = Node(node.points, node.radius, [_split(vectors, c, level) for c in children])
    node.centres = vectors[[c.points[0] for c in node.children]]
    node.radii = np.array([c.radius for c in node.children])
    return node


def near_pairs(a: np.ndarray, tree_a: Node, b: np.ndarray, tree_b: Node, cosine: float, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs with at least `cosine`; for a tree with `itself`, each pair once and no point with itself."""
    within = reach(cosine)
    stack = [(tree_a, tree_b)]
    while stack:
        u, v = stack.pop()
        same = itself and u is v
        if not u.children and not v.children:
            i, j = np.nonzero(a[u.points] @ b[v.points].T >= cosine)
            left, right = u.points[i], v.points[j]
            if same:
                kept = left < right
                left, right = left[kept], right[kept]
            if len(left):
                yield left, right
            continue
        us = u.children if u.children else [u]
        vs = v.children if v.children else [v]
        centres = [n.centres if n.children else x[n.points[:1]] for n, x in ((u, a), (v, b))]
        radii = [n.radii if n.children else np.array([n.radius]) for n in (u, v)]
        near = distances(*centres) <= radii[0][:, None] + radii[1][None, :] + within
        if same:
            near = np.triu(near)
        i, j = np.nonzero(near)
        # Pairs of single points are compared here, a run of pairs at a time.
        single = (np.array([len(n.points) for n in us]) == 1)[i] & (np.array([len(n.points) for n in vs]) == 1)[j]
        if same:
            single &= i != j
        if single.any():
            left = np.array([n.points[0] for n in us])[i[single]]
            right = np.array([n.points[0] for n in vs])[j[single]]
            for at in range(0, len(left), PAIRS):
                x, y = left[at : at + PAIRS], right[at : at + PAIRS]
                close = np.einsum("ij,ij->i", a[x], b[y]) >= cosine
                if close.any():
                    yield x[close], y[close]
        if same:
            own = (i == j) & (np.array([len(n.points) for n in us]) == 1)[i]
            single |= own
        stack += [(us[x], vs[y]) for x, y in zip(i[~single].tolist(), j[~single].tolist())]


def near_cells(centres: np.ndarray, radii: np.ndarray, cosine: float) -> list[tuple[int, int]]:
    """Pairs of cells (a <= b) that may hold a pair: the same bound on the cells' own radii."""
    within = reach(cosine)
    near = distances(centres, centres) <= radii[:, None] + radii[None, :] + within
    return [(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(near)))]
