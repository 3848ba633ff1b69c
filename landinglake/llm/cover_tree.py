"""Cover trees over unit vectors, and the pairs of their nodes that can hold close vectors.

A node stands for its centre and all vectors within its covering radius, which is measured. Its
children are a net of its vectors: centres further apart than half the node's radius (rounded to a
power of two), its own centre among them. So centres of a level are centres of all lower levels and
radii halve at least; a small group that is hardly tighter than the net is children of radius 0. Single vectors are nodes of radius 0.

Distances are chords, ``sqrt(2 - 2 cos)``. They are taken from products in single precision, so
each comes as a lower and an upper bound; who needs an exact answer asks for the vectors.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np

# Vectors below which, and radius up to which, a node has its vectors as children.
LEAF = 32
LEAST_RADIUS = 2.0 ** -6
# Candidates for centres compared at a time, and products held at a time.
BLOCK = 512
PRODUCTS = 1 << 21


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; rows must be finite and not zero."""
    scaled = vectors.astype(np.float64)
    scaled /= np.abs(scaled).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def product_error(dims: int) -> float:
    """How far a product of two unit vectors in single precision can be off."""
    return (dims + 8) * 2.0 ** -23


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


class CoverTree:
    """``points`` in the tree's order: the vectors of node i are ``begin[i]:end[i]``, its centre
    the first of them, its children the ``children[i]`` nodes from ``child[i]`` on. ``order`` says
    which of the given vectors each point is."""

    FIELDS = ("order", "begin", "end", "radius", "child", "children")

    def __init__(self, vectors: np.ndarray):
        points = unit(vectors).astype(np.float32)
        self.error = product_error(points.shape[1])
        order = np.arange(len(points))
        begin, end, radius, child, children = [0], [len(points)], [], [], []
        node = 0
        while node < len(begin):
            first, last = begin[node], end[node]
            own = order[first:last]
            far = float(chord((points[own] @ points[own[0]]).astype(np.float64) - self.error)
                        .max()) if last - first > 1 else 0.0
            radius.append(far)
            child.append(len(begin))
            group = np.zeros(1, int)
            if last - first > LEAF and far > LEAST_RADIUS:
                wide = 2.0 ** np.floor(np.log2(far * 0.999))
                group = _net(points, own, wide)
                if not group.any():  # the bound of the radius was just above a power of two
                    group = _net(points, own, wide / 2)
            if last - first == 1:
                children.append(0)
            elif not group.any():
                children.append(last - first)
                begin += range(first, last)
                end += range(first + 1, last + 1)
            else:
                by_group = np.argsort(group, kind="stable")
                order[first:last] = own[by_group]
                cuts = np.searchsorted(group[by_group], np.arange(group.max() + 2))
                starts = _child_starts(points[order[first:last]], cuts, wide, self.error)
                children.append(len(starts))
                begin += (first + starts).tolist()
                end += (first + np.append(starts[1:], last - first)).tolist()
            node += 1
        self.points, self.order = points[order], order
        self.begin, self.end = np.array(begin), np.array(end)
        self.radius, self.child = np.array(radius), np.array(child)
        self.children = np.array(children)

    def single(self, nodes: np.ndarray) -> np.ndarray:
        return self.children[nodes] == 0

    def open(self, nodes: np.ndarray) -> np.ndarray:
        """The children of the nodes; a single vector stays itself."""
        count = np.maximum(self.children[nodes], 1)
        first = np.where(self.children[nodes] > 0, self.child[nodes], nodes)
        return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())

    def widen(self, extra: np.ndarray) -> None:
        """Let every point stand for all within ``extra`` of it: radii that cover these too."""
        for node in range(len(self.begin) - 1, -1, -1):
            own = slice(self.begin[node], self.end[node])
            cosine = (self.points[own] @ self.points[own.start]).astype(np.float64)
            distance = chord(cosine - self.error)
            distance[0] = 0.0
            self.radius[node] = (distance + extra[own]).max()

    def to_bytes(self, **more: np.ndarray) -> bytes:
        target = io.BytesIO()
        np.savez(target, points=self.points, **{f: getattr(self, f) for f in self.FIELDS}, **more)
        return target.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[CoverTree, dict[str, np.ndarray]]:
        """The tree, and what else was packed with it."""
        loaded = dict(np.load(io.BytesIO(data), allow_pickle=False))
        tree = cls.__new__(cls)
        for name in ("points", *cls.FIELDS):
            setattr(tree, name, loaded.pop(name))
        tree.error = product_error(tree.points.shape[1])
        return tree, loaded


def _net(points: np.ndarray, own: np.ndarray, radius: float) -> np.ndarray:
    """A centre's number for each of ``own``: the first centre within ``radius``. Centres are
    further apart than that; the first of ``own`` is centre 0."""
    group = np.full(len(own), -1)
    least, found = np.float32(1 - radius * radius / 2), 0
    left = np.arange(len(own))
    while len(left):
        block = left[:BLOCK]
        near = points[own[block]] @ points[own[left]].T >= least
        near[np.arange(len(block)), np.arange(len(block))] = True
        covered, centres = np.zeros(len(block), bool), []
        for place in range(len(block)):
            if not covered[place]:
                centres.append(place)
                covered |= near[place, :len(block)]
        rows = near[centres]
        has = rows.any(axis=0)
        group[left[has]] = found + rows[:, has].argmax(axis=0)
        found += len(centres)
        left = left[~has]
    return group


def _child_starts(points: np.ndarray, cuts: np.ndarray, wide: float, error: float) -> np.ndarray:
    """Where the children of a node begin among its points, given the groups of its net.

    A few vectors that are hardly closer to each other than centres are would make a node that no
    radius parts from others; they are children each.
    """
    sizes = np.diff(cuts)
    centre = points[np.repeat(cuts[:-1], sizes)]
    away = chord(np.einsum("ij,ij->i", points, centre).astype(np.float64) - error)
    loose = (sizes <= LEAF) & (np.maximum.reduceat(away, cuts[:-1]) > wide / 2)
    starts = np.repeat(loose, sizes)
    starts[cuts[:-1]] = True
    return np.flatnonzero(starts)


def _slices(count: int, size: int) -> Iterator[slice]:
    for at in range(0, count, size):
        yield slice(at, at + size)


def traverse(a: CoverTree, b: CoverTree, reach: float, settle: Callable) -> None:
    """Go down two trees at once, from the roots, and leave out every pair of nodes whose centres
    are further apart than both radii and ``reach``.

    ``settle(i, j, near, far)`` gets the other pairs, as node numbers with bounds of their centres'
    distance, and returns which of them are to be opened. A node meets all the nodes that are left
    for it in one product.
    """
    pending = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while pending:
        own, others = pending.pop()
        for part in _slices(len(others), PRODUCTS):
            nodes_b = others[part]
            radius_b = b.radius[nodes_b]
            for part_a in _slices(len(own), max(1, PRODUCTS // len(nodes_b))):
                nodes_a = own[part_a]
                radius_a = a.radius[nodes_a]
                cosine = a.points[a.begin[nodes_a]] @ b.points[b.begin[nodes_b]].T
                widest = min(2.0, radius_a.max() + radius_b.max() + reach)
                i, j = np.nonzero(cosine >= 1 - widest * widest / 2 - 2 * a.error)
                cosine = cosine[i, j].astype(np.float64)
                near = chord(np.minimum(cosine + a.error, 1.0))
                i_radius, j_radius = radius_a[i], radius_b[j]
                left = near <= i_radius + j_radius + reach + 1e-12
                i, j = nodes_a[i[left]], nodes_b[j[left]]
                opened = settle(i, j, near[left], chord(cosine[left] - a.error))
                pending += _opened(a, b, i[opened], j[opened])


def _opened(a: CoverTree, b: CoverTree, i: np.ndarray, j: np.ndarray
            ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The children that meet: for each node of the side with fewer of them, its children and
    those of all the nodes it met."""
    by_b = len(np.unique(j)) < len(np.unique(i))
    one, many = (j, i) if by_b else (i, j)
    order = np.argsort(one, kind="stable")
    one, many = one[order], many[order]
    cuts = np.flatnonzero(np.diff(one, prepend=-1, append=-1))
    for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        node, met = one[begin:begin + 1], many[begin:end]
        yield (a.open(met), b.open(node)) if by_b else (a.open(node), b.open(met))
