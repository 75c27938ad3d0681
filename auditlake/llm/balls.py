"""Metric trees of integer points, built middle-out over anchors.

An anchor owns the points that are nearer to it than to any other. A new anchor is the point
farthest from its owner in the widest anchor; it can only take points that lie farther from
their owner than half the way between the two anchors, so the others are not looked at. From
about the square root of all points as anchors, the tree is agglomerated upwards, always the
two balls whose common ball is smallest, and the points of each anchor are split in the same
way downwards. A ball caches the number and the sum of its points, its centre and its radius.

Entries, the points that balls are assigned to, are kept in lists of candidates. A ball
inherits its parent's list and strikes out each entry whose distance to the centre exceeds
that of the nearest one by more than twice the radius, since none of its points can be
nearest to that entry. With one candidate left the ball is owned as a whole and its cached
sum counts; otherwise its children are asked, and in a leaf every point. Distances in a leaf
are exact integers, bounds have a margin for rounding, and of equal distances the lower
entry wins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 96
# Points within it have exact squared distances and sums of them in 64 bits.
LARGEST = 1 << 27
# Up to here products of eight components are exact in floating point.
EXACT_IN_DOUBLE = 1 << 22
FAR = np.iinfo(np.int64).max


@dataclass
class Tree:
    """``points`` in the tree's order, ``rows`` their places before; a node holds the points
    ``low`` to ``high`` and has two children, or none (-1)."""

    points: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    sums: np.ndarray
    radius: np.ndarray

    def pack(self) -> bytes:
        head = np.array([*self.points.shape, len(self.low)], np.int64)
        arrays = [self.points.astype(np.int32), *(a.astype(np.int32) for a in (self.rows, self.low, self.high, self.left, self.right))]
        return b"".join(a.tobytes() for a in [head, self.sums, self.radius, *arrays])

    @classmethod
    def unpack(cls, data: bytes) -> Tree:
        n, width, nodes = np.frombuffer(data, np.int64, 3)
        at, parts = 24, []
        for kind, shape in (
            (np.int64, (nodes, width)), (np.float64, (nodes,)), (np.int32, (n, width)), (np.int32, (n,)), *[(np.int32, (nodes,))] * 4,
        ):
            count = int(np.prod(shape))
            parts.append(np.frombuffer(data, kind, count, at).reshape(shape))
            at += count * np.dtype(kind).itemsize
        sums, radius, points, rows, low, high, left, right = parts
        return cls(points.astype(np.int64), rows, low, high, left, right, sums, radius)


def _anchors(points: np.ndarray, wanted: int) -> list[np.ndarray]:
    """Rows owned by each of about so many anchors; fewer where points are equal."""
    pivots = [points[0]]
    owner = np.zeros(len(points), np.int64)
    away = np.sqrt(((points - points[0]) ** 2).sum(1))
    for new in range(1, wanted):
        at = int(away.argmax())
        if away[at] == 0:
            break
        pivot = points[at]
        half = np.sqrt(((np.array(pivots) - pivot) ** 2).sum(1)) / 2
        near = np.flatnonzero(away >= half[owner] * (1 - 1e-9))
        found = np.sqrt(((points[near] - pivot) ** 2).sum(1))
        taken = found < away[near]
        owner[near[taken]], away[near[taken]] = new, found[taken]
        pivots.append(pivot)
    order = np.argsort(owner, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(owner[order])) + 1)


def _joined(balls: list[tuple]) -> tuple:
    """Agglomerate ``(tree, centre, radius, size)`` balls to one."""
    trees = [b[0] for b in balls]
    centres, radii, sizes = np.array([b[1] for b in balls]), np.array([b[2] for b in balls]), np.array([b[3] for b in balls], float)

    def common(i: int, js: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centres and radii of the balls around ball ``i`` and each of ``js``."""
        share = (sizes[js] / (sizes[js] + sizes[i]))[:, None]
        middle = centres[i] + (centres[js] - centres[i]) * share
        to_i = np.sqrt(((middle - centres[i]) ** 2).sum(1)) + radii[i]
        return middle, np.maximum(to_i, np.sqrt(((middle - centres[js]) ** 2).sum(1)) + radii[js])

    every = np.arange(len(balls))
    cost = np.stack([common(i, every)[1] for i in every])
    np.fill_diagonal(cost, np.inf)
    for _ in range(len(balls) - 1):
        i, j = divmod(int(cost.argmin()), len(balls))
        middle, radius = common(i, np.array([j]))
        trees[i] = (trees[i], trees[j])
        centres[i], radii[i], sizes[i] = middle[0], radius[0], sizes[i] + sizes[j]
        cost[j, :] = cost[:, j] = np.inf
        alive = np.flatnonzero(np.isfinite(cost[i]))
        if len(alive):
            cost[i, alive] = cost[alive, i] = common(i, alive)[1]
    return trees[i] if len(balls) > 1 else trees[0]


def _middle_out(points: np.ndarray, rows: np.ndarray) -> tuple | np.ndarray:
    """Nested pairs of rows, single arrays being leaves."""
    if len(rows) <= LEAF:
        return rows
    own = points[rows]
    groups = _anchors(own, int(np.ceil(np.sqrt(len(rows)))))
    if len(groups) == 1:
        return rows
    balls = []
    for group in groups:
        centre = own[group].mean(0)
        radius = np.sqrt(((own[group] - centre) ** 2).sum(1).max())
        balls.append((_middle_out(points, rows[group]), centre, radius, len(group)))
    return _joined(balls)


def build(points: np.ndarray) -> Tree:
    """Tree of at least one point, given as rows of integers."""
    floats = points.astype(np.float64)
    pending = [(_middle_out(floats, np.arange(len(points))), -1, 0)]
    low, high, left, right, order, size = [], [], [], [], [], 0
    parents = []
    while pending:
        tree, parent, side = pending.pop()
        node = len(low)
        if parent >= 0:
            (left, right)[side][parent] = node
        low.append(size)
        high.append(size)
        left.append(-1)
        right.append(-1)
        parents.append(parent)
        if isinstance(tree, tuple):
            # the left child is taken off first, so that a ball's points follow one another
            pending += [(tree[1], node, 1), (tree[0], node, 0)]
        else:
            order.append(tree)
            size += len(tree)
            high[node] = size
    for node in range(len(low) - 1, 0, -1):
        high[parents[node]] = max(high[parents[node]], high[node])
    rows = np.concatenate(order)
    sorted_points, spread = points[rows], floats[rows]
    low, high = np.array(low), np.array(high)
    totals = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(sorted_points, axis=0)])
    sums = totals[high] - totals[low]
    centres = sums / (high - low)[:, None]
    radius = np.array([np.sqrt(((spread[a:b] - c) ** 2).sum(1).max()) for a, b, c in zip(low, high, centres, strict=True)])
    return Tree(sorted_points, rows, low, high, np.array(left), np.array(right), sums, radius)


def squared_distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points to integer entries."""
    most = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if most <= EXACT_IN_DOUBLE and points.shape[1] <= 8:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return ((p**2).sum(1)[:, None] - 2 * (p @ e.T) + (e**2).sum(1)[None, :]).astype(np.int64)
    return ((points[:, None, :] - entries[None, :, :]) ** 2).sum(2)


def _settle(tree: Tree, entries: np.ndarray):
    """Nodes owned as a whole with their entry, and the points of the leaves left with theirs."""
    # of equal entries only the first can own anything
    _, first = np.unique(entries, axis=0, return_index=True)
    alive = np.zeros((1, len(entries)), bool)
    alive[0, first] = True
    nodes = np.zeros(1, np.int64)
    floats = entries.astype(np.float64)
    while len(nodes):
        centre = tree.sums[nodes] / (tree.high[nodes] - tree.low[nodes])[:, None]
        away = np.sqrt(((centre[:, None, :] - floats[None]) ** 2).sum(2))
        away[~alive] = np.inf
        nearest = away.min(1)
        bound = (nearest + 2 * tree.radius[nodes]) * (1 + 1e-9) + 1e-6
        alive = alive & (away <= bound[:, None])
        owned = alive.sum(1) == 1
        if owned.any():
            yield nodes[owned], alive[owned].argmax(1), None
        leaf = ~owned & (tree.left[nodes] < 0)
        if leaf.any():
            sizes = tree.high[nodes[leaf]] - tree.low[nodes[leaf]]
            begins = np.repeat(tree.low[nodes[leaf]] - np.cumsum(sizes) + sizes, sizes)
            at = begins + np.arange(sizes.sum())
            distances = squared_distances(tree.points[at], entries)
            distances[~np.repeat(alive[leaf], sizes, axis=0)] = FAR
            yield None, distances.argmin(1), at
        open_ = ~owned & ~leaf
        nodes = np.concatenate([tree.left[nodes[open_]], tree.right[nodes[open_]]]).astype(np.int64)
        alive = np.concatenate([alive[open_], alive[open_]])


def totals(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of the points nearest to each entry."""
    counts, sums = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    for nodes, own, at in _settle(tree, entries):
        if at is None:
            np.add.at(counts, own, tree.high[nodes] - tree.low[nodes])
            np.add.at(sums, own, tree.sums[nodes])
        else:
            np.add.at(counts, own, 1)
            np.add.at(sums, own, tree.points[at])
    return counts, sums


def nearest(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry of each point and its squared distance, in the order the points were given."""
    sorted_entry = np.zeros(len(tree.rows), np.int64)
    for nodes, own, at in _settle(tree, entries):
        if at is None:
            for node, entry in zip(nodes, own, strict=True):
                sorted_entry[tree.low[node] : tree.high[node]] = entry
        else:
            sorted_entry[at] = own
    distance = ((tree.points - entries[sorted_entry]) ** 2).sum(1)
    entry, error = np.empty_like(sorted_entry), np.empty_like(distance)
    entry[tree.rows], error[tree.rows] = sorted_entry, distance
    return entry, error
