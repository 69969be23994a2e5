"""Cover trees over unit vectors: nested nets with halving radii, and their dual traversal."""

from __future__ import annotations

import numpy as np

from learner_scoring.llm.common import ship_by_value

#: Radii of the nets below the root.
RADII = (1.0, 0.5, 0.25, 0.125)
#: Point pairs of two nodes that are settled by one matrix product.
DENSE = 1 << 20
#: Slack for rounding in the bounds; pairs within it are computed.
EPS = 1e-9


def distance(cos: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cos))


class Node:
    """Points [lo, hi) of the ordered vectors, all within ``radius`` of the point ``center``."""

    __slots__ = ("center", "lo", "hi", "radius", "level")

    def __init__(self, center: int, lo: int, hi: int, radius: float, level: int):
        self.center, self.lo, self.hi, self.radius, self.level = center, lo, hi, radius, level


def _net(x: np.ndarray, r: float) -> np.ndarray:
    """For each point the place of its net center: greedy, the first free point covers what lies within r."""
    owner = np.full(len(x), -1)
    free = np.arange(len(x))
    while len(free):
        c = free[0]
        near = distance(x[free] @ x[c]) <= r
        near[0] = True
        owner[free[near]] = c
        free = free[~near]
    return owner


class CoverTree:
    """Vectors in tree order; every node with several points has its next net below it."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.arange(len(x))
        self.below: dict[tuple[int, int, int], list[Node]] = {}
        self.root = Node(0, 0, len(x), 2.0, -1)
        work = [self.root]
        while work:
            node = work.pop()
            work += [n for n in self._split(node) if n.hi - n.lo > 1 and n.level + 1 < len(RADII)]

    def children(self, node: Node) -> list[Node]:
        """The nodes of the next net; a single point is its own child."""
        return self.below.get((node.lo, node.hi, node.level), [node])

    def _split(self, node: Node) -> list[Node]:
        part = slice(node.lo, node.hi)
        level = node.level + 1
        owner = _net(self.x[part], RADII[level])
        by = np.argsort(owner, kind="stable")
        self.x[part], self.order[part] = self.x[part][by], self.order[part][by]
        edge = np.concatenate([[0], np.flatnonzero(np.diff(owner[by])) + 1, [len(by)]])
        out = []
        for lo, hi in zip((edge[:-1] + node.lo).tolist(), (edge[1:] + node.lo).tolist()):
            # the center has the smallest place of its points, so the stable order puts it first
            far = float(distance(self.x[lo:hi] @ self.x[lo]).max()) if hi - lo > 1 else 0.0
            out.append(Node(lo, lo, hi, far, level))
        self.below[node.lo, node.hi, node.level] = out
        return out


def dual(a: CoverTree, b: CoverTree, cosine: float):
    """Blocks (lo, hi, lo, hi, mask) of the pairs at or above ``cosine``; mask None where all pairs are.

    Node pairs whose covering radii keep all their points apart are dropped
    unseen, those whose radii hold all points together are taken whole, and small
    ones are computed; the rest goes down a level. With ``a is b`` each pair of
    different nodes is met in one order and a node meets itself.
    """
    limit = float(distance(np.array(cosine)))
    work = [(a.root, b.root)]
    while work:
        p, q = work.pop()
        same = a is b and p.lo == q.lo and p.hi == q.hi
        size = (p.hi - p.lo) * (q.hi - q.lo)
        # the first net is always asked: it tells random points apart in one product
        if p.level >= 0 and (size <= DENSE or p.level + 1 == len(RADII) or q.level + 1 == len(RADII)):
            step = max(1, DENSE // (q.hi - q.lo))
            for lo in range(p.lo, p.hi, step):
                hi = min(p.hi, lo + step)
                mask = a.x[lo:hi] @ b.x[q.lo : q.hi].T >= cosine
                if mask.any():
                    yield lo, hi, q.lo, q.hi, mask
            continue
        mine, theirs = a.children(p), (a.children(p) if same else b.children(q))
        ca, cb = a.x[[n.center for n in mine]], b.x[[n.center for n in theirs]]
        d = distance(ca @ cb.T)
        reach = np.array([n.radius for n in mine])[:, None] + np.array([n.radius for n in theirs])[None, :]
        for i, j in zip(*np.nonzero(d <= reach + limit + EPS)):
            if same and j < i:
                continue
            n, m = mine[i], theirs[j]
            if d[i, j] + reach[i, j] <= limit - EPS:
                yield n.lo, n.hi, m.lo, m.hi, None
            else:
                work.append((n, m))


ship_by_value(__name__)
