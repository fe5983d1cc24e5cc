"""A robust-pruned flat graph over a bounded group of unit vectors, and range search in it."""

from __future__ import annotations

import numpy as np

#: Vectors of a shard about, shards that hold each vector, neighbours kept of three times as many tried, pruning slack.
SHARD, OVERLAP, DEGREE, ALPHA = 256, 2, 16, 1.2
#: Queries searched together, candidates in a query's beam, slack below the range while it expands, pairs scored at a time.
BATCH, BEAM, SLACK, PAIRS = 256, 12, 0.02, 1 << 17


def nearest(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` centres with the largest dot products."""
    k = min(k, len(centres))
    return np.argsort(-(x @ centres.T), axis=1, kind="stable")[:, :k]


def k_means(x: np.ndarray, k: int, rounds: int = 3) -> np.ndarray:
    """Unit centres, started from evenly spaced rows."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        near = nearest(x, c, 1)[:, 0]
        new = np.zeros_like(c)
        np.add.at(new, near, x)
        size = np.linalg.norm(new, axis=1, keepdims=True)
        c = np.where(size > 1e-9, new / np.maximum(size, 1e-9), c)
    return c


def robust_prune(x: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Edges within one shard: from the nearest on, a candidate stays if no kept neighbour is ``ALPHA`` times nearer to it than the node is."""
    sim = x @ x.T
    np.fill_diagonal(sim, -2)
    k = min(3 * degree, len(x) - 1)
    if k < 1:
        return np.zeros((0, 2), np.int64)
    near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sim, near, 1), axis=1, kind="stable"), 1)
    dist = np.sqrt(np.maximum(0, 2 - 2 * sim))
    row = np.arange(len(x))
    alive, kept = np.ones(near.shape, bool), np.zeros(near.shape, bool)
    for j in range(k):
        take = alive[:, j] & (kept.sum(1) < degree)
        kept[take, j] = True
        p = near[:, j]
        covered = ALPHA * dist[p[:, None], near] <= dist[row[:, None], near]
        alive &= ~(covered & take[:, None])
        alive[:, j] = False
    a, b = np.nonzero(kept)
    return np.stack([a, near[a, b]], 1)


class FlatGraph:
    """Adjacency lists of overlapping shards united in one graph, with the shards' medoids as entries; ``width`` widens lists and beams."""

    def __init__(self, x: np.ndarray, width: int = 1):
        self.x, self.width = x, width
        n = len(x)
        k = max(1, -(-n // SHARD))
        centres = k_means(x, k)
        member = nearest(x, centres, OVERLAP)
        edges: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
        medoids = []
        for c in range(k):
            inside = np.flatnonzero((member == c).any(1))
            if len(inside):
                medoids.append(inside[(x[inside] @ centres[c]).argmax()])
                # a shard much larger than planned is cut up; its parts share the medoid
                for part in np.array_split(inside, -(-len(inside) // (4 * SHARD))):
                    part = np.unique(np.append(part, medoids[-1]))
                    edges.append(part[robust_prune(x[part], DEGREE * width)])
        e = np.concatenate(edges)
        both = np.sort(np.concatenate([e[:, 0] * n + e[:, 1], e[:, 1] * n + e[:, 0]]))
        both = both[np.diff(both, prepend=-1) > 0]
        self.to = both % max(n, 1)
        self.head = np.searchsorted(both, np.arange(n + 1) * n)
        self.medoids = np.unique(np.array(medoids, np.int64))
        self.scored = 0

    def _fresh(self, q: np.ndarray, node: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The neighbours of ``node`` that the queries ``q`` haven't met, which are marked as met."""
        n = self.head[node + 1] - self.head[node]
        to = self.to[np.repeat(self.head[node] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        flat = np.repeat(q, n) * len(self.x) + to
        flat = np.unique(flat[~seen[flat]])
        seen[flat] = True
        return np.divmod(flat, len(self.x))

    def _score(self, queries: np.ndarray, q: np.ndarray, node: np.ndarray) -> np.ndarray:
        self.scored += len(q)
        parts = [np.einsum("ij,ij->i", queries[q[s : s + PAIRS]], self.x[node[s : s + PAIRS]]) for s in range(0, len(q), PAIRS)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def range_search(self, queries: np.ndarray, least: float, entry: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, vector) with a dot product of at least ``least``, as two arrays.

        From the medoids, and from the query's own node if ``entry`` gives it, a
        greedy search expands the best of a beam of ``BEAM`` until none of it is
        left; then every vector within the range (less ``SLACK``) is expanded
        until the range brings no new one. What is met is a bit for each pair;
        scores are kept for beams and for the range alone.
        """
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2]
        for s in range(0, len(queries), BATCH):
            y = queries[s : s + BATCH]
            q, node = self._search(y, least, None if entry is None else entry[s : s + BATCH])
            found.append((q + s, node))
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])

    def _search(self, y: np.ndarray, least: float, entry: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        m, n, beam = len(y), len(self.x), BEAM * self.width
        seen, rows = np.zeros(m * n, bool), np.arange(m)
        q, node = np.repeat(rows, len(self.medoids)), np.tile(self.medoids, m)
        if entry is not None:
            flat = np.unique(np.concatenate([q, rows]) * n + np.concatenate([node, entry]))
            q, node = np.divmod(flat, n)
        seen[q * n + node] = True
        best, score, open_ = np.full((m, beam), -1), np.full((m, beam), -2.0), np.zeros((m, beam), bool)
        done, hits, near = np.zeros(m * n, bool), [], []
        while True:
            got = self._score(y, q, node)
            inside = got >= least - SLACK
            near.append((q[inside], node[inside]))
            hits.append((q[got >= least], node[got >= least]))
            if len(q):
                # the new ones of each query side by side, then the best of them and of its beam
                rank = np.arange(len(q)) - np.searchsorted(q, q)
                wide = int(rank.max()) + 1
                new, value = np.full((m, wide), -1), np.full((m, wide), -2.0)
                new[q, rank], value[q, rank] = node, got
                all_n, all_s, all_o = np.hstack([best, new]), np.hstack([score, value]), np.hstack([open_, new >= 0])
                top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
                best, score, open_ = (np.take_along_axis(v, top, 1) for v in (all_n, all_s, all_o))
            pick = np.where(open_, score, -3.0).argmax(1)
            live = np.flatnonzero(open_[rows, pick])
            if not len(live):
                break
            open_[live, pick[live]] = False
            at = best[live, pick[live]]
            done[live * n + at] = True
            q, node = self._fresh(live, at, seen)
        q, node = (np.concatenate([p[i] for p in near]) for i in (0, 1))
        while len(q):
            more = ~done[q * n + node]
            q, node = q[more], node[more]
            done[q * n + node] = True
            q, node = self._fresh(q, node, seen)
            got = self._score(y, q, node)
            hits.append((q[got >= least], node[got >= least]))
            q, node = q[got >= least - SLACK], node[got >= least - SLACK]
        return np.concatenate([a for a, _ in hits]), np.concatenate([b for _, b in hits])


def near_pairs(x: np.ndarray, guests: np.ndarray | None, least: float, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Each pair of ``x`` (or of ``x`` and ``guests``) that the graph over ``x`` brings together, once.

    Among ``x`` a pair that either of the two finds counts, as (smaller, larger).
    """
    graph = FlatGraph(x, width)
    if guests is not None:
        q, node = graph.range_search(guests, least)
        return node, q
    q, node = graph.range_search(x, least, np.arange(len(x)))
    a, b = np.minimum(q, node), np.maximum(q, node)
    flat = np.unique((a * len(x) + b)[a < b])
    return np.divmod(flat, len(x))


def all_pairs(x: np.ndarray, guests: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Each pair of ``x`` (or of ``x`` and ``guests``) with a product of at least ``least``, once."""
    found = [(np.zeros(0, np.int64),) * 2]
    for s in range(0, len(x), 1024):
        hit = x[s : s + 1024] @ (x if guests is None else guests).T >= least
        a, b = np.nonzero(hit)
        keep = slice(None) if guests is not None else a + s < b
        found.append((a[keep] + s, b[keep]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def lowest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest one that links ``a - b`` lead to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
