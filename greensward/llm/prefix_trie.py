"""Exact overlap search among a bounded group of sets, by a prefix tree."""

from __future__ import annotations

import numpy as np


class PrefixTrie:
    """Sets as sequences in one order, in a trie whose single-child paths are one edge.

    ``flat[first[k]:last[k]]`` are the tokens on the edge into node k,
    ``depth[k]`` how many tokens lead to its end; its leaves are
    ``order[low[k]:high[k]]``, which have from ``least[k]`` to ``most[k]`` tokens
    and sizes of ``small[k]`` at least; ``child[head[k]:head[k + 1]]`` are its
    children. Node 0 is the root.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        """``sets`` are ranks, each ascending; equal sets may repeat. ``sizes`` count the tokens that no other set has too."""
        self.length, self.sizes = np.array([len(s) for s in sets], np.int64), sizes
        self.order = np.array(sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes()), np.int64)
        first, last, depth, parent, low, high, parts, used = [0], [0], [0], [-1], [0], [len(sets)], [], 0
        stack = [0]
        prev = np.zeros(0, np.int64)
        for at, i in enumerate(self.order):
            s = sets[i]
            n = min(len(s), len(prev))
            differ = np.flatnonzero(s[:n] != prev[:n])
            shared = int(differ[0]) if len(differ) else n
            child = -1
            while depth[stack[-1]] > shared:
                child = stack.pop()
                high[child] = at
            top = stack[-1]
            if depth[top] < shared:
                # split the edge into the child that was left last
                k, cut = len(first), shared - depth[top]
                first.append(first[child])
                last.append(first[child] + cut)
                depth.append(shared)
                parent.append(top)
                low.append(low[child])
                high.append(-1)
                first[child] += cut
                parent[child] = k
                stack.append(k)
                top = k
            if len(s) > shared or not len(s):
                first.append(used)
                parts.append(s[shared:])
                used += len(s) - shared
                last.append(used)
                depth.append(len(s))
                parent.append(top)
                low.append(at)
                high.append(-1)
                stack.append(len(first) - 1)
            prev = s
        for k in stack:
            high[k] = len(sets)
        self.flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.first, self.last, self.depth, self.low, self.high = (np.array(x, np.int64) for x in (first, last, depth, low, high))
        ends = np.append(self.length[self.order], 0)
        pairs = np.stack([self.low, np.maximum(self.high, self.low + 1)], 1).ravel()
        self.least, self.most = np.minimum.reduceat(ends, pairs)[::2], np.maximum.reduceat(ends, pairs)[::2]
        self.small = np.minimum.reduceat(np.append(self.sizes[self.order], 0), pairs)[::2]
        p = np.array(parent[1:], np.int64)
        self.child = np.argsort(p, kind="stable") + 1
        self.head = np.searchsorted(p[self.child - 1], np.arange(len(first) + 1))

    def search(self, mark: np.ndarray, tokens: int, size: int, percent: int, label: np.ndarray, own: int) -> np.ndarray:
        """Indices of the sets with ``100 * overlap >= percent * union`` to a probe.

        ``mark`` tells which ranks the probe has, ``tokens`` of them; its size is
        ``size``. Whole levels go down together, sharing the overlap of common
        prefixes. A subtree is left when even its longest rest couldn't reach
        the overlap that its smallest set needs, or when all its sets have the
        label ``own`` already. ``label`` goes by ``order``.
        """
        found = []
        node, over = np.zeros(1, np.int64), np.zeros(1, np.int64)
        lab = np.append(label, -1)
        while len(node):
            done = self.depth[node] == self.least[node]
            for k, o in zip(node[done], over[done], strict=True):
                full = self.order[self.low[k] : self.high[k]]
                full = full[self.length[full] == self.depth[k]]
                found.append(full[(100 + percent) * o >= percent * (size + self.sizes[full])])
            counts = self.head[node + 1] - self.head[node]
            kids = self.child[_ranges(self.head[node], counts)]
            if not len(kids):
                break
            above = np.repeat(over, counts)
            n = self.last[kids] - self.first[kids]
            hits = np.append(mark[self.flat[_ranges(self.first[kids], n)]], 0).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(n)])
            sums = np.concatenate([[0], np.cumsum(hits[:-1])])
            now = above + sums[at[1:]] - sums[at[:-1]]
            most = now + np.minimum(tokens - now, self.most[kids] - self.depth[kids])
            keep = (100 + percent) * most >= percent * (size + self.small[kids])
            pairs = np.stack([self.low[kids], self.high[kids]], 1).ravel()
            same = (np.minimum.reduceat(lab, pairs)[::2] == own) & (np.maximum.reduceat(lab, pairs)[::2] == own)
            keep &= ~same
            node, over = kids[keep], now[keep]
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    if not len(n):
        return np.zeros(0, np.int64)
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


def _ranked(sets: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Tokens as ranks in the global order, from its end: common tokens first, so that like sets share long prefixes."""
    vocabulary, back = np.unique(np.concatenate(sets), return_inverse=True)
    rank, out, at = len(vocabulary) - 1 - back, [], 0
    for s in sets:
        out.append(np.sort(rank[at : at + len(s)]))
        at += len(s)
    return out, len(vocabulary)


def linked_forest(sets: list[np.ndarray], sizes: np.ndarray, layers: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of indices, each a link, that join up the same components as all links among ``sets`` do.

    Tokens are numbers whose order is the global one, rare ones first, and
    ``sizes`` the sizes of the whole sets. Sets with an equal layer of 0 or more
    count as joined from the start. Each set probes the trie of all for sets of
    other components.
    """
    ranked, width = _ranked(sets)
    trie = PrefixTrie(ranked, sizes)
    label = np.arange(len(sets))
    for k in np.unique(layers[layers >= 0]):
        label[layers == k] = np.flatnonzero(layers == k)[0]
    mark = np.zeros(width, bool)
    out = []
    for i, s in enumerate(ranked):
        mark[s] = True
        for j in trie.search(mark, len(s), int(sizes[i]), percent, label[trie.order], int(label[i])):
            if label[i] != label[j]:
                out.append((i, int(j)))
                label[label == label[j]] = label[i]
        mark[s] = False
    return out


def linked_to(hub: np.ndarray, size: int, sets: list[np.ndarray], sizes: np.ndarray, percent: int) -> np.ndarray:
    """Indices of the sets that are linked with the hub, by one walk of their trie."""
    if not sets:
        return np.zeros(0, np.int64)
    ranked, width = _ranked([*sets, hub])
    mark = np.zeros(width, bool)
    mark[ranked[-1]] = True
    return PrefixTrie(ranked[:-1], sizes).search(mark, len(hub), size, percent, np.arange(len(sets)), -2)
