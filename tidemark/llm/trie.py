"""A prefix tree over ordered sets, searched for similar sets with the overlaps of shared paths."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Node:
    """Sequences low to high - 1 share the tokens from begin up to end; the children split them."""

    low: int
    high: int
    begin: int
    end: int
    children: tuple
    shortest: int
    longest: int


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def _build(sequences: list[np.ndarray], shared: list[int], low: int, high: int, begin: int) -> Node:
    """The node of sequences[low:high], which agree up to begin at least."""
    root = stack = None
    done: dict[tuple[int, int], Node] = {}
    # Depth first without recursion: long chains of prefixes would be too deep for it.
    stack = [(low, high, begin, None)]
    order = []
    while stack:
        lo, hi, at, _ = stack.pop()
        end = len(sequences[lo]) if hi - lo == 1 else min(min(shared[lo + 1:hi]), len(sequences[lo]))
        parts = []
        start = lo
        while hi - lo > 1 and start < hi and len(sequences[start]) == end:
            start += 1
        begin_part = start
        for i in range(start + 1, hi + 1):
            if hi - lo > 1 and (i == hi or shared[i] <= end):
                parts.append((begin_part, i, end, None))
                begin_part = i
        parts = [p for p in parts if p[0] < p[1]]
        order.append((lo, hi, at, end, parts))
        stack += parts
    for lo, hi, at, end, parts in reversed(order):
        sizes = [len(sequences[i]) for i in range(lo, hi)]
        done[lo, hi] = root = Node(
            lo, hi, at, end, tuple(done[p[0], p[1]] for p in parts), min(sizes), max(sizes))
    return root


class Forest:
    """Which indexed and searched sets are connected by the links found so far."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j


def linked(sets: list[np.ndarray], indexed: np.ndarray, searched: np.ndarray, percent: int,
           ) -> list[tuple[int, int]]:
    """Links (i, j) that connect what all pairs of a searched and an indexed set with
    100 * intersection >= percent * union connect. Sets are distinct tokens, none empty.

    Tokens are put in one order for all sets, frequent ones first, so that similar sets share long
    paths. A search carries the overlap down from node to node and leaves a subtree when the
    tokens left on either side can't make up what the smallest sequence there needs, or when all of
    it is connected to the searched set already.
    """
    everything, counts = np.unique(np.concatenate(sets), return_counts=True)
    rank = np.empty(len(everything), np.int64)
    rank[np.lexsort((everything, -counts))] = np.arange(len(everything))
    ranked = [np.sort(rank[np.searchsorted(everything, s)]) for s in sets]
    order = sorted(indexed.tolist(), key=lambda i: ranked[i].astype(">u4").tobytes())
    sequences = [ranked[i] for i in order]
    shared = [0] + [_shared(a, b) for a, b in zip(sequences[:-1], sequences[1:], strict=True)]
    root = _build(sequences, shared, 0, len(sequences), 0)
    forest, found = Forest(len(sets)), []
    has = np.zeros(len(everything), np.int64)
    for x in searched.tolist():
        own = ranked[x]
        size = len(own)
        has[:] = 0
        has[own] = 1
        up_to = np.cumsum(has)
        stack = [(root, 0)]
        while stack:
            node, overlap = stack.pop()
            if size * 100 < percent * node.shortest or node.longest * 100 < percent * size:
                continue
            mine = forest.find(x)
            if all(forest.find(order[i]) == mine for i in range(node.low, node.high)):
                continue
            path = sequences[node.low][node.begin:node.end]
            if len(path):
                overlap += int(has[path].sum())
                left = min(node.longest - node.end, size - int(up_to[path[-1]]))
            else:
                left = min(node.longest, size)
            # 100 * o >= percent * (a + b - o), for the smallest b below.
            if (overlap + left) * (100 + percent) < percent * (size + node.shortest):
                continue
            for i in range(node.low, node.high):
                if len(sequences[i]) != node.end:
                    break
                if order[i] != x and overlap * (100 + percent) >= percent * (size + node.end) \
                        and forest.join(order[i], x):
                    found.append((order[i], x))
            stack += [(child, overlap) for child in node.children]
    return found
