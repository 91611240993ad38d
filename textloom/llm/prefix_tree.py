"""A prefix tree of sorted sets, searched for sets of high Jaccard similarity.

A node holds a run of elements that all sets below it have in the same place, so
what a searching set shares with the run is counted once for all of them.
"""

from __future__ import annotations

import numpy as np


class Groups:
    """Union-find over positions of a list."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def union(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)


class Node:
    __slots__ = ("run", "children", "sets", "smallest", "deepest", "member", "one_group")

    def __init__(self, run: np.ndarray, member: int, size: int, deepest: int):
        self.run = run
        self.children: dict[int, Node] = {}
        self.sets: list[int] = []
        self.smallest = size  # of the set sizes below
        self.deepest = deepest  # most elements of a set below, after this run
        self.member = member
        self.one_group = True


class PrefixTree:
    """Sets are ascending arrays of positions in the global order; ``sizes`` also count elements held by one set only."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, percent: int, vocabulary: int):
        self.sets, self.sizes, self.percent = sets, sizes, percent
        self.groups = Groups(len(sets))
        self.root = Node(np.empty(0, np.int64), -1, 1 << 60, 0)
        self.mark = np.zeros(vocabulary, dtype=bool)

    def insert(self, i: int) -> None:
        rest, size, node = self.sets[i], int(self.sizes[i]), self.root
        while True:
            node.smallest = min(node.smallest, size)
            node.deepest = max(node.deepest, len(rest))
            if node.member < 0:
                node.member = i
            elif node.one_group:
                node.one_group = self.groups.find(node.member) == self.groups.find(i)
            if not len(rest):
                node.sets.append(i)
                return
            child = node.children.get(int(rest[0]))
            if child is None:
                child = Node(rest, i, size, 0)
                child.sets.append(i)
                node.children[int(rest[0])] = child
                return
            n = min(len(child.run), len(rest))
            differ = np.flatnonzero(child.run[:n] != rest[:n])
            shared = int(differ[0]) if len(differ) else n
            if shared < len(child.run):
                upper = Node(child.run[:shared], child.member, child.smallest, child.deepest + len(child.run) - shared)
                upper.one_group = child.one_group
                child.run = child.run[shared:]
                upper.children[int(child.run[0])] = child
                node.children[int(rest[0])] = upper
                child = upper
            node, rest = child, rest[shared:]

    def search(self, i: int) -> None:
        """Join set ``i`` with every group in the tree that holds a similar set.

        Subtrees in which all sets are in its group already are passed over, as
        are those where not even all remaining elements would suffice.
        """
        own, size, percent, groups = self.sets[i], int(self.sizes[i]), self.percent, self.groups
        self.mark[own] = True
        stack = [(self.root, 0)]
        while stack:
            node, shared = stack.pop()
            if node.member < 0 or (node.one_group and groups.find(node.member) == groups.find(i)):
                continue
            rest = len(own)
            if len(node.run):
                shared += int(np.count_nonzero(self.mark[node.run]))
                rest -= int(np.searchsorted(own, node.run[-1], side="right"))
            # 100 * inter >= percent * (size + other - inter), at the smallest size that can still be a partner
            other = max(node.smallest, -(-percent * size // 100))
            if (100 + percent) * (shared + min(rest, node.deepest)) < percent * (size + other):
                continue
            for j in node.sets:
                if (100 + percent) * shared >= percent * (size + int(self.sizes[j])):
                    groups.union(i, j)
            stack.extend((child, shared) for child in node.children.values())
        self.mark[own] = False


def similar_groups(tokens: list[np.ndarray], sizes: np.ndarray, percent: int) -> Groups:
    """Groups of sets that links of a Jaccard similarity of at least ``percent`` connect."""
    tree = _tree(tokens, sizes, percent)
    for i in np.argsort(sizes, kind="stable").tolist():
        tree.search(i)
        tree.insert(i)
    return tree.groups


def links_between(
    tokens: list[np.ndarray], sizes: np.ndarray, percent: int, labels: np.ndarray, strays: np.ndarray
) -> Groups:
    """The same, where sets of one label are known to be connected and only those marked in ``strays`` search."""
    tree = _tree(tokens, sizes, percent)
    first: dict[int, int] = {}
    for i, label in enumerate(labels.tolist()):
        tree.groups.union(first.setdefault(label, i), i)
    for i in np.flatnonzero(~strays).tolist():
        tree.insert(i)
    for i in np.flatnonzero(strays).tolist():
        tree.search(i)
        tree.insert(i)
    return tree.groups


def _tree(tokens: list[np.ndarray], sizes: np.ndarray, percent: int) -> PrefixTree:
    values = np.unique(np.concatenate(tokens))
    return PrefixTree([np.searchsorted(values, t) for t in tokens], sizes, percent, len(values))
