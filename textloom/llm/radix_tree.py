"""An adaptive radix tree over byte strings: nodes of four sizes that grow, and compressed paths.

Keys are whole numbers of fixed-width ids, written big-endian, so the order of
bytes is the order of ids. A key may be the beginning of another.
"""

from __future__ import annotations

from bisect import bisect_left
from typing import NamedTuple


class SortedKeys:
    """Up to ``capacity`` children beside their sorted key bytes: the two smallest layouts."""

    __slots__ = ("capacity", "children", "keys")

    def __init__(self, capacity: int, keys=(), children=()):
        self.capacity, self.keys, self.children = capacity, bytearray(keys), list(children)

    def get(self, byte: int):
        at = self.keys.find(byte)
        return None if at < 0 else self.children[at]

    def put(self, byte: int, child) -> bool:
        """Sets a child; false if there is no room for another one."""
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.children[at] = child
            return True
        if len(self.keys) == self.capacity:
            return False
        self.keys.insert(at, byte)
        self.children.insert(at, child)
        return True

    def items(self):
        return zip(self.keys, self.children)

    def grown(self):
        return SortedKeys(16, self.keys, self.children) if self.capacity < 16 else Indexed(self.items())


class Indexed:
    """Up to 48 children, found through one index byte per key."""

    __slots__ = ("children", "index")
    CAPACITY = 48
    NONE = 255

    def __init__(self, items=()):
        self.index, self.children = bytearray([self.NONE] * 256), []
        for byte, child in items:
            self.put(byte, child)

    def get(self, byte: int):
        at = self.index[byte]
        return None if at == self.NONE else self.children[at]

    def put(self, byte: int, child) -> bool:
        at = self.index[byte]
        if at != self.NONE:
            self.children[at] = child
            return True
        if len(self.children) == self.CAPACITY:
            return False
        self.index[byte] = len(self.children)
        self.children.append(child)
        return True

    def items(self):
        return ((byte, self.children[at]) for byte, at in enumerate(self.index) if at != self.NONE)

    def grown(self):
        return Full(self.items())


class Full:
    """A place for each of the 256 bytes."""

    __slots__ = ("children",)

    def __init__(self, items=()):
        self.children = [None] * 256
        for byte, child in items:
            self.children[byte] = child

    def get(self, byte: int):
        return self.children[byte]

    def put(self, byte: int, child) -> bool:
        self.children[byte] = child
        return True

    def items(self):
        return ((byte, child) for byte, child in enumerate(self.children) if child is not None)


class Node:
    """A branching of the tree, or the end of a key; ``prefix`` are the bytes skipped before it."""

    __slots__ = ("count", "ends", "layout", "low", "prefix")

    def __init__(self, prefix: bytes, count: int, low):
        self.prefix, self.count, self.low = prefix, count, low
        self.layout, self.ends = None, None

    def child(self, byte: int):
        return None if self.layout is None else self.layout.get(byte)

    def put(self, byte: int, child: Node) -> None:
        if self.layout is None:
            self.layout = SortedKeys(4)
        if not self.layout.put(byte, child):
            self.layout = self.layout.grown()
            self.layout.put(byte, child)

    def items(self):
        return () if self.layout is None else self.layout.items()


class Visit(NamedTuple):
    """A stop of the walk: a prefix of whole ids that some key has."""

    depth: int  # in ids
    last: bytes  # its last id
    count: int
    low: int
    ends: list | None  # members whose key ends here
    parent: int  # number of the stop one id above, in the order of the walk


def _common(prefix: bytes, key: bytes, at: int) -> int:
    """How many bytes of ``prefix`` stand in ``key`` from ``at``."""
    if key.startswith(prefix, at):
        return len(prefix)
    n = min(len(prefix), len(key) - at)
    lo = 0
    while lo < n:  # halves that are equal are skipped
        half = (lo + n + 1) // 2
        if prefix[lo:half] == key[at + lo : at + half]:
            lo = half
        else:
            n = half - 1
    return lo


class RadixTree:
    """Members (numbers) by key; every node knows how many members its subtree has and the smallest."""

    def __init__(self, width: int):
        self.width, self.root = width, None

    def insert(self, key: bytes, member: int) -> None:
        if len(key) % self.width:
            raise ValueError(f"a key of {len(key)} bytes is no whole number of ids of {self.width}")
        if self.root is None:
            self.root = Node(b"", 0, member)
        node, at = self.root, 0
        while True:
            shared = _common(node.prefix, key, at)
            if shared < len(node.prefix):
                self._split(node, shared)
            at += shared
            node.count += 1
            node.low = min(node.low, member)
            if at == len(key):
                if node.ends is None:
                    node.ends = []
                node.ends.append(member)
                return
            below = node.child(key[at])
            if below is None:
                leaf = Node(key[at + 1 :], 1, member)
                leaf.ends = [member]
                node.put(key[at], leaf)
                return
            node, at = below, at + 1

    @staticmethod
    def _split(node: Node, shared: int) -> None:
        """Puts a branching before the byte at which ``node``'s prefix ends to be shared."""
        rest = Node(node.prefix[shared + 1 :], node.count, node.low)
        rest.layout, rest.ends = node.layout, node.ends
        byte, node.prefix = node.prefix[shared], node.prefix[:shared]
        node.layout, node.ends = None, None
        node.put(byte, rest)

    def walk(self):
        """All prefixes of whole ids, parents first, in the order of ids; bytes between ids make no stop.

        A compressed path that runs over several ids makes a stop for each: they
        all have the members of the node below.
        """
        if self.root is None:
            return
        width, number = self.width, -1
        stack = [(self.root, b"", b"", -1, 0)]  # node, edge byte, bytes since the last whole id, stop above, depth
        while stack:
            node, byte, pending, above, depth = stack.pop()
            path = pending + byte + node.prefix
            whole = len(path) // width
            if above < 0:
                number += 1
                yield Visit(0, b"", node.count, node.low, node.ends if not path else None, -1)
                above = number
            for i in range(whole):
                depth, number = depth + 1, number + 1
                end = (i + 1) * width
                ends = node.ends if end == len(path) else None
                yield Visit(depth, path[end - width : end], node.count, node.low, ends, above)
                above = number
            rest = path[whole * width :]
            for key, child in reversed(list(node.items())):
                stack.append((child, bytes([key]), rest, above, depth))
