"""An adaptive radix tree over byte keys.

Inner nodes hold 4, 16, 48 or 256 children and grow from one layout to the
next; runs without a branch are compressed into the node below them.  Keys may
be prefixes of one another: any node can carry payloads.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Small:
    """Up to ``limit`` children by sorted branch bytes."""

    __slots__ = ("limit", "branches", "children")

    def __init__(self, limit: int = 4):
        self.limit, self.branches, self.children = limit, bytearray(), []

    def find(self, b: int):
        i = bisect_left(self.branches, b)
        return self.children[i] if i < len(self.branches) and self.branches[i] == b else None

    def replace(self, b: int, child) -> None:
        self.children[bisect_left(self.branches, b)] = child

    def full(self) -> bool:
        return len(self.children) == self.limit

    def add(self, b: int, child) -> None:
        i = bisect_left(self.branches, b)
        self.branches.insert(i, b)
        self.children.insert(i, child)

    def items(self) -> Iterator[tuple[int, object]]:
        return zip(self.branches, self.children)

    def larger(self):
        return self.moved(Small(16) if self.limit == 4 else Indexed())

    def moved(self, to):
        for b, child in self.items():
            to.add(b, child)
        return to


class Indexed:
    """Up to 48 children, found through 256 one-byte slots."""

    __slots__ = ("slots", "children")
    _NONE = 255

    def __init__(self):
        self.slots, self.children = bytearray([self._NONE]) * 256, []

    def find(self, b: int):
        i = self.slots[b]
        return None if i == self._NONE else self.children[i]

    def replace(self, b: int, child) -> None:
        self.children[self.slots[b]] = child

    def full(self) -> bool:
        return len(self.children) == 48

    def add(self, b: int, child) -> None:
        self.slots[b] = len(self.children)
        self.children.append(child)

    def items(self) -> Iterator[tuple[int, object]]:
        return ((b, self.children[i]) for b, i in enumerate(self.slots) if i != self._NONE)

    def larger(self):
        return Small.moved(self, Direct())


class Direct:
    """One place for each of 256 branches."""

    __slots__ = ("children",)

    def __init__(self):
        self.children: list = [None] * 256

    def find(self, b: int):
        return self.children[b]

    def add(self, b: int, child) -> None:
        self.children[b] = child

    replace = add

    def full(self) -> bool:
        return False

    def items(self) -> Iterator[tuple[int, object]]:
        return ((b, c) for b, c in enumerate(self.children) if c is not None)


class Node:
    """``prefix``: the bytes after the branch byte that led here; ``below``: the
    children's layout or None; ``payloads`` of the key that ends here; ``sample``:
    what any key through this node brought along."""

    __slots__ = ("prefix", "below", "payloads", "sample")

    def __init__(self, prefix: bytes, sample):
        self.prefix, self.below, self.payloads, self.sample = prefix, None, [], sample

    def child(self, b: int):
        return self.below.find(b) if self.below is not None else None

    def attach(self, b: int, node: Node) -> None:
        if self.below is None:
            self.below = Small()
        elif self.below.full():
            self.below = self.below.larger()
        self.below.add(b, node)

    def items(self):
        return self.below.items() if self.below is not None else iter(())


def agreement(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    differ = int.from_bytes(a) ^ int.from_bytes(b)
    return n - (differ.bit_length() + 7) // 8


class Tree:
    def __init__(self, sample=None):
        self.root = Node(b"", sample)

    def insert(self, key: bytes, payload, sample=None) -> None:
        node, parent, branch, at = self.root, None, 0, 0
        while True:
            if not key.startswith(node.prefix, at):
                # split the compressed run where the key leaves it
                m = agreement(node.prefix, key[at:at + len(node.prefix)])
                upper = Node(node.prefix[:m], node.sample)
                upper.attach(node.prefix[m], node)
                node.prefix = node.prefix[m + 1:]
                if parent is None:
                    self.root = upper
                else:
                    parent.below.replace(branch, upper)
                node = upper
            at += len(node.prefix)
            if at == len(key):
                node.payloads.append(payload)
                return
            below = node.child(key[at])
            if below is None:
                leaf = Node(key[at + 1:], sample)
                leaf.payloads.append(payload)
                node.attach(key[at], leaf)
                return
            parent, branch, node, at = node, key[at], below, at + 1

    def path(self, key: bytes) -> list[Node]:
        """The nodes that an inserted key goes through."""
        node, at, out = self.root, 0, []
        while True:
            out.append(node)
            at += len(node.prefix)
            if at == len(key):
                return out
            node, at = node.child(key[at]), at + 1
