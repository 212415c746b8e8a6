"""An adaptive radix tree over byte strings: nodes of 4, 16, 48 or 256 children, with compressed paths."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Node:
    """A path of bytes, the children after it by their first byte, and the values of keys that end after the path.

    The layout grows with the children: up to 4 and up to 16 sorted bytes beside their children, up to 48 children
    behind a table of 256 slots, and a plain table of 256 children.
    """

    __slots__ = ("path", "layout", "keys", "children", "values")

    def __init__(self, path: bytes):
        self.path, self.layout, self.keys, self.children, self.values = path, 4, bytearray(), [], []

    def find(self, byte: int) -> Node | None:
        if self.layout <= 16:
            k = bisect_left(self.keys, byte)
            return self.children[k] if k < len(self.keys) and self.keys[k] == byte else None
        if self.layout == 48:
            slot = self.keys[byte]
            return self.children[slot - 1] if slot else None
        return self.children[byte]

    def add(self, byte: int, child: Node) -> None:
        """Adds a child under a byte that has none yet."""
        if self.layout <= 16 and len(self.keys) == self.layout:
            self._grow()
        elif self.layout == 48 and len(self.children) == 48:
            self._grow()
        if self.layout <= 16:
            k = bisect_left(self.keys, byte)
            self.keys.insert(k, byte)
            self.children.insert(k, child)
        elif self.layout == 48:
            self.children.append(child)
            self.keys[byte] = len(self.children)
        else:
            self.children[byte] = child

    def replace(self, byte: int, child: Node) -> None:
        """Puts another child where the byte has one."""
        if self.layout <= 16:
            self.children[bisect_left(self.keys, byte)] = child
        elif self.layout == 48:
            self.children[self.keys[byte] - 1] = child
        else:
            self.children[byte] = child

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            slots = bytearray(256)
            for k, byte in enumerate(self.keys):
                slots[byte] = k + 1
            self.layout, self.keys = 48, slots
        else:
            table = [None] * 256
            for byte, slot in enumerate(self.keys):
                if slot:
                    table[byte] = self.children[slot - 1]
            self.layout, self.keys, self.children = 256, bytearray(), table

    def each(self) -> Iterator[Node]:
        return (c for c in self.children if c is not None)


class RadixTree:
    """Keys may repeat and may start with one another; a key's values stay in order of insertion."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        parent, node, at = None, self.root, 0
        while True:
            path = node.path
            if not key.startswith(path, at):
                same = next(k for k in range(len(path)) if at + k >= len(key) or key[at + k] != path[k])
                upper = Node(path[:same])
                upper.add(path[same], node)
                node.path = path[same + 1:]
                if parent is None:
                    self.root = upper
                else:
                    parent.replace(key[at - 1], upper)
                node, path = upper, upper.path
            at += len(path)
            if at == len(key):
                node.values.append(value)
                return
            child = node.find(key[at])
            if child is None:
                child = Node(key[at + 1:])
                child.values.append(value)
                node.add(key[at], child)
                return
            parent, node, at = node, child, at + 1

    def nodes(self) -> list[tuple[Node, int, int]]:
        """(node, index of its parent or -1, length of the keys that end there), parents before children."""
        found = [(self.root, -1, len(self.root.path))]
        for k, (node, _, end) in enumerate(found):  # the list grows while it is read
            found += [(child, k, end + 1 + len(child.path)) for child in node.each()]
        return found
