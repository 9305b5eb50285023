"""Adaptive radix tree over byte strings.

An inner node has one of four layouts by its number of children: sorted key
bytes beside a child list (up to 4, up to 16), an index of 256 bytes into a
child list (up to 48), or 256 child slots. A node grows into the next layout
when it is full. ``path`` holds the bytes that every key below a node shares
after the byte that leads to it (path compression); a key may end at a node
that has children.
"""

from __future__ import annotations

from bisect import bisect_left

NOTHING = 255


class Sorted:
    """Layout of few children: sorted key bytes beside the children."""

    __slots__ = ("bytes", "kids", "limit")

    def __init__(self, limit: int = 4):
        self.bytes, self.kids, self.limit = bytearray(), [], limit

    def get(self, b: int):
        at = bisect_left(self.bytes, b)
        return self.kids[at] if at < len(self.bytes) and self.bytes[at] == b else None

    def put(self, b: int, kid) -> "Sorted | Indexed":
        at = bisect_left(self.bytes, b)
        if at < len(self.bytes) and self.bytes[at] == b:
            self.kids[at] = kid
            return self
        if len(self.kids) == self.limit:
            grown = Sorted(16) if self.limit == 4 else Indexed()
            for c, k in self.items():
                grown.put(c, k)
            return grown.put(b, kid)
        self.bytes.insert(at, b)
        self.kids.insert(at, kid)
        return self

    def items(self):
        return zip(self.bytes, self.kids)


class Indexed:
    """Layout of up to 48 children: 256 places, each the number of a child."""

    __slots__ = ("places", "kids")

    def __init__(self):
        self.places, self.kids = bytearray([NOTHING]) * 256, []

    def get(self, b: int):
        at = self.places[b]
        return None if at == NOTHING else self.kids[at]

    def put(self, b: int, kid) -> "Indexed | Direct":
        at = self.places[b]
        if at != NOTHING:
            self.kids[at] = kid
            return self
        if len(self.kids) == 48:
            grown = Direct()
            for c, k in self.items():
                grown.put(c, k)
            return grown.put(b, kid)
        self.places[b] = len(self.kids)
        self.kids.append(kid)
        return self

    def items(self):
        return ((b, self.kids[at]) for b, at in enumerate(self.places) if at != NOTHING)


class Direct:
    """Layout of any number of children: one slot for each byte."""

    __slots__ = ("slots",)

    def __init__(self):
        self.slots = [None] * 256

    def get(self, b: int):
        return self.slots[b]

    def put(self, b: int, kid) -> "Direct":
        self.slots[b] = kid
        return self

    def items(self):
        return ((b, k) for b, k in enumerate(self.slots) if k is not None)


class Node:
    __slots__ = ("path", "layout", "value")

    def __init__(self, path: bytes, value=None):
        self.path, self.layout, self.value = path, None, value

    def put(self, b: int, kid: "Node") -> None:
        self.layout = (self.layout or Sorted()).put(b, kid)

    def children(self):
        return self.layout.items() if self.layout is not None else ()


class RadixTree:
    """Keys of any length with one value each; the root's path may be longer
    than nothing when all keys share a beginning."""

    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, value) -> None:
        if self.root is None:
            self.root = Node(key, value)
            return
        parent, lead, node, at = None, 0, self.root, 0
        while True:
            path = node.path
            same = _common(path, key, at)
            if same < len(path):                     # the key leaves inside the path: split it
                top = Node(path[:same])
                top.put(path[same], node)
                node.path = path[same + 1:]
                if parent is None:
                    self.root = top
                else:
                    parent.put(lead, top)
                node = top
            at += same
            if at == len(key):
                node.value = value
                return
            kid = node.layout.get(key[at]) if node.layout is not None else None
            if kid is None:
                node.put(key[at], Node(key[at + 1:], value))
                return
            parent, lead, node, at = node, key[at], kid, at + 1

    def get(self, key: bytes):
        node, at = self.root, 0
        while node is not None:
            if not key.startswith(node.path, at):
                return None
            at += len(node.path)
            if at == len(key):
                return node.value
            node, at = (node.layout.get(key[at]) if node.layout is not None else None), at + 1
        return None


def _common(path: bytes, key: bytes, at: int) -> int:
    """Bytes of ``path`` that ``key`` has from ``at`` on."""
    if key.startswith(path, at):
        return len(path)
    low, high = 0, min(len(path), len(key) - at)
    while low < high:                                # the first ``low`` bytes agree
        mid = (low + high + 1) // 2
        if key.startswith(path[:mid], at):
            low = mid
        else:
            high = mid - 1
    return low
