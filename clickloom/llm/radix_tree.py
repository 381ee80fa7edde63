"""An adaptive radix tree over byte strings: inner nodes of 4, 16, 48 or 256 places, with path compression.

Keys need no end mark: a node holds the value of the key that ends in it. A leaf is a node without places.
"""

from __future__ import annotations

from bisect import bisect_left


class Sorted:
    """Up to `room` children in order of their byte."""

    __slots__ = ("room", "keys", "kids")

    def __init__(self, room: int, keys=b"", kids=()):
        self.room, self.keys, self.kids = room, bytearray(keys), list(kids)

    def get(self, byte: int):
        i = bisect_left(self.keys, byte)
        return self.kids[i] if i < len(self.keys) and self.keys[i] == byte else None

    def put(self, byte: int, kid):
        """The layout that holds the child too: this one, or the next larger."""
        i = bisect_left(self.keys, byte)
        if i < len(self.keys) and self.keys[i] == byte:
            self.kids[i] = kid
            return self
        if len(self.keys) == self.room:
            larger = Sorted(16, self.keys, self.kids) if self.room == 4 else Indexed(self.keys, self.kids)
            return larger.put(byte, kid)
        self.keys.insert(i, byte)
        self.kids.insert(i, kid)
        return self

    def children(self):
        return self.kids


class Indexed:
    """Up to 48 children behind an index of 256 bytes."""

    __slots__ = ("index", "kids")

    def __init__(self, keys, kids):
        self.index, self.kids = bytearray(b"\xff" * 256), list(kids)
        for i, byte in enumerate(keys):
            self.index[byte] = i

    def get(self, byte: int):
        i = self.index[byte]
        return None if i == 255 else self.kids[i]

    def put(self, byte: int, kid):
        i = self.index[byte]
        if i != 255:
            self.kids[i] = kid
            return self
        if len(self.kids) == 48:
            return Direct(self).put(byte, kid)
        self.index[byte] = len(self.kids)
        self.kids.append(kid)
        return self

    def children(self):
        return [self.kids[i] for i in self.index if i != 255]


class Direct:
    """A place for every byte."""

    __slots__ = ("kids",)

    def __init__(self, smaller: Indexed):
        self.kids = [smaller.get(byte) for byte in range(256)]

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid):
        self.kids[byte] = kid
        return self

    def children(self):
        return [kid for kid in self.kids if kid is not None]


class Node:
    __slots__ = ("path", "value", "places")

    def __init__(self, path: bytes, value=None):
        self.path, self.value, self.places = path, value, None

    def get(self, byte: int):
        return self.places.get(byte) if self.places is not None else None

    def put(self, byte: int, kid: Node) -> None:
        self.places = (self.places or Sorted(4)).put(byte, kid)

    def children(self):
        return self.places.children() if self.places is not None else ()


def common(a: bytes, b: bytes) -> int:
    """How many first bytes are equal."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class Tree:
    def __init__(self):
        self.root = None

    def insert(self, key: bytes, value) -> None:
        """Keys are distinct; values are not None."""
        if self.root is None:
            self.root = Node(key, value)
            return
        node, above, at = self.root, None, 0
        while True:
            rest = key[at:at + len(node.path)]
            if rest != node.path:
                break
            at += len(node.path)
            if at == len(key):
                node.value = value
                return
            kid = node.get(key[at])
            if kid is None:
                node.put(key[at], Node(key[at + 1:], value))
                return
            above, node, at = (node, key[at]), kid, at + 1
        # The path is cut where the key leaves it; a new node takes its first part.
        n = common(node.path, rest)
        upper = Node(node.path[:n])
        upper.put(node.path[n], node)
        node.path = node.path[n + 1:]
        if at + n == len(key):
            upper.value = value
        else:
            upper.put(key[at + n], Node(key[at + n + 1:], value))
        if above is None:
            self.root = upper
        else:
            above[0].put(above[1], upper)

    def path(self, key: bytes) -> list[Node]:
        """The nodes from the root to the one in which a stored key ends."""
        found, node, at = [self.root], self.root, len(self.root.path)
        while at < len(key):
            node = node.get(key[at])
            found.append(node)
            at += 1 + len(node.path)
        return found
