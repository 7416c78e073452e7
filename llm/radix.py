"""An adaptive radix tree over byte keys, and what it says about the turns that the keys spell.

Inner nodes come in four layouts, for up to 4, 16, 48 and 256 children, and grow from one to the next.
Bytes that all keys below a node share are kept with the node (path compression). A key may end
where another goes on.
"""

from __future__ import annotations


class Sorted:
    """Up to 4, then up to 16 children: their bytes in order, and the children beside them."""

    __slots__ = ("prefix", "value", "bytes", "kids", "room")

    def __init__(self, prefix: bytes = b"", value=None, room: int = 4):
        self.prefix, self.value, self.bytes, self.kids, self.room = prefix, value, bytearray(), [], room

    def find(self, byte: int):
        at = self.bytes.find(byte)
        return None if at < 0 else self.kids[at]

    def put(self, byte: int, kid):
        """Sets a child; returns the node to use from now on."""
        at = self.bytes.find(byte)
        if at >= 0:
            self.kids[at] = kid
            return self
        if len(self.kids) == self.room:
            return self.grown().put(byte, kid)
        at = sum(b < byte for b in self.bytes)
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def grown(self):
        node = Sorted(self.prefix, self.value, 16) if self.room == 4 else Indexed(self.prefix, self.value)
        for byte, kid in self.children():
            node.put(byte, kid)
        return node

    def children(self):
        return zip(self.bytes, self.kids)


class Indexed:
    """Up to 48 children: a slot number for each byte."""

    __slots__ = ("prefix", "value", "slot", "kids")
    NONE = 255

    def __init__(self, prefix: bytes = b"", value=None):
        self.prefix, self.value, self.slot, self.kids = prefix, value, bytearray([self.NONE]) * 256, []

    def find(self, byte: int):
        at = self.slot[byte]
        return None if at == self.NONE else self.kids[at]

    def put(self, byte: int, kid):
        at = self.slot[byte]
        if at != self.NONE:
            self.kids[at] = kid
        elif len(self.kids) == 48:
            node = Direct(self.prefix, self.value)
            for b, k in self.children():
                node.put(b, k)
            return node.put(byte, kid)
        else:
            self.slot[byte] = len(self.kids)
            self.kids.append(kid)
        return self

    def children(self):
        return ((b, self.kids[s]) for b, s in enumerate(self.slot) if s != self.NONE)


class Direct:
    """A child for each byte."""

    __slots__ = ("prefix", "value", "kids")

    def __init__(self, prefix: bytes = b"", value=None):
        self.prefix, self.value, self.kids = prefix, value, [None] * 256

    def find(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid):
        self.kids[byte] = kid
        return self

    def children(self):
        return ((b, k) for b, k in enumerate(self.kids) if k is not None)


def shared(a: bytes, b: bytes) -> int:
    """Length of the common start."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while lo + 1 < hi:  # a[:lo] is shared, a[:hi] is not
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def insert(root, key: bytes, value):
    """Adds a key that is not in the tree yet; returns the root to use from now on."""
    if root is None:
        return Sorted(key, value)
    above, node, at = None, root, 0
    edge = 0

    def hang(new):
        nonlocal root
        if above is None:
            root = new
        else:
            above.put(edge, new)

    while True:
        same = shared(node.prefix, key[at : at + len(node.prefix)])
        if same < len(node.prefix):  # the path parts inside the shared bytes
            fork = Sorted(node.prefix[:same])
            fork.put(node.prefix[same], node)
            node.prefix = node.prefix[same + 1 :]
            at += same
            if at == len(key):
                fork.value = value
            else:
                fork.put(key[at], Sorted(key[at + 1 :], value))
            hang(fork)
            return root
        at += same
        if at == len(key):
            node.value = value
            return root
        kid = node.find(key[at])
        if kid is None:
            new = node.put(key[at], Sorted(key[at + 1 :], value))
            if new is not node:
                hang(new)
            return root
        above, edge, node, at = node, key[at], kid, at + 1


def walk(root, width: int):
    """Yields (bytes from the top, value, number of the node above, first and last position of an aligned node) bottom up.

    Positions are byte depths; a node covers those after the bottom of the node above it, up to its own
    bottom. Only multiples of ``width`` are aligned. Children come before the node above them, and
    nodes are numbered so that the node above has the smaller number.
    """
    order, stack = [], [(root, -1, 0)]
    while stack:
        node, above, top = stack.pop()
        bottom = top + len(node.prefix)
        mine = len(order)
        # The edge's byte belongs to this node, so an aligned position ``top`` is its own; position 0 is the root's.
        order.append((node.value, above, top, bottom))
        stack.extend((kid, mine, bottom + 1) for _, kid in reversed(list(node.children())))
    for mine in range(len(order) - 1, -1, -1):
        value, above, top, bottom = order[mine]
        yield mine, value, above, bottom // width * width, -(-top // width) * width
