"""BK-tree over 64-bit fingerprints."""

from __future__ import annotations

from collections.abc import Iterator


class BKTree:
    """Children are keyed by their integer Hamming distance to the parent.

    What lies within ``radius`` of a query can only be below edges whose distance differs from that
    of the parent by at most the radius, so no other edge is followed.
    """

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        at, children = self.root
        while distance := (at ^ value).bit_count():
            if distance not in children:
                children[distance] = (value, {})
                return
            at, children = children[distance]

    def within(self, value: int, radius: int) -> Iterator[int]:
        stack = [self.root] if self.root else []
        while stack:
            at, children = stack.pop()
            distance = (at ^ value).bit_count()
            if distance <= radius:
                yield at
            for edge, child in children.items():
                if distance - radius <= edge <= distance + radius:
                    stack.append(child)
