"""An FM-index over word ids that is extended at both ends, for n-grams of a bounded length."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np

# The id that parts pieces; no n-gram holds it.
GAP = 0


def _dense(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    ranks = np.empty(len(keys), dtype=np.int64)
    ranks[order] = np.cumsum(np.append(False, np.diff(keys[order]) != 0))
    return ranks


def suffix_order(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``ids`` in the order of the ``depth`` symbols that start there."""
    size = int(ids.max(initial=0)) + 1
    keys, most = ids.astype(np.int64), size
    for step in range(1, depth):
        if most * size >= 1 << 63:
            keys = _dense(keys)
            most = int(keys.max()) + 1
        following = np.zeros(len(ids), dtype=np.int64)
        following[:-step] = ids[step:]
        keys = keys * size + following
        most *= size
    return np.argsort(keys, kind="stable")


class Side:
    """The Burrows-Wheeler transform of one direction, its suffixes ordered to a bounded depth."""

    def __init__(self, ids: np.ndarray, depth: int):
        order = suffix_order(ids, depth)
        self.bwt = np.where(order > 0, ids[order - 1], GAP)

    @cached_property
    def step(self) -> np.ndarray:
        """Where the suffix stands that is one symbol longer than the one at each place (LF)."""
        out = np.empty(len(self.bwt), dtype=np.int64)
        out[np.argsort(self.bwt, kind="stable")] = np.arange(len(self.bwt))
        return out

    @cached_property
    def followed(self) -> np.ndarray:
        """How many of the places before each have a symbol, not a gap, to extend with."""
        return np.append(0, np.cumsum(self.bwt != GAP))


@dataclass(frozen=True)
class Ngrams:
    """N-grams of one length: a row of ids each, and where they stand in either order.

    ``left`` and ``right`` count the occurrences with a word of the same piece beside them.
    """

    words: np.ndarray
    count: np.ndarray
    left: np.ndarray
    right: np.ndarray
    forward: np.ndarray
    backward: np.ndarray


class FMIndex:
    """``ids`` begins and ends with ``GAP``."""

    def __init__(self, ids: np.ndarray, longest: int):
        self.longest = longest
        self.forward, self.backward = Side(ids, longest), Side(ids[::-1], longest)
        self.sizes = np.bincount(ids)

    def _made(self, words, count, forward, backward) -> Ngrams:
        beside = lambda side, at: side.followed[at + count] - side.followed[at]
        return Ngrams(words, count, beside(self.forward, forward), beside(self.backward, backward), forward, backward)

    def words(self) -> Ngrams:
        at = np.cumsum(self.sizes) - self.sizes
        ids = np.flatnonzero(self.sizes)
        ids = ids[ids != GAP]
        return self._made(ids[:, None], self.sizes[ids], at[ids], at[ids])

    def extend(self, ngrams: Ngrams, left: bool) -> Ngrams:
        """Every n-gram with each of the words that stand before (``left``) or after it.

        Backward search for all intervals at once: the symbols of an interval, sorted, are its
        extensions; the step from the first of each gives the interval in this side's order, and
        the number of lesser symbols gives it in the other's, since that sorts by them.
        """
        side = self.forward if left else self.backward
        own, other = (ngrams.forward, ngrams.backward) if left else (ngrams.backward, ngrams.forward)
        ends = np.cumsum(ngrams.count)
        parent = np.repeat(np.arange(len(own)), ngrams.count)
        within = np.arange(len(parent)) - np.repeat(ends - ngrams.count, ngrams.count)
        place = own[parent] + within
        symbol = side.bwt[place]
        keys = parent * len(self.sizes) + symbol
        order = np.argsort(keys, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0)[:len(keys)])
        count = np.diff(np.append(starts, len(keys)))
        first, lesser = place[order[starts]], within[starts]
        parent, symbol = parent[order[starts]], symbol[order[starts]]
        real = symbol != GAP
        first, lesser, parent, symbol, count = (x[real] for x in (first, lesser, parent, symbol, count))
        at, beyond = side.step[first], other[parent] + lesser
        row = ngrams.words[parent]
        if left:
            return self._made(np.column_stack([symbol, row]), count, at, beyond)
        return self._made(np.column_stack([row, symbol]), count, beyond, at)

    def enumerate(self) -> Iterator[Ngrams]:
        """All n-grams of each length up to ``longest``, extended at either end in turn."""
        ngrams = self.words()
        yield ngrams
        for length in range(2, self.longest + 1):
            ngrams = self.extend(ngrams, left=length % 2 == 0)
            yield ngrams
