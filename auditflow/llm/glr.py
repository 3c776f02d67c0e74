"""Least-cost repair of a sequence of symbols by a generalised LR parser with edits."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

# Letters of an audit.
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
# A symbol that has to be deleted; upper-case symbols are truncated.
GONE = "d"

# The role grammar: an optional system turn, then user and assistant in turn; or nothing at all.
ROLES = {"C": ((), ("T",), ("s", "T")), "T": (("P",), ("T", "P")), "P": (("u", "a"),)}

Best = tuple[int, str]


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3


class Stack:
    """A node of the graph-structured stack: an LR state above another node.

    There is one node for each pair of a state and the node below, so stacks share what is below
    and equal tops are the same node.
    """

    __slots__ = ("state", "below", "number", "reached", "above")

    def __init__(self, state: int, below: Stack | None, number: int):
        self.state, self.below, self.number = state, below, number
        self.above: dict[int, Stack] = {}
        self.reached: dict[str, tuple[Stack, ...]] = {}


class Repairer:
    """Repairs symbol sequences to sentences of ``grammar`` with the edits of ``costs``.

    ``insertable`` symbols can be put in anywhere and any symbol can be made one of them. All stacks
    are carried along together; where two become equal the lesser of (cost, audit) stays. Two audits
    of equal cost for the same rows never begin one another (the longer one would hold an insertion
    more), so what is least up to a row stays least whatever follows. Grammars whose stacks grow
    without bound (by recursion in the middle or on the right) are refused.
    """

    MOST_TOPS = 1_000

    def __init__(self, grammar=ROLES, start: str = "C", insertable: str = "ua", costs: Costs = Costs()):
        self.grammar, self.insertable, self.costs = grammar, insertable, costs
        self._states: dict[frozenset, int] = {}
        self._items: list[list] = []
        first = self._state({("", (start,), 0)})
        self._nodes: list[Stack] = []
        self.root = self._push(None, first)
        self._done = ("", (start,), 1)
        self.origin = {node.number: (0, "") for node in self._reduced([self.root])}
        self.starts = self._starts()

    def _state(self, kernel: set) -> int:
        items, open_items = set(kernel), list(kernel)
        while open_items:
            _, right, dot = open_items.pop()
            for rule in self.grammar.get(right[dot], ()) if dot < len(right) else ():
                if (item := (right[dot], rule, 0)) not in items:
                    items.add(item)
                    open_items.append(item)
        key = frozenset(items)
        if key not in self._states:
            self._states[key] = len(self._items)
            self._items.append(sorted(items))
        return self._states[key]

    @lru_cache(maxsize=None)  # noqa: B019
    def _goto(self, state: int, symbol: str) -> int | None:
        kernel = {(lhs, right, dot + 1) for lhs, right, dot in self._items[state] if right[dot:dot + 1] == (symbol,)}
        return self._state(kernel) if kernel else None

    def _push(self, below: Stack | None, state: int) -> Stack:
        known = below.above if below else {}
        if state not in known:
            known[state] = Stack(state, below, len(self._nodes))
            self._nodes.append(known[state])
        return known[state]

    def _reduced(self, nodes: Iterable[Stack]) -> tuple[Stack, ...]:
        """The nodes and all that reductions make of them."""
        out, queue = dict.fromkeys(nodes), list(nodes)
        while queue:
            node = queue.pop()
            for left, right, dot in self._items[node.state]:
                if left and dot == len(right):
                    base = node
                    for _ in right:
                        base = base.below
                    made = self._push(base, self._goto(base.state, left))
                    if made not in out:
                        out[made] = None
                        queue.append(made)
        return tuple(out)

    def _shifted(self, node: Stack, symbol: str) -> tuple[Stack, ...]:
        if symbol not in node.reached:
            state = self._goto(node.state, symbol)
            node.reached[symbol] = () if state is None else self._reduced([self._push(node, state)])
        return node.reached[symbol]

    def _offer(self, tops: dict[int, Best], node: Stack, symbol: str, best: Best) -> list[int]:
        better = []
        for made in self._shifted(node, symbol):
            if made.number not in tops or best < tops[made.number]:
                tops[made.number] = best
                better.append(made.number)
        return better

    def _with_insertions(self, tops: dict[int, Best]) -> dict[int, Best]:
        tops, queue = dict(tops), list(tops)
        while queue:
            number = queue.pop()
            cost, audit = tops[number]
            for symbol in self.insertable:
                queue += self._offer(tops, self._nodes[number], symbol, (cost + self.costs.insert, audit + INSERT))
        return tops

    def advance(self, tops: dict[int, Best], symbols: str) -> dict[int, Best]:
        """The tops after a further run of symbols."""
        costs = self.costs
        for symbol in symbols:
            tops = self._with_insertions(tops)
            after = {n: (cost + costs.delete, audit + DELETE) for n, (cost, audit) in tops.items()}
            if symbol != GONE:
                more, own = costs.truncated if symbol.isupper() else 0, symbol.lower()
                for number, (cost, audit) in tops.items():
                    node = self._nodes[number]
                    self._offer(after, node, own, (cost + more, audit + KEEP))
                    for other in self.insertable:
                        if other != own:
                            self._offer(after, node, other, (cost + more + costs.rerole, audit + REROLE))
            tops = after
        return tops

    def final(self, tops: dict[int, Best]) -> Best:
        """The least (cost, audit) of all tops from which the sentence can be completed."""
        tops = self._with_insertions(tops)
        return min(best for n, best in tops.items() if self._done in self._items[self._nodes[n].state])

    @lru_cache(maxsize=1 << 16)  # noqa: B019
    def repair(self, symbols: str) -> Best:
        return self.final(self.advance(self.origin, symbols))

    def _starts(self) -> list[int]:
        """Every top there can be between two symbols.

        All are made here, in one order, so their numbers mean the same in every process.
        """
        terminals = sorted({s for rules in self.grammar.values() for rule in rules for s in rule} - set(self.grammar))
        tops: dict[int, None] = {}
        new = list(self.origin)
        while new:
            tops.update(dict.fromkeys(new))
            if len(tops) > self.MOST_TOPS:
                raise ValueError("the grammar needs stacks of unbounded depth")
            made = [m.number for n in new for s in terminals for m in self._shifted(self._nodes[n], s)]
            new = [n for n in dict.fromkeys(made) if n not in tops]
        return sorted(tops)

    def table(self, symbols: str) -> list[tuple[int, int, int, str]]:
        """(start, end, cost, audit) of a run of symbols from every top it may start with.

        Runs are independent of each other in this form; ``chained`` puts them together.
        """
        out = []
        for start in self.starts:
            out += [(start, end, *best) for end, best in self.advance({start: (0, "")}, symbols).items()]
        return out

    def chained(self, runs: Iterable[tuple[int, list[tuple[int, int, int, str]]]]) -> Iterator[str]:
        """The audit of each of several runs, given as (number of symbols, table), in their order.

        What all tops agree on is settled and handed out at once, so hardly more than the audit of one
        run is held.
        """
        tops, waiting = dict(self.origin), []
        for size, table in runs:
            waiting.append(size)
            after: dict[int, Best] = {}
            for start, end, cost, audit in table:
                if start in tops:
                    best = (tops[start][0] + cost, tops[start][1] + audit)
                    if end not in after or best < after[end]:
                        after[end] = best
            audits = [audit for _, audit in after.values()]
            low, high = min(audits), max(audits)
            same = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
            settled, used = low[:same], 0
            while len(waiting) > 1 and (part := _part(settled[used:], waiting[0])) is not None:
                waiting.pop(0)
                used += len(part)
                yield part
            tops = {end: (cost, audit[used:]) for end, (cost, audit) in after.items()}
        _, rest = self.final(tops)
        while len(waiting) > 1:
            part = _part(rest, waiting.pop(0))
            rest = rest[len(part):]
            yield part
        if waiting:
            yield rest

    def cost(self, symbols: str, audit: str) -> int:
        """What the edits of an audit cost."""
        own = {KEEP: 0, REROLE: self.costs.rerole, DELETE: self.costs.delete}
        edits = audit.replace(INSERT, "")
        kept = sum(s.isupper() and e != DELETE for s, e in zip(symbols, edits))
        return sum(own[e] for e in edits) + kept * self.costs.truncated + audit.count(INSERT) * self.costs.insert


def _part(audit: str, size: int) -> str | None:
    """The shortest beginning of an audit with ``size`` edits of symbols."""
    at = 0
    for _ in range(size):
        while at < len(audit) and audit[at] == INSERT:
            at += 1
        if at == len(audit):
            return None
        at += 1
    return audit[:at]
