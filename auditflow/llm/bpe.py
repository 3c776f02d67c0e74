"""Byte-pair encoding counted by dynamic programming over prefixes."""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import accumulate

import regex

# Fixed value: how byte-level vocabularies of this family part a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Pieces, and pairs of tokens, that a process remembers.
KEPT = 700_000


def _bytes_of_letters() -> dict[str, int]:
    """The letters that byte-level vocabulary files write for the 256 bytes.

    Printable Latin-1 letters stand for themselves, the other bytes for the letters from 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """A vocabulary, and the number of tokens of every prefix of a piece of text.

    A chain of tokens is the encoding of its bytes exactly if each neighbouring pair is the encoding
    of its own bytes. So the last token of a prefix is the one suffix token that goes with the last
    token of what is before it, and the count is one more than the count there.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        letters = _bytes_of_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in parsed["model"]["merges"])
        merges = [(raw(a), raw(b)) for a, b in pairs]
        self.rank = {merge: n for n, merge in enumerate(merges)}
        self.made = {a + b: (a, b, n) for n, (a, b) in reversed(list(enumerate(merges)))}
        self.tokens = {raw(t) for t in parsed["model"]["vocab"] if all(c in letters for c in t)}
        self.longest = max(map(len, self.tokens))
        special = [t["content"] for t in parsed["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pieces = regex.compile(PATTERN).findall
        self._pairs: dict[tuple[bytes, bytes], bool] = {}
        self._spines: dict[tuple[bytes, int], list[tuple[bytes, float]]] = {}
        self._tables: dict[str, bytes | tuple[int, ...]] = {}

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The parts a token had at one edge while it was put together, and when each was taken up."""
        known = self._spines.get((token, side))
        if known is None:
            part, until, known = token, float("inf"), []
            while True:
                known.append((part, until))
                if part not in self.made:
                    break
                until = self.made[part][2]
                part = self.made[part][side]
            self._spines[token, side] = known
        return known

    def _goes_with(self, left: bytes, right: bytes) -> bool:
        """Whether the bytes of the two tokens encode to just these two.

        They do unless two parts that meet at the border merge before either is taken up by its own
        token. Of equal merges the one further left is done first.
        """
        rank = self.rank
        return not any(
            (n := rank.get((a, b))) is not None and n < a_until and n <= b_until
            for a, a_until in self._spine(left, 1)
            for b, b_until in self._spine(right, 0)
        )

    def table(self, piece: str) -> bytes | tuple[int, ...]:
        """Token counts of the prefixes of 0, 1, 2, … bytes of one piece."""
        found = self._tables.get(piece)
        if found is not None:
            return found
        data = piece.encode("utf-8", "surrogatepass")
        tokens, pairs, longest = self.tokens, self._pairs, self.longest
        last, counts = [b""], [0]
        for end in range(1, len(data) + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = data[start:end]
                if token not in tokens:
                    continue
                if start:
                    pair = (last[start], token)
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = self._goes_with(*pair)
                    if not fits:
                        continue
                last.append(token)
                counts.append(counts[start] + 1)
                break
            else:
                raise ValueError(f"the vocabulary has no token for byte {data[end - 1]}")
        if len(pairs) > KEPT:
            pairs.clear()
        if len(data) > 128:
            return tuple(counts)
        if len(self._tables) >= KEPT:
            self._tables.clear()
        found = self._tables[piece] = bytes(counts)
        return found

    def segments(self, text: str) -> list[tuple[str, bool]]:
        """Stretches of ordinary text and special tokens, in order."""
        if not self.special or not self.special.search(text):
            return [(text, False)]
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [(text[at:m.start()], False), (m.group(), True)]
            at = m.end()
        return [*out, (text[at:], False)]

    def prefixes(self, text: str) -> Prefixes:
        return Prefixes(self, text)


class Prefixes:
    """Token counts of all prefixes of one text.

    Kept are the ends of its pieces and the counts there; inside a piece the piece's own table
    answers. Nothing is encoded again.
    """

    def __init__(self, encoder: Encoder, text: str) -> None:
        self.encoder, self.text = encoder, text
        self.pieces: list[str] = []
        counts: list[int] = []
        table = encoder.table
        for part, special in encoder.segments(text):
            split = [part] if special else encoder.pieces(part)
            self.pieces += split
            counts += [1] if special else [table(p)[-1] for p in split]
        self.counts = [0, *accumulate(counts)]

    @property
    def total(self) -> int:
        return self.counts[-1]

    def ends(self) -> list[int]:
        return [0, *accumulate(map(len, self.pieces))]

    def at(self, chars: int) -> int:
        """Tokens of the first ``chars`` code points taken as a text of their own.

        Where the cut falls, the last pieces may be parted differently (a run of spaces, a cut
        special token), so the tail behind the last pieces that are sure is parted anew.
        """
        ends = self.ends()
        low = next((i for i, e in enumerate(ends) if e > chars), len(ends)) - 1
        longest = max((len(s) for s in self._special_strings()), default=0)
        while low > 0 and (ends[low] > chars - longest or low > len(ends) - 1):
            low -= 1
        low = max(0, low - 2)
        tail = self.text[ends[low]:chars]
        return self.counts[low] + sum(
            1 if special else sum(self.encoder.table(p)[-1] for p in self.encoder.pieces(part))
            for part, special in self.encoder.segments(tail)
        )

    def _special_strings(self) -> list[str]:
        return [p for p in self.pieces if self.encoder.special and self.encoder.special.fullmatch(p)]

    def fit(self, limit: int) -> int:
        """Code points of the longest run of whole pieces that needs at most ``limit`` tokens."""
        n = 0
        while n + 1 < len(self.counts) and self.counts[n + 1] <= limit:
            n += 1
        return sum(map(len, self.pieces[:n]))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The vocabulary of a file, read once per process."""
    return Encoder(path)
