"""Hashes of word windows, and which of them stand in an earlier document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

# Words of the k-mers among which a window's seed is the least.
SEED_WORDS = 6
# Words that are looked at together, so that memory stays bounded.
CHUNK = 1 << 20

_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all others (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & ((1 << 64) - 1), dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def runs_hash(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` numbers, from running sums of a polynomial."""
    n = len(hashes)
    if n < length:
        return np.empty(0, dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * _powers(_P, n), out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * _powers(_P_INVERSE, n - length + 1) + np.uint64(length))


def windows(hashes: np.ndarray, length: int, seed_words: int = SEED_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(seed, mark) of each window: its least k-mer, and a hash of the whole window."""
    kmers = runs_hash(hashes, seed_words)
    span = length - seed_words + 1
    have = 1
    while have < span:
        step = min(have, span - have)
        kmers = np.minimum(kmers[:-step], kmers[step:]) if len(kmers) > step else kmers[:0]
        have += step
    return kmers, runs_hash(hashes, length)


def pair_key(seeds: np.ndarray, marks: np.ndarray) -> np.ndarray:
    return mix(seeds + marks * np.uint64(_P))


def _changes(ranked: np.ndarray) -> np.ndarray:
    return np.append(True, ranked[1:] != ranked[:-1])[:len(ranked)]


def first_of(seeds: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """For each pair of a seed and a mark the index of the first equal one.

    Pairs are put in the order of one number made of both; where it cannot tell two apart, of both.
    """
    keys = pair_key(seeds, marks)
    order = np.argsort(keys, kind="stable")
    new = _changes(seeds[order]) | _changes(marks[order])
    if (new != _changes(keys[order])).any():
        order = np.lexsort((marks, seeds))
        new = _changes(seeds[order]) | _changes(marks[order])
    heads = np.flatnonzero(new)
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = np.repeat(order[heads], np.diff(np.append(heads, len(keys))))
    return out


def joined_runs(*columns: np.ndarray, rising: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs in which ``rising`` columns go up by one and the others stay."""
    n = len(columns[0])
    breaks = np.ones(n, dtype=bool)
    if n > 1:
        same = np.ones(n - 1, dtype=bool)
        for i, c in enumerate(columns):
            same &= c[1:] == c[:-1] + (1 if i in rising else 0)
        breaks[1:] = ~same
    starts = np.flatnonzero(breaks)
    return starts, np.diff(np.append(starts, n))


def chunks(n_windows: int, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    for at in range(0, n_windows, most):
        yield at, min(at + most, n_windows)
