"""Recompression: equal stretches of words get equal symbols inside (numpy, no Spark).

A text is a row of names, at first one for each word.  A *run* step replaces the
repeats of a name by one symbol; a *pair* step deals the names into left and
right ones by a seeded bit of the name, and replaces each left name that a right
one follows, with it, by one symbol.  A symbol's name is a 64-bit fingerprint of
what it stands for, so that it is the same in every text, on every machine, and
equal names stand for equal words.  A pair step shortens a row by a quarter on
average; whether two names are joined depends on those two names only, so equal
stretches are cut alike but for their edges.

For each symbol the *context* is kept: the words that decided that just these
words became this symbol.  Wherever the words of the context occur, the symbol
occurs, at the same place in them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from fragstat.llm.tokens import mixed

_U = np.uint64
_PRIME = _U(0x9E3779B97F4A7C15)

#: Odd, so that it has an inverse modulo 2 ** 64.
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass
class Symbols:
    """The rows of all texts, one after the other.  ``row`` numbers the texts (or
    stretches); words are counted through all of them."""
    name: np.ndarray  # uint64
    start: np.ndarray  # first word
    end: np.ndarray  # after the last word
    row: np.ndarray
    left: np.ndarray  # first word of the context; the word before the row if that the row begins there counts
    right: np.ndarray  # after the last word of the context

    def take(self, which: np.ndarray) -> Symbols:
        return Symbols(*(getattr(self, f)[which] for f in self.__dataclass_fields__))


def spell(names: np.ndarray, rows: np.ndarray) -> Symbols:
    """Each word a symbol; ``rows`` is the row of each."""
    at = np.arange(len(names), dtype=np.int32)
    return Symbols(names, at, at + 1, rows.astype(np.int32), at, at + 1)


def _joins(s: Symbols) -> np.ndarray:
    """For each symbol, whether the next one is its neighbour in the same row."""
    following = np.zeros(len(s.name), bool)
    np.equal(s.row[1:], s.row[:-1], out=following[:-1])
    return following


def _reach(s: Symbols, following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The contexts' far ends of each symbol's neighbours, or a word beyond the row."""
    before, after = s.start - 1, s.end + 1
    before[1:][following[:-1]] = s.left[:-1][following[:-1]]
    after[:-1][following[:-1]] = s.right[1:][following[:-1]]
    return before, after


def run_step(s: Symbols) -> Symbols:
    """Repeats of a name become one symbol.  What stands next to it on both sides
    tells that the run ends there, so the context grows by that."""
    if not len(s.name):
        return s
    following = _joins(s)
    before, after = _reach(s, following)
    left, right = np.minimum(before, s.left), np.maximum(after, s.right)
    same = following
    same[:-1] &= s.name[1:] == s.name[:-1]
    if not same.any():
        return Symbols(s.name, s.start, s.end, s.row, left, right)
    first = np.flatnonzero(~np.concatenate(([False], same[:-1])))
    last = np.append(first[1:], len(s.name)) - 1
    times = last - first + 1
    name = s.name[first]
    more = times > 1
    name[more] = mixed(mixed(name[more] + _U(0x52)) + times[more].astype(_U) * _PRIME)
    return Symbols(name, s.start[first], s.end[last], s.row[first],
                   np.minimum.reduceat(left, first), np.maximum.reduceat(right, first))


def pair_step(s: Symbols, seed: int) -> Symbols:
    """Left names take the right name that follows.  A pair needs no context but
    its own; a left name that stays alone needs the next one's, a right name that
    stays alone the one's before."""
    if not len(s.name):
        return s
    following = _joins(s)
    is_right = mixed(s.name + _U(seed * int(_PRIME) % (1 << 64))) >= _U(1 << 63)
    pairs = following & ~is_right
    pairs[:-1] &= is_right[1:]
    before, after = _reach(s, following)
    second = np.concatenate(([False], pairs[:-1]))
    left = np.where(is_right, np.minimum(before, s.left), s.left)  # unless it is a pair's second
    right = np.where(is_right, s.right, np.maximum(after, s.right))  # of a pair's first: the second's
    keep = np.flatnonzero(~second)
    firsts = np.flatnonzero(pairs)
    name, end = s.name.copy(), s.end.copy()
    name[firsts] = mixed(mixed(s.name[firsts] + _U(0x50)) * _PRIME + s.name[firsts + 1])
    end[firsts] = s.end[firsts + 1]
    left[firsts] = np.minimum(s.left[firsts], s.left[firsts + 1])
    return Symbols(name[keep], s.start[keep], end[keep], s.row[keep], left[keep], right[keep])


def climb(s: Symbols, steps: int, first: int = 0) -> Symbols:
    """``steps`` pair steps, numbered from ``first``, with a run step before every third."""
    for number in range(first, first + steps):
        if number % 3 == 0:
            s = run_step(s)
        s = pair_step(s, number + 1)
    return s


class Checks:
    """A second fingerprint of any stretch of words, independent of its symbols:
    a polynomial in their hashes modulo 2 ** 64."""

    def __init__(self, words: np.ndarray):
        powers = np.ones(len(words) + 1, _U)
        powers[1:] = _U(_INVERSE)
        terms = mixed(words ^ _U(0xA5A5A5A5A5A5A5A5)) * np.cumprod(powers)[:-1]
        self.sums = np.concatenate((np.zeros(1, _U), np.cumsum(terms, dtype=_U)))
        powers[1:] = _U(_BASE)
        self.powers = np.cumprod(powers)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return ((self.sums[end] - self.sums[start]) * self.powers[start] >> _U(32)).astype(np.uint32)
