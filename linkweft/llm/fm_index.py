"""An FM-index over word numbers whose rows are sorted by their next DEPTH symbols.

The text is an array of symbols 1 to m with 0 as a break, also at both ends.  Forward and
backward transforms are kept, so an interval of occurrences can be extended by a symbol on
either side while its places in both stay known.  Rows need be in order only up to DEPTH
symbols, since no longer pattern is asked for; patterns never hold a break.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard

from linkweft.llm import words as W

DEPTH = 4


def transform(text: np.ndarray) -> np.ndarray:
    """The symbol before each row, rows being sorted by their next DEPTH symbols."""
    rank, length = text.astype(np.int64), 1
    while length < DEPTH:
        # pairs of ranks of `length` symbols order twice as many symbols
        pair = rank * (int(rank.max(initial=0)) + 1) + np.roll(rank, -length)
        order = np.argsort(pair, kind="stable")
        new = np.zeros(len(text), dtype=np.int64)
        new[1:] = np.cumsum(pair[order][1:] != pair[order][:-1])
        rank = np.empty(len(text), dtype=np.int64)
        rank[order] = new
        length *= 2
    return text[np.argsort(rank, kind="stable") - 1]


class Transform:
    """One transformed text: the start of every symbol's rows, and where a row's symbol is a row itself."""

    def __init__(self, last: np.ndarray, symbols: int) -> None:
        self.last = last
        self.start = np.concatenate([[0], np.cumsum(np.bincount(last, minlength=symbols + 1))])
        self.row_of = np.empty(len(last), dtype=np.int64)
        self.row_of[np.argsort(last, kind="stable")] = np.arange(len(last))

    def extended(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """(interval, symbol, first row, occurrences, rows before it in the interval) of all one-symbol extensions."""
        rows = W.ragged(low, size)
        interval = np.repeat(np.arange(len(low)), size)
        symbol = self.last[rows].astype(np.int64)
        key = interval * len(self.start) + symbol
        order = np.argsort(key, kind="stable")
        key = key[order]
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
        begins = np.cumsum(size) - size
        one = order[at]
        return interval[one], symbol[one], self.row_of[rows[one]], np.diff(np.concatenate([at, [len(key)]])), at - begins[interval[one]]


@dataclass
class Grams:
    """Patterns, one row of symbols each, with their rows in both transforms."""

    symbols: np.ndarray
    forward: np.ndarray
    backward: np.ndarray
    size: np.ndarray

    def take(self, rows: np.ndarray) -> Grams:
        return Grams(self.symbols[rows], self.forward[rows], self.backward[rows], self.size[rows])


class Index:
    """Forward and backward transforms of one text over symbols 1 to `symbols`."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray, symbols: int) -> None:
        self.symbols = symbols
        self.forward, self.backward = Transform(forward, symbols), Transform(backward, symbols)

    @classmethod
    def of(cls, text: np.ndarray, symbols: int) -> Index:
        return cls(transform(text), transform(text[::-1]), symbols)

    def words(self) -> Grams:
        """All symbols that occur, as patterns of length one."""
        low, size = self.forward.start[1:-1], np.diff(self.forward.start)[1:]
        found = np.flatnonzero(size)
        return Grams(found[:, None] + 1, low[found], low[found], size[found])

    def left(self, grams: Grams) -> Grams:
        """Every pattern that is a symbol followed by one of `grams`."""
        of, symbol, row, size, before = self.forward.extended(grams.forward, grams.size)
        out = Grams(np.column_stack([symbol, grams.symbols[of]]), row, grams.backward[of] + before, size)
        return out.take(np.flatnonzero(symbol > 0))

    def right(self, grams: Grams) -> Grams:
        """Every pattern that is one of `grams` followed by a symbol."""
        of, symbol, row, size, before = self.backward.extended(grams.backward, grams.size)
        out = Grams(np.column_stack([grams.symbols[of], symbol]), grams.forward[of] + before, row, size)
        return out.take(np.flatnonzero(symbol > 0))


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as bytes: the first bytes of all of them, then the second ones, and so on, compressed."""
    data = np.ascontiguousarray(values, dtype="<i8").view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(data.T).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<i8")
