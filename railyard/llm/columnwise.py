"""Column-wise construction of a collection's Burrows-Wheeler transform and common prefixes.

Round ``j`` inserts the suffix of length ``j`` of every string that is long
enough, that is one symbol per string: where a suffix goes follows from the
rank of its first symbol among the symbols of the transform so far, and its
common prefixes with its neighbours are one more than the least common prefix
between the places of their tails. Transform and common prefixes lie in two
files of one byte per suffix, which a round reads from front to back and
writes anew.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

import numpy as np

#: Common prefixes are counted up to this (one byte each); strings are no longer.
MOST = 255


class ColumnFiles:
    """The two sequential files of a collection, each in two turns, in temporary files that go with the object."""

    def __init__(self):
        self.turns = [[tempfile.TemporaryFile(buffering=0) for _ in range(2)] for _ in range(2)]
        self.turn, self.size = 0, 0

    def write(self, *columns: np.ndarray) -> None:
        self.turn ^= 1
        self.size = len(columns[0])
        for file, column in zip(self.turns[self.turn], columns, strict=True):
            file.seek(0)
            left = memoryview(column)
            while left:
                left = left[file.write(left):]

    def read(self) -> list[np.ndarray]:
        columns = []
        for file in self.turns[self.turn]:
            file.seek(0)
            columns.append(np.empty(self.size, np.uint8))
            left = memoryview(columns[-1])
            while left:
                left = left[file.readinto(left):]
        return columns

    def close(self) -> None:
        for file in [f for turn in self.turns for f in turn]:
            file.close()


def least_between(common: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The minimum of ``common[low:high]`` for each pair; every range has an element."""
    if not len(low):
        return np.zeros(0, np.uint8)
    order = np.argsort(-low, kind="stable")  # from the back, so that no time goes into the gaps between ranges
    edges = np.column_stack([low[order], high[order]]).ravel()
    out = np.empty(len(low), np.uint8)
    out[order] = np.minimum.reduceat(np.append(common, np.uint8(MOST)), edges)[::2]
    return out


def sorted_suffixes(strings: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes that are not empty, in order: string, start, and common prefix with the one before.

    Strings are UTF-8 (or other bytes below 255) and at most ``MOST`` long.
    Equal suffixes are in the order of their strings.
    """
    n = len(strings)
    lengths = np.array([len(s) for s in strings], np.int64)
    longest = int(lengths.max(initial=0))
    # Column j holds the symbol at distance j from the end, one up, and 0 before the beginning.
    columns = np.zeros((longest + 1, n), np.uint8)
    for i, s in enumerate(strings):
        columns[:len(s), i] = np.frombuffer(s, np.uint8)[::-1] + 1
    files = ColumnFiles()
    try:
        files.write(columns[0], np.zeros(n, np.uint8))
        at = np.arange(n)
        for j in range(1, longest + 1):
            on = np.flatnonzero(lengths >= j)
            symbols, common = files.read()
            by_symbol = tails(symbols)
            rank = np.empty(len(symbols), np.int32)
            rank[by_symbol] = np.arange(len(by_symbol), dtype=np.int32)
            new = np.sort(rank[at[on]])
            # The inserted suffixes and those that follow them have a new neighbour before them.
            mark = np.zeros(len(by_symbol) + 1, bool)
            mark[new] = mark[new + 1] = True
            touched = np.flatnonzero(mark[:-1])
            same = touched[(touched > 0) & (symbols[by_symbol[touched]] == symbols[by_symbol[touched - 1]])]
            at[on] = n + rank[at[on]]
            old = np.ones(len(symbols) + len(on), bool)
            old[n + new] = False
            next_symbols, next_common = np.empty(len(old), np.uint8), np.empty(len(old), np.uint8)
            next_symbols[old], next_common[old] = symbols, common
            next_symbols[at[on]] = columns[j, on]
            next_common[n + touched] = 0
            next_common[n + same] = 1 + least_between(common, by_symbol[same - 1] + 1, by_symbol[same] + 1)
            files.write(next_symbols, next_common)
        symbols, common = files.read()
    finally:
        files.close()
    # Where each suffix went: from the empty suffix of each string backwards, symbol by symbol.
    by_symbol = tails(symbols)
    longer = np.empty(len(symbols), np.int64)
    longer[by_symbol] = n + np.arange(len(by_symbol))
    string, start, at = np.empty(len(symbols), np.int64), np.empty(len(symbols), np.int64), np.arange(n)
    for j in range(1, longest + 1):
        on = np.flatnonzero(lengths >= j)
        at[on] = longer[at[on]]
        string[at[on]], start[at[on]] = on, lengths[on] - j
    return string[n:], start[n:], common[n:]


def tails(symbols: np.ndarray) -> np.ndarray:
    """Places of the transform by their symbol, equal ones in order; beginnings of strings have none."""
    return np.argsort(symbols, kind="stable")[np.count_nonzero(symbols == 0):]
