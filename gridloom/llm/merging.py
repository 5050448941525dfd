"""Byte-pair merging of one short string, shared by the two tokenizer operators."""

from __future__ import annotations

import heapq
from collections.abc import Callable


NEVER = float("inf")
#: Up to so many symbols a scan of all neighbours is faster than a heap.
_SHORT = 48


def merge_symbols(symbols: list[str], priority: Callable[[str, str], float]) -> list[str]:
    """The symbols after all merges: always the neighbours of least priority, the leftmost of equals, save NEVER.

    Long words use a heap of neighbours over a doubly linked list: n symbols take n log n steps.
    """
    return _merge_short(symbols, priority) if len(symbols) <= _SHORT else _merge_long(symbols, priority)


def _merge_short(symbols: list[str], priority: Callable[[str, str], float]) -> list[str]:
    ranks = list(map(priority, symbols, symbols[1:]))
    while ranks:
        best = min(ranks)
        if best == NEVER:
            break
        i = ranks.index(best)
        symbols[i] += symbols.pop(i + 1)
        ranks.pop(i)
        if i:
            ranks[i - 1] = priority(symbols[i - 1], symbols[i])
        if i < len(ranks):
            ranks[i] = priority(symbols[i], symbols[i + 1])
    return symbols


def _merge_long(symbols: list[str], priority: Callable[[str, str], float]) -> list[str]:
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(left: int, right: int) -> None:
        p = priority(symbols[left], symbols[right])
        if p != NEVER:
            heapq.heappush(heap, (p, left, symbols[left], symbols[right], right))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, left, a, b, right = heapq.heappop(heap)
        if symbols[left] != a or symbols[right] != b or after[left] != right:
            continue
        symbols[left], symbols[right] = a + b, ""
        after[left] = after[right]
        if after[left] < n:
            before[after[left]] = left
            offer(left, after[left])
        if before[left] >= 0:
            offer(before[left], left)
    return [s for s in symbols if s]


def merge_pairs(symbols: list[str], rank: dict[tuple[str, str], int]) -> list[str]:
    """:func:`merge_symbols` with the priorities of pairs in a dictionary, without a call for each pair of a short word."""
    if len(symbols) > _SHORT:
        return _merge_long(symbols, lambda a, b: rank.get((a, b), NEVER))
    get = rank.get
    ranks = [get(pair, NEVER) for pair in zip(symbols, symbols[1:])]
    while ranks:
        best = min(ranks)
        if best == NEVER:
            break
        i = ranks.index(best)
        symbols[i] += symbols.pop(i + 1)
        del ranks[i]
        if i:
            ranks[i - 1] = get((symbols[i - 1], symbols[i]), NEVER)
        if i < len(ranks):
            ranks[i] = get((symbols[i], symbols[i + 1]), NEVER)
    return symbols


class Cache(dict):
    """A dictionary that fills itself and starts anew at ``most`` entries or about ``most_bytes``; only speed depends on it.

    An entry is taken to be ``entry`` bytes and four for each of its key, which the values here grow with; long keys, as in scripts
    without spaces, fill it with fewer entries.
    """

    def __init__(self, make: Callable | None, most: int = 1_000_000, most_bytes: int = 400_000_000, entry: int = 240):
        super().__init__()
        self.make, self.room, self.most_bytes = make, most_bytes, most_bytes
        self.entry = max(entry, most_bytes // most)

    def __missing__(self, key):
        self.room -= self.entry + 4 * len(key)
        if self.room < 0:
            self.clear()
            self.room = self.most_bytes
        value = self[key] = self.make(key)
        return value

    def hold(self, made: dict) -> None:
        """Take in what was made elsewhere, within the same bounds."""
        for key, value in made.items():
            self.room -= self.entry + 4 * len(key)
            if self.room < 0:
                self.clear()
                self.room = self.most_bytes - self.entry - 4 * len(key)
            self[key] = value
