"""Suffix sorting by induction with external priority queues.

:func:`suffixes` gives the suffixes of an integer sequence in order, each with
the length of its common prefix with its neighbour.  Suffixes that start a
rising run after a falling one (the sampled ones) are named by sorting their
substrings; where names repeat, the sequence of names is sorted by recursion.
From them the suffixes of falling type are induced in ascending order and those
of rising type in descending order.  Both inductions run through a priority
queue of tuples (first symbol, rank of the next suffix, position, common-prefix
value) that spills sorted runs to disk, as does the sort of the substrings.  The
common-prefix value of two neighbours of one first symbol is one more than the
smallest value between the ranks of their next suffixes; a stack of running
minima gives it when a tuple enters the queue.
"""

from __future__ import annotations

import heapq
import os
import pickle
import tempfile
from bisect import bisect_right
from collections import deque
from collections.abc import Iterable, Iterator

# Tuples that a queue holds in memory.
IN_MEMORY = 500_000


def _spill_folder() -> str | None:
    """Where Spark's own Python workers spill: the executor's block folder."""
    return (os.environ.get("SPARK_LOCAL_DIRS") or "").split(",")[0] or None


def _run_on_disk(items: list) -> Iterator:
    """The items again, from a file that vanishes with the iterator."""
    with tempfile.TemporaryFile(dir=_spill_folder()) as f:
        for i in range(0, len(items), 4096):
            pickle.dump(items[i:i + 4096], f, pickle.HIGHEST_PROTOCOL)
        items.clear()
        f.seek(0)
        while True:
            try:
                yield from pickle.load(f)
            except EOFError:
                return


def external_sorted(items: Iterable, limit: int = IN_MEMORY) -> Iterator:
    """Items in order; sorted runs beyond ``limit`` lie on disk."""
    held, runs = [], []
    for x in items:
        held.append(x)
        if len(held) >= limit:
            held.sort()
            runs.append(_started(held))
            held = []
    held.sort()
    return heapq.merge(held, *runs) if runs else iter(held)


def _started(held: list) -> Iterator:
    """A run that is on disk at once, not only when it is first read."""
    run = _run_on_disk(held)
    first = next(run)
    return _chained(first, run)


def _chained(first, rest: Iterator) -> Iterator:
    yield first
    yield from rest


class Queue:
    """A priority queue of tuples (first symbol, rank, ...) pushed with rising
    ranks: tuples of one symbol leave in the order in which they came, so each
    symbol has a list and only the symbols form a heap.  Beyond ``limit`` tuples
    all lists go to disk as one sorted run."""

    def __init__(self, limit: int = IN_MEMORY):
        self.limit, self.held = limit, 0
        self.lists: dict[int, deque] = {}
        self.symbols: list[int] = []
        self.runs: list[tuple] = []

    def push(self, item) -> None:
        mine = self.lists.get(item[0])
        if mine is None:
            mine = self.lists[item[0]] = deque()
            heapq.heappush(self.symbols, item[0])
        mine.append(item)
        self.held += 1
        if self.held > self.limit:
            run = _run_on_disk([x for s in sorted(self.lists) for x in self.lists[s]])
            heapq.heappush(self.runs, (next(run), len(self.runs), run))
            self.lists, self.symbols, self.held = {}, [], 0

    def first(self):
        """The smallest item, or None."""
        mine = self.lists[self.symbols[0]][0] if self.symbols else None
        if self.runs and (mine is None or self.runs[0][0] < mine):
            return self.runs[0][0]
        return mine

    def pop(self):
        if self.runs and (not self.symbols or self.runs[0][0] < self.lists[self.symbols[0]][0]):
            item, k, run = self.runs[0]
            after = next(run, None)
            if after is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (after, k, run))
            return item
        mine = self.lists[self.symbols[0]]
        item = mine.popleft()
        self.held -= 1
        if not mine:
            del self.lists[heapq.heappop(self.symbols)]
        return item


class _Minima:
    """Common-prefix values by rank; smallest value in a range that ends at the
    latest rank."""

    def __init__(self):
        self.ranks, self.values = [], []

    def add(self, rank: int, value: int) -> None:
        ranks, values = self.ranks, self.values
        while values and values[-1] >= value:
            values.pop()
            ranks.pop()
        ranks.append(rank)
        values.append(value)

    def after(self, rank: int) -> int:
        """The smallest value of the ranks above this one."""
        return self.values[bisect_right(self.ranks, rank)]


def _common(t: list[int], i: int, j: int, cap: int) -> int:
    """Length of the common prefix of two suffixes, up to ``cap``."""
    n = min(len(t) - max(i, j), cap)
    k = 0
    while k < n and t[i + k] == t[j + k]:
        k += 1
    return k


def _sampled_order(t: list[int], rising: bytearray, limit: int) -> list[int]:
    """The sampled positions in the order of their suffixes."""
    n = len(t)
    places = [i for i in range(1, n) if rising[i] and not rising[i - 1]]
    if len(places) <= 1:
        return places
    ends = {a: b for a, b in zip(places, places[1:], strict=False)}
    ends[places[-1]] = n - 1
    # With its type, no substring is the beginning of another.
    typed = [2 * x + r for x, r in zip(t, rising, strict=True)]
    names, name, last = {}, 0, None
    order = []
    for key, a in external_sorted(((typed[a:ends[a] + 1], a) for a in places), limit):
        if key != last:
            name, last = name + 1, key
        names[a] = name
        order.append(a)
    if name == len(places):
        return order
    reduced = [names[a] for a in places] + [0]
    return [places[i] for i, _ in suffixes(reduced, cap=1, limit=limit) if i < len(places)]


def _tuple(symbol: int, rank: int, i: int, pushed: dict[int, int], minima: _Minima, cap: int) -> tuple:
    """A queue entry; its common prefix is with the entry of the same first symbol
    before it."""
    value = min(cap, 1 + minima.after(pushed[symbol])) if symbol in pushed else 0
    pushed[symbol] = rank
    return symbol, rank, i, value


def suffixes(t: list[int], cap: int, limit: int = IN_MEMORY) -> Iterator[tuple[int, int]]:
    """(position, common prefix with the next larger suffix, up to ``cap``) of all
    suffixes in ascending order.  The last symbol must be the smallest, and
    unique."""
    n = len(t)
    if n == 1:
        return iter([(0, 0)])
    rising = bytearray(n)
    rising[n - 1] = 1
    for i in range(n - 2, -1, -1):
        rising[i] = t[i] < t[i + 1] or (t[i] == t[i + 1] and rising[i + 1])
    sampled = _sampled_order(t, rising, limit)

    # Ascending: falling suffixes, induced from sampled and falling ones.
    queue, minima = Queue(limit), _Minima()
    falling: list[tuple[int, int]] = []
    pushed: dict[int, int] = {}  # the rank at which a symbol entered the queue last
    rank, k, before = 0, 0, -1
    while True:
        item = queue.first()
        s = sampled[k] if k < len(sampled) else -1
        if item is None and s < 0:
            break
        # In a bucket the falling suffixes come first.
        if item is not None and (s < 0 or item[0] <= t[s]):
            _, _, i, value = queue.pop()
            falling.append((i, value))
        else:
            i = s
            k += 1
            value = _common(t, before, i, cap) if before >= 0 and t[before] == t[i] else 0
        rank += 1
        minima.add(rank, value)
        if i and not rising[i - 1]:
            queue.push(_tuple(t[i - 1], rank, i - 1, pushed, minima, cap))
        before = i

    # Descending: rising suffixes, induced from falling and rising ones.
    queue, minima = Queue(limit), _Minima()
    out: list[tuple[int, int]] = []
    pushed = {}
    rank, k, before = 0, len(falling) - 1, -1
    above = 0  # common prefix of the last falling suffix taken with the one below it
    while True:
        item = queue.first()
        f = falling[k][0] if k >= 0 else -1
        if item is None and f < 0:
            break
        if item is not None and (f < 0 or -item[0] >= t[f]):
            _, _, i, value = queue.pop()
        else:
            i = f
            same = before >= 0 and t[before] == t[i]
            value = 0 if not same else above if not rising[before] else _common(t, before, i, cap)
            above = falling[k][1]
            k -= 1
        rank += 1
        minima.add(rank, value)
        out.append((i, value))
        if i and rising[i - 1]:
            queue.push(_tuple(-t[i - 1], rank, i - 1, pushed, minima, cap))
        before = i
    # The sentinel has no sampled predecessor chain of its own; it is the smallest.
    if out[-1][0] != n - 1:
        out.append((n - 1, 0))
    out.reverse()
    return iter(out)
