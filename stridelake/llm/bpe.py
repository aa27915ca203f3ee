"""Byte-pair merging of many words at once, in numpy.

Words of one length lie in one matrix. In each round every row that still has a
candidate takes its lowest-ranked one (the leftmost of equals), as the agenda of
a single word would; rows without one leave. All rows that stay have merged once
a round, so the matrix narrows by one column.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from stridelake.llm import words as W

NEVER = np.int32(2**31 - 1)
BLOCK = 1 << 15
#: Words of more symbols than this take an agenda of their own.
LONG = 96


class MergeTable:
    """(left, right) -> (rank, merged), open addressing over numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, ranks: np.ndarray, merged: np.ndarray) -> None:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        self.mask = np.uint64((1 << max(int(len(keys) * 4).bit_length(), 4)) - 1)
        n = int(self.mask) + 1
        self.shift = np.uint64(64 - int(self.mask).bit_length())
        self.keys = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        self.ranks = np.full(n, NEVER, np.int32)
        self.merged = np.zeros(n, np.int32)
        todo = np.arange(len(keys))
        slots = self._home(keys)
        while len(todo):
            at = slots[todo]
            free = self.keys[at] == np.iinfo(np.uint64).max
            placed, first = np.unique(at[free], return_index=True)
            rows = todo[free][first]
            self.keys[placed], self.ranks[placed], self.merged[placed] = keys[rows], ranks[rows], merged[rows]
            left_over = np.ones(len(keys), bool)
            left_over[rows] = False
            todo = todo[left_over[todo]]
            slots[todo] = (slots[todo] + 1) & int(self.mask)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        # The upper bits of the product, on which both symbols bear; lower ones make long runs of taken slots.
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = self._home(keys)
        held = self.keys[at]
        wrong = np.flatnonzero((held != keys) & (held != np.iinfo(np.uint64).max))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & int(self.mask)
            held = self.keys[at[wrong]]
            wrong = wrong[(held != keys[wrong]) & (held != np.iinfo(np.uint64).max)]
        hit = self.keys[at] == keys
        return np.where(hit, self.ranks[at], NEVER), self.merged[at]


Skip = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]


def _block(symbols: np.ndarray, table: MergeTable, keys: np.ndarray, skip: Skip | None) -> tuple[np.ndarray, np.ndarray]:
    n, width = symbols.shape
    out, sizes = symbols.copy(), np.full(n, width)
    rows = np.arange(n)

    def look(left: np.ndarray, right: np.ndarray, key: np.ndarray, place: np.ndarray, step: int):
        rank, merged = table.find(left, right)
        if skip is not None:
            real = np.flatnonzero(rank != NEVER)
            rank[real[skip(key[real], left[real], right[real], place[real], step)]] = NEVER
        return rank, merged

    #: Where in the word each symbol starts, which names a candidate whatever has merged before it.
    origin = np.tile(np.arange(width, dtype=np.int32), (n, 1))
    rank, merged = look(
        symbols[:, :-1].ravel(), symbols[:, 1:].ravel(), np.repeat(keys, width - 1), origin[:, :-1].ravel(), 0
    )
    rank, merged = rank.reshape(n, width - 1), merged.reshape(n, width - 1)
    step = 0
    while rank.shape[1] and len(rows):
        step += 1
        best = rank.argmin(axis=1)
        alive = rank[np.arange(len(rows)), best] != NEVER
        if not alive.all():
            done = rows[~alive]
            out[done, : symbols.shape[1]] = symbols[~alive]
            sizes[done] = symbols.shape[1]
            rows, symbols, rank, merged, best, keys, origin = (x[alive] for x in (rows, symbols, rank, merged, best, keys, origin))
            if not len(rows):
                break
        each = np.arange(len(rows))
        symbols[each, best] = merged[each, best]
        stay = np.arange(symbols.shape[1] - 1) <= best[:, None]
        symbols = np.where(stay, symbols[:, :-1], symbols[:, 1:])
        if skip is not None:
            origin = np.where(stay, origin[:, :-1], origin[:, 1:])
        stay = stay[:, :-1]
        rank = np.where(stay, rank[:, :-1], rank[:, 1:])
        merged = np.where(stay, merged[:, :-1], merged[:, 1:])
        for shift in (-1, 0):
            at = best + shift
            ok = np.flatnonzero((at >= 0) & (at < symbols.shape[1] - 1))
            a = at[ok]
            rank[ok, a], merged[ok, a] = look(symbols[ok, a], symbols[ok, a + 1], keys[ok], origin[ok, a], step)
    if len(rows):
        out[rows, : symbols.shape[1]] = symbols
        sizes[rows] = symbols.shape[1]
    return out, sizes


def _alone(symbols: list[int], table: MergeTable, key: np.uint64, skip: Skip | None) -> list[int]:
    """One long word with a heap, in n log n."""
    import heapq

    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(at: list[int], step: int) -> None:
        left = np.array([symbols[i] for i in at], np.int32)
        right = np.array([symbols[after[i]] for i in at], np.int32)
        rank, merged = table.find(left, right)
        if skip is not None:
            real = np.flatnonzero(rank != NEVER)
            rank[real[skip(np.full(len(real), key), left[real], right[real], np.array(at)[real], step)]] = NEVER
        for i, r, m, x, y in zip(at, rank.tolist(), merged.tolist(), left.tolist(), right.tolist(), strict=True):
            if r != NEVER:
                heapq.heappush(heap, (r, i, m, x, y))

    if n > 1:
        offer(list(range(n - 1)), 0)
    step = 0
    while heap:
        _, i, m, x, y = heapq.heappop(heap)
        j = after[i]
        if j >= n or symbols[i] != x or symbols[j] != y:
            continue
        step += 1
        symbols[i], symbols[j] = m, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        near = [k for k in (before[i], i) if k >= 0 and after[k] < n]
        if near:
            offer(near, step)
    return [s for s in symbols if s >= 0]


def merge(
    symbols: np.ndarray, bounds: np.ndarray, table: MergeTable, keys: np.ndarray | None = None, skip: Skip | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Merge every word [bounds[i], bounds[i + 1]) of symbols; returns the same layout."""
    sizes = np.diff(bounds)
    keys = np.zeros(len(sizes), np.uint64) if keys is None else keys
    final = np.zeros(len(sizes), np.int64)
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    held: list[tuple[np.ndarray, np.ndarray]] = []
    with np.errstate(over="ignore"):
        for part in np.split(order, cuts):
            width = int(sizes[part[0]]) if len(part) else 0
            if width == 0:
                continue
            for i in range(0, len(part), BLOCK):
                rows = part[i : i + BLOCK]
                if width > LONG:
                    for r in rows:
                        got = np.array(_alone(symbols[bounds[r] : bounds[r + 1]].tolist(), table, keys[r], skip), np.int32)
                        final[r] = len(got)
                        held.append((np.array([r]), got))
                    continue
                got, n = _block(symbols[bounds[rows][:, None] + np.arange(width)].astype(np.int32), table, keys[rows], skip)
                final[rows] = n
                held.append((rows, got[np.arange(width) < n[:, None]]))
    out_bounds = np.concatenate([[0], np.cumsum(final)])
    out = np.zeros(out_bounds[-1], np.int32)
    for rows, values in held:
        out[ranges(out_bounds[rows], final[rows])] = values
    return out, out_bounds


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class SegmentCache:
    """What words have been merged into, by their 64-bit hash; starts anew once it holds `limit` words."""

    def __init__(self, limit: int = 1 << 18) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.values, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def look_up(
        self, hashes: np.ndarray, make: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Values and size of each word, in order; make(rows) merges the words at these rows, all different."""
        if len(self.known) > self.limit:
            self.clear()
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        get = self.known.get
        number = np.array([get(h, -1) for h in unique.tolist()], np.int64)
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            values, bounds = make(first[fresh])
            number[fresh] = len(self.bounds) - 1 + np.arange(len(fresh))
            self.known.update(zip(unique[fresh].tolist(), number[fresh].tolist(), strict=True))
            self.values = np.concatenate([self.values, values])
            self.bounds = np.concatenate([self.bounds, bounds[1:] + self.bounds[-1]])
        own = number[back]
        sizes = self.bounds[own + 1] - self.bounds[own]
        return self.values[ranges(self.bounds[own], sizes)], sizes
