"""Bin packing of a histogram of lengths by linear grouping and a configuration program.

All work is on the histogram (at most ``capacity`` rows, whatever the number of items): the answer
says, for runs of equal bins, which lengths each bin holds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

GROUPS = 100                # sizes that the large lengths are rounded up to, at most
LARGE_SHARE = 3             # lengths above capacity / LARGE_SHARE are large
COLUMNS = 4_000             # columns the program generates at most


@dataclass
class Run:
    """``bins`` bins, each holding the items ``lengths``."""

    bins: int
    lengths: tuple[int, ...]


def _groups(lengths: list[int], counts: dict[int, int], k: int) -> list[list[list[int]]]:
    """Lengths in falling order cut into ``k`` groups of equal numbers of items: [[length, items], ...]."""
    total = sum(counts[s] for s in lengths)
    out: list[list[list[int]]] = []
    filled = 0
    for s in lengths:
        left = counts[s]
        while left:
            if not out or filled >= total * len(out) // k:
                out.append([])
            take = min(left, max(1, total * len(out) // k - filled))
            out[-1].append([s, take])
            filled += take
            left -= take
    return out


def _best_pattern(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """The most valuable multiset of sizes that fits, by dynamic programming over the number of items."""
    most = capacity // int(sizes.min())
    value = np.zeros(capacity + 1)
    choices = []
    useful = [g for g in np.argsort(-worth / sizes) if worth[g] > 0]
    for _ in range(most):
        better, choice = value.copy(), np.full(capacity + 1, -1)
        for g in useful:
            s = sizes[g]
            candidate = value[: capacity + 1 - s] + worth[g]
            target = better[s:]
            up = candidate > target + 1e-12
            target[up] = candidate[up]
            choice[s:][up] = g
        choices.append(choice)
        value = better
    pattern = np.zeros(len(sizes), np.int64)
    room = capacity
    for choice in reversed(choices):
        g = choice[room]
        if g >= 0:
            pattern[g] += 1
            room -= sizes[g]
    return pattern


def few_sizes(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """Whole numbers of bins per pattern for few distinct sizes; what rounding leaves is not covered.

    Column generation on the linear program, rounded down. Patterns never hold more of a size in
    total than its demand.
    """
    basis = np.diag(capacity // sizes).astype(float)
    bins = demand / np.diag(basis)
    for _ in range(COLUMNS):
        worth = np.linalg.solve(basis.T, np.ones(len(sizes)))
        pattern = _best_pattern(sizes, worth, capacity)
        if pattern @ worth <= 1 + 1e-7:
            break
        change = np.linalg.solve(basis, pattern.astype(float))
        grows = change > 1e-9
        if not grows.any():
            break
        ratio = np.full(len(sizes), np.inf)
        ratio[grows] = np.maximum(bins[grows], 0) / change[grows]
        out = int(ratio.argmin())
        bins = bins - ratio[out] * change
        bins[out] = ratio[out]
        basis[:, out] = pattern
    left = demand.copy()
    chosen = []
    for j in np.argsort(-bins):
        pattern = basis[:, j].round().astype(np.int64)
        used = pattern > 0
        n = min(int(np.floor(bins[j] + 1e-6)), int((left[used] // pattern[used]).min()))
        if n > 0:
            chosen.append((n, pattern))
            left -= n * pattern
    return chosen


def _substitute(n: int, pattern: np.ndarray, groups: list[list[list[int]]]) -> list[Run]:
    """Runs of ``n`` bins of ``pattern`` with actual lengths, taken from the groups in falling order.

    The last and smallest place of a pattern stays open: what rounding up left over makes it larger,
    and best fit finds the length that suits it.
    """
    slots = []
    places = np.repeat(np.arange(len(pattern)), pattern)
    for g in places[: max(1, len(places) - 1)]:
        taken, need = [], n
        while need:
            s, have = groups[g][0]
            take = min(need, have)
            taken.append([s, take])
            need -= take
            groups[g][0][1] -= take
            if not groups[g][0][1]:
                groups[g].pop(0)
        slots.append(taken)
    runs = []
    while slots[0]:
        step = min(slot[0][1] for slot in slots)
        runs.append(Run(step, tuple(slot[0][0] for slot in slots)))
        for slot in slots:
            slot[0][1] -= step
            if not slot[0][1]:
                slot.pop(0)
    return runs


def _best_fit(runs: list[Run], items: list[tuple[int, int]], capacity: int) -> list[Run]:
    """Put items (length, count), longest first, where least room is left over; else into new bins."""
    by_room: list[list[Run]] = [[] for _ in range(capacity + 1)]
    for run in runs:
        by_room[capacity - sum(run.lengths)].append(run)
    for s, n in items:
        room = s
        while n:
            while room <= capacity and not by_room[room]:
                room += 1
            if room > capacity:
                each = capacity // s
                run = Run(max(1, n // each), ())
                fits, room = each, capacity
            else:
                run = by_room[room].pop()
                fits = room // s
            full = min(run.bins, n // fits)
            if not full:                # the last few items share one bin
                full, fits = 1, n
            if run.bins > full:
                by_room[room].append(Run(run.bins - full, run.lengths))
            by_room[room - fits * s].append(Run(full, run.lengths + (s,) * fits))
            n -= full * fits
            room = s
    return [run for group in by_room for run in group if run.lengths]


def pack(counts: dict[int, int], capacity: int, groups: int = GROUPS) -> list[Run]:
    """Runs of bins that hold ``counts[length]`` items of each length from 1 to ``capacity``.

    Full lengths take a bin each. Large lengths are rounded up within ``groups`` groups of equally many
    items, bins of few sizes are optimised for them, and the actual lengths take the rounded places.
    Small lengths, and large ones that rounding left over, go best-fit into what room there is.
    """
    runs = [Run(counts[capacity], (capacity,))] if counts.get(capacity) else []
    lengths = sorted((s for s, n in counts.items() if n and s < capacity), reverse=True)
    large = [s for s in lengths if s * LARGE_SHARE > capacity]
    rest = {s: counts[s] for s in lengths}
    if large:
        amount = sum(counts[s] for s in large)
        grouped = _groups(large, counts, max(1, min(groups, amount, len(large))))
        rounded: dict[int, list[list[int]]] = {}
        for group in grouped:               # groups that round up to one size are one
            rounded.setdefault(group[0][0], []).extend(group)
        sizes = np.array(list(rounded), np.int64)
        members = list(rounded.values())
        demand = np.array([sum(n for _, n in m) for m in members], np.int64)
        for n, pattern in few_sizes(sizes, demand, capacity):
            runs += _substitute(n, pattern, members)
        for s in large:
            rest[s] = 0
        for m in members:
            for s, n in m:
                rest[s] += n
    return _best_fit(runs, [(s, rest[s]) for s in lengths if rest[s]], capacity)
