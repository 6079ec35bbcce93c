"""A packing plan from the counts of lengths alone, as runs of equal sequences.

Its size depends on the number of different lengths, never on the number of documents.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Run(NamedTuple):
    """Documents of ``length`` with rank ``rank`` to ``rank + count`` go to sequences ``sequence`` and on, at ``offset``."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def _best_filling(room: int, sizes: list[int], left: list[int]) -> list[int]:
    """How many of each size fill ``room`` best, large ones first among equals."""
    # reach[w]: (size index, copies, previous w) of the first way found to use w.
    reach: dict[int, tuple[int, int, int]] = {0: (-1, 0, 0)}
    for k, (size, n) in enumerate(zip(sizes, left)):
        for used in list(reach):
            for copies in range(1, min(n, (room - used) // size) + 1):
                reach.setdefault(used + copies * size, (k, copies, used))
        if room in reach:
            break
    counts, at = [0] * len(sizes), max(reach)
    while at:
        k, copies, at = reach[at]
        counts[k] += copies
    return counts


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """(copies per size, number of sequences) covering the demand; sizes descend.

    Each configuration holds the largest size left and the best filling beside it, as often as the demand allows.
    """
    left, out = list(demand), []
    for k, size in enumerate(sizes):
        while left[k]:
            rest = left[k:]
            rest[0] -= 1
            copies = _best_filling(capacity - size, sizes[k:], rest)
            copies[0] += 1
            times = min(n // c for n, c in zip(left[k:], copies) if c)
            for i, c in enumerate(copies):
                left[k + i] -= c * times
            out.append(([0] * k + copies, times))
    return out


def plan(counts: np.ndarray, capacity: int, groups: int = 600, small: int = 4) -> list[Run]:
    """Runs that place every document; ``counts[n]`` documents have length ``n``, ``0 < n <= capacity``.

    Linear grouping: lengths above ``capacity / small`` are ranked and cut into ``groups`` of equal
    cardinality, each rounded up to its longest. Configurations are sought for these few sizes, actual
    documents take the rounded places, and shorter ones go best-fit into what is left.
    """
    counts = np.asarray(counts, np.int64)
    runs: list[Run] = []
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs of sequences (first, number)
    used = np.zeros(capacity + 1, np.int64)  # documents of a length placed so far
    sequences = 0

    large = [n for n in range(capacity, capacity // small, -1) if counts[n]]
    # Documents of large lengths in descending order, as borders of equal lengths.
    total = int(sum(counts[n] for n in large))
    border = np.cumsum([0] + [counts[n] for n in large])
    cuts = [total * g // groups for g in range(groups + 1)]
    members = [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
    longest = [large[int(np.searchsorted(border, a, side="right")) - 1] for a, _ in members]
    sizes = sorted(set(longest), reverse=True)
    first = {s: min(a for (a, _), x in zip(members, longest) if x == s) for s in sizes}
    demand = [sum(b - a for (a, b), x in zip(members, longest) if x == s) for s in sizes]
    taken = [first[s] for s in sizes]
    for copies, times in configurations(sizes, demand, capacity):
        places = []  # first document of each place, in descending order
        for k, c in enumerate(copies):
            places += [taken[k] + j * times for j in range(c)]
            taken[k] += c * times
        # Within these stretches every place keeps its actual length.
        steps = {0, times}
        for at in places:
            inside = border[np.searchsorted(border, at, side="right") : np.searchsorted(border, at + times)]
            steps.update((inside - at).tolist())
        steps = sorted(steps)
        for lo, hi in zip(steps, steps[1:]):
            offset = 0
            for at in places:
                i = int(np.searchsorted(border, at + lo, side="right")) - 1
                runs.append(Run(large[i], int(at + lo - border[i]), hi - lo, sequences + lo, offset))
                offset += large[i]
            room.setdefault(capacity - offset, []).append((sequences + lo, hi - lo))
        sequences += times
    for n in large:
        used[n] = counts[n]

    free = np.zeros(capacity + 1, bool)
    free[list(room)] = True
    for n in range(capacity // small, 0, -1):
        left = int(counts[n])
        while left:
            fits = np.flatnonzero(free[n:])
            if len(fits):
                tight = n + int(fits[0])
                begin, number = room[tight].pop()
                if number > left:
                    room[tight].append((begin + left, number - left))
                    number = left
                if not room[tight]:
                    del room[tight]
                    free[tight] = False
            else:  # open as many sequences as these documents need when they share them
                tight, begin = capacity, sequences
                number = -(-left // (capacity // n))
                sequences += number
            runs.append(Run(n, int(used[n]), number, begin, capacity - tight))
            used[n] += number
            left -= number
            room.setdefault(tight - n, []).append((begin, number))
            free[tight - n] = True
    return runs
