"""Bin packing of integer lengths from their histogram: configuration LP, multiplicative weights, rounding.

The covering LP has one variable per configuration (a multiset of lengths that fits one bin) and one constraint per
length. It is solved without listing the configurations: each length has a weight that shrinks as the length gets
covered, and a knapsack dynamic programme finds the configurations of greatest weight. One table prices all of them:
for every length, the best configuration that contains it. The fractional solution is rounded to whole bins within
the counts left, the LP is solved again for what remains, and the last few lengths are placed best-fit, by runs of
equal lengths in bins of equal content. Configurations that leave more than some room are left to the next step; that
room is chosen among powers of two, up to the whole bin, by the number of bins that come out.

The work and the number of patterns depend on the capacity and the number of distinct lengths, not on the number of
items: a step of the LP ends a length or covers ``EPSILON`` of one, and best fit adds at most two patterns a length
to those it changes.
"""

from __future__ import annotations

import numpy as np

Pattern = tuple[tuple[int, int], ...]  # (length, count), longest first

EPSILON = 0.15  # share of a length that one step covers at most
ETA = 2.0  # weight of the lag of a length
WIDTH = 16  # configurations taken from one pricing
ROUNDS = 2  # solve, round, solve the rest


def _price(capacity: int, lengths: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: best value within each capacity, and the length to take first (0: none)."""
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, dtype=np.int64)
    of_length = np.full(capacity + 1, -np.inf)
    of_length[lengths] = value
    reverse = of_length[::-1]  # reverse[capacity - l] belongs to l
    for c in range(int(lengths[0]), capacity + 1):
        # best[0..c-1] against lengths c..1
        total = best[:c] + reverse[capacity - c : capacity]
        at = int(total.argmax())
        if total[at] > best[c - 1]:
            best[c], take[c] = total[at], c - at
        else:
            best[c], take[c] = best[c - 1], take[c - 1]
    return best, take


def _configuration(first: int, capacity: int, take: np.ndarray, counts: np.ndarray, rest: np.ndarray) -> dict[int, int]:
    """The priced configuration that holds ``first``, with no more items of a length than there are."""
    found = {first: 1}
    room = capacity - first
    while room > 0 and (length := int(take[room])):
        if found.get(length, 0) >= counts[length]:
            break
        found[length] = found.get(length, 0) + 1
        room -= length
    return found


def fractional(counts: np.ndarray, capacity: int) -> dict[Pattern, float]:
    """Approximate solution of the configuration LP: bins per configuration. ``counts[l]`` items have length l.

    The dual value of a length is its share of the bin times a weight, ``exp(ETA * uncovered share)``, that falls by
    a factor with each step that covers it.
    """
    rest = counts.astype(np.float64)
    solution: dict[Pattern, float] = {}
    while True:
        lengths = np.flatnonzero(rest > 1e-6)
        if not len(lengths):
            return solution
        value = lengths * np.exp(ETA * rest[lengths] / counts[lengths])
        best, take = _price(capacity, lengths, value)
        priced = value + best[capacity - lengths]
        met: set[int] = set()
        for length in lengths[np.argsort(-priced, kind="stable")].tolist():
            if length in met:
                continue
            config = _configuration(length, capacity, take, counts, rest)
            if met.intersection(config):
                continue
            step = min(min(rest[k], EPSILON * counts[k]) / n for k, n in config.items())
            key = tuple(sorted(config.items(), reverse=True))
            solution[key] = solution.get(key, 0.0) + step
            for k, n in config.items():
                rest[k] = max(0.0, rest[k] - step * n)
            met.update(config)
            if len(met) > 4 * WIDTH:
                break


def _best_fit(counts: np.ndarray, capacity: int) -> dict[Pattern, int]:
    """Best-fit decreasing by histogram: the bins that placing the items one by one would give.

    An item goes to the bin with the least room that fits, and the next equal item to the same bin while it fits, as its
    room is then the least. So a group of equal bins takes as many equal items each as fit, but for one bin at the end.
    """
    free: dict[int, dict[Pattern, int]] = {}
    mask = 0
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            fits = mask >> length
            room = length + (fits & -fits).bit_length() - 1 if fits else capacity
            each = room // length
            held, bins = free[room].popitem() if fits else ((), -(-left // each))
            if fits and not free[room]:
                del free[room]
                mask &= ~(1 << room)
            full = min(bins, left // each)
            left -= full * each
            last = left if full < bins else 0
            left -= last
            for n, times in ((each, full), (last, int(last > 0)), (0, bins - full - (last > 0))):
                if times > 0:
                    key = (*held, (length, n)) if n else held
                    group = free.setdefault(room - n * length, {})
                    group[key] = group.get(key, 0) + times
                    mask |= 1 << (room - n * length)
    plan: dict[Pattern, int] = {}
    for key, times in (item for group in free.values() for item in group.items()):
        plan[key] = plan.get(key, 0) + times
    return plan


def _whole_bins(solution: dict[Pattern, float], counts: np.ndarray, capacity: int, spare: int) -> tuple[dict[Pattern, int], np.ndarray]:
    """The solution rounded, larger shares first, never more items than there are; and the counts left.

    Configurations with more than ``spare`` room come to nothing.
    """
    left, plan = counts.copy(), {}
    for key in sorted(solution, key=lambda k: -solution[k]):
        if sum(length * n for length, n in key) < capacity - spare:
            continue
        times = min(int(solution[key] + 0.5), *(int(left[length]) // n for length, n in key))
        if times > 0:
            plan[key] = times
            for length, n in key:
                left[length] -= times * n
    return plan, left


def _merged(*plans: dict[Pattern, int]) -> dict[Pattern, int]:
    total: dict[Pattern, int] = {}
    for key, times in (item for plan in plans for item in plan.items()):
        total[key] = total.get(key, 0) + times
    return total


def solve(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> dict[Pattern, int]:
    """Whole bins per configuration that hold every item exactly once. ``counts`` has ``capacity + 1`` entries."""
    left = counts.astype(np.int64).copy()
    plan: dict[Pattern, int] = {}
    if left[capacity]:
        plan[((capacity, 1),)] = int(left[capacity])
        left[capacity] = 0
    best = _merged(plan, _best_fit(left, capacity))
    for _ in range(rounds):
        if left.sum() < 2:
            break
        solution = fractional(left, capacity)
        tried = []
        for spare in [0, *(1 << k for k in range(capacity.bit_length() + 1))]:
            bins, rest = _whole_bins(solution, left, capacity, spare)
            whole = _merged(plan, bins, _best_fit(rest, capacity))
            tried.append((sum(whole.values()), int(rest.sum()), spare, whole, bins, rest))
        fewest = min(tried, key=lambda t: t[:3])
        # At the same number of bins the plan of the later round: it leaves less to best fit.
        if fewest[0] <= sum(best.values()):
            best = fewest[3]
        plan, left = _merged(plan, fewest[4]), fewest[5]
        if not fewest[4]:
            break
    return best
