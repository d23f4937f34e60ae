"""The packing plan against placing items one by one, and on histograms where few bins can be filled."""

from __future__ import annotations

import numpy as np
import pytest

from saleloom.llm import config_lp

CAPACITY = 64


def histogram(lengths) -> np.ndarray:
    return np.bincount(np.asarray(lengths, dtype=np.int64), minlength=CAPACITY + 1)


def held(plan) -> np.ndarray:
    counts = np.zeros(CAPACITY + 1, dtype=np.int64)
    for pattern, times in plan.items():
        assert times > 0
        assert sum(length * n for length, n in pattern) <= CAPACITY
        for length, n in pattern:
            counts[length] += n * times
    return counts


def one_by_one(lengths) -> int:
    """Bins of best-fit decreasing, item by item."""
    rooms: list[int] = []
    for length in sorted(lengths, reverse=True):
        fitting = [(room, i) for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting)[1]] -= length
        else:
            rooms.append(CAPACITY - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_by_runs(seed):
    rng = np.random.default_rng(seed)
    high = int(rng.integers(3, CAPACITY + 1))
    lengths = rng.integers(1, high, int(rng.integers(0, 400)))
    if seed % 3 == 0:
        lengths = np.append(lengths, np.full(150, 41))  # one length that a third of all have
    plan = config_lp._best_fit(histogram(lengths), CAPACITY)
    assert (held(plan) == histogram(lengths)).all()
    assert sum(plan.values()) == one_by_one(lengths.tolist())


CASES = {
    "none": [],
    "one": [5],
    "whole bins": [CAPACITY] * 7 + [1],
    "no exact fill": [41] * 500,
    "all over half": list(range(33, 60)) * 40,
    "halves and thirds": [20, 21, 22, 23] * 100,
    "big and small": [47] * 300 + list(range(9, 22)) * 30,
    "ones": [1] * 1000,
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_plan_holds_every_item_once(case):
    counts = histogram(CASES[case])
    plan = config_lp.solve(counts, CAPACITY)
    assert (held(plan) == counts).all()
    bins = sum(plan.values())
    assert bins >= -(-int((counts * np.arange(CAPACITY + 1)).sum()) // CAPACITY)
    assert bins <= one_by_one(CASES[case])


def test_work_does_not_grow_with_items():
    counts = histogram([41, 30, 20, 13]) * 1_000_000_000
    plan = config_lp.solve(counts, CAPACITY)
    assert (held(plan) == counts).all()
    assert len(plan) < 50


def test_configurations_that_leave_room_are_used():
    # Two of 30 leave 4; no bin can be filled, and still the LP places nearly all items.
    counts = histogram([30] * 1000 + [25] * 300)
    solution = config_lp.fractional(counts, CAPACITY)
    bins, rest = config_lp._whole_bins(solution, counts, CAPACITY, CAPACITY)
    assert rest.sum() <= 2 * len(solution)
    assert sum(bins.values()) > 600
