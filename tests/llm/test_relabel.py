"""Labels merged by new links equal the components of all links."""

from __future__ import annotations

import random

import pytest

from saleloom.llm import set_join
from saleloom.llm.components import components

LINKS = "a long, b long"


def lowest_of(links) -> dict[int, int]:
    label = {n: n for link in links for n in link}
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def labels(df) -> dict[int, int]:
    rows = df.collect()
    assert len({r["class"] for r in rows}) == len(rows)
    return {r["class"]: r["found_label"] for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_rounds_of_links(spark, seed):
    rng = random.Random(seed)
    first = [(rng.randrange(-40, 40), rng.randrange(40, 60)) for _ in range(20)]
    named = components(spark.createDataFrame(first, LINKS)).selectExpr("node AS class", "label AS found_label")
    seen = list(first)
    for _ in range(2):
        # Links between old components, to classes without a link so far, and among these.
        more = [(rng.randrange(-60, 0), rng.randrange(0, 90)) for _ in range(8)] + [(200 + len(seen), 300), first[0]]
        seen += more
        named = set_join._relabelled(named, spark.createDataFrame(more, LINKS))
    assert labels(named) == lowest_of(seen)
