"""Connected components against union-find: chains, stars, rings, repeated and self links, nulls, no links."""

import random

import pytest

from daybook.llm import components
from daybook.llm.components import connected_components


def brute(links):
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in root}


CASES = {
    "none": [],
    "nulls and self links": [(1, None), (None, 2), (3, 3), (None, None), (5, 4), (4, 5), (5, 4)],
    "chain": [(i, i + 1) for i in range(60)],
    "chain backwards": [(100 - i, 99 - i) for i in range(60)],
    "star with a large hub": [(1000, i) for i in range(500)],
    "ring": [(i, (i + 1) % 40) for i in range(40)],
    "negative ids": [(-5, 3), (3, -9), (2**62, -(2**62))],
    "random": [(random.Random(i).randrange(300), random.Random(-i).randrange(300)) for i in range(260)],
}


@pytest.mark.parametrize("case", CASES)
def test_components(spark, case):
    got = connected_components(spark.createDataFrame(CASES[case], "a long, b long")).collect()
    assert len(got) == len({r.node for r in got}) and {r.node: r.root for r in got} == brute(CASES[case])


def test_a_star_is_written_once(spark, monkeypatch):
    written = []
    write = components.materialize
    monkeypatch.setattr(components, "materialize", lambda *a: written.append(a) or write(*a))
    star = spark.createDataFrame([(0, i) for i in range(1, 50)], "a long, b long")
    assert {tuple(r) for r in connected_components(star).collect()} == {(i, 0) for i in range(50)}
    assert len(written) == 1
