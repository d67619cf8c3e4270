"""Connected components against plain union of sets."""

import random

import pytest

from earlymark.llm.graphs import connected_components


def _plain(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(parent)}


_RNG = random.Random(1)


@pytest.mark.parametrize(
    "edges",
    [
        [(k, k + 1) for k in range(40)],
        [(0, k) for k in range(1, 200)] + [(199, k) for k in range(200, 300)] + [(7, 7), (2000, 2000)],
        [(_RNG.randrange(300), _RNG.randrange(300)) for _ in range(180)],
        [(-(1 << 62), 5), (5, -9), (5, -9), (3, 3)],
        [],
    ],
)
def test_components(spark, edges):
    out = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len({r.node for r in out}) == len(out)
    assert {r.node: r.component for r in out} == _plain(edges)
