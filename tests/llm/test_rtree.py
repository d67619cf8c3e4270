import math
import random

import numpy as np
import pytest

from earlymark.llm import rtree as r


def plain(rows, anchors, positives=5, negatives=5):
    """All by sorting everything; rows: set of (id, label, tuple of whole numbers)."""
    rows, out = sorted(set(rows)), []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for a, label, q in (x for x in rows if anchors(x[0])):
        scored = sorted((-dot(q, v), i, other) for i, other, v in rows if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            hard = [(x, i) for x, i, other in scored if other != label and 80 * -s <= 100 * -x <= 100 * -s][:negatives]
            out += [(a, p, k, i, -s, -x) for k, (x, i) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows, parts=3):
    df = spark.createDataFrame([(i, g, list(v), 1, "x") for i, g, v in rows], "id long, label long, v array<long>, no int, told string").repartition(parts)
    return sorted(map(tuple, r.hard_negatives(df.select("id", "label", "v").distinct(), "id % 10 = 0").collect()))


def rows_of(seed, n, d=6, size=20, labels=4):
    rng = random.Random(seed)
    return [(k, rng.randrange(labels), tuple(rng.randrange(-size, size) for _ in range(d))) for k in range(n)]


@pytest.mark.parametrize(("tile", "leaf", "fan", "block"), [(16_384, 32, 16, 128), (50, 4, 2, 3), (7, 1, 2, 1)])
def test_all_partners_are_found(spark, monkeypatch, tile, leaf, fan, block):
    for name, value in zip(("TILE", "LEAF", "FAN", "BLOCK"), (tile, leaf, fan, block)):
        monkeypatch.setattr(r, name, value)
    rows = rows_of(tile, 300) + rows_of(1, 300, size=2)  # the second half shares ids with the first and has many ties
    assert mined(spark, rows) == plain(rows, lambda i: i % 10 == 0)


def test_equal_vectors_and_labels(spark):
    rows = [(k, 1, (3, 4)) for k in range(200)] + [(k, 2, (3, 4)) for k in range(200, 400)] + [(1000, 1, (3, 4))] * 3 + [(1001, 3, (0, 0)), (1002, 3, (-3, -4)), (1010, 4, (-1, 0))]
    got = mined(spark, rows)
    assert got == plain(rows, lambda i: i % 10 == 0) and any(x[0] == 1000 for x in got)


def test_large_and_uneven_vectors(spark):
    rows = [(k, k % 2, (2**28 + k, k)) for k in range(40)] + [(100 + k, k % 2, (k,) * k) for k in range(12)] + [(200, 0, ())]
    assert mined(spark, rows) == plain(rows, lambda i: i % 10 == 0)
    assert mined(spark, []) == []


def test_bounds_prune(monkeypatch):
    """Far clusters are never opened, and what is left is what brute force finds."""
    monkeypatch.setattr(r, "LEAF", 32)
    rng = np.random.default_rng(2)
    v = (rng.integers(-5, 6, (4000, 8)) + 100 * np.eye(8, dtype=np.int64)[rng.integers(0, 8, 4000)]).astype(np.float64)
    tree = r.Tree(np.arange(4000), np.zeros(4000, np.int64), v)
    assert sorted(tree.ids.tolist()) == list(range(4000)) and max(np.diff(tree.ends)) <= r.LEAF
    for level, above in zip(tree.levels, tree.levels[1:]):
        for k in range(len(above["least"])):
            own = slice(k * r.FAN, (k + 1) * r.FAN)
            assert (level["low"][own] >= above["low"][k]).all() and (level["high"][own] <= above["high"][k]).all()
    s = r.Search(tree, 0, 0, v[0])
    want = sorted((-int(x), i) for i, x in enumerate(v @ v[0]) if i)[:5]
    assert s.best(5, True) == want and len(s.scores) < len(tree.ends) / 2
    most = int(-want[2][0])
    assert s.best(3, True, most - 50, most) == sorted((-int(x), i) for i, x in enumerate(v @ v[0]) if i and most - 50 <= x <= most)[:3]


def test_what_takes_no_part(spark):
    rows = [(0, 1, [0.5, 0.25]), (1, 1, [0.5, None]), (2, 1, [math.nan, 0.1]), (3, 1, [math.inf, 0.1]), (4, None, [0.5, 0.5]), (5, 1, None), (None, 1, [0.5, 0.5]), (6, 1, [-0.001, 0.999]), (6, 1, [-0.001, 0.999])]
    got = sorted(map(tuple, r.usable(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")).collect()))
    assert got == [(0, 1, [128, 64]), (6, 1, [-1, 255])]


def test_result_is_that_of_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = sorted(con.sql(r.ORACLES["op13_rtree_hard_negatives"]).select(*names).fetchall())
    assert sorted(map(tuple, r.op13_rtree_hard_negatives(spark, sf).select(*names).collect())) == want and want
