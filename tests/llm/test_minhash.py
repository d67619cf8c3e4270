import random

import numpy as np

from earlymark.llm import minhash as m
from earlymark.llm.graphs import connected_components

from .reference import components, shingles


def near_copies(seed=1, bases=6, copies=40):
    """Copies with more and more edits, so that similarities lie on both sides of the threshold."""
    rng, out = random.Random(seed), {}
    for b in range(bases):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([6, 30, 120, 300]))]
        for c in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, max(1, len(w) // 20) + 1)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            out[len(out) * 7 + b] = " ".join(w)
    return out


def test_chunk_keys_meet_within_the_radius():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**16, (200, m.SYMBOLS)).astype(np.uint16)
    other = base.copy()
    for row in other:
        at = rng.choice(m.SYMBOLS, m.RADIUS, replace=False)
        row[at] ^= 1
    a, b = m.chunk_keys(base), m.chunk_keys(other)
    assert all(np.intersect1d(x, y).size for x, y in zip(a, b))


def test_sets_are_those_of_the_words():
    texts = ["", " \t", "One two", "a b c d e", "a b c d e f a b c d e", "A\x0bb C\nd e"]
    assert [len(s) for s in m.shingle_sets([t.encode() for t in texts])] == [len(shingles(t)) for t in texts]
    x, y = m.shingle_sets([b"A B c D e", b"a b C\nd  e"])
    assert x == y and m.shingle_sets([b"a b"])[0] != m.shingle_sets([b"b a"])[0]


def check(spark, texts, extra=(), percent=85):
    rows = [(i, t, "en", 0) for i, t in texts.items()] + [(i, t, "en", 0) for i, t in extra]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rep string, component int")
    out = m.near_duplicates(docs, percent).toPandas()
    assert len(out) == len(rows)
    want = components(texts, percent)
    for r in out.itertuples():
        if r.doc_id == r.doc_id and r.doc_id is not None:
            assert r.component_id == want[int(r.doc_id)] and r.n_shingles == len(shingles(texts[int(r.doc_id)])) and r.kept == (r.doc_id == r.component_id)
    return out


def test_components_are_exact(spark):
    check(spark, near_copies())
    check(spark, near_copies(seed=2, bases=3), percent=80)


def test_edges_of_a_hot_bucket_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 8)
    check(spark, near_copies(seed=3, bases=2, copies=60))


def test_nulls_repeats_and_long_texts(spark):
    texts = {1: None, 2: "", 3: "same words here", 4: "Same  words\nhere", 5: "x " * 30_000, 6: "x " * 30_001, 9: "other", 10: " "}
    out = check(spark, texts, extra=[(3, "same words here"), (None, "same words here"), (None, "alone in its class")])
    lost = out[out.doc_id.isna()]
    assert set(lost.component_id.dropna()) == {3.0} and sorted(lost.kept) == [False, True]
    assert m.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (7, 7), (200, 5)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, 200: 0, 100: 100, 101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
