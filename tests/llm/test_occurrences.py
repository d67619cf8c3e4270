import random

import numpy as np
import pytest

from earlymark.llm import occurrences as o

from .reference import components, shingles
from .test_minhash import near_copies


def check(spark, texts, extra=(), percent=80):
    rows = [(i, t, "en", 0) for i, t in texts.items()] + [(i, t, "en", 0) for i, t in extra]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rep string, component int").repartition(3)
    out = o.jaccard_components(docs, percent).toPandas()
    assert len(out) == len(rows)
    want = components(texts, percent)
    for r in out.itertuples():
        if r.doc_id == r.doc_id and r.doc_id is not None:
            assert r.component_id == want[int(r.doc_id)] and r.n_shingles == len(shingles(texts[int(r.doc_id)]))
    return out


@pytest.mark.parametrize(("short", "flush", "block"), [(24, 8 << 20, 4096), (3, 2000, 8), (2, 8 << 20, 4096)])
def test_components_are_exact(spark, monkeypatch, short, flush, block):
    monkeypatch.setattr(o, "SHORT", short)
    monkeypatch.setattr(o, "FLUSH", flush)
    monkeypatch.setattr(o, "BLOCK", block)
    check(spark, near_copies(seed=short), percent=85 if short == 2 else 80)


def test_shared_passages_and_sizes(spark):
    """Texts that share a passage of more or less than the threshold, and texts that hold another one whole."""
    rng, out = random.Random(5), {}
    passage = [f"p{k}" for k in range(80)]
    for k in range(150):
        own = [f"q{rng.randrange(10**6)}" for _ in range(rng.choice([2, 8, 14, 20, 26, 90]))]
        out[k] = " ".join(passage + own if k % 2 else own[:3] + passage + own[3:])
    check(spark, out)


def test_common_passages_make_no_groups(spark, monkeypatch):
    """In much text the cells tell little of a shingle; here they tell nothing. Texts with common passages and else nothing in common aren't groups."""
    rng, texts, most = random.Random(7), {}, []
    passages = [" ".join(f"c{k}w{j}" for j in range(9)) for k in range(6)]
    for k in range(300):
        parts = [" ".join(f"d{k}w{j}v{i}" for j in range(18)) for i in range(4)]
        texts[k] = " ".join(x for pair in zip(parts, [*rng.sample(passages, 3), ""]) for x in pair)
    texts |= {1000 + k: f"{texts[k]} one more" for k in range(40)}
    exact = o.exact_edges

    def seen(docs, reps, groups, percent):
        most.append(groups.groupBy("component").count().agg({"count": "max"}).first()[0])
        return exact(docs, reps, groups, percent)

    monkeypatch.setattr(o, "frequencies", lambda rows: np.zeros(1 << o.CELLS_BITS, np.uint64))
    monkeypatch.setattr(o, "exact_edges", seen)
    out = check(spark, texts)
    assert (out[out.doc_id >= 1000].component_id == out[out.doc_id >= 1000].doc_id - 1000).all()
    assert most == [2], most


@pytest.mark.parametrize("percent", [50, 80, 99, 100])
def test_search_finds_what_brute_force_finds(percent):
    rng = np.random.default_rng(percent)
    for _ in range(20):
        base = rng.choice(10**6, 120, replace=False).astype(np.uint64)
        sets = []
        for _ in range(60):
            s = rng.permutation(base)[: rng.integers(60, 121)]
            s = np.concatenate([s, rng.choice(10**9, rng.integers(0, 30), replace=False).astype(np.uint64)])
            sets.append(np.unique(s))
        got, want = o.linked(sets, percent).roots(), o.Forest(len(sets))
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    want.join(np.array([i]), np.array([j]))
        assert len({*zip(got.tolist(), want.roots().tolist())}) == len(set(got.tolist())) == len(set(want.roots().tolist()))


def test_every_link_shares_the_merged_lists():
    """The occurrences that a pair must have among the merged lists are at least one, and no linked pair has fewer."""
    for n in range(1, 200):
        for m in range(n, n * 100 // 80 + 1):
            t = o.least_overlap(n, m, 80)
            assert 100 * t >= 80 * (n + m - t) and 100 * (t - 1) < 80 * (n + m - t + 1)
            kept = m - o.prefix_lists(m, 80)
            assert t - kept >= 1 and t - (n - o.prefix_lists(n, 80)) >= 1


def test_nulls_repeats_and_long_texts(spark):
    texts = {1: None, 2: "", 3: "same words here", 4: "Same  words\nhere", 5: "x " * 30_000, 6: "x " * 30_001, 9: "other", 10: " "}
    out = check(spark, texts, extra=[(3, "same words here"), (None, "same words here"), (None, "alone in its class")])
    assert set(out[out.doc_id.isna()].component_id.dropna()) == {3.0}
    assert o.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_result_is_that_of_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(o.ORACLES["op12_divide_skip_jaccard"]).df().sort_values("doc_id").values.tolist()
    got = o.op12_divide_skip_jaccard(spark, sf).toPandas()[["doc_id", "n_shingles", "component_id"]].sort_values("doc_id").values.tolist()
    assert got == want
