import random
import re
from collections import Counter

import numpy as np
import pytest

from earlymark.llm import phrases as p

from .reference import UP


def plain(rows, least, best):
    """rank -> row of each language, by counting every phrase."""
    f, n = {}, Counter()
    for text, lang in rows:
        own = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UP)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(w)
            own.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        cand, longer = [], Counter()
        for ph, a in own.items():
            if len(ph) == 3 and a >= least:
                for part in (ph[:2], ph[1:]):
                    longer[part] = max(longer[part], a)
        for ph, a in own.items():
            if len(ph) == 1 or a < least or (len(ph) == 2 and longer[ph] and 100 * longer[ph] >= 50 * a):
                continue
            score, k = min((1_000_000 * a * a // (own[ph[:k]] * own[ph[k:]]), k) for k in range(1, len(ph)))
            cand.append((-score, -a, " ".join(ph).encode(), own[ph[:k]], own[ph[k:]]))
        out += [(lang, r, x.decode(), -a, lf, rt, n[lang], -s) for r, (s, a, x, lf, rt) in enumerate(sorted(cand)[:best], 1)]
    return sorted(out)


def texts(seed, rows, words):
    rng = random.Random(seed)
    vocab = [f"W{rng.randrange(words)}é" if k % 5 == 0 else f"w{k}" for k in range(words)]
    return [("".join(f"{rng.choice([*vocab[: rng.randrange(1, words)], 'alpha Beta gamma'])}{rng.choice([' ', ' ', ' ', '  ', chr(9), '. ', ', ', chr(10)])}" for _ in range(rng.randrange(0, 80))), rng.choice(["en", "de", None, ""])) for _ in range(rows)]


def mined(spark, rows, least=10, best=2000, parts=3):
    docs = spark.createDataFrame([(k, t, g, 1) for k, (t, g) in enumerate(rows)], "doc_id long, text string, lang string, key int").repartition(parts)
    return sorted(map(tuple, p.collocations(docs, least, best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("proposed", [1, 2, 10**9])
def test_whatever_the_sample_proposes(spark, monkeypatch, proposed):
    """With nothing proposed the border's passes find all; with a small table phrases are counted that weren't proposed."""
    monkeypatch.setattr(p, "PROPOSED", proposed)
    monkeypatch.setattr(p, "AT_ONCE", 3000)
    rows = texts(proposed % 7, 300, 40)
    want = plain(rows, 5, 2000)
    assert mined(spark, rows, 5) == want and {len(r[2].split()) for r in want} == {2, 3}


def test_passes_until_closed(spark, monkeypatch):
    """A triple whose pairs and words all fail to be proposed needs two expansions."""
    monkeypatch.setattr(p, "PROPOSED", 10**9)
    passes, counts = [], p.counts
    monkeypatch.setattr(p, "counts", lambda *a: passes.append(1) or counts(*a))
    rows = [("red green blue", "en")] * 12
    assert mined(spark, rows) == plain(rows, 10, 2000) and len(passes) == 4


def test_ties_at_the_last_rank(spark):
    rows = [(" . ".join(f"a{k} b{k}" for k in range(30)), "en")] * 10 + [("x y z x y z", None)] * 10
    assert mined(spark, rows, best=7) == plain(rows, 10, 7)


def test_large_counts_are_exact(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    a, left, right = 999_999_999_937, 10**12, 10**12 + 39
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(p.floor_score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 1_000_000 * a * a // (left * right)
    assert Decimal(1_000_000) * a * a > 2**64


def test_nulls_repeats_empty_and_long(spark):
    rows = [(None, None), ("", "en"), ("  ..  ", "en"), ("one two " * 3000 + "three", "en"), ("x" * 50_000 + " y", "en")] + [("same words. same words", "fr")] * 5
    assert mined(spark, rows) == plain(rows, 10, 2000)
    assert mined(spark, []) == [] and mined(spark, [("a b", "en")]) == []
    w = p.Words([b"A b", b"", b"a B,a\x0bb"], np.array([1, 2, 1], np.uint64))
    assert w.word[0] == w.word[2] == w.word[4] and list(w.goes_on) == [True, False, True, False, False]


def test_result_is_that_of_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = sorted(con.sql(p.ORACLES["op11_toivonen_collocations"]).select(*names).fetchall())
    assert sorted(map(tuple, p.op11_toivonen_collocations(spark, sf).select(*names).collect())) == want and len(want) > 20
