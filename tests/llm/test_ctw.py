import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from earlymark.llm import ctw

from .reference import UP, words


def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)


class Plain:
    """Context trees in dictionaries, node by node."""

    def __init__(self, texts, depth=ctw.DEPTH):
        self.depth, self.counts = depth, {}
        for t in texts:
            for context, node, bit in self.steps(t):
                for d in range(depth + 1):
                    self.counts.setdefault((context[depth - d :], node), [0, 0])[bit] += 1
        self.children = {}
        for context, node in self.counts:
            if context:
                self.children.setdefault((context[1:], node), []).append((context, node))
        self.weighted = {}
        for key in sorted(self.counts, key=lambda k: -len(k[0])):
            own = kt(*self.counts[key])
            if len(key[0]) < depth:
                own = np.logaddexp(own, sum(self.weighted[c] for c in self.children[key])) - math.log(2)
            self.weighted[key] = own

    def steps(self, text):
        data = b"\xff" * self.depth + text.translate(UP).encode() + b"\xff"
        for i in range(self.depth, len(data)):
            for t in range(8):
                yield data[i - self.depth : i], 1 << t | data[i] >> 8 - t, data[i] >> 7 - t & 1

    def one(self, context, node, d=0):
        key = (context[self.depth - d :], node)
        if key not in self.counts:
            return 0.5
        a, b = self.counts[key]
        here = (b + 0.5) / (a + b + 1)
        if d == self.depth or (context[self.depth - d - 1 :], node) not in self.counts:
            return here
        stop = math.exp(kt(a, b) - math.log(2) - self.weighted[key])
        return stop * here + (1 - stop) * self.one(context, node, d + 1)

    def score(self, text):
        return sum(math.log10(p if bit else 1 - p) for c, n, bit in self.steps(text) for p in [self.one(c, n)])


ROWS = [(i, t) for i, t in enumerate(["the cat sat. The cat", "A dog and a Dog", "", None, "the  dog\nsat é", "zebra ñ", "the cat sat on the mat " * 5, "x" * 300, "\tthe"])] + [(None, "the null"), (3, None), (6, "the cat sat on the mat " * 5)]


def docs(spark):
    return spark.createDataFrame([(i, t, 0.0) for i, t in ROWS], "doc_id long, text string, score double")


def want():
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    train = [t or "" for i, t in ROWS if not held(i)]
    counts = Counter(w for t in train for w in words(t))
    n, v, model = sum(counts.values()) + len(train), len(counts) + 1, Plain(train)
    out = []
    for i, t in ROWS:
        w = words(t)
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(train) + 1) / (n + v + 1))
        out.append((-1 if i is None else i, held(i), len(w) + 1, sum(x in counts for x in w) + 1, n, round(base, 6), round(model.score(t or ""), 6)))
    return sorted(out)


def got(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in df.collect())


def test_is_the_plain_model(spark):
    assert got(ctw.scored(docs(spark))) == want()


def test_many_small_parts_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(ctw, "PART", 30)
    monkeypatch.setattr(ctw, "ROWS_AT_ONCE", 3)
    assert got(ctw.scored(docs(spark).repartition(2))) == want()


def test_long_texts_and_clashing_columns(spark):
    long = "many words in one long text, " * 60_000  # over AT_ONCE bytes
    rows = [(1, "a", long, 0, 0), (1, "b", long, 0, 0), (5, "c", "many words", 0, 0)]
    out = ctw.scored(spark.createDataFrame(rows, "doc_id long, held_out string, text string, part int, kind int")).collect()
    assert len(out) == 3 and len({r.score for r in out if r.doc_id == 1}) == 1
    for r in out:
        text = long if r.doc_id == 1 else "many words"
        assert r.n_tokens == len(words(text)) + 1 and abs(r.bits_per_byte + r.score * math.log2(10) / (len(text) + 1)) < 1e-9


def test_probabilities_of_all_bytes_sum_to_one():
    model = Plain(["abracadabra", "abc"])
    for context in (b"\xffabra"[-ctw.DEPTH :].rjust(ctw.DEPTH, b"\xff"), b"zzzzz"):
        total = 0.0
        for byte in range(256):
            p = 1.0
            for t in range(8):
                one = model.one(context, 1 << t | byte >> 8 - t)
                p *= one if byte >> 7 - t & 1 else 1 - one
            total += p
        assert abs(total - 1) < 1e-9


def test_nothing_to_learn_from(spark):
    out = ctw.scored(docs(spark).where("doc_id = 0"), held_out=F.lit(True)).collect()[0]
    assert out.train_tokens == 0 and abs(out.score - 8 * 21 * math.log10(0.5)) < 1e-9
    assert ctw.scored(docs(spark).limit(0)).count() == 0


def test_lookup():
    keys = np.random.default_rng(0).integers(-(2**63), 2**63, 5000)
    table = ctw.Lookup(keys, np.arange(5000.0))
    assert (table.get(keys, -1) == np.arange(5000)).all() and (table.get(keys + 1, -1) == -1).mean() > 0.99
    assert (ctw.Lookup(keys[:0], np.zeros(0)).get(keys, 7.0) == 7).all()
