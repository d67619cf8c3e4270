import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from earlymark.llm import suffixes as s

from .reference import removed, sha


def documents(seed=0, n=60):
    rng = random.Random(seed)
    letters = lambda k: "".join(rng.choice("abcdefgh é") for _ in range(k))
    passages = [letters(rng.randrange(90, 400)) for _ in range(8)]
    out = {}
    for i in range(n):
        parts = [letters(rng.randrange(0, 200))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            cut = rng.randrange(0, 30)
            parts += [p[cut:], letters(rng.randrange(0, 60))]
        out[i * 3] = "".join(parts)
    out[1000] = out[3]
    out[1001] = "z" * 700
    out[1002] = "ab" * 300
    out[1003] = "z" * 150 + "q" + "z" * 99
    out[1004], out[1005], out[1006] = None, "", "short"
    out[1007] = "tail " * 30_000
    return out


def check(spark, texts):
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in texts.items()], "doc_id long, text string, starts int, kind string")
    out = s.without_repeats(docs).withColumn("sha", F.sha2("kept", 256)).toPandas().set_index("doc_id")
    for i, (n, gone, spans, kept) in removed(texts).items():
        r = out.loc[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.sha) == (n, gone, spans, sha(kept)), i
    assert (out.starts == 1).all() and (out.kind == "k").all()


def test_removes_what_brute_force_removes(spark):
    check(spark, documents())


def test_small_batches_and_portions_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(s, "BATCH", 3)
    check(spark, documents(seed=4, n=40))


def test_runs_cover_every_window_once():
    texts = [t.encode() for t in documents(2, 30).values() if t]
    text, start, windows, distance, anchor, covered = s.runs(texts)
    assert (windows <= 69).all() and (distance + 0 <= 68).all()
    total = sum(max(0, len(t) - 99) for t in texts)
    assert windows.sum() == total
    seen = {(a, b + k) for a, b, w in zip(text.tolist(), start.tolist(), windows.tolist()) for k in range(w)}
    assert len(seen) == total
    by = {}
    for a, b, w, c in zip(text.tolist(), start.tolist(), windows.tolist(), covered.tolist()):
        assert by.setdefault(c, texts[a][b : b + w + 99]) == texts[a][b : b + w + 99]


def test_levels_stay_few_and_know_all():
    family, seen = s.IndexFamily(), set()
    rng = np.random.default_rng(0)
    for _ in range(40):
        batch = np.array([b"%0100d" % x for x in rng.integers(0, 900, 50)], "S100")
        want = []
        for x in batch.tolist():
            want.append(x in seen)
            seen.add(x)
        assert family.repeated(batch).tolist() == want
    assert len(family.levels) <= 11 and sum(map(len, family.levels)) == len(seen)


def test_null_ids_repeats_and_empty_tables(spark):
    text = "".join(map(str, range(200)))
    docs = spark.createDataFrame([(None, text), (5, text), (5, text), (6, text)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_removed) for r in s.without_repeats(docs).collect())
    assert got == [(-1, 0), (5, 0), (5, 0), (6, len(text))]
    assert s.without_repeats(docs.limit(0)).count() == 0


def test_as_text_has_whole_characters(spark):
    a = "é" * 80
    docs = spark.createDataFrame([(1, "x" + a), (2, "yy" + a + "zz"), (3, None)], "doc_id long, text string")
    out = {r.doc_id: r.kept for r in s.without_repeats(docs, as_text=True).collect()}
    assert out[2] == "yyzz" and out[3] is None and "�" not in out[1]


def test_windows_of_common_anchors_are_dealt_out(spark, monkeypatch):
    rng = random.Random(9)
    letters = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    passage, heads = letters(260), [letters(150) for _ in range(12)]
    texts = {i: rng.choice(heads)[rng.randrange(40) :] + letters(rng.randrange(3)) + passage + letters(120) for i in range(150)}
    monkeypatch.setattr(s, "FAMILY_RUNS", 5)
    check(spark, texts)
    docs = s.numbered(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    found = s.surveyed(docs)
    largest = found.where(f"kind = {s.OPEN}").groupBy("anchor").count().agg(F.max("count")).first()[0]
    size = F.sum(F.length("bytes") - s.LENGTH + 1)
    parts = s.open_parts(docs, found).cache()
    of_anchor, of_family = (parts.groupBy(*by).agg(size.alias("n")).agg(F.max("n")).first()[0] for by in (["anchor"], ["anchor", "family"]))
    assert largest > 60 and 4 * of_family <= of_anchor


def test_one_id_with_two_texts_and_null_ids(spark):
    rng = random.Random(9)
    letters = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    p, own, q = letters(300), letters(442), letters(150)
    rows = [(1, p), (2, own), (2, p), (None, q), (None, letters(120) + q), (3, q + letters(50)), (3, q + letters(50)), (4, None), (None, None), (4, "")]
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, copy string, doc int")
    for _ in range(2):
        out = s.without_repeats(docs, nulls_first=True).collect()
        assert len(out) == len(rows) and {(r["copy"], r.doc) for r in out} == {("x", 5)}
        by = {(r.doc_id, r.text): r for r in out}
        assert by[2, own].n_removed == 0 and by[2, p].n_removed == 300 and by[1, p].n_removed == 0
        gone = [r.n_removed for r in out if r.doc_id is None and r.text]
        assert sorted(gone) == [0, 150] and all(r.n_removed >= 150 for r in out if r.doc_id == 3)
        docs = docs.repartition(5)
    assert s.without_repeats(docs.limit(0)).count() == 0


def test_small_chunks_of_runs_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(s, "HELD_RUNS", 8)
    monkeypatch.setattr(s, "FAMILY_RUNS", 2)
    check(spark, documents(seed=11, n=40))


def test_many_ids_with_several_texts_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(s, "BROADCAST_ROWS", 0)
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c"), (None, "d"), (None, "e")], "doc_id long, text string")
    copies = {(r.doc_id, r.text): r["copy"] for r in s.numbered(docs).collect()}
    assert copies[2, "c"] == 0 and 0 not in (copies[1, "a"], copies[1, "b"], copies[None, "d"]) and copies[1, "a"] != copies[1, "b"]


def test_a_task_builds_its_index_families_one_after_the_other(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    class Counted(s.IndexFamily):
        def __init__(self):
            self.levels = []
            made.add(1)

    monkeypatch.setattr(s, "IndexFamily", Counted)
    check(spark, documents(seed=5, n=40))  # fewer windows than one task takes
    assert made.value == s.FAMILIES


def test_slices_have_one_value():
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array([0, 0, 0, 1, 3, 3, 3, 3, 3])], names=["n", "turn"])
    got = [x.column(0).to_pylist() for x in s._slices(batch, 1, 2)]
    assert got == [[0, 1], [2], [3], [4, 5], [6, 7], [8]] and not list(s._slices(batch.slice(0, 0), 1, 2))
