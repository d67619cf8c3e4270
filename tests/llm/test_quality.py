import zlib

import numpy as np

from pyspark.sql import functions as F

from earlymark.llm import quality as q


def test_views_of_odd_texts():
    texts = [b"", b"a", "é".encode() * 5, b"a a a a\nb\nb", b"WORD!! " * 50]
    x = q.text_view(texts)
    z = q.meta_view([None, "en", "", "fr", "de"], [None] * 5, [None, 1, -3, 9, 10**9], texts)
    assert x.shape == (5, q.TEXT_FEATURES) and z.shape == (5, q.META_FEATURES) and np.isfinite(x).all() and np.isfinite(z).all()


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    y = (rng.random(2100) < 0.5).astype(float)
    x = [(y[:, None] * 2 - 1 + rng.normal(scale=s, size=(2100, 3))).astype(np.float32) for s in (1.0, 1.3)]
    own, alone = (q.Views(x[0][:60], x[1][:60], y[:60]) for _ in range(2))
    for _ in range(3):
        said = [f.logit(v[60:2000]) for f, v in zip(own.fitted, x)]
        for k in (0, 1):
            for i in np.flatnonzero(np.abs(said[k]) > 2.2).tolist():
                own.teach(1 - k, i, x[1 - k][60 + i], int(said[k][i] > 0))
        own.fit()
    right = lambda m: ((m.scores(x[0][2000:], x[1][2000:])[2] > 0.5) == y[2000:]).mean()
    assert right(own.model()) >= 0.95 and right(own.model()) >= right(alone.model()) - 0.02


def plain(rows, labels, rounds, taught):
    """doc_id -> score, row by row in lists; rows in the order that they are numbered in."""
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    view = lambda r: (q.text_view([(r[1] or "").encode()])[0], q.meta_view([r[2]], [r[3]], [r[4]], [(r[1] or "").encode()])[0])
    known = sorted((r for r in rows if r[0] in labels and not held(r[0])), key=lambda r: r[0])
    rest = [r for r in rows if r[0] not in labels and not held(r[0])]
    own, pool = [view(r) for r in known], [view(r) for r in rest]
    both = q.Views(*(np.array([v[k] for v in own]) for k in (0, 1)), np.array([labels[r[0]] for r in known], float))
    for _ in range(rounds):
        said = []
        for k in (0, 1):
            p = [1 / (1 + np.exp(-both.fitted[k].logit(v[k][None, :])[0])) for v in pool]
            for label in (1, 0):
                for group in range(q.SOURCES):
                    sure = [(-(x if label else 1 - x), i) for i, x in enumerate(p) if (x if label else 1 - x) >= q.SURE and zlib.crc32((rest[i][3] or "").encode()) % q.SOURCES == group]
                    said += [(1 - k, i, label) for _, i in sorted(sure)[:taught]]
        for k, i, label in sorted(said, key=lambda x: (x[0], x[1], -x[2])):
            both.teach(k, i, pool[i][k], label)
        both.fit()
    model = both.model()
    return {r[0]: float(model.scores(*(x[None, :] for x in view(r)))[2][0]) for r in rows}


def test_is_plain_co_training_over_all_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").select("doc_id", "text", "lang", "source", "n_chars").limit(700).coalesce(1)
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect() if r.quality is not None and r.doc_id % 3}
    rows = [tuple(r) for r in docs.collect()]
    frame = spark.createDataFrame(rows, docs.schema).coalesce(1)
    got = {r.doc_id: r.score for r in q.quality(frame, spark.createDataFrame(list(labels.items()), "doc_id long, quality int"), rounds=2, taught=4).collect()}
    want = plain(rows, labels, 2, 4)
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in got) < 1e-4


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    out = q.quality(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (out.quality == out.predicted).mean() > 0.97 and out[out.quality == 1].predicted.mean() > 0.99
    assert out.score.between(0, 1).all()


def test_nulls_missing_labels_and_carried_columns(spark):
    rows = [(1, None, None, None, None, 7), (2, "", "en", "s", 0, 7), (2, "", "en", "s", 0, 7), (None, "x y " * 20_000, "en", "s", 3, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, extra int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = q.quality(docs, none, carry=docs.columns).collect()
    assert len(out) == 4 and all(r.predicted == 1 and r.extra == 7 for r in out)
    assert q.quality(docs.limit(0), none).count() == 0


def test_ids_with_two_texts_in_any_layout(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    second = docs.join(labels.select("doc_id"), "doc_id", "left_semi").withColumn("text", F.concat(F.lit("junk junk !!! "), F.reverse("text")))
    both = docs.unionByName(second)
    runs = []
    for d in (both.coalesce(1), both.repartition(5, "text"), both.orderBy(F.desc("text")).coalesce(2)):
        runs.append({(r.doc_id, r.key): r.score for r in q.quality(d.withColumn("key", F.md5("text")), labels, carry=["doc_id", "key"], rounds=2).collect()})
    for other in runs[1:]:
        assert other.keys() == runs[0].keys() and max(abs(other[k] - runs[0][k]) for k in other) < 1e-4
