import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from earlymark.llm import toxicity as t


def plain_kernel(s, u, n=t.ORDER, decay=t.DECAY):
    total = 0.0
    for a in itertools.combinations(range(len(s)), n):
        for b in itertools.combinations(range(len(u)), n):
            if all(s[i] == u[j] for i, j in zip(a, b)):
                total += decay ** (a[-1] - a[0] + b[-1] - b[0] + 2)
    return total


def test_kernel_counts_gapped_subsequences():
    words = ["idiot", "ixdiot", "idio", "clown", "abcabc", "tab"]
    for a, b in itertools.product(words, words):
        got = t.subsequence_kernel(t.coded([a], -1), t.coded([b], -2))[0]
        assert abs(got - plain_kernel(a, b)) < 1e-4 * max(1, got)


def test_gaps_and_inserted_characters_still_count():
    f = t.Features(["idiot", "worthless"])
    clean = f(["a fine idea about iodine and worth less"])[0]
    for text in ("you idiot", "you IDIOT!!", "you i.d.i.o.t", "you i d i o t", "you idxiot"):
        assert np.abs(f([text])[0][:4] - clean[:4]).max() > 0.2, text


def test_windows_cover_long_words():
    word = "".join(chr(97 + i % 26) for i in range(100))
    parts = t.windows(word)
    assert all(len(x) <= t.WINDOW for x in parts) and all(any(word[i : i + 12] in x for x in parts) for i in range(89))


def test_machine_and_scale_separate():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + 0.1 * rng.normal(size=400) > 1).astype(float)
    w = t.fit_svm(x, y)
    margin = x @ w[:-1] + w[-1]
    slope, shift = t.fit_scale(margin, y)
    p = 1 / (1 + np.exp(-(slope * margin + shift)))
    assert ((p >= 0.5) == y).mean() > 0.95 and slope > 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    out = t.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    rank = out.score.rank()
    n = int(out.toxic.sum())
    auc = (rank[out.toxic == 1].sum() - n * (n + 1) / 2) / (n * (len(out) - n))
    assert auc > 0.95 and (out.toxic == out.predicted).mean() > 0.96
    assert out.score.between(0, 1).all() and set(out.predicted) <= {0, 1}


def test_nulls_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (2, "", 1), (None, "idiot " * 9000, 0), (9, "some words", 0)], "doc_id long, text string, toxic int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for labels in (none, spark.createDataFrame([(1, 1, 1), (None, 0, 1), (9, 0, None)], "doc_id long, quality int, toxic int")):
        out = t.toxicity(docs, labels).collect()
        assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
        assert {r.doc_id: r.held_out for r in out}[9] == (zlib.crc32(b"9") % 5 == 0)
    assert t.toxicity(docs.limit(0), none).count() == 0


def test_score_ignores_everything_but_text(spark):
    rows = [(i, f"plain words {i % 7}" + (" rotten idiot" if i % 3 == 0 else ""), "en", f"s{i % 3}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    out = t.toxicity(docs, labels).join(docs, "doc_id").groupBy("text").agg(F.countDistinct("score").alias("n"), F.max("predicted").alias("p")).collect()
    assert all(r.n == 1 and r.p == int("idiot" in r.text) for r in out)


def test_short_landmarks_are_found_in_long_words():
    f = t.Features(["idiot", "moron", "clown", "liar", "git"])
    clean = f(["qwertzuopasdfghjkyxcvbnm"])[0]
    noise = "qwertzupasdfghjkyxcvbqwertzupasdfghjky"
    plain = [noise[:k] + "idiot" + noise[k:] for k in range(0, len(noise), 5)]
    glued = ["fool,idiot,clown,moron,liar", "you-are-such-an-idiot-and-more-than-that", "|name|moron|12|", "x" * 12 + "clown" + "y" * 12, noise * 40 + "moron" + noise * 40, "a_git_b", "you g i t"]
    for text in plain + glued:
        assert np.abs(f([text])[0][:10] - clean[:10]).max() > 0.2, text
    listed = f(["fool,idiot,clown,moron,liar"])[0]
    apart = f(["fool idiot clown moron liar"])[0]
    assert np.abs(listed[:10] - apart[:10]).max() < 0.05


def test_every_stretch_stands_in_a_window():
    for length in range(3, 25):
        for n in range(1, 150, 7):
            word = "".join(chr(0x4E00 + i) for i in range(n))
            own = list(t.windows_for(word, length))
            size = min(n, length + length // 2)
            assert all(len(x) <= 2 * length for x in own) and all(any(word[i : i + size] in x for x in own) for i in range(n - size + 1))


def plain_features(text, marks, white):
    """Word by word from the plain kernel, without the pre-selection of words."""
    m, words = len(marks), text.lower().split()
    total, largest = np.zeros(m), np.zeros(m)
    norm = lambda a: max(plain_kernel(a, a), 1e-12) ** 0.5
    for w in words + t.spelled(words):
        for j, mark in enumerate(marks):
            own = [0.0] + [plain_kernel(x, mark) / (norm(x) * norm(mark)) for x in t.parts(w) if 0.6 * len(mark) <= len(x) <= 3 * len(mark)]
            v = min(1.0, max(0.0, (max(own) - t.LEAST) / (1 - t.LEAST)))
            total[j] += v
            largest[j] = max(largest[j], v)
    return np.concatenate([np.log1p(total) @ white, largest @ white, [np.log1p(len(words))]])


TEXTS = [f"{a} {b} {c}" for a in ("you", "that is some", "a fine") for b in ("idiot", "idxiot!", "i.d.i.o.t", "wor-thless", "w o r t h l e s s", "clowns", "garden", "worthy", "idea") for c in ("", "of the house")][:40]


def test_scores_are_those_of_plain_features(spark):
    rows = [(i, x) for i, x in enumerate(TEXTS * 5)]
    bad = lambda x: any(y in x.replace("-", "").replace(".", "").replace("x", "") for y in ("idiot", "worthless", "clowns", "w o r t h"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = {i: int(bad(x)) for i, x in rows}
    got = {r.doc_id: r.score for r in t.toxicity(docs, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")).collect()}
    learn = [(i, x) for i, x in rows if zlib.crc32(str(i).encode()) % 5]
    marks = t.chosen_landmarks(spark.createDataFrame([(x, labels[i]) for i, x in learn], "text string, toxic int"), t.LANDMARKS, t.CANDIDATES)
    white = t.Features(marks).white
    by_text = {x: plain_features(x, marks, white) for x in TEXTS}
    x, y = np.array([by_text[v] for _, v in learn]), np.array([labels[i] for i, _ in learn])
    third = np.arange(len(x)) % 3 == 0
    middle, w = t.fit_svm(x[~third], y[~third]), t.fit_svm(x, y)
    slope, shift = t.fit_scale(np.column_stack([x[third], np.ones(third.sum())]) @ middle, y[third])
    want = {i: 1 / (1 + np.exp(-(slope * (by_text[v] @ w[:-1] + w[-1]) + shift))) for i, v in rows}
    assert len(marks) >= 2 and max(abs(got[i] - want[i]) for i in got) < 2e-3


def test_the_layout_of_files_changes_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    runs = []
    for d, lab in ((docs, labels), (docs.repartition(7, "text"), labels.repartition(3)), (docs.orderBy(F.desc("doc_id")).coalesce(2), labels.coalesce(1))):
        runs.append({r.doc_id: (r.score, r.predicted) for r in t.toxicity(d, lab).collect()})
    for other in runs[1:]:
        assert other.keys() == runs[0].keys()
        assert max(abs(other[i][0] - runs[0][i][0]) for i in other) < 1e-4 and all(other[i][1] == runs[0][i][1] for i in other)


def test_forgotten_words_count_in_their_batch(monkeypatch):
    """However few words are remembered, a text's features are those that it has alone."""
    texts = ["you idiot here", "garden of the house", "idiot clown", "wor-thless idea", "you idiot here", "clowns", "new words and idiot"] * 3
    alone = [t.Features(["idiot", "clown", "worthless"])([x])[0] for x in texts]
    monkeypatch.setattr(t, "REMEMBERED", 1)
    f = t.Features(["idiot", "clown", "worthless"])
    got = [row for k in range(0, len(texts), 2) for row in f(texts[k : k + 2])]
    assert np.allclose(got, alone) and any(row[0] for row in got)
