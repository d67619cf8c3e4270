import random
from collections import Counter

from earlymark.llm import decontamination as d

from .reference import words


def grams(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(docs, items, least=0.8):
    """(doc, item) -> (start, similarity) of the best window."""
    out = {}
    for i, text in docs.items():
        w = words(text)
        for j, item in items.items():
            b = words(item)
            k = min(5, len(b))
            if not k or len(w) < k:
                continue
            target, size = grams(b, k), min(len(b), len(w))
            for s in range(len(w) - size + 1):
                own = grams(w[s : s + size], k)
                common = sum((own & target).values())
                x = common / (own.total() + target.total() - common)
                if x >= least and x > out.get((i, j), (0, 0))[1] + 1e-12:
                    out[i, j] = (s, x)
    return out


def cases(seed=0):
    rng = random.Random(seed)
    text = lambda n, v=300: [f"w{rng.randrange(v)}" for _ in range(n)]
    items = {j: " ".join(text(rng.choice([8, 20, 40, 60]))) for j in range(8)}
    items |= {20: "One two", 21: "alone", 22: "", 23: None, 24: "a b a b a b a b a b"}
    docs = {}
    for i in range(40):
        parts = text(rng.randrange(0, 80))
        if i % 2:
            own = words(items[rng.randrange(8)])
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = "changed"
            parts += own
        docs[i] = " ".join(parts + text(rng.randrange(0, 40)))
    docs |= {100: None, 101: "", 102: "one TWO three", 103: "ALONE", 104: "x a b a b a b a b a b y", 105: " ".join(words(items[3])[:-1]), 106: "y " * 20_000 + items[2]}
    return docs, items


def test_finds_what_brute_force_finds(spark):
    docs, items = cases()
    rows = [(i, t, 1, "h") for i, t in docs.items()] + [(5, docs[5], 1, "h"), (None, items[1], 1, "h")]
    table = spark.createDataFrame(rows, "doc_id long, text string, n int, item_id string")
    bench = spark.createDataFrame([(j, t, 0) for j, t in items.items()] + [(None, docs[1], 0), (3, items[3], 0)], "item_id long, text string, width int")
    got = {(r.doc_id, r.item_id): (r.start, r.similarity) for r in d.contaminated(table, bench).collect()}
    want = {k: (s, round(x, 6)) for k, (s, x) in brute(docs, items).items()}
    assert got == want and len(want) >= 12


def test_all_shuffled(spark, monkeypatch):
    monkeypatch.setattr(d, "BROADCAST_ROWS", -1)
    docs, items = cases(seed=5)
    got = {(r.doc_id, r.item_id) for r in d.contaminated(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    assert got == set(brute(docs, items))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert d.contaminated(docs.limit(0), bench).count() == 0 and d.contaminated(docs, bench.limit(0)).count() == 0
    assert d.contaminated(docs, bench).count() == 1


def test_blocks_alone_find_nearly_all(spark):
    """With no filter before the fingerprints: all windows of all items' sizes."""
    docs, items = cases(seed=7)
    docs.pop(106)  # 20,000 words
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = set(brute(docs, items))
    got = {(r.doc_id, r.item_id) for r in d.contaminated(table, bench, every_window=True).collect()}
    assert got <= want and len(got) >= 0.9 * len(want) and len(want) >= 10


def test_one_id_with_two_texts_and_null_ids(spark):
    item, clean = "one two three four five six seven eight nine ten", "quite another text that holds nothing of the kind at all"
    rows = [(1, clean), (1, "so " + item), (None, item), (None, clean), (2, None), (3, "so " + item), (3, "so " + item)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, hash int, doc int")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    for _ in range(2):
        assert sorted((r.doc_id, r.start) for r in d.contaminated(docs, bench).collect()) == [(1, 1), (3, 1)]
        left = d.without_benchmark(docs, bench)
        assert left.columns == docs.columns
        assert sorted(((r.doc_id or 0, r.text or "") for r in left.collect())) == [(0, clean), (1, clean), (2, "")]
        docs = docs.repartition(3).orderBy("text")
