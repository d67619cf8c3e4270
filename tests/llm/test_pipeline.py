import pytest

from .reference import components, removed, words

pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in pipeline.STAGES:
        new = pipeline.stored(stage(spark, docs, SF))
        out.append((docs, new))
        docs = new
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_dedup", "suffix_dedup", "decontamination", "packing"]
    for before, after in stages[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"] and after.schema.simpleString() == before.schema.simpleString()


def test_quality_keeps_good_and_drops_bad(spark, stages):
    kept, labels = texts(stages[0][1]), spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert sum(r.doc_id in kept for r in labels if r.quality == 1) >= 0.97 * sum(r.quality == 1 for r in labels)
    assert sum(r.doc_id in kept for r in labels if r.quality == 0) <= 0.5 * sum(r.quality == 0 for r in labels)


def test_one_of_each_group(stages):
    before, after = (texts(x) for x in stages[1])
    want = components(before, 80)
    assert after == {i: t for i, t in before.items() if want[i] == i}


def test_passages_go(stages):
    before, after = (texts(x) for x in stages[2])
    want = removed(before)
    assert after == {i: want[i][3].decode("utf-8", "ignore") for i in before}
    assert all(r.n_chars == len(r.text) for r in stages[2][1].collect())


def test_benchmark_goes(spark, stages):
    before, after = (texts(x) for x in stages[3])
    items = [" ".join(words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, t in before.items():
        if any(b in " ".join(words(t)) for b in items):
            assert i not in after
        elif i not in after:
            assert any(len(set(b.split()) & set(words(t))) > 0.5 * len(set(b.split())) for b in items)


def test_packing_takes_all(stages):
    before, pieces = texts(stages[4][0]), stages[4][1].toPandas()
    assert set(pieces.doc_id) == set(before)
    for _, g in pieces.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 1024


def test_run_is_the_stages(spark, stages):
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, pipeline.run(spark, SF).select(*cols).collect())) == sorted(map(tuple, stages[-1][1].select(*cols).collect()))


def test_odd_rows_in_every_stage(spark):
    """Null ids, null and empty texts, repeated rows, one id with two texts, and columns that the stages use themselves."""
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(words(r.text)) >= 20)
    long = " ".join(f"w{i % 977}x{i % 89}" for i in range(60_000))
    a, b = (" ".join(f"{c}{i * 37 % 1009}" for i in range(60)) for c in "ab")
    rows = [(None, a), (1, a), (None, b), (None, b), (2, item), (None, "see " + item), (3, None), (None, None), (4, ""), (5, long), (5, "one id, two texts"), (6, "word " + long[:300])]
    names = "doc_id long, text string, lang string, source string, n_chars long, predicted int, kept string, shard int, `a.b` int, _doc int, root int"
    docs = spark.createDataFrame([(*r, "en", "web", len(r[1] or ""), 7, "k", 8, 9, 10, 11) for r in rows], names)
    known = pipeline.STAGES[:4]
    for name, stage in known:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        got = out.collect()
        assert all((r.predicted, r.kept, r.shard, r["a.b"], r._doc, r.root) == (7, "k", 8, 9, 10, 11) for r in got), name
        pairs = sorted(((r.doc_id or 0, r.text or "") for r in got))
        if name == "near_dedup":
            assert (1, a) in pairs and (0, a) not in pairs and pairs.count((0, b)) == 1 and (0, "") in pairs and (3, "") in pairs and (4, "") in pairs
            assert (5, long) in pairs and (5, "one id, two texts") in pairs
        if name == "suffix_dedup":
            assert len(got) == len(rows) and (6, "word ") in pairs and (1, "") in pairs and (0, a) in pairs and (5, "one id, two texts") in pairs
            assert all(r.n_chars == len(r.text or "") or r.text is None for r in got)
        if name == "decontamination":
            assert not any(item in (r.text or "") for r in got) and len(got) == len(rows) - 2
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert len({(r.doc_id, r.start, r.sequence_id, r.offset) for r in pipeline.STAGES[4][1](spark, docs, SF).collect()}) >= len(rows)
    assert pipeline.STAGES[4][1](spark, docs.limit(0), SF).count() == 0


def test_stages_hand_python_small_batches(spark, monkeypatch):
    from earlymark.llm import quality, suffixes

    seen, large = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    parts, portions = quality._parts, suffixes.portions

    def told(batch):
        seen.add(1)
        large.add(batch.nbytes > 2 * (4 << 20))
        return batch

    monkeypatch.setattr(quality, "_parts", lambda batches: parts(map(told, batches)))
    monkeypatch.setattr(suffixes, "portions", lambda batch: portions(told(batch)))
    docs = spark.range(6000).coalesce(1).selectExpr("id AS doc_id", "repeat(sha2(cast(id AS string), 512), 16) AS text", "'en' AS lang", "'web' AS source", "2048L AS n_chars")
    for stage in (pipeline.good_documents, pipeline.first_passages):
        before = seen.value
        stage(spark, docs, SF).count()
        assert seen.value > before + 2 and large.value == 0
