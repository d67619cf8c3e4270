import pyarrow as pa

from earlymark.llm.common import BATCH_BYTES, in_slices, stored


def test_slices_are_cut_by_rows_and_bytes():
    texts = ["x" * 10] * 7 + [None, ""] + ["y" * 95, "é" * 60, "z"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)))], names=["text", "k"])
    got = [s.column(1).to_pylist() for s in in_slices(batch, "text", rows=5, size=100)]
    assert [k for s in got for k in s] == list(range(len(texts))) and got == [[0, 1, 2, 3, 4], [5, 6, 7, 8], [9], [10], [11]]
    assert [s.num_rows for s in in_slices(batch, 0, rows=100, size=10**6)] == [len(texts)] and not list(in_slices(batch.slice(0, 0), "text"))


def test_python_gets_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "b"])

    docs = spark.range(4000).coalesce(1).selectExpr("id", "repeat('x', 500) AS text")
    before = spark.conf.get(BATCH_BYTES)
    got = stored(docs.mapInArrow(sizes, "n long, b long"), batch="100k").toPandas()
    assert got.n.sum() == 4000 and got.b.max() < 2 * 100_000 and spark.conf.get(BATCH_BYTES) == before


def test_what_is_written_between_steps_comes_in_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "b"])

    docs = spark.range(6000).coalesce(1).selectExpr("repeat('word ', 400) AS text")
    got = stored(docs.mapInArrow(sizes, "n long, b long")).toPandas()
    assert got.n.sum() == 6000 and got.b.max() < 2 * (4 << 20)
