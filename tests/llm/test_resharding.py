import zlib
from itertools import product

from pyspark.sql import functions as F

from earlymark.llm import resharding as r


def test_flow_moves_the_least():
    sizes, capacities = [10, 0, 3], [4, 4, 5]
    flow = r.min_cost_flow(sizes, capacities, [[int(i != j) for j in range(3)] for i in range(3)])
    assert [sum(x) for x in flow] == sizes and all(sum(c) <= k for c, k in zip(zip(*flow), capacities))
    assert sum(flow[i][j] for i in range(3) for j in range(3) if i != j) == 6


def test_flow_uses_cheap_detours():
    cost = [[1, 5], [1, 2]]
    flow = r.min_cost_flow([2, 2], [2, 2], cost)
    best = min(a * 1 + (2 - a) * 5 + (2 - a) * 1 + a * 2 for a in range(3))
    assert sum(flow[i][j] * cost[i][j] for i, j in product(range(2), repeat=2)) == best


def brute(sizes, stay, shards):
    """The least bytes that must leave their shard: what each holds over an equal share."""
    share = sum(sizes) / shards
    return sum(max(0, x - (share if i < stay else 0)) for i, x in enumerate(sizes))


def test_documents(spark, tmp_path):
    rows = [(i, "x" * (i * 37 % 400), "hot" if i % 3 else f"s{i % 5}", i) for i in range(2000)]
    rows += [(5000, None, None, 0), (None, "no id", "a", 0), (7, "again", "b", 1), (7, "again", "b", 1), (9, "long " * 20, "c", 1)]
    rows += [(None, f"null {i}", "a", 0) for i in range(300)]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, source string, shard int, file int, size int, slot int")
    path = tmp_path / "s"
    rows_df = r.resharded(docs, r.source_layout(), str(path))
    files = {f: f.stat().st_mtime_ns for f in (path / "old").rglob("*.parquet")}
    out = rows_df.toPandas()
    assert len(out) == len(rows) and sorted(out._c1.fillna("")) == sorted(x[1] or "" for x in rows) and (out[["_c3", "_c4", "_c5", "_c6"]].nunique() <= 2000).all()
    assert (out["size"] == out._c1.map(lambda t: len(t or "") + 16)).all()
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    total = out.groupby("shard")["size"].sum()
    assert len(total) == 40 and total.max() - total.min() < 2 * out["size"].max(), sorted(total)
    old = out.groupby("old_shard")["size"].sum()
    assert len(old) >= 20
    moved = out[out.shard != out.old_shard]["size"].sum()
    assert abs(moved - brute(old.tolist(), 32, 40)) < 32 * out["size"].max()
    # a row is rewritten if its file has a row that moves, and no file was touched but to read it
    touched = set(map(tuple, out[out.shard != out.old_shard][["old_shard", "file"]].values.tolist()))
    assert [bool(x.rewritten) for x in out.itertuples()] == [(x.old_shard, x.file) in touched for x in out.itertuples()]
    assert not out.rewritten.all() and all(f.stat().st_mtime_ns == t for f, t in files.items())
    written = spark.read.parquet(str(path / "new")).agg(F.sum("size")).first()[0]
    assert written == out[out.rewritten]["size"].sum() and not any(len(list(d.glob("*.parquet"))) > 1 for d in (path / "old").glob("*/*"))


def test_small_and_odd_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert r.resharded(docs, r.source_layout(), str(tmp_path / "a")).count() == 0
    long = spark.createDataFrame([(1, "y" * 300_000, "a"), (1, "z", None), (None, None, None)], docs.schema)
    out = r.resharded(long, r.source_layout(), str(tmp_path / "b")).toPandas()
    assert sorted(out["size"]) == [16, 17, 300_016] and all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard"))


def test_query_columns(spark):
    out = r.op4_flow_resharding(spark, "/root/testdata/sf0.001").toPandas()
    text = {x.doc_id: x.text for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert all(x.text_crc32 == zlib.crc32(text[x.doc_id].encode()) and x["size"] == len(text[x.doc_id].encode()) + 16 for _, x in out.iterrows())


def test_column_names_that_the_operator_uses_itself(spark, tmp_path):
    names = ["_old", "old_shard", "pos", "_class", "_row", "rewritten", "_mid", "_c0"]
    docs = spark.createDataFrame([(i, "x" * i, "a", *range(8)) for i in range(50)], ", ".join(["doc_id long", "text string", "source string", *(f"{n} int" for n in names)]))
    out = r.resharded(docs, r.source_layout(), str(tmp_path / "s")).toPandas()
    assert sorted(out._c0) == list(range(50)) and [set(out[f"_c{k}"]) for k in range(3, 11)] == [{k} for k in range(8)]
