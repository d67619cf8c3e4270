import datetime as dt

from pyspark.sql import functions as F

from earlymark.sources import keyed as k
from earlymark.sources.sinks import complete


def files(path):
    return {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def rows(spark, ids, v):
    return spark.createDataFrame([(i, v) for i in ids], "id int, v int")


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path):
    t = k.Keyed(str(tmp_path / "t"), ("id",), buckets=16)
    k.merge_upsert(t, rows(spark, range(500), 0))
    before, had = files(tmp_path / "t"), k.manifest(spark, t)[1]
    assert len(had) == 16 and sum(r.rows for r in had) == 500
    out = k.merge_upsert(t, rows(spark, [3, 3000], 7))
    assert sorted(map(tuple, out.collect())) == sorted([(i, 7 if i == 3 else 0) for i in range(500)] + [(3000, 7)])
    now = k.manifest(spark, t)[1]
    assert sum(r.write == 1 for r in now) >= 14 and all(f.stat().st_mtime_ns == m for f, m in before.items())
    made = [f for f in set(files(tmp_path / "t")) - set(before) if "_bucket=" in str(f)]
    assert 1 <= len(made) <= 2
    out = k.merge_update(t, rows(spark, [5, 6, 9999], 8).withColumnRenamed("v", "v"), ["v"], "id = 5")
    assert {r.id: r.v for r in out.where("v > 6").collect()} == {3: 7, 3000: 7, 5: 8}


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    t = k.Keyed(str(tmp_path / "t"), ("id",), buckets=4)
    k.merge_upsert(t, rows(spark, range(10), 0))
    bad = lambda target, batch: batch.withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    try:
        k.merge(t, rows(spark, range(10), 1), bad)
    except Exception as e:
        assert "no" in str(e)
    assert complete(spark, t.path, "m") == [1] and {r.v for r in k.read(spark, t).collect()} == {0}
    assert k.merge_upsert(t, rows(spark, range(10), 2)).where("v = 2").count() == 10


def test_history_opens_the_parts_that_may_hold_a_key(spark, tmp_path, monkeypatch):
    t = k.Keyed(str(tmp_path / "t"), ("id", "day"), ranged="day", buckets=4)
    day = lambda n: dt.date(2026, 1, n)
    batch = lambda n, v: spark.createDataFrame([(i, day(n), v) for i in range(40)], "id int, day date, v int")
    for n in range(1, 7):
        k.append_new(t, batch(n, n))
    before = files(tmp_path / "t")
    opened, open_ = [], k._open
    monkeypatch.setattr(k, "_open", lambda spark, t, rows, schema: opened.append(len(rows)) or open_(spark, t, rows, schema))
    out = k.append_new(t, batch(7, 7).unionByName(batch(6, 99)).unionByName(batch(7, 7)))
    assert opened[0] == 4  # of the 24 folders, those of day 6
    assert sorted(map(tuple, out.groupBy("day", "v").count().collect())) == [(day(n), n, 40) for n in range(1, 8)]
    assert all(f.stat().st_mtime_ns == m for f, m in before.items())
    writes = complete(spark, t.path, "m")
    k.append_new(t, batch(3, 5))
    assert complete(spark, t.path, "m") == writes  # a replay adds nothing
    assert k.compact(spark, t, 6) == 4 and len(k.manifest(spark, t)[1]) == 4 and k.read(spark, t).count() == 280 and k.compact(spark, t, 6) == 0


def test_empty_tables_and_batches(spark, tmp_path):
    t = k.Keyed(str(tmp_path / "t"), ("id",), buckets=4)
    none = rows(spark, [], 0)
    assert k.merge_upsert(t, none).count() == 0 and k.append_new(t, none).count() == 0 and complete(spark, t.path, "m") == []
    assert k.append_new(t, rows(spark, [1, 1, 2], 5)).count() == 2 and k.compact(spark, t) == 0
