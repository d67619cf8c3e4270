import datetime as dt

import pytest
from pyspark.sql import functions as F

from earlymark.contracts import CONTRACTS, SCHEMAS, contract
from earlymark.sources import files, keyed, sinks
from earlymark.streaming import ingest as s

SCHEMA = "presence_id string, entity_id string, event_at timestamp_ntz, run_date date"
DAY, AT = dt.date(2026, 9, 21), dt.datetime(2026, 9, 20)
FEED = s.Feed(contract("presence"), SCHEMA)


def land(spark, path, name, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}")


def sides(spark, root):
    return [sorted(r.presence_id for r in s.side(spark, root, name, SCHEMA).collect()) for name in s.SIDES]


def test_each_file_once_on_both_sides(spark, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "out")
    land(spark, landed, "a", [("p1", "e1", AT, DAY), ("p2", None, AT, DAY)])

    def run():
        s.ingest(spark, landed, FEED, DAY, root).awaitTermination()
        return sides(spark, root)

    assert run() == [["p1"], ["p2"]] and run() == [["p1"], ["p2"]]
    land(spark, landed, "b", [("p3", "e1", AT, DAY)])
    assert run() == [["p1", "p3"], ["p2"]]
    row = s.side(spark, root, "accepted", SCHEMA).where("presence_id = 'p3'").first()
    assert row._source_file.endswith(".parquet") and "/b/" in row._source_file and row._ingested_at is not None
    log = spark.read.schema(s.EVENTS).parquet(f"{root}/events").where("expectation = 'recoverable'").orderBy("batch_id").collect()
    assert [(r.flow, r.passed, r.failed) for r in log] == [("presence", 1, 1), ("presence", 1, 0)]


@pytest.mark.parametrize("bad", [(None, "e1", AT, DAY), (" ", "e1", AT, DAY), ("p9", "e1", None, DAY)])
def test_a_batch_that_breaks_what_must_hold_leaves_nothing(spark, tmp_path, bad):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "out")
    land(spark, landed, "a", [("p1", "e1", AT, DAY), ("p2", None, AT, DAY)])
    s.ingest(spark, landed, FEED, DAY, root).awaitTermination()
    land(spark, landed, "b", [("p3", "e1", AT, DAY), ("p4", None, AT, DAY), bad])
    for _ in range(2):  # the checkpoint doesn't advance, so it fails again
        with pytest.raises(Exception, match="ExpectationFailed"):
            s.ingest(spark, landed, FEED, DAY, root).awaitTermination()
        assert sides(spark, root) == [["p1"], ["p2"]]
        assert spark.read.schema(s.EVENTS).parquet(f"{root}/events").select("batch_id").distinct().count() == 1
    for f in (tmp_path / "landed" / "b").iterdir():
        f.unlink()
    land(spark, landed, "c", [("p3", "e1", AT, DAY)])


def test_values_that_do_not_fit_arrive_in_quarantine(spark, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "out")
    raw = "presence_id string, entity_id string, event_at string, run_date string, surplus string"
    land(spark, landed, "a", [("p1", "e1", str(AT), str(DAY), None), ("p2", "e1", str(AT), "soon", None), ("p3", "e1", str(AT), str(DAY), "more")], raw)
    s.ingest(spark, landed, s.Feed(contract("presence"), SCHEMA, raw), DAY, root).awaitTermination()
    assert sides(spark, root) == [["p1"], ["p2", "p3"]]
    got = {r.presence_id: (r.violation_reason, r[files.RESCUED]) for r in s.side(spark, root, "quarantine", SCHEMA).collect()}
    assert got == {"p2": ("RESCUED_DATA", '{"run_date":"soon"}'), "p3": ("RESCUED_DATA", '{"surplus":"more"}')}


def test_six_feeds_from_one_call(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "out")
    values = {"string": "x", "timestamp_ntz": AT, "date": DAY, "double": 1.0, "long": 1, "boolean": True}
    for name, schema in SCHEMAS.items():
        row = {c: values[t] for c, t in (f.split() for f in schema.split(", "))} | ({"event_type": "SUPPORT"} if name == "activity" else {})
        broken = {CONTRACTS[name].key: None} if name == "balances" else {}
        land(spark, f"{landing}/{name}", "a", [tuple((row | broken).values()), tuple(row.values())], schema)
    feeds = {name: s.Feed(contract(name), schema) for name, schema in SCHEMAS.items()}
    with pytest.raises(Exception, match="ExpectationFailed"):
        s.ingest_all(spark, landing, feeds, DAY, root)
    assert {n: s.side(spark, f"{root}/{n}", "accepted", SCHEMAS[n]).count() for n in feeds} == {n: 0 if n == "balances" else 2 for n in feeds}


def test_late_parents_and_replays(spark, tmp_path):
    landed, table = str(tmp_path / "landed"), keyed.Keyed(str(tmp_path / "table"), ("presence_id",), buckets=4)
    parents = spark.createDataFrame([("e1",)], "entity_id string")
    land(spark, landed, "a", [("p1", "e1", AT, DAY), ("p2", "e2", AT, DAY)])

    def run(parents):
        source = files.stream(spark, landed, SCHEMA)
        s.conform_stream(source, table, ["event_at"], str(tmp_path / "c"), parents, "entity_id").awaitTermination()
        return sorted((r.presence_id, r.event_at) for r in keyed.read(spark, table).collect())

    assert run(parents) == [("p1", AT)]
    both = parents.unionByName(spark.createDataFrame([("e2",)], "entity_id string"))
    assert run(both) == [("p1", AT)]  # the file was seen; the late parent's child comes with its next delivery
    land(spark, landed, "b", [("p2", "e2", AT, DAY), ("p1", "e1", AT - dt.timedelta(1), DAY)])
    assert run(both) == [("p1", AT), ("p2", AT)]


def test_clustered_writes(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    out = sinks.write_version(df, str(tmp_path / "t"), ["k"])
    assert out.count() == 1000
    assert sinks.write_run(df.withColumn("run_date", F.lit(DAY)), str(tmp_path / "r"), DAY) == 1000
