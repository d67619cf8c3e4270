import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earlymark.contracts import contract
from earlymark.operators import conform, quality
from earlymark.sources import files

DAY, TODAY = dt.date(2026, 9, 21), dt.date(2026, 9, 22)
AT = dt.datetime(2026, 9, 20, 8)


def reason(spark, name, schema, *row):
    out = quality.classify(spark.createDataFrame([row], schema), contract(name), TODAY).first()
    return out.is_critical_valid, out.is_recoverable_valid, out.violation_reason


@pytest.mark.parametrize(("gpa", "want"), [(3.2, None), (-0.1, "GPA_OUT_OF_RANGE"), (4.1, "GPA_OUT_OF_RANGE"), (None, "GPA_OUT_OF_RANGE")])
def test_period_rules(spark, gpa, want):
    schema = "period_id string, entity_id string, census_date date, cumulative_gpa double, run_date date"
    assert reason(spark, "periods", schema, "p1", "e1", dt.date(2026, 9, 1), gpa, DAY) == (True, want is None, want)


def test_balance_and_activity_rules(spark):
    schema = "balance_id string, entity_id string, event_at timestamp_ntz, balance_amount double, run_date date"
    assert reason(spark, "balances", schema, "b", "e", AT, -0.01, DAY)[2] == "NEGATIVE_BALANCE"
    schema = "activity_id string, entity_id string, event_at timestamp_ntz, event_type string, run_date date"
    assert reason(spark, "activity", schema, "a", "e", AT, "PARTY", DAY)[2] == "UNKNOWN_EVENT_TYPE"


def test_order_of_reasons(spark):
    schema = "presence_id string, entity_id string, event_at timestamp_ntz, run_date date"
    check = lambda *row: reason(spark, "presence", schema, *row)
    assert check(None, None, None, None) == (False, False, "MISSING_PRIMARY_KEY")
    assert check(" ", "e", AT, DAY) == (False, False, "MISSING_PRIMARY_KEY")
    assert check("p", None, None, None) == (False, False, "INVALID_EVENT_TIMESTAMP")
    assert check("p", None, AT, None) == (True, False, "MISSING_PARENT_ID")
    assert check("p", "e", AT, None) == (True, False, "INVALID_RUN_DATE")
    assert check("p", "e", AT, dt.date(2026, 9, 23)) == (True, False, "INVALID_RUN_DATE")
    assert check("p", "e", dt.datetime(2026, 9, 22), DAY) == (True, False, "EVENT_AFTER_RUN_DATE")
    assert check("p", "e", AT, DAY) == (True, True, None)


def test_entities_need_no_parent(spark):
    schema = "entity_id string, record_effective_at timestamp_ntz, run_date date"
    assert reason(spark, "entities", schema, "e", AT, None)[2] == "INVALID_RUN_DATE" and reason(spark, "entities", schema, "e", AT, DAY)[1]


def test_unknown_dataset():
    with pytest.raises(ValueError):
        contract("nothing")


def test_three_way_routing_and_rescue(spark):
    raw = spark.createDataFrame([("p1", "e", "1", None), ("p2", "e", "x", None), (None, "e", "1", None), ("p4", "e", "1", "more")], "presence_id string, entity_id string, n string, surplus string")
    wide = raw.withColumn("event_at", F.lit(AT).cast("timestamp_ntz")).withColumn("run_date", F.lit(DAY))
    schema = T.StructType().add("presence_id", "string").add("entity_id", "string").add("n", "long").add("event_at", "timestamp_ntz").add("run_date", "date")
    rows = quality.classify(files.rescue(wide, schema), contract("presence"), TODAY, files.RESCUED)
    assert {r.presence_id for r in quality.accepted(rows).collect()} == {"p1", None}
    assert {(r.presence_id, r.violation_reason) for r in quality.quarantined(rows).collect()} == {("p2", "RESCUED_DATA"), ("p4", "RESCUED_DATA")}
    assert {r.presence_id: r[files.RESCUED] for r in rows.collect()}["p2"] == '{"n":"x"}'


def test_expectation_stops_the_job(spark):
    df = spark.range(3)
    assert quality.must_hold(df, "small", F.col("id") < 3).count() == 3
    with pytest.raises(Exception, match="expectation small failed"):
        quality.must_hold(df, "small", F.col("id") < 2).collect()


def test_later_ingest_wins_whatever_the_order(spark):
    rows = [("e1", AT, 1, "old"), ("e1", AT, 2, "new"), ("e2", AT, 1, "only"), ("e1", AT - dt.timedelta(1), 9, "late")]
    for order in (rows, rows[::-1], rows + rows):
        df = spark.createDataFrame(order, "event_id string, event_at timestamp_ntz, ingested int, value string")
        assert sorted((r.event_id, r.value) for r in conform.latest(df, ["event_id"], ["event_at", "ingested"]).collect()) == [("e1", "new"), ("e2", "only")]


def test_orphans(spark):
    parent = spark.createDataFrame([("e1",)], "entity_id string")
    child = spark.createDataFrame([("c1", "e1"), ("c2", "e9"), ("c3", None)], "event_id string, entity_id string")
    assert sorted(r.record_id for r in conform.orphans({"c": (child, "event_id")}, parent, "entity_id").collect()) == ["c2", "c3"]
