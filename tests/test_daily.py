import datetime as dt

import pytest
from pyspark.sql import functions as F

from earlymark.operators import daily as d

DAY = dt.date(2026, 9, 21)


def stages(stop=None):
    def first(spark, inputs, day):
        return spark.range(100).select("id", F.lit(day.day).alias("d"))

    def second(spark, inputs, day):
        out = inputs["first"].where("id % 2 = 0")
        return out.withColumn("id", F.when(F.col("id") > 50, F.raise_error(F.lit("stopped")).cast("long")).otherwise(F.col("id"))) if stop == "second" else out

    return [d.Stage("first", first), d.Stage("second", second, ("first",)), d.Stage("third", lambda spark, inputs, day: inputs["second"].unionByName(inputs["first"]), ("first", "second"))]


def test_a_day_can_be_stopped_and_repeated(spark, tmp_path):
    root = str(tmp_path)
    assert d.ledger(spark, root).count() == 0
    with pytest.raises(Exception, match="stopped"):
        d.run_day(spark, root, DAY, stages("second"))
    assert d.recorded(spark, root, DAY, "first") and not d.recorded(spark, root, DAY, "second")
    with pytest.raises(ValueError):
        d.output(spark, root, DAY, "second")
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "first").rglob("*")}
    assert d.run_day(spark, root, DAY, stages()) == ["second", "third"]
    rows = d.ledger(spark, root).orderBy("stage").collect()
    assert [(r.stage, r.row_count) for r in rows] == [("first", 100), ("second", 50), ("third", 150)]
    assert d.run_day(spark, root, DAY, stages()) == [] and d.ledger(spark, root).orderBy("stage").collect() == rows
    assert all(f.stat().st_mtime_ns == m for f, m in before.items())
    other = DAY + dt.timedelta(1)
    assert d.run_day(spark, root, other, stages()) == ["first", "second", "third"] and d.ledger(spark, root).count() == 6
    with pytest.raises(ValueError, match="needs"):
        d.run_day(spark, root, other, stages()[1:])
