"""Streams from landed files to accepted, quarantined and conformed tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..contracts import Contract
from ..operators import conform, quality
from ..sources import files, keyed

SIDES = ("accepted", "quarantine")


class ExpectationFailed(Exception):
    """A batch has rows that break what must hold."""


@dataclass(frozen=True)
class Feed:
    """A feed's contract, the schema that its rows must fit, and how its files are written. landed is the schema of the files, where that is another one."""

    contract: Contract
    schema: str
    landed: str | None = None
    format: str = "parquet"
    expectations: dict[str, Column] = field(default_factory=dict)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """source in the place of target. A missing source leaves an empty target away."""
    path = lambda x: spark._jvm.org.apache.hadoop.fs.Path(x)
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(path(target), True)
    if fs.exists(path(source)):
        fs.mkdirs(path(target).getParent())
        if not fs.rename(path(source), path(target)):
            raise OSError(f"{source} couldn't be moved to {target}")


def guarded(feed: Feed, today: dt.date, root: str) -> Callable[[DataFrame, int], None]:
    """What is done with a micro-batch: write, check, then commit.

    One job reads the batch, casts it to the schema (what doesn't fit is kept aside and sends the row to quarantine), classifies it, and writes both sides to a staging folder, while the same pass
    counts the expectations. If a row breaks what must hold (a key and an event time), the batch fails: nothing of it is moved to where readers look, and the
    checkpoint doesn't advance, so the batch comes again. Else both sides are moved, each to a folder named after the batch, and the counts are
    appended to the event log. A batch that is repeated replaces what it wrote before.
    """
    contract, wanted = feed.contract, T.StructType.fromDDL(feed.schema)
    own = ("_source_file", "_ingested_at")
    conditions = {"primary_key_present": quality.present(contract.key), "event_timestamp_present": F.col(contract.event_time).isNotNull(), "recoverable": F.col(quality.RULE_COLUMNS[1]), **feed.expectations}

    def commit(batch: DataFrame, batch_id: int) -> None:
        spark, staging = batch.sparkSession, f"{root}/staging/batch={batch_id}"
        fit = files.rescue(batch, T.StructType([*wanted.fields, *[batch.schema[c] for c in own]]))
        rows = quality.classify(fit, contract, today, rescued=files.RESCUED)
        seen = Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("n"), *[F.count_if(quality.holds(c)).alias(f"e{k}") for k, c in enumerate(conditions.values())])
        side = F.when(~F.col(quality.RULE_COLUMNS[0]), "broken").when(F.col(quality.RULE_COLUMNS[1]), SIDES[0]).otherwise(SIDES[1])
        counted.withColumn("_side", side).drop(*quality.RULE_COLUMNS[:2]).write.mode("overwrite").partitionBy("_side").parquet(staging)
        got = seen.get
        passed = {name: got[f"e{k}"] for k, name in enumerate(conditions)}
        broken = [name for name in ("primary_key_present", "event_timestamp_present") if passed[name] < got["n"]]
        if broken:
            raise ExpectationFailed(f"{contract.name}, batch {batch_id}: {', '.join(broken)}")
        for name in reversed(SIDES):
            _rename(spark, f"{staging}/_side={name}", f"{root}/{name}/batch={batch_id}")
        log = [(contract.name, batch_id, name, n, got["n"] - n) for name, n in passed.items()]
        spark.createDataFrame(log, EVENTS).coalesce(1).write.mode("overwrite").parquet(f"{root}/events/batch={batch_id}")

    return commit


EVENTS = "flow string, batch_id long, expectation string, passed long, failed long"


def ingest(spark: SparkSession, path: str, feed: Feed, today: dt.date, root: str) -> StreamingQuery:
    """Every new file's rows to root/accepted or root/quarantine, each exactly once, and the expectations of each batch to root/events."""
    source = files.with_provenance(files.stream(spark, path, feed.landed or feed.schema, form=feed.format))
    return source.writeStream.foreachBatch(guarded(feed, today, root)).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()


def ingest_all(spark: SparkSession, landing: str, feeds: dict[str, Feed], today: dt.date, root: str) -> None:
    """All feeds, side by side, from landing/<name> to root/<name>; a feed that fails doesn't stop the others, and its error is raised in the end."""
    running = {name: ingest(spark, f"{landing}/{name}", feed, today, f"{root}/{name}") for name, feed in feeds.items()}
    failed = None
    for query in running.values():
        try:
            query.awaitTermination()
        except Exception as e:
            failed = failed or e
    if failed:
        raise failed


def side(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """A feed's accepted or quarantined rows; an empty table where there are none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    known = T.StructType([*T.StructType.fromDDL(schema).fields, *T.StructType.fromDDL("_source_file string, _ingested_at timestamp").fields, T.StructField(files.RESCUED, T.StringType()), T.StructField(quality.RULE_COLUMNS[2], T.StringType()), T.StructField("batch", T.IntegerType())])
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], known)
    return spark.read.schema(known).parquet(f"{root}/{name}")


def conform_stream(source: DataFrame, table: keyed.Keyed, sequence: list[str], checkpoint: str, parents: DataFrame | None = None, parent_key: str | None = None) -> StreamingQuery:
    """Keeps the latest row of each key in a keyed table as batches arrive; a batch rewrites the buckets of its keys.

    With parents, rows whose parent isn't there yet are dropped here; the orphan report, which is recomputed, shows
    them, and they come in when they are delivered again. A repeated batch changes nothing.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        own = conform.with_parent(batch, parents, parent_key) if parents is not None else batch
        keyed.merge(table, own, lambda target, rows: conform.upserted(target, rows, list(table.keys), sequence))

    return source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
