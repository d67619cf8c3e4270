"""A day's run from files to products, which can be stopped and repeated."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import _fs

LEDGER = "run_date date, stage string, path string, row_count long, checksum decimal(38,0)"


@dataclass(frozen=True)
class Stage:
    """make(spark, inputs, day): the stage's rows, from those of the stages that it needs."""

    name: str
    make: Callable[[SparkSession, dict[str, DataFrame], dt.date], DataFrame]
    needs: tuple[str, ...] = ()


def _record(root: str, day: dt.date, stage: str) -> str:
    return f"{root}/ledger/run_date={day.isoformat()}/stage={stage}"


def recorded(spark: SparkSession, root: str, day: dt.date, stage: str) -> bool:
    fs, p = _fs(spark, f"{_record(root, day, stage)}/_SUCCESS")
    return fs.exists(p)


def output(spark: SparkSession, root: str, day: dt.date, stage: str) -> DataFrame:
    """What a stage that is in the ledger wrote for a day."""
    if not recorded(spark, root, day, stage):
        raise ValueError(f"{stage} has no record for {day}")
    return spark.read.parquet(f"{root}/{stage}/run_date={day.isoformat()}")


def run_day(spark: SparkSession, root: str, day: dt.date, stages: list[Stage]) -> list[str]:
    """Runs the stages for a day, in order, and returns the names of those that ran.

    A stage writes root/<stage>/run_date=<day> and then its record in the ledger, with the number of rows and an order-free checksum. A stage in the ledger is not run
    again, so a day that is repeated changes nothing; one that stopped on the way goes on with the first stage without a record, whose half-written output is
    replaced. Stages that come later see earlier ones as they were recorded.
    """
    ran, known = [], set()
    for stage in stages:
        missing = [n for n in stage.needs if n not in known]
        if missing:
            raise ValueError(f"{stage.name} needs {missing}, which don't come before it")
        if not recorded(spark, root, day, stage.name):
            path = f"{root}/{stage.name}/run_date={day.isoformat()}"
            stage.make(spark, {n: output(spark, root, day, n) for n in stage.needs}, day).write.mode("overwrite").parquet(path)
            written = spark.read.parquet(path)
            hashed = F.xxhash64(*[F.col(f"`{c}`") for c in written.columns]).cast("decimal(38,0)")
            row = written.agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(hashed), F.lit(0)).cast("decimal(38,0)").alias("checksum")).select(F.lit(path).alias("path"), "row_count", "checksum")
            row.coalesce(1).write.mode("overwrite").parquet(_record(root, day, stage.name))
            ran.append(stage.name)
        known.add(stage.name)
    return ran


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """All records: run_date, stage, path, row_count, checksum."""
    fs, p = _fs(spark, f"{root}/ledger")
    if not fs.exists(p):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{root}/ledger")
