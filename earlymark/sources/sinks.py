"""Writing tables on Parquet: versions, partitions, and the rules of inserts, upserts and conditional updates (tables in buckets, in keyed, apply them to parts).

A versioned table is a folder of versions; a writer makes the next version and readers take the latest one, so no job overwrites what it reads and a
failed job leaves the table as it was.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def complete(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers n of the folders path/<prefix>n whose write has committed, in order."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a table, in order."""
    return complete(spark, path, "v")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The latest version; an empty table of the schema if there is none."""
    found = versions(spark, path)
    if found:
        return spark.read.parquet(f"{path}/v{found[-1]}")
    if schema is None:
        raise ValueError(f"{path} has no version")
    return spark.createDataFrame([], schema)


def write_version(df: DataFrame, path: str, cluster_by: list[str] | None = None) -> DataFrame:
    """Writes df as the next version, clustered on request, and reads it back."""
    spark = df.sparkSession
    target = f"{path}/v{(versions(spark, path) or [0])[-1] + 1}"
    (clustered(df, cluster_by) if cluster_by else df).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def clustered(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows dealt out by ranges of the columns and sorted in each file, so that readers skip files."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """target and the rows of source with new keys; a key that repeats in source counts once. Rows in target never change."""
    from ..operators.conform import latest

    rest = [c for c in source.columns if c not in keys]
    new = latest(source, keys, rest) if rest else source.distinct()
    return target.unionByName(new.join(target.select(*keys), keys, "left_anti").select(*source.columns))


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """target with the rows of source in place of those with their keys. source must have each key once."""
    return target.join(source.select(*keys), keys, "left_anti").select(*target.columns).unionByName(source)


def update_where(target: DataFrame, updates: DataFrame, keys: list[str], columns: list[str], condition: str) -> DataFrame:
    """target with columns from updates in rows that match and meet the condition; other rows as they are."""
    new = updates.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_hit"))
    rows = target.join(new, keys, "left").withColumn("_do", F.coalesce(F.expr(condition) & F.col("_hit"), F.lit(False)))
    return rows.select(*[F.when(F.col("_do"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def evolved(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with the schema's further columns as nulls; its own columns and values stay."""
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in df.columns])


def write_run(df: DataFrame, path: str, day: dt.date) -> int:
    """Overwrites one run date's partition and returns the rows that are there then."""
    target = f"{path}/run_date={day.isoformat()}"
    df.drop("run_date").write.mode("overwrite").parquet(target)
    return df.sparkSession.read.parquet(target).count()


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Publishes a snapshot to a database that serves it."""
    df.write.mode("overwrite").option("truncate", "true").jdbc(url, table, properties=properties)
