"""Keyed tables on Parquet: rows in buckets of their key's hash, so a batch opens and writes the buckets that it touches and no others.

path/d<n>/_bucket=<b>/ are the files that write n made, path/m<n>/ is the manifest after it: a row for each folder that belongs to the table then, with its
bucket, its number of rows and the least and largest value of one key column. The manifest is written last, so a failed write leaves the table as it was, and
no file is ever changed. A table has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import complete, update_where, upsert
from .workspace import kept

BUCKET = "_bucket"


@dataclass(frozen=True)
class Keyed:
    """A table's place and key. ranged is the key column by whose values parts are skipped, such as a date; buckets can't change once rows are written."""

    path: str
    keys: tuple[str, ...]
    ranged: str | None = None
    buckets: int = 64

    @property
    def by(self) -> str:
        return self.ranged or self.keys[0]

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")


def manifest(spark: SparkSession, t: Keyed) -> tuple[int, list[Row]]:
    """The number of the last write (0 if none) and the folders of the table: at most one for each bucket and write since the last compaction."""
    done = complete(spark, t.path, "m")
    return (done[-1], spark.read.parquet(f"{t.path}/m{done[-1]}").collect()) if done else (0, [])


def _open(spark: SparkSession, t: Keyed, rows: list[Row], schema: T.StructType | None) -> DataFrame:
    if rows:
        return spark.read.parquet(*[f"{t.path}/d{r.write}/{BUCKET}={r.bucket}" for r in rows])
    if schema is None:
        raise ValueError(f"{t.path} has no rows and no schema was given")
    return spark.createDataFrame([], schema)


def read(spark: SparkSession, t: Keyed, schema: T.StructType | None = None) -> DataFrame:
    return _open(spark, t, manifest(spark, t)[1], schema)


def _write(t: Keyed, df: DataFrame, n: int, others: list[Row]) -> None:
    """df as write n; others are the folders that stay."""
    spark, data = df.sparkSession, f"{t.path}/d{n}"
    kind = df.schema[t.by].dataType
    df.withColumn(BUCKET, t.bucket()).repartition(BUCKET).sortWithinPartitions(BUCKET, *t.keys).write.partitionBy(BUCKET).mode("overwrite").parquet(data)
    made = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(data)
    new = made.groupBy(F.col(BUCKET).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), F.min(t.by).alias("low"), F.max(t.by).alias("high")).collect()  # one for each bucket
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("write", T.IntegerType()), T.StructField("rows", T.LongType()), T.StructField("low", kind), T.StructField("high", kind)])
    told = [(r.bucket, r.write, r.rows, r.low, r.high) for r in others] + [(r.bucket, n, r.rows, r.low, r.high) for r in new]
    spark.createDataFrame(told, schema).coalesce(1).write.mode("overwrite").parquet(f"{t.path}/m{n}")


def merge(t: Keyed, batch: DataFrame, rule: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """The table after rule(rows of the buckets that the batch touches, batch) has replaced those buckets."""
    spark = batch.sparkSession
    batch = kept(batch)
    touched = {r[0] for r in batch.select(t.bucket().alias("b")).distinct().collect()}  # at most t.buckets numbers
    n, rows = manifest(spark, t)
    if touched:
        out = rule(_open(spark, t, [r for r in rows if r.bucket in touched], batch.schema if not rows else _open(spark, t, rows[:1], None).schema), batch)
        _write(t, out, n + 1, [r for r in rows if r.bucket not in touched])
    return read(spark, t, batch.schema)


def merge_upsert(t: Keyed, source: DataFrame) -> DataFrame:
    """source's rows in place of those with their keys; source must have each key once."""
    return merge(t, source, lambda target, batch: upsert(target, batch, list(t.keys)))


def merge_update(t: Keyed, updates: DataFrame, columns: list[str], condition: str) -> DataFrame:
    """columns of updates in rows that match and meet the condition."""
    return merge(t, updates, lambda target, batch: update_where(target, batch, list(t.keys), columns, condition))


def may_hold(rows: list[Row], spans: dict[int, tuple]) -> list[Row]:
    """The folders whose bucket and range of values meet those of a batch: bucket -> (least, largest). Values without an order to go by open all of a bucket."""
    meets = lambda r, low, high: None in (r.low, r.high, low, high) or (r.low <= high and low <= r.high)
    return [r for r in rows if r.bucket in spans and meets(r, *spans[r.bucket])]


def append_new(t: Keyed, source: DataFrame) -> DataFrame:
    """The table with the rows of source whose keys it lacks; of a key that repeats in source one row counts. Rows in the table never change.

    Only folders that may hold one of source's keys are opened, and what is new is added as files of its own.
    """
    from ..operators.conform import latest

    spark = source.sparkSession
    source = kept(source)
    spans = {r[0]: (r[1], r[2]) for r in source.groupBy(t.bucket()).agg(F.min(t.by), F.max(t.by)).collect()}  # at most t.buckets rows
    n, rows = manifest(spark, t)
    rest = [c for c in source.columns if c not in t.keys]
    one = latest(source, list(t.keys), rest) if rest else source.distinct()
    known = _open(spark, t, may_hold(rows, spans), source.schema).select(*t.keys)
    new = kept(one.join(known, list(t.keys), "left_anti").select(*source.columns))
    if not new.isEmpty():
        _write(t, new, n + 1, rows)
    return read(spark, t, source.schema)


def compact(spark: SparkSession, t: Keyed, most: int = 8) -> int:
    """Rewrites the buckets that have more than `most` folders as one folder each; returns how many."""
    n, rows = manifest(spark, t)
    folders: dict[int, int] = {}
    for r in rows:
        folders[r.bucket] = folders.get(r.bucket, 0) + 1
    many = {b for b, k in folders.items() if k > most}
    if many:
        _write(t, _open(spark, t, [r for r in rows if r.bucket in many], None), n + 1, [r for r in rows if r.bucket not in many])
    return len(many)
