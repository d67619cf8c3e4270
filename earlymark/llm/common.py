"""Shared pieces of the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The letters that are folded, and the white space that parts words.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]+"

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that a Python worker gets at once.
BATCH = "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share.

    Only where that setting is absent on a single machine (as in tests) a temporary folder is set instead; a cluster must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="earlymark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/earlymark-{uuid.uuid4().hex}"


@contextmanager
def batches_of(spark: SparkSession, size: str | None) -> Iterator[None]:
    """What runs meanwhile in this session hands Python about so many bytes at once (a size as "4m"; None: as the session says)."""
    before = spark.conf.get(BATCH_BYTES, None)
    if size:
        spark.conf.set(BATCH_BYTES, size)
    try:
        yield
    finally:
        if size and before is None:
            spark.conf.unset(BATCH_BYTES)
        elif size:
            spark.conf.set(BATCH_BYTES, before)


def stored(df: DataFrame, partition_by: str | None = None, batch: str | None = BATCH) -> DataFrame:
    """df written once to the shared folder and read again, so that later steps neither recompute it nor
    depend on the executors that made it. batch: the size of batches for Python, as in batches_of."""
    spark = df.sparkSession
    path = shared_dir(spark)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    with batches_of(spark, batch):
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folded(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(folded(text), SPACE, -1), lambda w: w != "")


def spread_rank(df: DataFrame, group: list[str], order: list[Column], spread: Column, out: str, weight: str | None = None) -> DataFrame:
    """Gapless ranks from 0 within each group, without one task that holds a whole group.

    spread deals the rows of a group to at most 256 parts. Rows are ranked within (group, part), and each
    part is moved up by the rows of the parts before it. The table of part sizes has one row for each
    (group, part) and is joined by sort and merge unless Spark finds it small. With weight, a row takes
    that many ranks.
    """
    from pyspark.sql import Window as W

    step = F.col(weight) if weight else F.lit(1)
    df = df.withColumn("_part", F.pmod(spread, F.lit(256)).cast("int"))
    sizes = df.groupBy(*group, "_part").agg(F.sum(step.cast("long")).alias("_n"))
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inner = W.partitionBy(*group, "_part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = df.withColumn("_r", F.sum(step.cast("long")).over(inner) - step.cast("long"))
    same = [ranked[g].eqNullSafe(sizes[f"_g_{g}"]) for g in group] + [ranked["_part"] == sizes["_p"]]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return ranked.join(sizes, on).withColumn(out, F.col("_base") + F.col("_r")).drop("_part", "_p", "_r", "_base", *[f"_g_{g}" for g in group])


def in_groups(batches: Iterator[pa.RecordBatch], columns: list[str], at_once: int) -> Iterator[pa.Table]:
    """Rows, sorted by columns (numbers), in tables of about at_once rows that cut no group of rows equal in them."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < at_once:
            continue
        t = pa.Table.from_batches(held)
        new = np.zeros(size - 1, bool)
        for c in columns:
            x = t[c].to_numpy()
            new |= x[1:] != x[:-1]
        cuts = np.flatnonzero(new)
        if len(cuts):
            yield t.slice(0, cuts[-1] + 1)
            t = t.slice(cuts[-1] + 1)
        held, size = t.combine_chunks().to_batches(), t.num_rows
    if held:
        yield pa.Table.from_batches(held)


def in_slices(batch: pa.RecordBatch, column: str | int, rows: int = 500, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most so many rows and bytes of text in a column, or of one row."""
    low, held = 0, 0
    for k, n in enumerate(pc.binary_length(batch.column(column)).fill_null(0).to_pylist()):
        if k > low and (k - low == rows or held + n > size):
            yield batch.slice(low, k - low)
            low, held = k, 0
        held += n
    if batch.num_rows > low:
        yield batch.slice(low)
