"""Latest row of each key, orphans, and protected columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """The row of each key with the largest sequence; a hash aggregate with partial results, so hot keys combine before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*sequence)).alias("_r")) if rest else df.select(*keys).distinct()
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def ranked_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order (nulls where the order puts them)."""
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def upserted(target: DataFrame, batch: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """target after a batch of changes: late rows don't replace later ones, and a replayed batch changes nothing."""
    return latest(target.unionByName(batch), keys, sequence)


def with_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose parent is there; Spark broadcasts the keys only if they are small."""
    return child.join(parent.select(key).distinct(), key, "left_semi")


def orphans(children: dict[str, tuple[DataFrame, str]], parent: DataFrame, key: str) -> DataFrame:
    """dataset, record_id, and the parent key of child rows without a parent. children: name -> (rows, record id column)."""
    parents = parent.select(key).distinct()
    parts = [df.join(parents, key, "left_anti").select(F.lit(name).alias("dataset"), F.col(record).cast("string").alias("record_id"), key) for name, (df, record) in children.items()]
    return reduce(DataFrame.unionByName, parts)


def orphan_counts(children: dict[str, tuple[DataFrame, str]], parent: DataFrame, key: str) -> DataFrame:
    return orphans(children, parent, key).groupBy("dataset").agg(F.count(F.lit(1)).alias("orphans"))


def isolated(df: DataFrame, protected: list[str]) -> DataFrame:
    """df without the protected columns."""
    return df.drop(*protected)


def protected_view(df: DataFrame, key: str, protected: list[str], sequence: list[str]) -> DataFrame:
    """The protected columns of each key's latest row, and nothing else."""
    return latest(df, [key], sequence).select(key, *protected)
