"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _least(edges: DataFrame) -> DataFrame:
    """edges (u, v) with m, the least of u and its neighbours v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    return edges.join(least, edges["u"] == least["_u"]).drop("_u")


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of edges (a, b), by alternating star steps.

    Each round every node hangs its larger neighbours, then its smaller ones, below the least of them, until all
    hang below their component's least node. Rounds grow with the logarithm of the nodes. The edges stay distributed and are
    written to the shared folder after each round.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = _mark(edges)
    while True:
        # two rows of each row by explode, not by union: a plan that holds its input once has half the joins at each step
        large = _least(_each(edges, ("u", "v"), ("v", "u"))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        new = stored(_each(_least(large), ("v", "m"), ("u", "m")).where("u <> v").distinct())
        before, mark = mark, _mark(new)
        if mark == before:
            return new.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(new.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        edges = new


def _each(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """u, v: for each row a row of each pair of its columns."""
    return rows.select(F.inline(F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs])))


def _mark(edges: DataFrame) -> tuple:
    """Count and sum of hashes of the edges; equal sets of edges have equal ones."""
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
