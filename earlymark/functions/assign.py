"""Deterministic assignments: columns that depend on ids and a seed alone."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Multipliers of the congruential assignments.
COHORT = (1_103_515_245, 12_345)
PROPENSITY = (2_654_435_761, 2_246_822_519)
SPACE = 10_000
#: Ids of a cohort that are joined before they are digested.
PIECE = 1000


def hash_bucket(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets))


def congruential(key: Column, seed: int, factors: tuple[int, int]) -> Column:
    """pmod(key * a + seed * b, SPACE), without overflow whatever the key."""
    a, b = factors
    return F.pmod(F.pmod(key.cast("long"), F.lit(SPACE)) * (a % SPACE) + seed * b % SPACE, F.lit(SPACE))


def in_cohort(key: Column, seed: int, per_ten_thousand: int = 150) -> Column:
    return congruential(key, seed, COHORT) < per_ten_thousand


def propensity(key: Column, seed: int) -> Column:
    return congruential(key, seed, PROPENSITY)


def ladder(value: Column, steps: list[tuple[float, str]], other: str) -> Column:
    """The name of the first step whose bound value is under."""
    out = F.when(F.lit(False), F.lit(None))
    for bound, name in steps:
        out = out.when(value < bound, name)
    return out.otherwise(other)


def skewed(bucket: Column, buckets: int, low: float, width: float) -> Column:
    """low plus width times the square of a uniform bucket, in cents."""
    return F.round(F.lit(low) + F.pow(bucket / F.lit(float(buckets)), F.lit(2.0)) * width, 2)


def entity_and_period(row: Column, entities: int, periods: list[str]) -> tuple[Column, Column]:
    """Row number -> entity (row mod entities) and period (row div entities, by name)."""
    return F.pmod(row, F.lit(entities)), F.get(F.array(*map(F.lit, periods)), F.floor(row / F.lit(entities)).cast("int"))


def without_last(key: Column, count: int, rows: int, value: Column) -> Column:
    """value, null for the last rows of count: known defects."""
    return F.when(key < count - rows, value)


def derived_key(*parts: Column | str) -> Column:
    """SHA-256 of the parts, joined by a bar."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def cohort_keys(rows: DataFrame, cohort: str, ids: str, out: str = "cohort_key") -> DataFrame:
    """cohort and the key of its set of ids, whatever their order: SHA-256 of the distinct ids in order, joined by a bar.

    Range partitions of the sorted ids join them to pieces of PIECE ids, and a task digests a cohort's pieces one after the other, so
    no cohort is held as a whole. Null ids don't count; a cohort without others has the key of nothing.
    """
    own = rows.select(F.col(cohort), F.col(ids).cast("string").alias("_id")).distinct()
    kind = own.schema[cohort]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            low, at, pieces = 0, [], []
            for k in range(1, len(names) + 1):
                if k == len(names) or k == low + PIECE or names[k] != names[low] or values[k - 1] is None:
                    at.append(low)
                    pieces.append(None if values[low] is None else "|".join(values[low:k]))
                    low = k
            yield pa.RecordBatch.from_arrays([c.take(pa.array(at, pa.int64())) for c in batch.columns] + [pa.array(pieces, pa.string())], names=[cohort, "_id", "_piece"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, sha, first = None, None, True
        key = lambda n, s, t: pa.RecordBatch.from_arrays([pa.array([n], t), pa.array([s.hexdigest()])], names=[cohort, out])
        for batch in batches:
            for own_name, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if sha is None or own_name != name:
                    if sha is not None:
                        yield key(name, sha, batch.column(0).type)
                    name, sha, first = own_name, hashlib.sha256(), True
                if piece is not None:
                    sha.update(piece.encode() if first else b"|" + piece.encode())
                    first = False
            last = batch.column(0).type
        if sha is not None:
            yield key(name, sha, last)

    pieces = own.repartitionByRange(cohort, "_id").sortWithinPartitions(cohort, "_id").mapInArrow(join, T.StructType([kind]).add("_id", "string").add("_piece", "string"))
    return pieces.repartition(cohort).sortWithinPartitions(cohort, "_id").select(cohort, "_piece").mapInArrow(digest, T.StructType([kind]).add(out, "string"))


def padded_id(prefix: str, number: Column, digits: int = 6) -> Column:
    """prefix and the number with leading zeros; a number of more digits keeps them all."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) < digits, F.lpad(text, digits, "0")).otherwise(text))


def pseudonym(key: Column, length: int = 12) -> Column:
    """The first characters of the key's SHA-256: the same for the same key, and no way back to it without a list of keys."""
    return F.substring(F.sha2(key.cast("string"), 256), 1, length)
