"""Landed files: batch and streaming reads, provenance, and values that don't fit the schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"


def scan(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def scan_sql(spark: SparkSession, path: str) -> DataFrame:
    """A table by its path in SQL."""
    return spark.sql(f"SELECT * FROM parquet.`{path}`")


def stream(spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int = 1000, form: str = "parquet") -> DataFrame:
    """Every file below path once, those that are there already too. form is parquet, json or csv (with a header)."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true")
    return (reader.option("header", "true") if form == "csv" else reader).format(form).load(path)


def with_provenance(df: DataFrame, at=None) -> DataFrame:
    """df with the file that each row came from and the time of the read."""
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"), (F.current_timestamp() if at is None else F.lit(at)).alias("_ingested_at"))


def rescue(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df cast to the schema, with what didn't fit as JSON text in _rescued_data (null if all did).

    Values that can't be cast become null and are kept there, as are columns that the schema lacks.
    """
    wanted = {f.name: f.dataType for f in schema}
    casts = [F.col(n).try_cast(t).alias(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in wanted.items()]
    lost = [F.when(F.col(n).try_cast(t).isNull(), F.col(n)).cast("string").alias(n) for n, t in wanted.items() if n in df.columns]
    extra = [F.col(n).cast("string").alias(n) for n in df.columns if n not in wanted]
    kept = lost + extra
    some = F.coalesce(*[F.when(c.isNotNull(), True) for c in kept], F.lit(False)) if kept else F.lit(False)
    json = F.to_json(F.struct(*kept)) if kept else F.lit(None)
    return df.select(*casts, F.when(some, json).cast("string").alias(RESCUED))
