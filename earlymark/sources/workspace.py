"""A folder for what a job writes on the way."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def workspace(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share; where that is unset on a single machine (tests), a temporary one is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="earlymark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/work-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """df, written once to a work folder and read from there."""
    path = workspace(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
