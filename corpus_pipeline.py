"""From raw documents to packed sequences: five operators, each on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earlymark.llm.common import stored, table
from earlymark.llm.decontamination import without_benchmark
from earlymark.llm.minhash import one_of_each
from earlymark.llm.packing import packed_documents
from earlymark.llm.quality import accepted
from earlymark.llm.suffixes import without_repeats


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers don't reject; rows without doc_id or text are judged like any other.

    All stages keep all columns of docs, whatever they are called, and give an empty table for an empty one.
    """
    return stored(accepted(docs, table(spark, sf_dir, "labels")))  # written here, so that Python gets small batches


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group that a similarity of 0.8 connects.

    A row without doc_id stays only if its group has none with one; among several, the smallest hash of the text decides, and of rows that repeat
    both one stays. Rows without words belong to no group and all stay.
    """
    return one_of_each(docs, percent=80)


def first_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the stretches of 100 bytes and more that an earlier place has too; n_chars, if there, follows.

    Rows without doc_id come before all others, in the order of a hash of their text. A null text stays null.
    """
    names = {c: c if c in ("doc_id", "text") else f"_p{k}" for k, c in enumerate(docs.columns)}
    out = without_repeats(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), as_text=True, nulls_first=True)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*[new.get(c, F.col(n)).cast(docs.schema[c].dataType).alias(c) for c, n in names.items()])


def unknown_to_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, rows without doc_id included. A null text holds none."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of at most 1024 tokens; a null text is its end token alone."""
    return packed_documents(docs)


STAGES = [("quality", good_documents), ("near_dedup", one_of_each_group), ("suffix_dedup", first_passages), ("decontamination", unknown_to_benchmark), ("packing", sequences)]

#: SQL can't express the classifier and the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = stored(docs) if 0 < k < len(STAGES) - 1 else docs  # the first stage writes its own
    return docs
