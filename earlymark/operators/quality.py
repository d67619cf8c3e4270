"""Row quality: classify, split, report, and stop on what must not happen."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import Contract

RULE_COLUMNS = ("is_critical_valid", "is_recoverable_valid", "violation_reason")


def present(column: str) -> Column:
    return F.col(column).isNotNull() & (F.trim(F.col(column).cast("string")) != "")


def holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def recoverable_rules(contract: Contract, today: dt.date) -> list[tuple[str, Column]]:
    rules = [("MISSING_PARENT_ID", present(contract.parent_key))] if contract.parent_key else []
    run = F.col(contract.run_date)
    rules += [("INVALID_RUN_DATE", run.isNotNull() & (run <= F.lit(today))), ("EVENT_AFTER_RUN_DATE", F.to_date(contract.event_time) <= run)]
    return rules + [(reason, F.expr(condition)) for reason, condition in contract.checks]


def classify(df: DataFrame, contract: Contract, today: dt.date, rescued: str | None = None) -> DataFrame:
    """df with whether each row is critically and recoverably valid, and the first rule that fails.

    With rescued, a column of values that didn't fit the schema, such rows are invalid for that reason first.
    """
    key, time = present(contract.key), F.col(contract.event_time).isNotNull()
    rules = recoverable_rules(contract, today)
    if rescued:
        rules = [("RESCUED_DATA", F.col(rescued).isNull()), *rules]
    reason = F.when(F.col(rescued).isNotNull(), "RESCUED_DATA") if rescued else F.when(F.lit(False), F.lit(None))
    reason = reason.when(~key, "MISSING_PRIMARY_KEY").when(~time, "INVALID_EVENT_TIMESTAMP")
    for label, condition in rules:
        reason = reason.when(~holds(condition), label)
    critical = holds(key & time)
    recoverable = reduce(Column.__and__, [holds(c) for _, c in rules], critical)
    return df.select("*", critical.alias(RULE_COLUMNS[0]), recoverable.alias(RULE_COLUMNS[1]), reason.cast("string").alias(RULE_COLUMNS[2]))


def accepted(classified: DataFrame) -> DataFrame:
    """Valid rows, and critically invalid ones, so that the check that must hold for all of them stops the run."""
    return classified.where("is_recoverable_valid OR NOT is_critical_valid")


def quarantined(classified: DataFrame) -> DataFrame:
    return classified.where("is_critical_valid AND NOT is_recoverable_valid")


def must_hold(df: DataFrame, name: str, condition: Column) -> DataFrame:
    """df, whose first row that breaks the condition fails the job."""
    return df.where(F.when(holds(condition), True).otherwise(F.raise_error(F.lit(f"expectation {name} failed")).cast("boolean")))


def expectation_report(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """expectation, passed, failed: one scan for all conditions."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(holds(c)).alias(f"p{i}") for i, c in enumerate(conditions.values())])
    rows = [F.struct(F.lit(name).alias("expectation"), F.col(f"p{i}").alias("passed"), (F.col("n") - F.col(f"p{i}")).alias("failed")) for i, name in enumerate(conditions)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def forbidden_columns(df: DataFrame, denied: list[str]) -> DataFrame:
    """column_name of the columns that a product must not have."""
    found = [(c,) for c in df.columns if c in denied]
    return df.sparkSession.createDataFrame(found, "column_name string")


def violations(df: DataFrame, key: str, constraints: dict[str, Column]) -> DataFrame:
    """key, constraint: a row for each constraint that a row breaks; a null condition is no violation, as in SQL checks."""
    broken = F.filter(F.array(*[F.when(~c, F.lit(name)) for name, c in constraints.items()]), lambda x: x.isNotNull())
    return df.select(key, F.explode(broken).alias("constraint"))
