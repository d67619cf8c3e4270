"""Roll-ups, profiles and pages over the products."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .products import ELEVATED


def weighted(value: str, weight: str) -> Column:
    """Weighted mean that ignores groups without a value; null without weight."""
    return F.sum(F.col(value) * F.col(weight)) / F.nullif(F.sum(F.when(F.col(value).isNotNull(), F.col(weight))), F.lit(0))


def at_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows at the largest value of the column, by a join on its maximum: no value passes the driver."""
    return df.join(F.broadcast(df.agg(F.max(column).alias(column))), column)


def kpi_rollup(metrics: DataFrame, by_at_risk: bool = False) -> DataFrame:
    """Totals at the latest date. As is, all means are weighted by entities, and groups without a value keep their weight;
    by_at_risk weighs coverage by the elevated entities and leaves groups without a value out."""
    n = F.nullif(F.sum("entity_count"), F.lit(0))
    plain = lambda c: (F.sum(F.col("entity_count") * F.col(c)) / n).alias(c)
    fair = lambda c, w="entity_count": weighted(c, w).alias(c)
    means = [fair("retention_rate"), fair("intervention_coverage", "at_risk_count"), fair("days_to_first_intervention"), fair("follow_up_completion_rate")] if by_at_risk else [plain(c) for c in ("retention_rate", "intervention_coverage", "days_to_first_intervention", "follow_up_completion_rate")]
    return at_latest(metrics, "score_date").groupBy("score_date").agg(F.sum("entity_count").alias("entity_count"), F.sum("at_risk_count").alias("at_risk_count"), *means, F.sum("exposure").alias("exposure"), F.max("fresh_at").alias("fresh_at"))


def trend_rollup(trends: DataFrame, by: list[str]) -> DataFrame:
    return trends.groupBy(*by).agg(F.sum("entity_count").alias("entity_count"), weighted("average_score", "entity_count").alias("average_score"))


def total_by(df: DataFrame, by: list[str], column: str, alias: str, where: str | None = None) -> DataFrame:
    return (df.where(where) if where else df).groupBy(*by).agg(F.sum(column).alias(alias))


def concentration(trends: DataFrame) -> DataFrame:
    return total_by(trends.where(F.col("risk_tier").isin(*ELEVATED)), ["program"], "entity_count", "elevated_entities")


def weighted_by(df: DataFrame, by: list[str], value: str, weight: str, where: str | None = None) -> DataFrame:
    return (df.where(where) if where else df).groupBy(*by).agg(weighted(value, weight).alias(value))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """dataset, row_count."""
    return reduce(DataFrame.unionByName, [df.groupBy().agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("row_count")) for name, df in tables.items()])


def duplicate_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """dataset, duplicates: rows beyond the first of each key, from counts by key (partial before the shuffle)."""
    part = lambda name, df, keys: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.lit(name).alias("dataset"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
    return reduce(DataFrame.unionByName, [part(name, df, keys) for name, (df, keys) in tables.items()])


def completeness(df: DataFrame, columns: list[str], late: Column | None = None) -> DataFrame:
    """Rows, nulls of each column, and rows that shouldn't be there yet, in one scan."""
    extra = [F.count_if(F.coalesce(late, F.lit(False))).alias("future_rows")] if late is not None else []
    return df.agg(F.count(F.lit(1)).alias("row_count"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns], *extra)


def profile(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count and mean of each group: the shape of a skewed distribution."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), F.round(F.avg(value), 6).alias("average"))


def rate_by(df: DataFrame, by: list[str], condition: Column, alias: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), F.avg(F.when(condition, 1.0).otherwise(0.0)).alias(alias))


def checksum(df: DataFrame, columns: list[str]) -> DataFrame:
    """row_count and a sum of row hashes that doesn't depend on the order of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("checksum"))


def freshness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """dataset, row_count, fresh_at."""
    return reduce(DataFrame.unionByName, [df.groupBy().agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("row_count"), F.max(time).alias("fresh_at")) for name, (df, time) in tables.items()])


def metric_delta(before: DataFrame, after: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """metric, before, after, delta of some aggregates over two states of a table."""
    def long(df: DataFrame, name: str) -> DataFrame:
        one = df.agg(*[m.cast("double").alias(k) for k, m in measures.items()])
        return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias(name)) for k in measures])).alias("r")).select("r.*")

    return long(before, "before").join(long(after, "after"), "metric").withColumn("delta", F.col("after") - F.col("before"))


def page(df: DataFrame, tier: str, size: int, offset: int) -> DataFrame:
    """A page of a caseload with the number of all its rows: highest priority, then follow-ups due, then score, then id.

    An empty tier means all. The total is an aggregate joined to the page, not a window over one partition.
    """
    rows = df.where(F.lit(tier == "") | (F.col("risk_tier") == tier))
    total = rows.agg(F.count(F.lit(1)).alias("total_count"))
    order = [F.asc("caseload_priority"), F.desc("follow_up_due"), F.desc("risk_score"), F.asc("entity_id")]
    return rows.orderBy(*order).offset(offset).limit(size).crossJoin(F.broadcast(total))  # one row


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    if k < 0:
        raise ValueError("k must not be negative")
    return df.orderBy(*order).limit(k)


def lookup(df: DataFrame, key: str, value: object, latest_by: str | None = None) -> DataFrame:
    """The rows of one key, or its latest one."""
    rows = df.where(F.col(key) == F.lit(value))
    return rows.orderBy(F.desc(latest_by)).limit(1) if latest_by else rows


def allowed(df: DataFrame, entitlements: DataFrame, column: str, user: str | Column | None = None) -> DataFrame:
    """Rows that the user is entitled to: the value in column, or * for all. Without an entitlement there are none."""
    who = F.current_user() if user is None else F.lit(user) if isinstance(user, str) else user
    own = entitlements.where(F.col("user_identity") == who).select(F.col("scope").cast("string").alias("_scope")).distinct()
    everything = own.where("_scope = '*'").limit(1).select(F.lit(True).alias("_all"))
    some = df.join(own.where("_scope <> '*'"), F.col(column).cast("string") == F.col("_scope"), "left_semi")
    every = df.join(F.broadcast(everything), F.lit(True), "left_semi")
    rest = some.join(F.broadcast(everything), F.lit(True), "left_anti")
    return every.unionByName(rest)


def owner_history(cases: DataFrame, events: DataFrame, entity: object, owner: object) -> DataFrame:
    """An entity's cases of one owner with their events, the latest first."""
    own = cases.where((F.col("entity_id") == F.lit(entity)) & (F.col("owner") == F.lit(owner)))
    return own.join(events, "intervention_id").orderBy(F.desc("at"))


def urgency(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("follow_up_due"), F.desc("caseload_priority"), F.asc("entity_id"))
