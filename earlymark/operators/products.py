"""The published products: context, caseload, executive metrics and trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .changelog import ACTIVE

ELEVATED = ("medium", "high")
RETAINED = ("PERSISTED", "RETAINED")
DIMENSIONS = ["program", "cohort", "term", "score_date", "risk_tier", "intervention_status"]


def risk_tier(score: Column) -> Column:
    """high from 0.6, medium from 0.3, else low."""
    return F.when(score >= 0.6, "high").when(score >= 0.3, "medium").otherwise("low")


def latest_scores(history: DataFrame, key: str = "entity_id") -> DataFrame:
    """Each entity's latest score: by cutoff, then scoring time, then the number of the model version (no number: smallest)."""
    rest = [c for c in history.columns if c != key]
    number = F.expr("coalesce(try_cast(model_version AS BIGINT), -9223372036854775808)")
    best = history.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("as_of", "scored_at", number)).alias("_r"))
    return best.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def first_and_last_term(periods: DataFrame, key: str, time: str, record: str, term: str) -> DataFrame:
    """cohort (the term that an entity entered in) and last_term."""
    at = F.struct(time, record)
    return periods.groupBy(key).agg(F.min_by(term, at).alias("cohort"), F.max_by(term, at).alias("last_term"))


def latest_outcome(outcomes: DataFrame, key: str, time: str, record: str, fields: list[str]) -> DataFrame:
    best = outcomes.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(time, record)).alias("_r"))
    return best.select(key, *[F.col(f"_r.{c}").alias(c) for c in fields])


def entity_context(scores: DataFrame, features: DataFrame, terms: DataFrame, outcomes: DataFrame, interventions: DataFrame) -> DataFrame:
    """Latest scores with the features they were made from, terms, outcome and interventions; defaults where there are none."""
    key = "entity_id"
    joined = scores.join(features, [key, "as_of"]).join(terms, key, "left").join(outcomes, key, "left").join(interventions, key, "left")
    return (
        joined.withColumn("term", F.coalesce("outcome_term", "last_term")).withColumn("score_date", F.to_date("as_of"))
        .withColumn("intervention_status", F.coalesce("intervention_status", F.lit("not_started")))
        .withColumn("follow_up_due", F.coalesce("follow_up_due", F.lit(False))).withColumn("follow_up_completed", F.coalesce("follow_up_completed", F.lit(False)))
        .drop("outcome_term", "last_term")
    )


def caseload(context: DataFrame) -> DataFrame:
    """Elevated entities with their priority for each advisor: 1 is the highest score, ties by id."""
    order = W.partitionBy("advisor_id").orderBy(F.desc("risk_score"), F.asc("entity_id"))
    return context.where(F.col("risk_tier").isin(*ELEVATED)).withColumn("caseload_priority", F.row_number().over(order).cast("long"))


def detail(context: DataFrame) -> DataFrame:
    return context.drop("exposure")


def executive_metrics(context: DataFrame, keep_negative: bool = False) -> DataFrame:
    """Ten measures for each combination of DIMENSIONS.

    retention_rate counts entities without an outcome as not retained, observed_retention_rate leaves them out.
    Coverage counts active cases of elevated entities. Times to the first intervention before the score are
    left out unless keep_negative. Shares without a denominator are null.
    """
    elevated = F.col("risk_tier").isin(*ELEVATED)
    retained = F.when(F.col("outcome_status").isin(*RETAINED), 1.0).otherwise(0.0)
    days = F.expr("timestampdiff(SECOND, scored_at, first_intervention_at)") / 86400.0
    return context.groupBy(*DIMENSIONS).agg(
        F.countDistinct("entity_id").alias("entity_count"),
        F.count_if(elevated).alias("at_risk_count"),
        F.avg(retained).alias("retention_rate"),
        F.avg(F.when(F.col("outcome_status").isNotNull(), retained)).alias("observed_retention_rate"),
        F.avg(F.when(elevated, F.when(F.col("intervention_status").isin(*ACTIVE), 1.0).otherwise(0.0))).alias("intervention_coverage"),
        F.avg(days if keep_negative else F.when(days >= 0, days)).alias("days_to_first_intervention"),
        F.avg(F.when(F.col("follow_up_due"), F.col("follow_up_completed").cast("double"))).alias("follow_up_completion_rate"),
        F.sum(F.when(elevated, F.col("exposure")).otherwise(0.0)).alias("exposure"),
        F.lit(True).alias("exposure_is_estimate"),
        F.max("scored_at").alias("fresh_at"),
    )


def risk_trends(rows: DataFrame, dimensions: list[str] = DIMENSIONS) -> DataFrame:
    """Number of entities and spread of scores; over the context, or over all scores for the real history."""
    return rows.groupBy(*dimensions).agg(F.countDistinct("entity_id").alias("entity_count"), F.avg("risk_score").alias("average_score"), F.min("risk_score").alias("minimum_score"), F.max("risk_score").alias("maximum_score"))


def tier_transitions(scores: DataFrame) -> DataFrame:
    """Scores whose tier differs from the entity's score before."""
    before = F.lag("risk_tier").over(W.partitionBy("entity_id").orderBy("as_of"))
    return scores.withColumn("prior_tier", before).where("prior_tier <> risk_tier").select("entity_id", "as_of", "prior_tier", "risk_tier")


def serving_snapshot(product: DataFrame, keys: list[str], source: str, target: str, write_back: set[str]) -> DataFrame:
    """product checked for publishing: no write-back table may feed it, and its keys are whole and unique.

    The key check runs with the data: a null or repeated key fails the job.
    """
    if source in write_back or target in write_back:
        raise ValueError(f"{source} -> {target}: a write-back table may not feed a serving table")
    seen = F.count(F.lit(1)).over(W.partitionBy(*keys))
    ok = F.when((seen == 1) & F.coalesce(*[F.when(F.col(k).isNull(), False) for k in keys], F.lit(True)), True)
    return product.withColumn("_ok", ok.otherwise(F.raise_error(F.lit(f"{target}: key {keys} is null or repeated")).cast("boolean"))).where("_ok").drop("_ok")
