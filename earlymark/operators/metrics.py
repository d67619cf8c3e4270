"""Evaluation of scores: ranking, calibration, errors by cohort, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.workspace import kept

#: The cohort of rows without one.
UNKNOWN = "UNKNOWN"
#: Gates that a model must pass: at least, at least, at most.
GATES = {"average_precision": 0.20, "top_k_recall": 0.20, "calibration_error": 0.10}


def checked(df: DataFrame, label: str, score: str) -> DataFrame:
    """df, failing the job on labels other than 0 and 1 and on scores that are no probabilities."""
    ok = F.col(label).isin(0, 1) & F.col(score).between(0.0, 1.0)
    return df.where(F.when(F.coalesce(ok, F.lit(False)), True).otherwise(F.raise_error(F.lit("labels must be 0 or 1 and scores within 0 and 1")).cast("boolean")))


def ranked(df: DataFrame, score: str, tie: str, carry: list[str], parts: int | None = None) -> DataFrame:
    """df with rank (1 is the largest score, ties by id), running sums of carry, the number of rows and the totals of carry, in two passes.

    Rows are dealt out by ranges of (score, id) and written with the number of their range, so that both passes read the same ranges; a score that many rows
    share is dealt over several. Rows are numbered within each range, which starts after the totals of the ranges before it: one row for each range. So no task sorts
    everything.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc(score), F.asc(tie)]
    dealt = kept(df.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()))
    inner = W.partitionBy("_p").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    own = dealt.select("*", F.row_number().over(inner).alias("_n"), *[F.sum(c).over(inner).alias(f"_s_{c}") for c in carry])
    sizes = dealt.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{c}") for c in carry])
    before, every = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1), W.orderBy("_p").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    zero = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    base = sizes.select(F.col("_p").alias("_q"), zero("_n").alias("_bn"), F.sum("_n").over(every).alias("of"), *[zero(f"_t_{c}").alias(f"_b_{c}") for c in carry], *[F.sum(f"_t_{c}").over(every).alias(f"total_{c}") for c in carry])
    joined = own.join(F.broadcast(base), F.col("_p") == F.col("_q"))  # one row for each range
    return joined.select(*df.columns, (F.col("_n") + F.col("_bn")).alias("rank"), *[(F.col(f"_s_{c}") + F.col(f"_b_{c}")).alias(f"running_{c}") for c in carry], "of", *[f"total_{c}" for c in carry])


def ranking_metrics(df: DataFrame, label: str, score: str, tie: str, fractions: list[float]) -> DataFrame:
    """n, positives, average_precision and top, an array of (fraction, k, recall, precision), from one ranking of the checked rows.

    average_precision is the mean of the precision at each positive, 0 without positives. k is max(1, round(n * fraction)), halves to even.
    """
    y = F.col(label).cast("long").alias("y")
    rows = ranked(checked(df, label, score).select(y, F.col(score).alias("s"), F.col(tie).alias("t")), "s", "t", ["y"])
    k = lambda f, n: F.greatest(F.lit(1), F.rint(n * f)).cast("long")
    hit = F.when(F.col("y") == 1, F.col("running_y") / F.col("rank"))
    hits = [F.coalesce(F.sum(F.when(F.col("rank") <= k(f, F.col("of")), F.col("y"))), F.lit(0)).alias(f"h{i}") for i, f in enumerate(fractions)]
    out = rows.agg(F.coalesce(F.max("of"), F.lit(0)).alias("n"), F.coalesce(F.max("total_y"), F.lit(0)).alias("positives"), F.sum(hit).alias("_precisions"), *hits)
    share = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    top = [F.struct(F.lit(f).alias("fraction"), k(f, F.col("n")).alias("k"), share(F.col(f"h{i}"), F.col("positives")).alias("recall"), (F.col(f"h{i}") / k(f, F.col("n"))).alias("precision")) for i, f in enumerate(fractions)]
    return out.select("n", "positives", share(F.col("_precisions"), F.col("positives")).alias("average_precision"), F.array(*top).alias("top"))


def average_precision(df: DataFrame, label: str, score: str, tie: str) -> DataFrame:
    """Mean of the precision at each positive; 0 without positives."""
    return ranking_metrics(df, label, score, tie, []).select("average_precision")


def top_k_metrics(df: DataFrame, label: str, score: str, tie: str, fraction: float = 0.10) -> DataFrame:
    """k = max(1, round(n * fraction)) rows with the largest scores: recall and precision."""
    return top_k_ladder(df, label, score, tie, [fraction]).drop("fraction")


def top_k_ladder(df: DataFrame, label: str, score: str, tie: str, fractions: list[float]) -> DataFrame:
    """fraction, k, recall, precision for each fraction, from one ranking."""
    return ranking_metrics(df, label, score, tie, fractions).select(F.inline("top"))


def calibration_error(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean distance of score and outcome over bins of equal width, weighted by rows; the last bin is closed."""
    if bins < 1:
        raise ValueError("bins must be positive")
    cell = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1))
    grouped = checked(df, label, score).groupBy(cell.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.abs(F.avg(score) - F.avg(F.col(label).cast("double"))).alias("gap"))
    return grouped.agg((F.sum(F.col("n") * F.col("gap")) / F.sum("n")).alias("calibration_error"))


def cohort_errors(df: DataFrame, label: str, predicted: str, cohort: str) -> DataFrame:
    """False positive and false negative rates of each cohort, 0 without a denominator. Rows without a cohort are the cohort UNKNOWN."""
    y, p = F.col(label), F.col(predicted)
    df = checked(df, label, predicted).withColumn(cohort, F.coalesce(F.col(cohort).cast("string"), F.lit(UNKNOWN)))
    share = lambda bad, of: F.coalesce(F.count_if(bad) / F.nullif(F.count_if(of), F.lit(0)), F.lit(0.0))
    return df.groupBy(cohort).agg(F.count(F.lit(1)).alias("row_count"), share((y == 0) & (p == 1), y == 0).alias("false_positive_rate"), share((y == 1) & (p == 0), y == 1).alias("false_negative_rate"))


def fairness_gap(errors: DataFrame) -> DataFrame:
    gap = lambda c: (F.max(c) - F.min(c)).alias(f"{c}_gap")
    return errors.agg(gap("false_positive_rate"), gap("false_negative_rate"))


def gated(metrics: DataFrame) -> DataFrame:
    """Candidates (one row each, complexity smallest first) with eligible and chosen: the simplest that passes
    all gates, else the one with the best average precision."""
    ok = (F.col("average_precision") >= GATES["average_precision"]) & (F.col("top_k_recall") >= GATES["top_k_recall"]) & (F.col("calibration_error") <= GATES["calibration_error"])
    rows = metrics.withColumn("eligible", F.coalesce(ok, F.lit(False)))
    best = rows.agg(F.max_by("candidate", F.struct("eligible", F.when(F.col("eligible"), -F.col("complexity").cast("double")).otherwise(F.col("average_precision")))).alias("_best"))
    return rows.crossJoin(F.broadcast(best)).withColumn("chosen", F.col("candidate") == F.col("_best")).drop("_best")  # one row


def chronological_split(df: DataFrame, period: str) -> DataFrame:
    """df with split: the latest period validates, all before it train. A table of one period fails the job."""
    last = df.agg(F.max(period).alias("_last"), F.min(period).alias("_first"))
    rows = df.crossJoin(F.broadcast(last))  # one row
    part = F.when(F.col("_first") == F.col("_last"), F.raise_error(F.lit("a split needs two periods")).cast("string"))
    return rows.withColumn("split", part.when(F.col(period) == F.col("_last"), "validation").otherwise("train")).drop("_last", "_first")


def rule_score(attendance: Column, missed: Column, hold: Column, idle_days: Column, withdrawals: Column) -> Column:
    """A transparent score from five signals, each clipped, within 0 and 1."""
    clip = lambda c, high: F.greatest(F.least(c.cast("double"), F.lit(float(high))), F.lit(0.0))
    total = 0.35 * (1.0 - clip(attendance, 1)) + 0.20 * clip(missed, 4) / 4 + 0.20 * hold.cast("double") + 0.15 * clip(idle_days, 60) / 60 + 0.10 * clip(withdrawals, 2) / 2
    return clip(total, 1)


def logistic_score(bias: float, terms: list[tuple[float, Column]]) -> Column:
    z = F.lit(bias)
    for weight, value in terms:
        z = z + weight * value.cast("double")
    return 1 / (1 + F.exp(-z))


def leading_factors(names: list[str], values: list[Column], means: list[float], weights: list[float], k: int = 3) -> Column:
    """Names of the k features with the largest contribution (value - mean) * weight, either way; ties by name."""
    parts = [F.struct((-F.abs((v.cast("double") - m) * w)).alias("c"), F.lit(n).alias("n")) for n, v, m, w in zip(names, values, means, weights)]
    return F.transform(F.slice(F.sort_array(F.array(*parts)), 1, k), lambda x: x["n"])
