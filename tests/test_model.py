import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from earlymark.operators import metrics, model


def rows(spark, n=400):
    rng = np.random.default_rng(4)
    kinds = ["a", "b", "c_d", None]
    data = [(k, float(rng.normal()), float(rng.integers(0, 9)) if k % 7 else None, kinds[int(rng.integers(0, 4))]) for k in range(n)]
    return spark.createDataFrame([(*r, int(r[1] + (r[2] or 0) / 4 + (r[3] == "b") > 1)) for r in data], "id long, x double, y double, kind string, label int")


def test_tree_factors_add_up_to_the_margin(spark):
    df = rows(spark)
    fitted = model.fit_boosted(df, "label", ["x", "y"], ["kind"], rounds=12, depth=3)
    names, parts, base = model.contributions(fitted, df)
    assert names == ["x", "y", "kind"]
    got = fitted.transform(df).select(vector_to_array("rawPrediction")[1].alias("margin"), parts.alias("parts")).collect()
    assert all(abs(sum(r.parts) + base - r.margin) < 1e-9 for r in got) and any(abs(r.parts[2]) > 0.01 for r in got)


def test_logistic_factors_add_up_to_the_margin(spark):
    df = rows(spark)
    fitted = model.fit_logistic(df, "label", ["x", "y"], ["kind"])
    names, parts, base = model.contributions(fitted, df)
    out = fitted.transform(df).select(vector_to_array("probability")[1].alias("p"), parts.alias("parts")).collect()
    assert all(abs(1 / (1 + math.exp(-sum(r.parts) - base)) - r.p) < 1e-9 for r in out) and names[-1] == "kind"


def test_scored_names_three_factors(spark):
    df = rows(spark)
    for fitted in (model.fit_logistic(df, "label", ["x", "y"], ["kind"]), model.fit_boosted(df, "label", ["x", "y"], ["kind"], rounds=5)):
        got = model.scored(fitted, df, ["id"]).collect()
        assert all(sorted(r.leading_factors) == ["kind", "x", "y"] and r.risk_tier in ("low", "medium", "high") for r in got) and len({r.leading_factors[0] for r in got}) > 1
    empty = model.scored(fitted, df.limit(0), ["id"])
    assert empty.count() == 0


def test_boosted_trees_are_fitted_to_different_rows(spark, monkeypatch):
    """Copies of the rows add weight to the rows that the rounds go over, and no rows; without a subsample they change no score."""
    df, seen, alike = rows(spark).withColumn("x", F.floor("x").cast("double")), [], model.alike
    monkeypatch.setattr(model, "alike", lambda df, columns, draws=500: seen.append(alike(df, columns, draws)) or seen[-1])
    copies = df.crossJoin(spark.range(50).select(F.col("id").alias("copy")))
    once, often = (model.fit_boosted(x, "label", ["x", "y"], ["kind"], rounds=6, depth=3, share=1.0) for x in (df, copies))
    (n, total), (m, large) = ((r[0], r[1]) for r in (x.agg(F.count("*"), F.sum("_weight")).first() for x in seen))
    assert n == total == 400 and abs(large - 20_000) < 1e-6 and m < 1000
    a, b = ({r.id: r.risk_score for r in model.risk_scores(fitted, df).collect()} for fitted in (once, often))
    assert len(set(a.values())) > 5 and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_bins_part_all_values_of_few_and_heavy_ones_of_many(spark):
    df = spark.range(1000).select((F.col("id") % 9).cast("double").alias("few"), F.when(F.col("id") < 900, 5.0).otherwise(F.col("id") / 7 - 130).alias("heavy"), F.col("id").cast("double").alias("even"), F.lit(3.0).alias("one"))
    cut = model.bins(df, df.columns)
    got = cut.transform(df)
    assert all(len(x) <= model.BINS + 1 for x in cut.getSplitsArray())
    assert got.select("_bfew").distinct().count() == 9 and got.select("_bone").distinct().count() == 1
    heavy = {r._bheavy for r in got.where("heavy = 5.0").collect()}
    assert len(heavy) == 1 and not heavy & {r._bheavy for r in got.where("heavy <> 5.0").collect()}
    assert got.groupBy("_beven").count().agg(F.max("count")).first()[0] <= 40


def test_features_are_those_allowed_and_not_denied(spark):
    df = rows(spark, 5)
    assert model.feature_columns(df, ["y", "x", "label"], ["label", "kind"]) == ["y", "x"]
    with pytest.raises(ValueError, match="missing"):
        model.feature_columns(df, ["x", "z"], [])
    with pytest.raises(ValueError, match="no feature"):
        model.feature_columns(df, ["label"], ["label"])


def many(spark, n=100_000):
    return spark.range(n).select("id", (F.pmod(F.xxhash64("id"), F.lit(7)) == 0).cast("int").alias("y"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000).alias("s")).withColumn("s", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("s")))


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ranks_and_top_k_of_many_rows(spark, reuse):
    """A third of the rows share a score; ranks are gapless whether or not exchanges are reused."""
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = many(spark)
        plain = sorted(((-r.s, r.id, r.y) for r in df.collect()))
        hits = np.cumsum([p[2] for p in plain])
        got = metrics.ranked(df, "s", "id", [], parts=8).select("id", "rank").collect()
        assert {r["rank"]: r.id for r in got} == {k: p[1] for k, p in enumerate(plain, 1)}
        r = metrics.ranking_metrics(df, "y", "s", "id", [0.1, 0.3, 0.5, 0.6, 0.9]).first()
        assert abs(r.average_precision - np.mean([hits[k] / (k + 1) for k, p in enumerate(plain) if p[2]])) < 1e-9 and (r.n, r.positives) == (len(plain), hits[-1])
        for t in r.top:
            assert t.k == round(len(plain) * t.fraction) and abs(t.recall - hits[t.k - 1] / hits[-1]) < 1e-12 and abs(t.precision - hits[t.k - 1] / t.k) < 1e-12
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_metrics_check_their_rows_and_take_empty_tables(spark):
    df = many(spark, 20)
    for bad in (df.withColumn("y", F.lit(2)), df.withColumn("s", F.lit(1.5)), df.withColumn("s", F.lit(None).cast("double"))):
        for call in (metrics.average_precision, metrics.top_k_metrics):
            with pytest.raises(Exception, match="labels must be"):
                call(bad, "y", "s", "id").collect()
        with pytest.raises(Exception, match="labels must be"):
            metrics.calibration_error(bad, "y", "s").collect()
    r = metrics.ranking_metrics(df.limit(0), "y", "s", "id", [0.5]).first()
    assert (r.n, r.positives, r.average_precision, r.top[0].k, r.top[0].recall) == (0, 0, 0.0, 1, 0.0)


def test_rows_without_cohort_are_unknown(spark):
    df = spark.createDataFrame([(1, 1, "a"), (0, 1, None), (1, 0, None)], "y int, p int, c string")
    got = {r.c: (r.row_count, r.false_positive_rate, r.false_negative_rate) for r in metrics.cohort_errors(df, "y", "p", "c").collect()}
    assert got == {"a": (1, 0.0, 0.0), metrics.UNKNOWN: (2, 1.0, 1.0)}
