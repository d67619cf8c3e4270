"""Fit, compare and apply risk models with Spark ML."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import Bucketizer, Imputer, ImputerModel, OneHotEncoder, OneHotEncoderModel, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import kept
from .metrics import leading_factors
from .products import risk_tier

#: Bins of a number in boosted trees, as many as Spark's trees make by default.
BINS = 32
#: A draw of a boosted model's subsample takes or leaves at most one row in so many.
DRAWS = 100_000


def modes(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """The most frequent value of each column, the smallest of equally frequent ones; empty text where a column has none."""
    if not columns:
        return {}
    row = df.agg(*[F.mode(F.col(c).cast("string"), True).alias(c) for c in columns]).first()
    return {c: row[c] or "" for c in columns}


def preparation(numeric: list[str], categorical: list[str], usual: dict[str, str]) -> list:
    """Median for missing numbers and the usual value for missing categories, standard scale; unknown categories are a category of their own."""
    return [Imputer(strategy="median", inputCols=numeric, outputCols=[f"_{c}" for c in numeric]), *assembly([f"_{c}" for c in numeric], categorical, usual)]


def assembly(numbers: list[str], categorical: list[str], usual: dict[str, str]) -> list:
    """Numbers on the standard scale and coded categories as one vector."""
    quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    filled = ", ".join(f"coalesce(cast(`{c}` AS string), {quoted(usual[c])}) AS `_m_{c}`" for c in categorical)
    return [
        VectorAssembler(inputCols=numbers, outputCol="_numbers"),
        StandardScaler(withMean=True, inputCol="_numbers", outputCol="_scaled"),
        *([SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")] if categorical else []),
        *[StringIndexer(inputCol=f"_m_{c}", outputCol=f"_i_{c}", handleInvalid="keep", stringOrderType="alphabetAsc") for c in categorical],
        *([OneHotEncoder(inputCols=[f"_i_{c}" for c in categorical], outputCols=[f"_o_{c}" for c in categorical], handleInvalid="keep")] if categorical else []),
        VectorAssembler(inputCols=["_scaled", *[f"_o_{c}" for c in categorical]], outputCol="features"),
    ]


def balanced(df: DataFrame, label: str) -> DataFrame:
    """df with _weight: both classes weigh the same in all."""
    totals = df.agg(F.count(F.lit(1)).alias("_n"), F.sum(label).alias("_pos"))
    rows = df.crossJoin(F.broadcast(totals))  # one row
    own = F.when(F.col(label) == 1, F.col("_pos")).otherwise(F.col("_n") - F.col("_pos"))
    return rows.withColumn("_weight", F.col("_n") / (2 * F.greatest(own, F.lit(1)))).drop("_n", "_pos")


def fit_logistic(train: DataFrame, label: str, numeric: list[str], categorical: list[str]) -> PipelineModel:
    last = LogisticRegression(featuresCol="features", labelCol=label, weightCol="_weight", maxIter=50)
    return Pipeline(stages=[*preparation(numeric, categorical, modes(train, categorical)), last]).fit(balanced(train, label))


def bins(df: DataFrame, columns: list[str], most: int = BINS) -> Bucketizer:
    """Cuts each column into at most `most` bins: between all its values if there are no more of them, else at quantiles of all rows, where a value at two of them is a bin of its own."""
    about = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    few = [c for c in columns if about[c] <= 2 * most]  # the count is an estimate
    values = df.agg(F.lit(0), *[F.sort_array(F.collect_set(c)).alias(c) for c in few]).first()
    many = [c for c in columns if c not in few or len(values[c]) > most]
    ranked = dict(zip(many, df.approxQuantile(many, [k / most for k in range(1, most)], 0.001))) if many else {}
    splits = []
    for c in columns:
        if c in many:  # a bin starts at its least value
            cuts = {math.nextafter(q, math.inf) for q in ranked[c]} | {q for q in ranked[c] if ranked[c].count(q) > 1}
        else:
            cuts = {(a + b) / 2 for a, b in zip(values[c], values[c][1:])}
        splits.append([-math.inf, *(sorted(x for x in cuts if math.isfinite(x)) or [0.0]), math.inf])
    return Bucketizer(splitsArray=splits, inputCols=columns, outputCols=[f"_b{c}" for c in columns], handleInvalid="keep")


def alike(df: DataFrame, columns: list[str], draws: int = DRAWS) -> DataFrame:
    """The different rows of columns with _weight, the number of rows that each stands for. A row that stands for more than one in `draws` of all comes several times, with equal shares."""
    spark = df.sparkSession
    groups = kept(df.groupBy(*columns).count())
    most = max(1.0, (groups.agg(F.sum("count")).first()[0] or 0) / draws)
    times = F.ceil(F.col("count") / most).cast("int")
    rows = groups.select(*columns, (F.col("count") / times).alias("_weight"), F.explode(F.sequence(F.lit(1), times)).alias("_k")).drop("_k")
    return kept(rows.repartition(spark.sparkContext.defaultParallelism))


def fit_boosted(train: DataFrame, label: str, numeric: list[str], categorical: list[str], rounds: int = 250, depth: int = 4, step: float = 0.05, share: float = 0.9, seed: int = 17) -> PipelineModel:
    """Boosted trees. They see a number's bin alone, so rows that are alike in bins, categories and label are one row with their number as weight: a round's work grows with the different ones."""
    usual = modes(train, categorical)
    imputer = Imputer(strategy="median", inputCols=numeric, outputCols=[f"_{c}" for c in numeric]).fit(train)
    cut = bins(imputer.transform(train), [f"_{c}" for c in numeric])
    binned = cut.getOutputCols()
    last = GBTClassifier(featuresCol="features", labelCol=label, weightCol="_weight", maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=share, seed=seed)
    rows = alike(cut.transform(imputer.transform(train)), [*binned, *categorical, label])
    return PipelineModel([imputer, cut, *Pipeline(stages=[*assembly(binned, categorical, usual), last]).fit(rows).stages])


def feature_columns(df: DataFrame, allowed: Sequence[str], denied: Sequence[str]) -> list[str]:
    """The columns of df that are on the allowed list and not on the denied one, in the order of the allowed list.

    A column on neither list is no feature, so one that is added to a table later doesn't slip into a model. No allowed column at all, or one that is missing, is an error.
    """
    missing = [c for c in allowed if c not in df.columns]
    own = [c for c in allowed if c in df.columns and c not in denied]
    if missing or not own:
        raise ValueError(f"missing features: {missing}" if missing else "no feature is allowed")
    return own


def feature_groups(model: PipelineModel, rows: DataFrame) -> tuple[list[str], list[int]]:
    """Names of the columns that a model's features come from, and for each place of the feature vector the number of its column."""
    schema = model.transform(rows.limit(0)).schema
    numeric = next(s for s in model.stages if isinstance(s, ImputerModel)).getInputCols()
    places = sorted((a["idx"], a["name"]) for group in schema["features"].metadata["ml_attr"]["attrs"].values() for a in group)
    coded = sorted((c for s in model.stages if isinstance(s, OneHotEncoderModel) for c in s.getOutputCols()), key=len, reverse=True)
    names, of = list(numeric), []
    for k, (_, name) in enumerate(places):
        column = numeric[k] if k < len(numeric) else next(c for c in coded if name.startswith(f"{c}_")).removeprefix("_o_")
        if column not in names:
            names.append(column)
        of.append(names.index(column))
    return names, of


class Trees:
    """The trees of a boosted model as arrays: what each split goes by, where it leads, and the mean outcome at each node."""

    def __init__(self, model: GBTClassificationModel):
        rows: list[list] = []
        self.roots, self.weights = [], list(model.treeWeights)

        def walk(node) -> int:
            k = len(rows)
            rows.append([-1, 0.0, None, -1, -1, float(node.prediction())])
            if node.subtreeDepth():
                split = node.split()
                kind = split.getClass().getSimpleName()
                left = None if kind == "ContinuousSplit" else frozenset(split.leftCategories())
                rows[k][:3] = [int(split.featureIndex()), float(split.threshold()) if left is None else 0.0, left]
                rows[k][3] = walk(node.leftChild())
                rows[k][4] = walk(node.rightChild())
            return k

        for tree in model.trees:
            self.roots.append(walk(tree._call_java("rootNode")))
        self.feature, self.at, self.left_set, self.left, self.right, self.value = (list(c) for c in zip(*rows))
        self.base = sum(w * self.value[r] for w, r in zip(self.weights, self.roots))

    def contributions(self, x: np.ndarray, groups: list[int], n: int) -> np.ndarray:
        """For each row of features what each group adds to the margin: along each tree's path, the change of the mean outcome at each split, to the split's feature. With base they sum to the margin."""
        out = np.zeros((len(x), n))
        for root, weight in zip(self.roots, self.weights):
            todo = [(root, np.arange(len(x)))]
            while todo:
                k, own = todo.pop()
                if self.left[k] < 0 or not len(own):
                    continue
                v = x[own, self.feature[k]]
                left = v <= self.at[k] if self.left_set[k] is None else np.isin(v, list(self.left_set[k]))
                for child, part in ((self.left[k], own[left]), (self.right[k], own[~left])):
                    out[part, groups[self.feature[k]]] += weight * (self.value[child] - self.value[k])
                    todo.append((child, part))
        return out


def contributions(model: PipelineModel, rows: DataFrame) -> tuple[list[str], Column, float]:
    """Column names, an array column of what each adds to the score's margin (over model.transform(rows)), and the margin of none.

    For a logistic model that is weight times value (numbers are centred), for a boosted one the changes along its trees' paths.
    """
    names, groups = feature_groups(model, rows)
    last, n = model.stages[-1], len(names)
    if isinstance(last, GBTClassificationModel):
        trees = Trees(last)

        @F.pandas_udf("array<double>")
        def along(features: pd.Series) -> pd.Series:
            x = np.stack(features.to_numpy()) if len(features) else np.zeros((0, len(groups)))
            return pd.Series(list(trees.contributions(x, groups, n)))

        return names, along(vector_to_array("features")), trees.base
    weights = last.coefficients.toArray().tolist()
    terms = [[F.lit(w) * vector_to_array("features")[j] for j, w in enumerate(weights) if groups[j] == g] for g in range(n)]
    return names, F.array(*[reduce(Column.__add__, t) if t else F.lit(0.0) for t in terms]), float(last.intercept)


def risk_scores(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows as the model transforms them, with risk_score."""
    return model.transform(rows).withColumn("risk_score", vector_to_array("probability")[1])


def scored(model: PipelineModel, rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, risk_score, risk_tier and leading_factors, the three columns that move the score most, either way."""
    names, parts, _ = contributions(model, rows)
    out = risk_scores(model, rows).withColumn("_parts", parts)
    factors = leading_factors(names, [F.col("_parts")[k] for k in range(len(names))], [0.0] * len(names), [1.0] * len(names))
    return out.select(*keys, "risk_score", risk_tier(F.col("risk_score")).alias("risk_tier"), factors.alias("leading_factors"))
