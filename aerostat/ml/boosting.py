"""Gradient boosting with a row and a column subset per tree.

Spark's own boosting draws columns anew at every node. Here each round fits one ``DecisionTreeRegressor`` to the
residual of the rounds before, on the rows and columns drawn for that round, and the trees are put together as a
``GBTRegressionModel``: it is saved, loaded, explained (``operators/tree_attribution.py``) and applied like any other.

* Rows: a row takes part where a hash of its key columns and the round falls below ``subsample``; reruns and lost
  executors draw the same rows. Rows with equal keys (NULL included) share their lot.
* Columns: ``int(colsample * features)`` of them (at least one), drawn by seed and round; the others are constant for that
  tree, so no split can use them.
* The first tree is a single leaf, the mean label, with weight 1; all others weigh ``step``.
* With ``validation`` rows, boosting ends after ``patience`` rounds without a lower error there, and the trees after
  the best round are dropped.

Rows with a NULL label are dropped, an empty training table is an error, and a NULL feature is one, as in the other
models. The running prediction is a column of a table that is cut by ``checkpoint()`` every ``cut_every`` rounds, so
a plan holds at most that many trees.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerostat.schemas import GBT_PARAMS

_HASH_STEPS = 1 << 30


def drawn_columns(features: Sequence[str], fraction: float, seed: int, turn: int) -> list[str]:
    """The columns of one round, in the order of ``features``."""
    n = max(1, int(fraction * len(features) + 1e-9))
    chosen = set(random.Random(f"{seed}/{turn}").sample(list(features), n))
    return [f for f in features if f in chosen]


def drawn_rows(key: Sequence[str], fraction: float, seed: int, turn: int) -> Column:
    """Whether a row takes part in a round."""
    u = F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), *[F.col(k) for k in key]), F.lit(_HASH_STEPS))
    return u < F.lit(int(fraction * _HASH_STEPS))


def _joined(spark: SparkSession, trees: list, weights: list[float]) -> GBTRegressionModel:
    """One boosted model of fitted trees and their weights."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    arr = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    w = gateway.new_array(jvm.double, len(trees))
    for i, (t, x) in enumerate(zip(trees, weights)):
        arr[i], w[i] = t._java_obj, float(x)
    name = jvm.org.apache.spark.ml.util.Identifiable.randomUID("GBTRegressionModel")
    return GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(name, arr, w, trees[0].numFeatures)).setFeaturesCol("features")


def fit_boosted(train: DataFrame, features: Sequence[str], label: str, key: Sequence[str], rounds: int = GBT_PARAMS["maxIter"],
                depth: int = GBT_PARAMS["maxDepth"], step: float = GBT_PARAMS["stepSize"],
                subsample: float = GBT_PARAMS["subsamplingRate"], colsample: float = 0.8, seed: int = GBT_PARAMS["seed"],
                validation: DataFrame | None = None, patience: int = 10, cut_every: int = 8, **tree_params) -> PipelineModel:
    """A boosted model over ``features`` (see the module); ``tree_params`` go to each tree (``maxBins``, ...)."""
    spark, features = train.sparkSession, list(features)
    assemble = VectorAssembler(inputCols=features, outputCol="features")
    names, y, m = [f"f{i}" for i in range(len(features))], "y", "m"

    def table(df: DataFrame, base: float) -> DataFrame:
        own = [F.col(f).cast("double").alias(n) for f, n in zip(features, names)]
        draw = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)]).alias("k")
        return df.filter(F.col(label).isNotNull()).select(draw, F.col(label).cast("double").alias(y), F.lit(base).alias(m), *own)

    whole = VectorAssembler(inputCols=names, outputCol="features")
    kept = ["k", y, m, *names]
    labelled = table(train, 0.0)
    if labelled.isEmpty():
        raise ValueError("no row with a label to train on")
    first = DecisionTreeRegressor(labelCol=y, featuresCol="features", maxDepth=0, seed=seed).fit(whole.transform(labelled))
    base = first._java_obj.rootNode().prediction()
    sides = {"train": table(train, base).checkpoint()}
    if validation is not None:
        sides["held"] = table(validation, base).checkpoint()
    trees, weights, best, best_at = [first], [1.0], None, 1
    if validation is not None:
        best = _error(sides["held"])
    since = 0
    for turn in range(rounds):
        columns = set(drawn_columns(features, colsample, seed, turn))
        now = _advanced(spark, sides["train"], whole, trees[len(trees) - since:], step)
        drawn = now.filter(drawn_rows(["k"], subsample, seed, turn)).select(
            (F.col(y) - F.col(m)).alias("r"), *[(F.col(n) if f in columns else F.lit(0.0)).alias(n) for f, n in zip(features, names)])
        if drawn.isEmpty():
            continue
        tree = DecisionTreeRegressor(labelCol="r", featuresCol="features", maxDepth=depth, seed=seed + turn, **tree_params)
        trees.append(tree.fit(whole.transform(drawn)))
        weights.append(step)
        since += 1
        if validation is not None:
            err = _error(_advanced(spark, sides["held"], whole, trees[len(trees) - since:], step))
            if err is not None and (best is None or err < best):
                best, best_at = err, len(trees)
            elif len(trees) - best_at >= patience:
                break
        if since >= cut_every:
            sides = {s: _advanced(spark, d, whole, trees[len(trees) - since:], step).select(*kept).checkpoint() for s, d in sides.items()}
            since = 0
    if validation is not None and best is not None:
        trees, weights = trees[:best_at], weights[:best_at]
    return PipelineModel([assemble, _joined(spark, trees, weights)])


def _advanced(spark: SparkSession, df: DataFrame, whole: VectorAssembler, trees: list, step: float) -> DataFrame:
    """The rows with the weighted predictions of ``trees`` added to their running prediction."""
    if not trees:
        return df
    return _joined(spark, trees, [step] * len(trees)).transform(whole.transform(df)) \
        .withColumn("m", F.col("m") + F.col("prediction")).drop("features", "prediction")


def _error(df: DataFrame) -> float | None:
    return df.agg(F.sqrt(F.avg((F.col("y") - F.col("m")) ** 2))).first()[0]
