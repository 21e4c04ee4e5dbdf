"""Per-row feature attribution in long form, global ranking, dependence data and example rows.

For a linear model the exact Shapley value of feature j is
``coef_j * (x_j - mean_j)`` with the background mean; the contributions plus
the base value (the prediction at the mean) add up to the prediction. Means
come from one aggregate over the background rows, used as scalar subqueries.
For tree models, :func:`monte_carlo_shapley` estimates the same quantity as a
Spark job: (row, permutation, position) combinations are exploded and scored
with one ``transform``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from aerostat.functions.scalar import text_bar


def background_means(background: DataFrame, features: Sequence[str]) -> dict[str, Column]:
    m = background.agg(F.struct(*[F.avg(f).alias(f) for f in features]).alias("m")).scalar()
    return {f: m[f] for f in features}


def linear_attribution(rows: DataFrame, row_id: str, coefs: dict[str, float], intercept: float,
                       means: dict[str, Column]) -> DataFrame:
    """Long form (row_id, feature, feature_value, contribution) plus base value and prediction per row."""
    feats = list(coefs)
    base = F.lit(intercept)
    pred = F.lit(intercept)
    for f in feats:
        base = base + F.lit(coefs[f]) * means[f]
        pred = pred + F.lit(coefs[f]) * F.col(f).cast("double")
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("feature_value"),
                             (F.lit(coefs[f]) * (F.col(f).cast("double") - means[f])).alias("contribution"))
                    for f in feats])
    return rows.select(F.col(row_id), base.alias("base_value"), pred.alias("prediction"),
                       F.explode(arr).alias("a")).select(row_id, "a.feature", "a.feature_value", "a.contribution",
                                                         "base_value", "prediction")


def attribution_rank(long: DataFrame, k: int | None = None, bar_scale: int = 100) -> DataFrame:
    """Mean |contribution| per feature, largest first, with a text bar; optionally the top k."""
    r = long.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
    r = r.orderBy(F.col("mean_abs_contribution").desc(), "feature")
    if k is not None:
        r = r.limit(k)
    return r.withColumn("bar", text_bar(F.col("mean_abs_contribution"), bar_scale))


def dependence(long: DataFrame, top: int = 3) -> DataFrame:
    """(feature value, contribution) pairs for the ``top`` features by mean |contribution| (semi join)."""
    best = attribution_rank(long, k=top).select("feature")
    return long.join(F.broadcast(best), on="feature", how="left_semi")  # at most ``top`` rows


def pick_examples(rows: DataFrame, row_id: str, label: str, order: str = "sample_key",
                  low: float = 50.0, high: float = 150.0) -> DataFrame:
    """The first low-label row, the first high-label row and the third row in ``order``.

    Missing low/high rows fall back to the first / second row. One aggregate and a
    top three (``TakeOrderedAndProject``): no task holds more than three rows.
    """
    ends = rows.agg(F.struct(F.min_by(F.col(row_id), F.when(F.col(label) < low, F.col(order))).alias("good"),
                             F.min_by(F.col(row_id), F.when(F.col(label) > high, F.col(order))).alias("bad")).alias("e"))
    first = rows.select(F.col(order).alias("o"), F.col(row_id).alias("id")).orderBy("o", "id").limit(3)
    three = first.agg(F.sort_array(F.collect_list(F.struct("o", "id"))).alias("t"))
    picks = three.withColumn("e", ends.scalar())
    at = lambda i: F.get("t", F.lit(i))["id"]
    return picks.select(F.explode(F.array(
        F.struct(F.lit("good").alias("example"), F.coalesce("e.good", at(0)).alias(row_id)),
        F.struct(F.lit("bad").alias("example"), F.coalesce("e.bad", at(1)).alias(row_id)),
        F.struct(F.lit("random").alias("example"), at(2).alias(row_id)))).alias("e")).select("e.*")


def explain_rows(long: DataFrame, picks: DataFrame, row_id: str) -> DataFrame:
    """Attributions of the picked rows, ordered within each row by |contribution| (rank 1 = largest)."""
    j = long.join(F.broadcast(picks), on=row_id)  # picks has 3 rows
    w = Window.partitionBy("example").orderBy(F.abs("contribution").desc(), "feature")
    return j.withColumn("rank", F.row_number().over(w))


def monte_carlo_shapley(rows: DataFrame, row_id: str, features: Sequence[str], background_row: dict[str, float],
                        model, permutations: int = 16, seed: int = 42) -> DataFrame:
    """Sampled Shapley values for any Spark ML model, as one Spark job.

    For each row and permutation, features are switched from the background
    value to the row value one at a time; the change of the prediction at each
    switch is that feature's marginal contribution. Everything is exploded
    into (row, permutation, position) rows, assembled and scored together.
    """
    from pyspark.ml.feature import VectorAssembler

    n = len(features)
    # an order of the feature indexes for each row and permutation, by a hash: the same under any partitioning
    hashed = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(
        F.xxhash64(F.col(row_id), F.col("perm_id"), i, F.lit(seed)).alias("h"), i.alias("i")))
    perm = F.transform(F.array_sort(hashed), lambda x: x["i"])
    base = rows.select(F.col(row_id), *[F.col(f).cast("double").alias(f) for f in features],
                       F.explode(F.sequence(F.lit(1), F.lit(permutations))).alias("perm_id"))
    base = base.withColumn("order", perm)
    steps = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(n))).alias("pos"))
    # feature i takes the row value when its position in the permutation is < pos
    cols = []
    for i, f in enumerate(features):
        on = F.array_position(F.col("order"), F.lit(i)) <= F.col("pos")
        cols.append(F.when(on, F.col(f)).otherwise(F.lit(float(background_row[f]))).alias("_v_" + f))
    mixed = steps.select(row_id, "perm_id", "order", "pos", *cols)
    va = VectorAssembler(inputCols=["_v_" + f for f in features], outputCol="features")
    scored = model.transform(va.transform(mixed)).select(row_id, "perm_id", "order", "pos", "prediction")
    w = Window.partitionBy(row_id, "perm_id").orderBy("pos")
    marg = scored.withColumn("delta", F.col("prediction") - F.lag("prediction", 1).over(w)).filter("pos > 0")
    marg = marg.withColumn("feature_idx", F.col("order")[F.col("pos") - 1])
    names = F.array(*[F.lit(f) for f in features])
    return (marg.groupBy(row_id, "feature_idx").agg(F.avg("delta").alias("contribution"))
            .select(row_id, names[F.col("feature_idx")].alias("feature"), "contribution"))
