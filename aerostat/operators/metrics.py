"""Regression metrics per (model, split), model choice, and importance ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from aerostat.functions.scalar import text_bar


def common_row_metrics(df: DataFrame, label: str, preds: dict[str, Column], split: str = "split") -> DataFrame:
    """RMSE, MAE, R^2 and n per (model, split) over the rows where the label and every prediction are present.

    Rows are not multiplied by the number of models: one aggregate holds a struct of sums per model, and only
    its few result rows are unpivoted.
    """
    y = F.col(label).cast("double")
    named = df.select(F.col(split).alias("split"), y.alias("y"), *[p.cast("double").alias(f"p{i}") for i, p in enumerate(preds.values())])
    ok = named.na.drop("any", subset=["y", *[f"p{i}" for i in range(len(preds))]])
    errs = [F.col("y") - F.col(f"p{i}") for i in range(len(preds))]
    agg = ok.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.var_pop("y").alias("_var"), *[
        F.struct(F.lit(m).alias("model"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.sum(e * e).alias("sse")).alias(f"m{i}")
        for i, (m, e) in enumerate(zip(preds, errs))])
    long = agg.select("split", "n", "_var", F.explode(F.array(*[f"m{i}" for i in range(len(preds))])).alias("m"))
    r2 = F.lit(1.0) - F.try_divide(F.col("m.sse"), F.col("n") * F.col("_var"))
    return long.select("m.model", "split", "n", "m.rmse", "m.mae", r2.alias("r2"))


def regression_metrics(long: DataFrame, by: Sequence[str] = ("model", "split")) -> DataFrame:
    """RMSE, MAE, R^2 and n over rows where label and prediction are both present.

    R^2 = 1 - SSE / (n * var_pop(y)), one pass, combined map-side.
    """
    ok = long.filter(F.col("y").isNotNull() & F.col("pred").isNotNull())
    err = F.col("y") - F.col("pred")
    agg = ok.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_sse"),
        F.var_pop("y").alias("_var"))
    r2 = F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("n") * F.col("_var"))
    return agg.withColumn("r2", r2).drop("_sse", "_var")


def best_model(metrics: DataFrame, priority: Sequence[str], split: str = "test") -> DataFrame:
    """The model with the lowest RMSE; equal RMSE resolves by ``priority`` order."""
    pos = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("model"))
    prio = F.when(pos == 0, F.lit(len(priority) + 1)).otherwise(pos)  # unlisted models rank last on ties
    m = metrics.filter(F.col("split") == split).withColumn("_prio", prio)
    return m.agg(F.min_by(F.struct("model", "rmse", "mae", "r2"), F.struct("rmse", "_prio")).alias("b")).select("b.*")


def correlation_importance(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """|corr(feature, label)| normalised to sum 1, one row per feature (one aggregate, no window)."""
    pairs = [F.struct(F.lit(f).alias("feature"), F.coalesce(F.abs(F.corr(f, label)), F.lit(0.0)).alias("w"))
             for f in features]
    row = df.agg(F.array(*pairs).alias("a"))
    total = F.aggregate("a", F.lit(0.0), lambda acc, x: acc + x["w"])
    return row.select(F.explode("a").alias("x"), total.alias("_t")).select(
        F.col("x.feature").alias("feature"), F.try_divide(F.col("x.w"), F.col("_t")).alias("importance"))


def top_k(importance: DataFrame, k: int, value: str = "importance", bar_scale: int = 50) -> DataFrame:
    """The k largest by ``value`` (ties by feature name), with a text bar; a top-k report."""
    top = importance.orderBy(F.col(value).desc(), F.col("feature")).limit(k)
    return top.withColumn("bar", text_bar(F.col(value), bar_scale))
