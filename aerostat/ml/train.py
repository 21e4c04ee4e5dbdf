"""Model training and evaluation with pyspark.ml.

Features are always assembled by name (``VectorAssembler`` saved inside the
pipeline), never by column position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from aerostat.ml.boosting import fit_boosted
from aerostat.operators.metrics import best_model, regression_metrics
from aerostat.operators.windows import windowed
from aerostat.schemas import GBT_PARAMS, MODEL_PRIORITY, RF_PARAMS, SeriesSpec
from aerostat.sources.store import register_metrics

MODEL_BUILDERS = {
    # the reference's forest samples no feature subsets, hence "all"
    "random_forest": lambda label: RandomForestRegressor(labelCol=label, featuresCol="features",
                                                         featureSubsetStrategy="all", **RF_PARAMS),
    # column subsample 0.8 (Spark draws per node, not per tree)
    "xgboost": lambda label: GBTRegressor(labelCol=label, featuresCol="features", featureSubsetStrategy="0.8",
                                          **GBT_PARAMS),
    "linear": lambda label: LinearRegression(labelCol=label, featuresCol="features"),
}


def pipeline(features: Sequence[str], label: str, kind: str = "random_forest", **overrides) -> Pipeline:
    est = MODEL_BUILDERS[kind](label)
    if overrides:
        est = est.copy({est.getParam(k): v for k, v in overrides.items()})
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), est])


def fit(train: DataFrame, features: Sequence[str], label: str, kind: str = "random_forest", **overrides) -> PipelineModel:
    """A fitted pipeline; kind ``"boosted"`` (a column subset per tree) needs ``key``, the columns that name a row."""
    if kind == "boosted":
        return fit_boosted(train, features, label, **overrides)
    return pipeline(features, label, kind, **overrides).fit(train)


def evaluate(model: PipelineModel, data: DataFrame, label: str, split_col: str = "split",
             model_name: str = "model") -> DataFrame:
    """RMSE / MAE / R^2 per split of a fitted model."""
    pred = model.transform(data).select(F.lit(model_name).alias("model"), F.col(split_col).alias("split"),
                                        F.col(label).cast("double").alias("y"), F.col("prediction").alias("pred"))
    return regression_metrics(pred)


def importances(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Model-native importances zipped with the feature names (bounded by the number of features)."""
    vec = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(features, [float(v) for v in vec])), "feature string, importance double")


def flatten_sequences(seq: DataFrame, fields: Sequence[str], out: str = "features") -> DataFrame:
    """Lookback array<struct> -> one dense vector (lookback x fields), row-major in time."""
    flat = F.flatten(F.transform("x", lambda s: F.array(*[s[f].cast("double") for f in fields])))
    return seq.withColumn(out, array_to_vector(flat))


def fit_lookback(seq_train: DataFrame, fields: Sequence[str], kind: str = "linear", **overrides):
    """Regressor on flattened lookback windows (the re-aimed sequence model)."""
    est = MODEL_BUILDERS[kind]("y")
    if overrides:
        est = est.copy({est.getParam(k): v for k, v in overrides.items()})
    return est.fit(flatten_sequences(seq_train, fields))


def aligned(df: DataFrame, spec: SeriesSpec, target: str, align: str = "next", label: str = "label") -> DataFrame:
    """Add the label: the target one row ahead (``"next"``), or of the same row (``"same"``, for parity with models
    trained that way). Lag and change features of a row contain its own target, so only ``"next"`` asks for a forecast.

    Rows without a next one have a NULL label and are dropped.
    """
    if align == "same":
        out = df.withColumn(label, F.col(target).cast("double"))
    elif align == "next":
        out = windowed(df, spec, [lambda cx: {label: F.lead(F.col(target).cast("double"), 1).over(cx.w)}], context_rows=1, context_cols=[target], lead_rows=1)
    else:
        raise ValueError(f"align must be 'next' or 'same', got {align!r}")
    return out.filter(F.col(label).isNotNull())


def train_and_register(spark: SparkSession, data: DataFrame, spec: SeriesSpec, features: Sequence[str], target: str, kind: str,
                       base: str, registry: str, version: int, snapshot_version: str, align: str = "next", **overrides) -> PipelineModel:
    """Fit on the train rows of ``data`` (with a ``split`` column), save as a version, and register the test metrics and the
    native importances (where the model has them)."""
    rows = aligned(data, spec, target, align)
    model = fit(rows.filter("split = 'train'"), features, "label", kind, **overrides)
    save_version(model, base, kind, version)
    test = evaluate(model, rows, "label", model_name=kind).filter("split = 'test'").first()
    if test is not None:
        register_metrics(spark, registry, kind, version, {m: test[m] for m in ("rmse", "mae", "r2")}, snapshot_version)
    if hasattr(model.stages[-1], "featureImportances"):
        importances(spark, model, features).select(F.lit(kind).alias("model"), F.lit(version).alias("version"), "feature", "importance") \
            .write.mode("append").parquet(f"{base.rstrip('/')}/importances")
    return model


def best_registered(spark: SparkSession, registry: str, priority: Sequence[str] = MODEL_PRIORITY) -> DataFrame:
    """The registered model with the lowest test RMSE, each model by its newest version; ties go by ``priority``."""
    rows = spark.read.parquet(registry)
    newest = rows.groupBy("model").agg(F.max("version").alias("version"))
    wide = (rows.join(newest, ["model", "version"]).groupBy("model", "version")
            .agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in ("rmse", "mae", "r2")]))
    return best_model(wide.withColumn("split", F.lit("test")), priority)


def version_path(base: str, kind: str, version: int) -> str:
    return f"{base.rstrip('/')}/{kind}/v={int(version)}"


def save_version(model: PipelineModel, base: str, kind: str, version: int) -> str:
    """Save under a path of its own; a version that exists is never overwritten."""
    path = version_path(base, kind, version)
    model.write().save(path)
    return path


def saved_versions(spark: SparkSession, base: str, kind: str) -> list[int]:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{kind}")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[2:]) for n in names if n.startswith("v="))


def load_latest(spark: SparkSession, base: str, kinds: Sequence[str]) -> tuple[PipelineModel, str, int]:
    """The newest version of the first of ``kinds`` that has a loadable one, with its kind and version."""
    errors = []
    for kind in kinds:
        for version in reversed(saved_versions(spark, base, kind)):
            try:
                return PipelineModel.load(version_path(base, kind, version)), kind, version
            except Exception as e:  # a damaged version: the one before it, or the next kind, serves
                errors.append(f"{kind} v={version}: {str(e)[:200]}")
    raise LookupError("no model can be loaded: " + ("; ".join(errors) or f"none of {list(kinds)} is saved"))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
