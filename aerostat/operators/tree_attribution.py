"""Exact Shapley attribution and native importance of tree models.

A model is a *node table*: ``tree, node, left, right, feature, threshold, value, weight, cover`` (and ``gain``),
one row per node; leaves have no children. A row goes left where ``feature <= threshold``; a missing value
(NULL or NaN) goes right, as in the model. :func:`node_table` reads it from what Spark ML saves.

The value of a feature set S at a row is the model's expectation when only S is known: known splits are followed,
unknown ones averaged by cover. For a leaf with path features f (each once, its splits merged) that is
``value * prod(inside_f for f in S) * prod(ratio_f for f not in S)``, so a leaf's contribution to a feature depends
only on which of its path's conditions the row meets. Per leaf these contributions are summed over all subsets by
their size (the coefficients of a polynomial), once for every pattern of met conditions that occurs, and rows look
theirs up. Contributions plus the base value are the prediction.

The model's leaves go to the tasks as the model itself does in a ``transform``; rows are streamed in Arrow batches,
no row is shuffled and nothing is emitted per row and leaf.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from aerostat.session import shared_path

NODE_SCHEMA = "tree int, node int, left int, right int, feature string, threshold double, value double, weight double, cover double, gain double"
#: bytes of contribution tables that a task keeps; patterns beyond are computed per batch
TABLE_BYTES = 64 << 20
TABLE_FEATURES = 8


def node_table(model, features: Sequence[str]) -> DataFrame:
    """The node table of a fitted Spark ML tree, forest or boosted model (or a pipeline that ends in one)."""
    tree = model.stages[-1] if hasattr(model, "stages") else model
    spark = SparkSession.getActiveSession()
    path = shared_path(spark, "node-table", tree.uid)
    tree.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    boosted, forest = hasattr(tree, "treeWeights") and "GBT" in type(tree).__name__, "treeID" in data.columns
    data = data.select(F.col("treeID").alias("tree"), "nodeData.*") if forest else data.select(F.lit(0).alias("tree"), "*")
    weights = [float(w) for w in tree.treeWeights] if forest else [1.0]
    share = F.array(*[F.lit(w if boosted else w / sum(weights)) for w in weights])[F.col("tree")]
    names = F.array(*[F.lit(f) for f in features])
    categorical = F.col("split.numCategories") > 0
    is_leaf = F.col("leftChild") < 0
    return data.select(
        F.col("tree").cast("int").alias("tree"), F.col("id").alias("node"), F.when(~is_leaf, F.col("leftChild")).alias("left"),
        F.when(~is_leaf, F.col("rightChild")).alias("right"),
        F.when(~is_leaf & categorical, F.raise_error(F.lit("categorical splits have no threshold"))).when(
            ~is_leaf, F.get(names, F.col("split.featureIndex"))).alias("feature"),
        F.when(~is_leaf, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"), F.col("prediction").alias("value"),
        share.alias("weight"), F.col("rawCount").cast("double").alias("cover"), F.when(~is_leaf, F.col("gain")).alias("gain"))


def _tree_paths(nodes: pd.DataFrame) -> pd.DataFrame:
    """The leaves of one tree with their merged conditions; inner covers are the sums of the leaves' below."""
    at = {int(r.node): r for r in nodes.itertuples()}
    root = (set(at) - {int(c) for r in at.values() if not pd.isna(r.left) for c in (r.left, r.right)}).pop()
    cover: dict[int, float] = {}
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        if not pd.isna(at[n].left):
            stack += [int(at[n].left), int(at[n].right)]
    for n in reversed(order):
        r = at[n]
        cover[n] = cover[int(r.left)] + cover[int(r.right)] if not pd.isna(r.left) else (0.0 if pd.isna(r.cover) else float(r.cover))
    out, stack = [], [(root, {})]
    while stack:
        n, path = stack.pop()
        r = at[n]
        if pd.isna(r.left):
            f = sorted(path)
            out.append((int(r.tree), n, float(r.weight) * float(r.value), f, *[[path[x][i] for x in f] for i in range(3)]))
            continue
        for child, left in ((int(r.left), True), (int(r.right), False)):
            low, high, ratio = path.get(r.feature, (None, None, 1.0))
            share = cover[child] / cover[n] if cover[n] else 0.5
            t = float(r.threshold)
            merged = (low, t if high is None else min(high, t), ratio * share) if left else (t if low is None else max(low, t), high, ratio * share)
            stack.append((child, {**path, r.feature: merged}))
    return pd.DataFrame(out, columns=["tree", "leaf", "value", "features", "low", "high", "ratio"])


def leaf_paths(nodes: DataFrame) -> DataFrame:
    """Per leaf its weighted value, the features on its path, the bounds on each (above ``low``, at most ``high``) and its share of cover."""
    return nodes.groupBy("tree").applyInPandas(
        _tree_paths, "tree int, leaf int, value double, features array<string>, low array<double>, high array<double>, ratio array<double>")


class Leaf:
    """One leaf over the columns of a matrix."""

    def __init__(self, row: dict, features: Sequence[str]):
        self.value, self.ratio = row["value"], np.array(row["ratio"], float)
        self.cols = np.array([features.index(f) for f in row["features"]], np.int64)
        self.low, self.high = ([math.nan if v is None else v for v in row[c]] for c in ("low", "high"))
        self.table: np.ndarray | None = None

    def inside(self, x: np.ndarray) -> np.ndarray:
        """Per row and path feature whether all its splits lead here; a missing value is on the right of each."""
        part = x[:, self.cols]
        right, left = ~(part <= self.low), part <= self.high
        return (np.isnan(self.low) | right) & (np.isnan(self.high) | left)

    def contributions(self, met: np.ndarray) -> np.ndarray:
        """Per pattern of met conditions the Shapley value of each path feature."""
        m = len(self.cols)
        size = np.array([math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m) for k in range(m)])
        out = np.empty(met.shape)
        for i in range(m):
            poly = np.zeros((len(met), m))
            poly[:, 0] = 1
            for j in range(m):
                if j != i:
                    poly[:, 1:] = poly[:, 1:] * self.ratio[j] + poly[:, :-1] * met[:, j:j + 1]
                    poly[:, 0] *= self.ratio[j]
            out[:, i] = self.value * (met[:, i] - self.ratio[i]) * (poly @ size)
        return out

    def add(self, x: np.ndarray, total: np.ndarray, prediction: np.ndarray, keep: bool) -> int:
        """Add this leaf's part for every row; the bytes of a table that is kept for later rows."""
        met, m, made = self.inside(x), len(self.cols), 0
        prediction += np.where(met.all(axis=1), self.value, 0.0)
        if not m:
            return 0
        if self.table is None and keep and m <= TABLE_FEATURES:
            self.table = self.contributions(((np.arange(1 << m)[:, None] >> np.arange(m)) & 1).astype(float))
            made = self.table.nbytes
        if self.table is not None:
            total[:, self.cols] += self.table[met @ (1 << np.arange(m))]
        else:
            patterns, which = np.unique(met, axis=0, return_inverse=True)
            total[:, self.cols] += self.contributions(patterns.astype(float))[which.reshape(-1)]
        return made


def _matrix(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(f"f{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(len(features))])


def _numbered(rows: DataFrame, features: Sequence[str], *more) -> DataFrame:
    return rows.select(*more, *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])


def _leaves(paths: DataFrame) -> list[dict]:
    """All leaves (bounded by the model, which the driver holds in a ``transform`` too)."""
    return sorted(paths.toArrow().to_pylist(), key=lambda r: (r["tree"], r["leaf"]))


def tree_attribution(rows: DataFrame, row_id: str, nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """Long form (row_id, feature, feature_value, contribution, base_value, prediction), exact to rounding.

    Every feature of ``features`` has a row, also where no tree uses it (contribution 0).
    """
    features = list(features)
    leaves = _leaves(leaf_paths(nodes))
    base = sum(r["value"] * math.prod(r["ratio"]) for r in leaves)
    source = _numbered(rows, features, F.col(row_id).alias("id"))

    def run(batches):
        held, model = 0, [Leaf(r, features) for r in leaves]
        for b in batches:
            x = _matrix(b, features)
            total, prediction = np.zeros(x.shape), np.zeros(len(x))
            for leaf in model:
                held += leaf.add(x, total, prediction, held < TABLE_BYTES)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(features))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.ListArray.from_arrays(ends, pa.array(total.reshape(-1))), pa.array(prediction),
                                              *[b.column(f"f{i}") for i in range(len(features))]], out_names)

    kind = source.schema["id"].dataType.simpleString()
    out_names = ["id", "c", "prediction", *[f"f{i}" for i in range(len(features))]]
    scored = source.mapInArrow(run, f"id {kind}, c array<double>, prediction double, " + ", ".join(f"f{i} double" for i in range(len(features))))
    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"f{i}").alias("feature_value"), F.col("c")[i].alias("contribution"))
                     for i, f in enumerate(features)])
    return scored.select("id", "prediction", F.explode(each).alias("a")).select(
        F.col("id").alias(row_id), "a.feature", "a.feature_value", "a.contribution", F.lit(float(base)).alias("base_value"), "prediction")


def fitted_on(nodes: DataFrame, rows: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """``nodes`` with the covers that ``rows`` give and, with a ``label``, each split's gain in its variance.

    Every task sums count, label and squared label per leaf; the sums go up each tree.
    """
    features = list(features)
    leaves = _leaves(leaf_paths(nodes))
    y = F.lit(0.0) if label is None else F.col(label).cast("double")

    def run(batches):
        model, sums = [Leaf(r, features) for r in leaves], np.zeros((len(leaves), 3))
        for b in batches:
            x, t = _matrix(b, features), b.column("y").to_numpy(zero_copy_only=False).astype(float)
            for i, leaf in enumerate(model):
                here = t[leaf.inside(x).all(axis=1)]
                sums[i] += len(here), here.sum(), (here * here).sum()
        yield pa.RecordBatch.from_arrays([pa.array([r["tree"] for r in leaves], pa.int32()), pa.array([r["leaf"] for r in leaves], pa.int32()),
                                          *[pa.array(sums[:, i]) for i in range(3)]], ["tree", "node", "n", "s", "q"])

    stats = (_numbered(rows, features, y.alias("y")).mapInArrow(run, "tree int, node int, n double, s double, q double")
             .groupBy("tree", "node").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")]))

    def up(one: pd.DataFrame) -> pd.DataFrame:
        one = one.set_index("node")
        for n in _deepest_first(one):
            l, r = int(one.at[n, "left"]), int(one.at[n, "right"])
            for c in ("n", "s", "q"):
                one.at[n, c] = one.at[l, c] + one.at[r, c]
            parts = [one.loc[k, ["n", "s", "q"]] for k in (n, l, r)]
            spread = [p.q - p.s * p.s / p.n if p.n else 0.0 for p in parts]
            one.at[n, "gain"] = (spread[0] - spread[1] - spread[2]) / one.at[n, "n"] if one.at[n, "n"] else 0.0
        one["cover"] = one["n"]
        return one.reset_index()[[c.split()[0] for c in NODE_SCHEMA.split(", ")]]

    both = nodes.drop("cover", "gain").join(stats, ["tree", "node"], "left").withColumn("gain", F.lit(None).cast("double"))
    return both.groupBy("tree").applyInPandas(up, NODE_SCHEMA)


def _deepest_first(one: pd.DataFrame) -> list[int]:
    """The inner nodes of a tree, children before their parents."""
    inner = {int(n): (int(r.left), int(r.right)) for n, r in one.iterrows() if not pd.isna(r.left)}
    root = (set(map(int, one.index)) - {c for pair in inner.values() for c in pair}).pop()
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        if n in inner:
            order.append(n)
            stack += inner[n]
    return order[::-1]


def native_importance(nodes: DataFrame, features: Sequence[str], per_tree: bool = True) -> DataFrame:
    """``feature, importance``: gain times cover summed per tree and feature, then over all trees.

    With ``per_tree`` each tree's shares add up to 1 first, as forests do; boosted models sum the gains
    themselves (False). Features that no tree uses have 0; importances add up to 1 unless no tree splits.
    """
    gains = nodes.filter(F.col("left").isNotNull()).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("cover")).alias("g"))
    whole = gains.groupBy("tree").agg(F.sum("g").alias("t")).filter("t > 0")
    share = F.col("g") / F.col("t") if per_tree else F.col("g")
    shares = gains.join(whole, "tree").groupBy("feature").agg(F.sum(share).alias("w"))
    total = shares.agg(F.sum("w")).scalar()
    names = nodes.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return names.join(shares, "feature", "left").select("feature", F.coalesce(F.col("w") / total, F.lit(0.0)).alias("importance"))
