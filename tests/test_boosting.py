"""Boosting with a row and a column subset per tree: against a plain loop, early end, reload, attribution."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerostat.ml import boosting, train
from aerostat.operators.tree_attribution import node_table

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (160, 4)).astype(float)
    y = 3 * x[:, 0] - x[:, 1] * x[:, 2] / 4 + rng.normal(0, 1, 160)
    data = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id long, a double, b double, c double, d double, y double").cache()


def _grow(x, r, columns, depth):
    """A greedy least-squares tree as nested tuples: thresholds halfway between the values that occur at the root."""
    points = {j: (lambda v: (v[1:] + v[:-1]) / 2)(np.unique(x[:, j])) for j in columns}

    def node(at, left):
        mean = r[at].mean()
        sse = lambda s: ((r[s] - r[s].mean()) ** 2).sum()
        best = None
        for j in columns if left else ():
            for t in points[j]:
                lo, hi = at[x[at, j] <= t], at[x[at, j] > t]
                if len(lo) and len(hi):
                    gain = sse(at) - sse(lo) - sse(hi)
                    if best is None or gain > best[0] + 1e-12:
                        best = (gain, j, t, lo, hi)
        if best is None or best[0] <= 1e-12:
            return mean
        return best[1], best[2], node(best[3], left - 1), node(best[4], left - 1)
    return node(np.arange(len(r)), depth)


def _value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def _loop(spark, pdf, rounds, depth, step, subsample, colsample, seed):
    x, y = pdf[FEATURES].to_numpy(), pdf["y"].to_numpy()
    m = np.full(len(y), y.mean())
    for turn in range(rounds):
        keyed = spark.createDataFrame([(int(i),) for i in pdf["id"]], "id long").select("id", F.struct(F.col("id").alias("k0")).alias("k"))
        drawn = {r.id for r in keyed.filter(boosting.drawn_rows(["k"], subsample, seed, turn)).collect()}
        at = np.array([i in drawn for i in pdf["id"]])
        columns = [FEATURES.index(f) for f in boosting.drawn_columns(FEATURES, colsample, seed, turn)]
        tree = _grow(x[at], (y - m)[at], columns, depth)
        m = m + step * np.array([_value(tree, r) for r in x])
    return m


def test_equals_a_plain_loop_and_reloads(spark, rows, scratch):
    args = dict(rounds=5, depth=2, step=0.3, subsample=0.7, colsample=0.5, seed=9)
    model = boosting.fit_boosted(rows, FEATURES, "y", ["id"], cut_every=2, **args)
    got = model.transform(rows).orderBy("id").toPandas()
    want = _loop(spark, rows.orderBy("id").toPandas(), **args)
    assert np.allclose(got["prediction"], want, atol=1e-9)
    assert model.stages[-1].numFeatures == 4 and len(train.importances(spark, model, FEATURES).collect()) == 4
    # every tree keeps to its own columns
    used = {r.tree: set(r.f) for r in node_table(model, FEATURES).filter("feature is not null").groupBy("tree").agg(F.collect_set("feature").alias("f")).collect()}
    assert used and all(f <= set(boosting.drawn_columns(FEATURES, 0.5, 9, t - 1)) for t, f in used.items())
    train.save_version(model, scratch, "boosted", 1)
    again, kind, version = train.load_latest(spark, scratch, ["boosted"])
    assert (kind, version) == ("boosted", 1)
    assert np.array_equal(again.transform(rows).orderBy("id").toPandas()["prediction"], got["prediction"])


def test_early_end_on_held_out_rows(spark, rows):
    noise = rows.withColumn("y", F.pmod(F.xxhash64("id"), F.lit(1000)) / 100.0)  # nothing to learn: every round fits noise
    part, held = noise.filter("id % 4 != 0"), noise.filter("id % 4 = 0")
    few = boosting.fit_boosted(part, FEATURES, "y", ["id"], rounds=7, depth=4, step=0.9, validation=held, patience=2, cut_every=3)
    full = boosting.fit_boosted(part, FEATURES, "y", ["id"], rounds=7, depth=4, step=0.9)
    n = few.stages[-1].getNumTrees
    assert n < full.stages[-1].getNumTrees == 8
    err = lambda m: m.transform(held).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
    assert err(few) <= err(full)


def test_null_labels_keys_and_clashing_names(spark, rows):
    odd = rows.withColumn("id", F.when(F.col("id") > 5, F.col("id"))).withColumn("y", F.when(F.col("a") > 0, F.col("y"))) \
        .withColumnsRenamed({"a": "f1", "b": "m", "c": "k"})
    model = boosting.fit_boosted(odd, ["f1", "m", "k", "d"], "y", ["id"], rounds=2, depth=2)
    assert model.transform(odd).count() == 160
    with pytest.raises(ValueError):
        boosting.fit_boosted(odd.limit(0), ["f1"], "y", ["id"])


def test_fit_by_kind(spark, rows):
    a = train.fit(rows, FEATURES, "y", "boosted", key=["id"], rounds=2, depth=2)
    b = boosting.fit_boosted(rows, FEATURES, "y", ["id"], rounds=2, depth=2)
    assert a.transform(rows).select("id", "prediction").exceptAll(b.transform(rows).select("id", "prediction")).count() == 0
