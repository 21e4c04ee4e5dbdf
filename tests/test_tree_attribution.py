"""Exact tree attribution against enumeration over all feature subsets, and against the models themselves."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from aerostat.ml import train
from aerostat.operators import attribution as attr, tree_attribution as ta

FEATS = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(400).select(F.col("id"), *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(17)) / 4.0).alias(f) for i, f in enumerate(FEATS)])
    return df.withColumn("y", F.col("a") * 3 + F.when(F.col("b") > 2, F.col("c") * F.col("d")).otherwise(-F.col("e"))).cache()


def expected(nodes, row, known):
    """A tree's expectation with only ``known`` features, by its recursion."""
    def walk(n):
        r = nodes[n]
        if r["left"] is None:
            return r["value"]
        left, right = nodes[r["left"]], nodes[r["right"]]
        if r["feature"] in known:
            return walk(r["left"] if row[r["feature"]] is not None and row[r["feature"]] <= r["threshold"] else r["right"])
        return (left["cover"] * walk(r["left"]) + right["cover"] * walk(r["right"])) / (left["cover"] + right["cover"])
    return walk(0)


def by_enumeration(table, row, feats):
    trees = {}
    for r in table:
        trees.setdefault(r["tree"], {})[r["node"]] = r
    weight = {t: next(iter(n.values()))["weight"] for t, n in trees.items()}
    value = lambda known: sum(weight[t] * expected(n, row, known) for t, n in trees.items())
    m, out = len(feats), {}
    for f in feats:
        rest = [x for x in feats if x != f]
        out[f] = sum(math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m) * (value({*s, f}) - value(set(s)))
                     for k in range(m) for s in itertools.combinations(rest, k))
    return out, value(set())


KINDS = [("random_forest", {"numTrees": 4, "maxDepth": 5}), ("xgboost", {"maxIter": 4, "maxDepth": 4})]


@pytest.mark.parametrize("kind, options", KINDS)
def test_equals_enumeration_and_adds_up(spark, data, kind, options):
    model = train.fit(data, FEATS, "y", kind, **options)
    nodes = ta.node_table(model, FEATS)
    long = ta.tree_attribution(data, "id", nodes, FEATS)
    got = {}
    for r in long.collect():
        got.setdefault(r.id, {})[r.feature] = r
    assert len(got) == 400 and all(set(g) == set(FEATS) for g in got.values())
    predicted = {r.id: r.prediction for r in model.transform(data).collect()}
    for i, g in got.items():
        first = g["a"]
        assert abs(first.base_value + sum(x.contribution for x in g.values()) - predicted[i]) < 1e-9
        assert abs(first.prediction - predicted[i]) < 1e-9
    table = [r.asDict() for r in nodes.collect()]
    for row in data.filter("id < 12").collect():
        want, base = by_enumeration(table, row.asDict(), FEATS)
        assert abs(got[row.id]["a"].base_value - base) < 1e-9
        assert all(abs(got[row.id][f].contribution - want[f]) < 1e-9 for f in FEATS)
    assert attr.attribution_rank(long).count() == len(FEATS)


def test_deep_paths_and_kept_tables_agree(spark, data, monkeypatch):
    model = train.fit(data, FEATS, "y", "random_forest", numTrees=3, maxDepth=9)
    nodes = ta.node_table(model, FEATS)
    key = lambda df: {(r.id, r.feature): r.contribution for r in df.collect()}
    kept = key(ta.tree_attribution(data, "id", nodes, FEATS))
    monkeypatch.setattr(ta, "TABLE_BYTES", 0)
    computed = key(ta.tree_attribution(data, "id", nodes, FEATS))
    assert all(abs(kept[k] - computed[k]) < 1e-12 for k in kept) and kept.keys() == computed.keys()


@pytest.mark.parametrize("kind, options", KINDS)
def test_native_importance_equals_the_models_own(spark, data, kind, options):
    model = train.fit(data, FEATS, "y", kind, **options)
    own = {r.feature: r.importance for r in train.importances(spark, model, FEATS).collect()}
    got = {r.feature: r.importance for r in ta.native_importance(ta.node_table(model, FEATS), FEATS, kind == "random_forest").collect()}
    assert got.keys() == own.keys() and all(abs(got[f] - own[f]) < 1e-9 for f in FEATS)


STUMPS = [(0, 0, 1, 2, "a", 2.0, None), (0, 1, None, None, None, None, 1.0), (0, 2, 3, 4, "a", 3.0, None), (0, 3, None, None, None, None, 5.0),
          (0, 4, None, None, None, None, 9.0), (7, 3, None, None, None, None, 2.5)]


def test_covers_missing_values_and_a_tree_without_splits(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 2.5), (4, None), (5, float("nan")), (6, float("-inf"))], "id long, a double")
    nodes = spark.createDataFrame([(*n, 2.0, None, None) for n in STUMPS], ta.NODE_SCHEMA)
    fitted = ta.fitted_on(nodes, rows, ["a"], "id")
    cover = {(r.tree, r.node): r.cover for r in fitted.collect()}
    assert cover == {(0, 0): 6, (0, 1): 3, (0, 2): 3, (0, 3): 1, (0, 4): 2, (7, 3): 6}
    got = {r.id: r for r in ta.tree_attribution(rows, "id", fitted, ["a"]).collect()}
    base = 2 * ((3 * 1 + 1 * 5 + 2 * 9) / 6) + 2 * 2.5
    assert {i: r.prediction for i, r in got.items()} == {1: 7.0, 2: 7.0, 3: 15.0, 4: 23.0, 5: 23.0, 6: 7.0}
    assert all(abs(r.base_value - base) < 1e-12 and abs(r.base_value + r.contribution - r.prediction) < 1e-12 for r in got.values())


def test_empty_rows_and_nodes_without_cover(spark):
    nodes = spark.createDataFrame([(*n, 1.0, None, None) for n in STUMPS], ta.NODE_SCHEMA)
    none = spark.createDataFrame([], "id long, a double")
    assert ta.tree_attribution(none, "id", ta.fitted_on(nodes, none, ["a"], "id"), ["a"]).count() == 0
    rows = spark.createDataFrame([(1, 1.0)], "id long, a double")
    r = ta.tree_attribution(rows, "id", ta.fitted_on(nodes, none, ["a"]), ["a"]).first()
    assert r.base_value == 0.5 * 1 + 0.5 * (0.5 * 5 + 0.5 * 9) + 2.5 and r.base_value + r.contribution == r.prediction == 3.5
    assert [x.importance for x in ta.native_importance(ta.fitted_on(nodes, none, ["a"], "id"), ["a"]).collect()] == [0.0]


def test_categorical_splits_are_refused(spark):
    from pyspark.ml.feature import VectorAssembler, VectorIndexer
    from pyspark.ml.regression import DecisionTreeRegressor
    df = spark.range(60).select((F.col("id") % 3).cast("double").alias("a"), F.when(F.col("id") % 3 == 1, 5.0).otherwise(1.0).alias("y"))
    v = VectorAssembler(inputCols=["a"], outputCol="raw").transform(df)
    indexed = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=4).fit(v).transform(v)
    model = DecisionTreeRegressor(labelCol="y", maxDepth=2).fit(indexed)
    with pytest.raises(Exception, match="categorical"):
        ta.node_table(model, ["a"]).collect()
