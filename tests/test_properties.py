"""Properties: split sizes and order, idempotent upsert, additivity, scale inverse, partition independence."""

import os

import pytest
from pyspark.sql import Window, functions as F

from aerostat.operators import asof, attribution as attr, incremental as inc, scale
from aerostat.operators.features import basic_features
from aerostat.operators.split import time_split
from aerostat.sources import store
from aerostat.sources import tables as tb
from tests.conftest import SF01

U = tb.USER_SPEC


@pytest.mark.parametrize("spec", [tb.USER_SPEC, tb.USER_SPEC_SPLIT_ALL], ids=["sampled", "split_all"])
def test_split_sizes_and_order(spark, spec):
    s = time_split(tb.user_series(spark, SF01), spec)
    per = s.groupBy("user_id").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("split") == "train", 1).otherwise(0)).alias("tr"),
        F.max(F.when(F.col("split") == "train", F.col("ts"))).alias("max_tr"),
        F.min(F.when(F.col("split") == "test", F.col("ts"))).alias("min_te"))
    bad = per.filter((F.col("tr") != F.floor(F.lit(0.8) * F.col("n"))) | (F.col("max_tr") >= F.col("min_te")))
    assert bad.count() == 0


@pytest.mark.parametrize("spec", [tb.USER_SPEC, tb.USER_SPEC_SPLIT_ALL], ids=["sampled", "split_all"])
def test_last_n_equals_naive(spark, spec):
    e = tb.user_series(spark, SF01)
    as_of = F.lit("2024-01-25 12:00:00").cast("timestamp")
    got = asof.last_n(e, spec, 24, as_of).select("event_id", "rank_from_end")
    w = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    ref = (e.filter(F.col("ts") <= as_of).withColumn("rank_from_end", F.row_number().over(w).cast("int"))
           .filter("rank_from_end <= 24").select("event_id", "rank_from_end"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_upsert_twice_equals_once(spark, scratch):
    e = tb.user_series(spark, SF01).select("user_id", "ts", "event_id", "value")
    path = os.path.join(scratch, "series")
    first = store.with_date_partition(e.filter(F.col("ts") < "2024-01-20"), "ts")
    batch = store.with_date_partition(e.filter(F.col("ts") >= "2024-01-19").withColumn("value", F.col("value") + 1),
                                      "ts")
    store.upsert_table(spark, first, path, ["user_id", "ts"], ["event_id"])
    store.upsert_table(spark, batch, path, ["user_id", "ts"], ["event_id"])
    once = spark.read.parquet(path).select("user_id", "ts", "event_id", "value").collect()
    store.upsert_table(spark, batch, path, ["user_id", "ts"], ["event_id"])
    twice = spark.read.parquet(path).select("user_id", "ts", "event_id", "value").collect()
    assert sorted(once) == sorted(twice)
    assert len(once) == e.count()
    changed = spark.read.parquet(path).filter(F.col("ts") >= "2024-01-19")
    orig = e.filter(F.col("ts") >= "2024-01-19")
    j = changed.join(orig.withColumnRenamed("value", "v0"), ["user_id", "ts", "event_id"])
    assert j.filter(F.abs(F.col("value") - F.col("v0") - 1) > 1e-9).count() == 0


def test_union_keep_first_prefers_existing(spark):
    a = spark.createDataFrame([(1, "2024-01-01", 1, "old")], "u long, t string, id long, s string")
    b = spark.createDataFrame([(1, "2024-01-01", 0, "new"), (2, "2024-01-01", 5, "new")],
                              "u long, t string, id long, s string")
    out = {(r.u, r.s) for r in inc.union_keep_first(a, b, ["u", "t"], ["id"]).collect()}
    assert out == {(1, "old"), (2, "new")}
    out2 = {(r.u, r.s) for r in inc.upsert_latest(a, b, ["u", "t"], ["id"]).collect()}
    assert out2 == {(1, "new"), (2, "new")}


def test_minmax_inverse_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "x double, c double")
    fit = scale.fit_minmax(df, ["x", "c"])
    out = scale.minmax_inverse(scale.minmax_transform(df, fit), fit).collect()
    assert [r.x_scaled for r in out] == [0.0, 1.0, 0.5]
    assert all(r.c_scaled == 0.0 for r in out)          # constant column -> 0
    assert all(abs(r.x - r.x_restored) < 1e-12 and abs(r.c - r.c_restored) < 1e-12 for r in out)


def test_single_row_scale(spark):
    df = spark.createDataFrame([(7.0,)], "x double")
    fit = scale.fit_minmax(df, ["x"])
    assert scale.minmax_transform(df, fit).first().x_scaled == 0.0


def test_linear_attribution_adds_up(spark):
    f = basic_features(tb.user_series(spark, SF01), U, target="value")
    coefs = {"hour": 0.3, "aqi_lag_1h": 0.5, "aqi_rolling_mean_3h": 0.25, "is_weekend": -2.0}
    means = attr.background_means(f, list(coefs))
    sample = asof.hash_sample(f, ["event_id"], 200, 42)
    long = attr.linear_attribution(sample, "event_id", coefs, 1.5, means)
    chk = long.groupBy("event_id").agg(F.sum("contribution").alias("s"), F.first("base_value").alias("b"),
                                       F.first("prediction").alias("p"))
    assert chk.count() == 200
    assert chk.filter(F.abs(F.col("s") + F.col("b") - F.col("p")) > 1e-6).count() == 0


@pytest.mark.parametrize("name", ["features_basic", "split_80_20", "last_n", "union_dedup", "recursive_forecast"])
def test_independent_of_shuffle_partitions(spark, name):
    import __spark_entry__ as ent
    q = ent.queries()[name]
    results = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(q(spark, SF01).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_hash_sample_stable(spark):
    e = tb.user_series(spark, SF01)
    a = [r.event_id for r in asof.hash_sample(e, ["event_id"], 50, 42).collect()]
    b = [r.event_id for r in asof.hash_sample(e.repartition(13), ["event_id"], 50, 42).collect()]
    assert a == b and len(set(a)) == 50


def test_first_available_fallback(spark, scratch):
    df, label = tb.first_available([
        ("missing", lambda: spark.read.parquet(os.path.join(scratch, "nope"))),
        ("events", lambda: tb.events(spark, SF01)),
    ])
    assert label == "events" and "k" in df.columns


def test_global_split_equals_naive(spark):
    from aerostat.operators.split import global_time_split
    e = tb.user_series(spark, SF01).select("user_id", "ts", "event_id", "value")
    got = global_time_split(e, U).select("event_id", "split")
    n = e.count()
    w = Window.orderBy("ts", "event_id")   # whole-table window: test reference only
    ref = e.withColumn("split", F.when(F.row_number().over(w) <= int(0.8 * n), "train").otherwise("test")) \
        .select("event_id", "split")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    assert got.filter("split = 'train'").count() == int(0.8 * n)


def test_global_split_all_levels(spark, monkeypatch):
    """Force refinement down to the microsecond level and check the cut is still exact."""
    from aerostat.operators import split as sp
    monkeypatch.setattr(sp, "FINAL_BUCKET_ROWS", 0)
    e = tb.user_series(spark, SF01).select("user_id", "ts", "event_id")
    got = sp.global_time_split(e, U, 0.37).filter("split = 'train'")
    n = int(0.37 * e.count())
    w = Window.orderBy("ts", "event_id")
    ref = e.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= n).drop("r")
    assert got.count() == n and got.drop("split").exceptAll(ref).count() == 0


def test_best_model_ties_follow_priority(spark):
    from aerostat.operators.metrics import best_model
    m = spark.createDataFrame([("other", "test", 1.0, 0.5, 0.9), ("xgboost", "test", 1.0, 0.4, 0.9),
                               ("random_forest", "test", 1.0, 0.3, 0.9), ("lstm", "train", 0.1, 0.1, 0.9)],
                              "model string, split string, rmse double, mae double, r2 double")
    assert best_model(m, ["lstm", "xgboost", "random_forest"]).first().model == "xgboost"


def test_plans_of_scaling_and_alerts(spark):
    """One subquery for any number of scaled columns; the alert table scans its source once."""
    from aerostat.operators.alerts import alert_table
    e = tb.user_series(spark, SF01)
    wide = e.select("value", *[(F.col("value") * i).alias(f"c{i}") for i in range(12)])
    fit = scale.fit_minmax(wide, wide.columns)
    plan = scale.minmax_transform(wide, fit)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scalar-subquery") == 1
    alerts = alert_table(e.select("user_id", "ts", "event_id", "value"), tb.USER_SPEC_PLAIN, "value", F.lit("2024-01-25 12:00:00").cast("timestamp"))
    physical = alerts._jdf.queryExecution().sparkPlan().toString()
    assert physical.count("FileScan") == 1 and "Join" not in physical


def test_metrics_over_common_rows(spark):
    from aerostat.operators.metrics import common_row_metrics
    df = spark.createDataFrame([("test", 1.0, 2.0, None), ("test", 3.0, 1.0, 3.0), ("test", 5.0, 5.0, 4.0), ("train", None, 1.0, 1.0)], "split string, y double, a double, b double")
    got = {(r.model, r.split): (r.n, round(r.mae, 6)) for r in common_row_metrics(df, "y", {"a": F.col("a"), "b": F.col("b")}).collect()}
    assert got == {("a", "test"): (2, 1.0), ("b", "test"): (2, 0.5)}


def test_global_cut_with_rows_without_a_time(spark):
    from aerostat.operators.split import global_time_split
    e = tb.user_series(spark, SF01).select("user_id", "ts", "event_id").withColumn("ts", F.when(F.col("event_id") % 2 == 0, F.col("ts")))
    got = global_time_split(e, U, 0.8)
    w = Window.orderBy(F.col("ts").asc_nulls_last(), "event_id")
    ref = e.withColumn("split", F.when(F.row_number().over(w) <= int(0.8 * e.count()), "train").otherwise("test"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def _against_window(spark, rows, spec, fraction):
    from aerostat.operators.split import global_time_split
    got = global_time_split(rows, spec, fraction)
    w = Window.orderBy(*[F.col(c).asc_nulls_last() for c in spec.order_cols])   # whole-table window: test reference only
    ref = rows.withColumn("split", F.when(F.row_number().over(w) <= int(fraction * rows.count()), "train").otherwise("test"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


@pytest.mark.parametrize("fraction", [0.05, 0.45, 0.999])
def test_global_split_among_equal_and_missing_times(spark, monkeypatch, fraction):
    """A third of all rows at one time, a third without a time: the cut goes on with the tie-break column, in small brackets."""
    from aerostat.operators import split as sp
    monkeypatch.setattr(sp, "FINAL_BUCKET_ROWS", 20)
    at = F.timestamp_seconds(F.when(F.col("id") % 3 == 0, F.lit(500)).when(F.col("id") % 3 == 1, F.col("id")))
    rows = spark.range(3000).select(at.alias("ts"), F.xxhash64("id").alias("event_id"), F.lit(1).alias("user_id")).cache()
    _against_window(spark, rows, U, fraction)


def test_global_split_by_text_and_equal_rows(spark, monkeypatch):
    """A string tie-break is bracketed from a sample; rows that are equal in every order column stay together."""
    from aerostat.operators import split as sp
    monkeypatch.setattr(sp, "FINAL_BUCKET_ROWS", 10)
    spec = U.with_(order=("name",))
    rows = spark.range(2000).select(F.timestamp_seconds(F.lit(7)).alias("ts"), F.sha1(F.col("id").cast("string")).alias("name"), F.lit(1).alias("user_id"))
    _against_window(spark, rows.cache(), spec, 0.8)
    same = spark.range(300).select(F.timestamp_seconds(F.lit(7)).alias("ts"), F.lit("a").alias("name"), F.lit(1).alias("user_id"))
    assert sp.global_cut_key(same, spec, 0.5)[1] == "a"
    assert [r.split for r in sp.global_time_split(same, spec, 0.5).select("split").distinct().collect()] == ["train"]
    assert sp.global_cut_key(same.limit(0), spec, 0.5) is None


def test_global_split_survives_a_wrong_bracket(spark, monkeypatch):
    """The sketch only steers: with brackets far from the cut the counts still find it."""
    from aerostat.operators import split as sp
    monkeypatch.setattr(sp, "FINAL_BUCKET_ROWS", 15)
    monkeypatch.setattr(sp, "_quantiles", lambda p, margin: (min(1.0, p + 0.1), min(1.0, p + 0.2)))
    rows = spark.range(1500).select(F.timestamp_seconds(F.col("id") * 7 % 1500).alias("ts"), F.col("id").alias("event_id"), F.lit(1).alias("user_id"))
    _against_window(spark, rows.cache(), U, 0.37)
