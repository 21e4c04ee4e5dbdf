"""Tables and files: CSV round trip, snapshots, registry, views, alert sink, serving fill, JSON payloads."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from aerostat.operators.features import engineer
from aerostat.operators.grid import STATION_SPEC, hourly_grid, station_series
from aerostat.schemas import AIR_PAYLOAD_SCHEMA, POLLUTANT_COLS, INDEX_COLS
from aerostat.sources import payload as pl
from aerostat.sources import store
from aerostat.sources import tables as tb
from aerostat.streaming import ingest
from tests.conftest import SF001


def test_csv_round_trip_sorted(spark, scratch):
    e = tb.user_series(spark, SF001).select("user_id", "ts", "value")
    path = os.path.join(scratch, "csv")
    store.write_csv_sorted(e, path, "ts", partitions=4)
    back = store.read_csv(spark, path, "user_id long, ts string, value double", ts_cols=["ts"])
    assert back.count() == e.count()
    assert back.exceptAll(e).count() == 0
    parts = sorted(f for f in os.listdir(path) if f.endswith(".csv"))
    bounds = []
    for f in parts:
        d = spark.read.option("header", True).csv(os.path.join(path, f)).agg(F.min("ts"), F.max("ts")).first()
        if d[0] is not None:
            bounds.append((d[0], d[1]))
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))   # part files concatenate in time order


def test_snapshot_refuses_overwrite(spark, scratch):
    df = spark.range(3)
    p = store.snapshot(df, os.path.join(scratch, "snap"), "20240120")
    assert spark.read.parquet(p).count() == 3
    with pytest.raises(AnalysisException):
        store.snapshot(df, os.path.join(scratch, "snap"), "20240120")


def test_registry_latest_version(spark, scratch):
    reg = os.path.join(scratch, "registry")
    store.register_metrics(spark, reg, "random_forest", 20240101, {"rmse": 1.0, "r2": 0.9}, "20240101")
    store.register_metrics(spark, reg, "random_forest", 20240102, {"rmse": 0.9, "r2": 0.95}, "20240102")
    assert store.latest_version(spark, reg, "random_forest") == 20240102
    assert spark.read.parquet(reg).count() == 4


def test_create_if_absent_and_view(spark, scratch):
    from aerostat.schemas import RAW_SERIES_SCHEMA
    p = os.path.join(scratch, "raw")
    store.create_if_absent(spark, p, RAW_SERIES_SCHEMA)
    store.create_if_absent(spark, p, RAW_SERIES_SCHEMA)      # second call is a no-op
    v = store.register_view(spark.read.parquet(p), "raw_view")
    v2 = store.register_view(spark.read.parquet(p), "raw_view")   # re-creating is fine
    assert v.count() == v2.count() == 0


def test_serving_mode_has_no_nulls(spark):
    g = hourly_grid(station_series(tb.events(spark, SF001)), STATION_SPEC)
    out = engineer(g, STATION_SPEC, mode="serving")
    assert out.count() == g.count()
    nulls = out.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in out.columns]).first().asDict()
    assert sum(nulls.values()) == 0


def test_alert_sink(spark, scratch):
    e = tb.user_series(spark, SF001).select("user_id", "ts", "event_id", "value")
    src = os.path.join(scratch, "series")
    store.upsert_table(spark, store.with_date_partition(e, "ts"), src, ["user_id", "ts"], ["event_id"])
    alerts = os.path.join(scratch, "alerts")
    sink = ingest.alert_sink(src, alerts, tb.USER_SPEC, "value", lambda: F.lit("2024-01-25 12:00:00").cast("timestamp"))
    sink(e, 0)
    sink(e, 1)    # same hour twice: alerts are keyed, not duplicated
    a = spark.read.parquet(alerts)
    assert a.count() == a.select("user_id", "ts", "level").distinct().count() > 0
    assert a.filter(~F.col("level").isin("hazardous", "unhealthy")).count() == 0


def test_json_payload_read_and_explode(spark, scratch):
    rows = [{"city": "c1", "hourly": {"time": ["2025-01-01T00:00", "2025-01-01T01:00"],
                                      **{c: [1.0, 2.0] for c in POLLUTANT_COLS + INDEX_COLS}}}]
    path = os.path.join(scratch, "payload.json")
    import json
    with open(path, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    p = pl.read_payload_json(spark, path, AIR_PAYLOAD_SCHEMA)
    good, bad = pl.split_unequal(p, ["time", *POLLUTANT_COLS, *INDEX_COLS])
    out = pl.explode_payload(good, POLLUTANT_COLS + INDEX_COLS)
    assert bad.count() == 0 and out.count() == 2
    assert out.filter(F.col("us_aqi") == 2.0).first().timestamp.hour == 1


def test_weather_payload_renames(spark, scratch):
    from aerostat.schemas import WEATHER_PAYLOAD_SCHEMA, WEATHER_RENAMES
    import json
    row = {"city": "c1", "hourly": {"time": ["2025-01-01T00:00"], **{k: [1.5] for k in WEATHER_RENAMES}}}
    path = os.path.join(scratch, "weather.json")
    with open(path, "w") as f:
        f.write(json.dumps(row) + "\n")
    p = pl.read_payload_json(spark, path, WEATHER_PAYLOAD_SCHEMA)
    out = pl.explode_payload(p, list(WEATHER_RENAMES), renames=WEATHER_RENAMES)
    assert out.columns == ["city", "timestamp", *WEATHER_RENAMES.values()]


def test_interval_payload_schema_and_model_frame(spark):
    from aerostat.operators.features import input_columns, model_frame
    from aerostat.schemas import FEATURE_COLS, INTERVAL_PAYLOAD_SCHEMA
    df = spark.createDataFrame([("x", 0, 3600, ["a"], [[1.0]])], INTERVAL_PAYLOAD_SCHEMA)
    assert pl.time_axis(df, ["a"]).count() == 1
    g = hourly_grid(station_series(tb.events(spark, SF001)), STATION_SPEC)
    f = engineer(g, STATION_SPEC, mode="training")
    assert sorted(input_columns(f)) == sorted(FEATURE_COLS)          # 12 raw + 31 derived
    assert model_frame(f).columns == ["city", "timestamp", "us_aqi", *FEATURE_COLS]


def test_assumed_error_table(spark):
    from aerostat.operators.forecast import assumed_error_table
    rows = {r.horizon_h: (r.rmse, r.expected_rmse, r.error_range) for r in assumed_error_table(spark).collect()}
    assert rows[1] == (0.87, "0.87", "±0.87") and rows[72][1] == "5.48"


def test_small_helpers(spark, scratch):
    import datetime as dt
    from aerostat.functions.scalar import parse_time, to_utc, version_label, with_constant_first
    from aerostat.operators.asof import first_row
    from aerostat.operators.features import drop_incomplete
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 2, 3), 1.0), ("a", dt.datetime(2024, 1, 1, 0), None)],
                               "e string, ts timestamp, v double")
    assert with_constant_first(df, "city", "X").columns == ["city", "e", "ts", "v"]
    r = df.select(version_label(F.col("ts")).alias("v"), to_utc(F.col("ts"), "Asia/Kolkata").alias("u"),
                  parse_time(F.lit("2025-01-01T00:00")).alias("p")).first()
    assert r.v == 20240102 and r.u == dt.datetime(2024, 1, 1, 21, 30) and r.p == dt.datetime(2025, 1, 1)
    spec = tb.SeriesSpec(entity=("e",), ts="ts")
    assert first_row(df, spec).first().ts == dt.datetime(2024, 1, 1, 0)
    kept, obs = drop_incomplete(df)
    assert kept.count() == 1 and obs.get == {"rows_in": 2, "rows_dropped": 1}
    frame, label = store.snapshot_or_live(df, os.path.join(scratch, "snaps"), "20240102")
    assert label == "20240102" and frame.count() == 2
    frame2, label2 = store.snapshot_or_live(df, os.path.join(scratch, "snaps"), "20240102")   # same day again
    assert label2 == "20240102" and frame2.count() == 2   # the frozen rows of that day, not the live ones
    changed, label3 = store.snapshot_or_live(df.limit(1), os.path.join(scratch, "snaps"), "20240102")
    assert label3 == "20240102" and changed.count() == 2


def test_read_range_prunes_partitions(spark, scratch):
    e = tb.user_series(spark, SF001).select("user_id", "ts", "event_id", "value")
    path = os.path.join(scratch, "t")
    store.with_date_partition(e, "ts").write.partitionBy("date").parquet(path)
    df = store.read_range(spark, path, "ts", "2024-01-10 06:00:00", "2024-01-12 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "GreaterThanOrEqual(ts," in plan
    want = e.filter((F.col("ts") >= "2024-01-10 06:00:00") & (F.col("ts") < "2024-01-12 00:00:00")).count()
    assert df.count() == want > 0


def test_empty_upsert_and_key_check(spark, scratch):
    e = store.with_date_partition(tb.user_series(spark, SF001).select("user_id", "ts", "event_id", "value"), "ts")
    path = os.path.join(scratch, "t")
    store.upsert_table(spark, e.limit(0), path, ["user_id", "ts"], ["event_id"], ts="ts")
    assert not store.table_exists(spark, path)
    store.upsert_table(spark, e, path, ["user_id", "ts"], ["event_id"], ts="ts")
    store.upsert_table(spark, e.limit(0), path, ["user_id", "ts"], ["event_id"], ts="ts")
    assert spark.read.parquet(path).count() == e.count()
    with pytest.raises(ValueError):
        store.upsert_table(spark, e, path, ["user_id"], ["event_id"], ts="ts")
    files = sum(len([f for f in fs if f.endswith(".parquet")]) for _, _, fs in os.walk(path))
    assert files <= 2 * e.select("date").distinct().count()


def test_staging_is_removed(spark, scratch):
    from aerostat.session import shared_path
    e = store.with_date_partition(tb.user_series(spark, SF001).select("user_id", "ts", "event_id", "value"), "ts")
    store.upsert_table(spark, e, os.path.join(scratch, "t"), ["user_id", "ts"], ["event_id"])
    staging = shared_path(spark, "staging").removeprefix("file:")
    assert not os.path.exists(staging) or not os.listdir(staging)


def test_bad_payloads_go_to_quarantine(spark, scratch):
    schema = "city string, hourly struct<time: array<string>, a: array<double>>"
    p = spark.createDataFrame([("ok", (["2025-01-01T00:00"], [1.0])), ("bad time", (["2025-01-01T00:00", "yesterday"], [1.0, 2.0])),
                               ("no time", ([None], [1.0])), ("unequal", (["2025-01-01T00:00"], []))], schema)
    good, bad = pl.split_unequal(p, ["time", "a"])
    path = os.path.join(scratch, "quarantine")
    pl.quarantine(bad, path, "air")
    assert [r.city for r in pl.explode_payload(good, ["a"]).collect()] == ["ok"]
    kept = spark.read.parquet(path).collect()
    assert len(kept) == 3 and all(r.source == "air" and '"city"' in r.payload for r in kept)


def test_payloads_stay_bounded_for_a_full_day(spark):
    rows = spark.range(5000).select(F.col("id").alias("event_id"), F.lit(1).cast("long").alias("user_id"), F.col("id").cast("double").alias("value"),
                                    F.lit(None).cast("double").alias("k"), F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("ts"))
    sizes = [r.n for r in pl.land_payloads(rows).select(F.size("hourly.time").alias("n")).collect()]
    assert sum(sizes) == 5000 and max(sizes) < 1.3 * pl.PAYLOAD_BLOCK


def test_stale_by_a_fraction_of_a_second_and_overflow_counts(spark):
    import datetime as dt
    from aerostat.functions.scalar import cast_overflows, is_stale
    now = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(now - dt.timedelta(hours=6),), (now - dt.timedelta(hours=6, microseconds=500_000),)], "ts timestamp")
    assert [r.s for r in df.select(is_stale(F.col("ts"), F.lit(now), 6 * 3600).alias("s")).collect()] == [False, True]
    assert cast_overflows(spark.createDataFrame([(2**40, 1), (None, 2), (5, 3)], "a long, b long")).first().asDict() == {"a": 1, "b": 0}


def test_view_in_the_catalog(spark, scratch):
    path = os.path.join(scratch, "v")
    spark.range(4).write.parquet(path)
    store.save_view(spark, "kept_view", f"SELECT id FROM parquet.`{path}` WHERE id > 1")
    assert spark.newSession().table("kept_view").count() == 2
    spark.sql("DROP VIEW kept_view")
