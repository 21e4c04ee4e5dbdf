"""Streaming jobs give the batch answer."""

import os

from pyspark.sql import functions as F

from aerostat.sources import tables as tb
from aerostat.streaming import ingest
from tests.conftest import SF01

KEY = ["user_id", "ts"]


def _land_files(spark, df, folder, n_files, order_col):
    """Write the rows as n separate parquet files, in the given file order."""
    parts = df.withColumn("_f", F.pmod(F.hash(order_col), F.lit(n_files)))
    for i in range(n_files):
        parts.filter(F.col("_f") == i).drop("_f").coalesce(1).write.parquet(os.path.join(folder, f"batch={i:03d}"))


def test_stream_upsert_equals_batch_with_shuffled_files(spark, scratch):
    e = tb.user_series(spark, SF01).select("user_id", "ts", "event_id", "value")
    # 10 % conflicting duplicates: same key, another id and value
    dup = e.filter(F.col("event_id") % 10 == 0).withColumn("event_id", F.col("event_id") + 100000) \
        .withColumn("value", F.col("value") * 2)
    feed = e.unionByName(dup)
    landing = os.path.join(scratch, "landing")
    flat = os.path.join(scratch, "flat")
    _land_files(spark, feed, landing, 3, "event_id")
    # flatten to one folder of files so the file source picks them up in arbitrary order
    spark.read.parquet(landing).drop("batch").write.parquet(flat)

    table = os.path.join(scratch, "table")
    src = ingest.read_event_files(spark, flat, feed.schema, max_files=1)
    ingest.run_available(src, ingest.upsert_sink(table, KEY, ["event_id"], "ts"), os.path.join(scratch, "ckpt"))

    got = spark.read.parquet(table).select("user_id", "ts", "event_id", "value")
    from aerostat.operators.incremental import dedup_keep_first
    want = dedup_keep_first(feed, KEY, ["event_id"])
    assert got.count() == e.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hourly_stream_equals_batch(spark, scratch):
    e = tb.events(spark, SF01).select("event_type", "ts", "value")
    # time-ordered files (disorder stays within the watermark delay)
    folder = os.path.join(scratch, "ordered")
    e.withColumn("d", F.to_date("ts")).write.partitionBy("d").parquet(folder)
    src = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 4).parquet(folder)
    agg = ingest.hourly_stream(src, ["event_type"], "ts", "value", delay="2 hours")
    q = agg.writeStream.outputMode("append").format("memory").queryName("hourly_out").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("hourly_out")
    want = ingest.hourly_aggregate(e, ["event_type"], "ts", "value")
    # the last windows stay open until the watermark passes them; everything emitted equals batch
    assert got.exceptAll(want).count() == 0
    closed = want.filter(F.col("hour_ts") < F.lit("2024-01-30 21:00:00").cast("timestamp"))
    assert closed.exceptAll(got).count() == 0


def test_late_rows_go_to_side_table(spark, scratch):
    e = tb.user_series(spark, SF01).select("user_id", "ts", "event_id", "value")
    table, late = os.path.join(scratch, "t"), os.path.join(scratch, "late")
    sink = ingest.late_splitting_sink(table, late, tb.USER_SPEC, KEY, ["event_id"])
    sink(e.filter(F.col("ts") < "2024-01-20"), 0)
    sink(e.filter(F.col("ts") >= "2024-01-19"), 1)
    assert spark.read.parquet(table).count() == e.count()
    n_late = spark.read.parquet(late).count()
    wm = e.filter(F.col("ts") < "2024-01-20").groupBy("user_id").agg(F.max("ts").alias("w"))
    expect = e.filter(F.col("ts") >= "2024-01-19").join(wm, "user_id").filter(F.col("ts") <= F.col("w")).count()
    assert n_late == expect > 0


def test_feature_stream_equals_batch(spark, scratch):
    """Features kept current batch by batch (files out of time order) equal one batch computation."""
    from aerostat.operators import windows as win
    e = tb.user_series(spark, SF01).select("user_id", "ts", "event_id", "value")
    spec = tb.USER_SPEC_PLAIN

    def build(df):
        st = [lambda cx: {"lag_1": cx.lag("value", 1), "lag_24": cx.lag("value", 24),
                          "mean_6": cx.guarded(F.avg, "value", 6)}]
        return win.windowed(df, spec, st, context_rows=24, context_cols=["value"])

    flat = os.path.join(scratch, "flat")
    e.withColumn("_f", F.pmod(F.hash("event_id"), F.lit(3))).repartition(3, "_f").drop("_f").write.parquet(flat)
    raw, feats = os.path.join(scratch, "raw"), os.path.join(scratch, "feats")
    sink = ingest.feature_sink(raw, feats, spec, KEY, ["event_id"], build)
    src = ingest.read_event_files(spark, flat, e.schema, max_files=1)
    ingest.run_available(src, sink, os.path.join(scratch, "ckpt"))

    got = spark.read.parquet(feats).select("user_id", "ts", "event_id", "lag_1", "lag_24", "mean_6")
    want = build(e).select("user_id", "ts", "event_id", "lag_1", "lag_24", "mean_6")
    assert got.count() == e.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_feature_refresh_reads_old_history_only_when_needed(spark, scratch):
    """A short lookback window still gives exact features (older rows are fetched for sparse users)."""
    from aerostat.operators import windows as win
    from aerostat.sources import store
    e = tb.user_series(spark, SF01).select("user_id", "ts", "event_id", "value")
    spec = tb.USER_SPEC_PLAIN

    def build(df):
        st = [lambda cx: {"lag_24": cx.lag("value", 24), "mean_6": cx.guarded(F.avg, "value", 6)}]
        return win.windowed(df, spec, st, context_rows=24, context_cols=["value"])

    raw, feats = os.path.join(scratch, "raw"), os.path.join(scratch, "feats")
    sink = ingest.feature_sink(raw, feats, spec, KEY, ["event_id"], build, lookback="1 day")
    for i, (lo, hi) in enumerate([("2024-01-01", "2024-01-15"), ("2024-01-15", "2024-01-22"),
                                  ("2024-01-22", "2024-02-01")]):
        sink(e.filter((F.col("ts") >= lo) & (F.col("ts") < hi)), i)
    got = spark.read.parquet(feats).select("user_id", "ts", "event_id", "lag_24", "mean_6")
    want = build(e).select("user_id", "ts", "event_id", "lag_24", "mean_6")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    index = ingest.entity_index(spark, raw)
    assert index.count() == e.select("user_id").distinct().count() and ingest.index_versions(spark, raw) == [0, 1, 2]
    assert store.table_exists(spark, raw)


def _rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("user_id", "ts", "event_id", "value").collect()))


def test_empty_all_late_and_repeated_batches(spark, scratch):
    e = tb.user_series(spark, SF01).select("user_id", "ts", "event_id", "value")
    table, late = os.path.join(scratch, "t"), os.path.join(scratch, "late")
    clock = lambda: F.lit("2024-02-01 00:00:00").cast("timestamp")
    sink = ingest.late_splitting_sink(table, late, tb.USER_SPEC, KEY, ["event_id"], as_of=clock)
    batches = [e.limit(0), e.filter(F.col("ts") < "2024-01-20"), e.filter(F.col("ts") >= "2024-01-19"),
               e.filter(F.col("ts") < "2024-01-02").withColumn("event_id", F.col("event_id") + 1_000_000), e.limit(0)]
    for epoch, b in enumerate(batches):
        sink(b, epoch)
    want = _rows(spark, table), _rows(spark, late)
    assert len(want[0]) == e.count()
    sink(batches[3], 3)   # delivered again: the same rows are late, the same rows are stored
    assert (_rows(spark, table), _rows(spark, late)) == want


def test_a_row_from_the_future_does_not_stop_the_feed(spark, scratch):
    e = tb.user_series(spark, SF01).select("user_id", "ts", "event_id", "value").filter("user_id = 1")
    table, late = os.path.join(scratch, "t"), os.path.join(scratch, "late")
    clock = lambda: F.lit("2024-01-10 00:00:00").cast("timestamp")
    sink = ingest.late_splitting_sink(table, late, tb.USER_SPEC, KEY, ["event_id"], as_of=clock)
    future = e.limit(1).withColumn("ts", F.lit("2030-01-01 00:00:00").cast("timestamp")).withColumn("event_id", F.lit(10**9))
    sink(future.unionByName(e.filter(F.col("ts") < "2024-01-05")), 0)
    sink(e.filter(F.col("ts") >= "2024-01-10"), 1)
    assert spark.read.parquet(table).filter(F.col("ts") >= "2024-01-10").count() == e.filter(F.col("ts") >= "2024-01-10").count() + 1


def test_a_crash_leaves_the_older_index(spark, scratch):
    e = tb.user_series(spark, SF01).select("user_id", "ts", "event_id", "value")
    table = os.path.join(scratch, "t")
    ingest.update_entity_index(spark, e, tb.USER_SPEC, table, 0)
    os.makedirs(os.path.join(ingest.index_path(table), "v=1"))   # begun, never finished
    assert ingest.index_versions(spark, table) == [0]
    assert ingest.entity_index(spark, table).count() == e.select("user_id").distinct().count()
    for epoch in range(1, 6):
        ingest.update_entity_index(spark, e.limit(1), tb.USER_SPEC, table, epoch)
    assert ingest.index_versions(spark, table) == [3, 4, 5]


def test_refresh_pads_over_a_long_gap(spark, scratch):
    """Forty rows without a value between the last value and the new row: stream and batch pad alike."""
    import datetime as dt
    from aerostat.operators import windows as win
    from aerostat.sources import store
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(hours=h), h, 5.0 + h if h < 3 or h >= 43 else None) for h in range(46)]
    e = spark.createDataFrame(rows, "user_id long, ts timestamp, event_id long, value double")
    raw = os.path.join(scratch, "raw")
    store.upsert_table(spark, store.with_date_partition(e, "ts"), raw, KEY, ["event_id"])
    build = lambda df: win.windowed(df, tb.USER_SPEC_PLAIN, [lambda cx: {"p": cx.padded_prev("value")}])
    new = e.filter(F.col("event_id") >= 43)
    got = ingest.refresh_features(spark, raw, new, tb.USER_SPEC_PLAIN, build, 24, "12 hours", fill_col="value")
    want = build(e).filter(F.col("event_id") >= 43)
    assert sorted((r.event_id, r.p) for r in got.collect()) == sorted((r.event_id, r.p) for r in want.collect()) == [(43, 7.0), (44, 48.0), (45, 49.0)]
