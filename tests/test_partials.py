"""Kept partial aggregates equal full scans, whatever the order and repetition of batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aerostat.operators import asof, incremental as inc, rollups as roll
from aerostat.schemas import SeriesSpec
from aerostat.sources import partials as kept, store, versioned as vt

SPEC = SeriesSpec(entity=("user_id",), ts="ts", order=("event_id",), target="value")
SCHEMA = "user_id long, ts timestamp, event_id long, value double, n_rows string"
T0 = dt.datetime(2024, 1, 1)


def readings(n=400):
    r = random.Random(5)
    out = [(r.choice([1, 1, 1, 2, 3, None]), T0 + dt.timedelta(hours=r.randrange(24 * 6)), i, float(r.randrange(200)), "x") for i in range(n)]
    return out + [(1, None, n, 7.0, "x"), (9, None, n + 1, None, "x"), (8, T0, n + 2, None, "x"), (8, T0 + dt.timedelta(days=2), n + 3, float("nan"), "x")]


def same(a, b):
    assert sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect()))


def check(parts, rows, as_of):
    same(kept.watermark(parts, SPEC), inc.high_watermark(rows, SPEC))
    same(kept.profile(parts, SPEC), roll.profile(rows, SPEC))
    same(kept.daily_rollup(parts, SPEC), roll.daily_rollup(rows, SPEC))
    same(kept.history_size(parts, SPEC, 50), asof.history_size(rows, SPEC, 50))
    same(kept.history_size(parts, SPEC, 50, as_of, rows), asof.history_size(rows, SPEC, 50, as_of))


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_and_repeated(spark, scratch, seed):
    data, r = readings(), random.Random(seed)
    r.shuffle(data)
    cuts = sorted(r.sample(range(len(data)), 3))
    batches = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
    for number, batch in enumerate(batches):
        df = spark.createDataFrame(batch, SCHEMA)
        first = kept.merge_batch(spark, f"{scratch}/p", df, SPEC, number)
        assert kept.merge_batch(spark, f"{scratch}/p", df, SPEC, number) == first
        assert kept.merge_batch(spark, f"{scratch}/p", spark.createDataFrame(batches[0], SCHEMA), SPEC, 0) == first
    assert kept.merge_batch(spark, f"{scratch}/p", df.limit(0), SPEC, 99) == first
    parts = vt.read(spark, f"{scratch}/p")
    check(parts, spark.createDataFrame(data, SCHEMA), F.lit(T0 + dt.timedelta(days=3, hours=7)))
    plan = kept.profile(parts, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "commit=" in plan
    with pytest.raises(ValueError, match="as_of"):
        kept.history_size(parts, SPEC, 50, F.current_timestamp())


def test_feeds_have_batch_numbers_of_their_own_and_a_crash_leaves_none(spark, scratch, monkeypatch):
    df = spark.createDataFrame(readings(40), SCHEMA)
    kept.merge_batch(spark, f"{scratch}/p", df, SPEC, 4, feed="a")
    monkeypatch.setattr(vt, "create_once", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        kept.merge_batch(spark, f"{scratch}/p", df, SPEC, 4, feed="b")
    monkeypatch.undo()
    same(kept.profile(vt.read(spark, f"{scratch}/p"), SPEC), roll.profile(df, SPEC))
    kept.merge_batch(spark, f"{scratch}/p", df, SPEC, 4, feed="b")
    kept.merge_batch(spark, f"{scratch}/p", df, SPEC, 4, feed="a")
    same(kept.profile(vt.read(spark, f"{scratch}/p"), SPEC), roll.profile(df.union(df), SPEC))


def test_a_taken_version_is_merged_anew(spark, scratch, monkeypatch):
    a, b = (spark.createDataFrame(readings(40)[i::2], SCHEMA) for i in (0, 1))
    real, calls = vt.commit, []

    def raced(spark, path, *rest):
        if not calls:
            calls.append(1)
            kept.merge_batch(spark, path, a, SPEC, 0, feed="a")
        return real(spark, path, *rest)
    monkeypatch.setattr(vt, "commit", raced)
    kept.merge_batch(spark, f"{scratch}/p", b, SPEC, 0, feed="b")
    same(kept.profile(vt.read(spark, f"{scratch}/p"), SPEC), roll.profile(a.union(b), SPEC))


def test_partials_follow_a_keyed_table(spark, scratch):
    rows_path, path = f"{scratch}/rows", f"{scratch}/p"
    assert kept.follow(spark, path, rows_path, SPEC) == []
    data = readings()
    later = [(u, t, e + 10_000, 1000.0, x) for u, t, e, v, x in data if t is not None and t >= T0 + dt.timedelta(days=4)][::3]
    for part in (data, later):
        new = store.with_date_partition(spark.createDataFrame(part, SCHEMA), "ts")
        vt.upsert(spark, rows_path, new, ["user_id", "ts"], ["event_id"], ts="ts")
        changed = kept.follow(spark, path, rows_path, SPEC)
    assert changed == ["date=2024-01-05", "date=2024-01-06"]
    assert kept.follow(spark, path, rows_path, SPEC) == []
    vt.vacuum(spark, rows_path, keep=1)
    assert kept.follow(spark, path, rows_path, SPEC) == []
    check(vt.read(spark, path), vt.read(spark, rows_path).drop("date"), F.lit(T0 + dt.timedelta(days=4, hours=12)))


def test_a_restarted_stream_counts_each_batch_once(spark, scratch):
    data = [(u, t, e, v, x) for u, t, e, v, x in readings(60)]
    for i in range(3):
        spark.createDataFrame(data[i::3], SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/in")

    def run(fail_after):
        sink, seen = kept.partials_sink(f"{scratch}/p", SPEC), []

        def write(batch, number):
            sink(batch, number)
            seen.append(number)
            if len(seen) == fail_after:
                raise RuntimeError("lost after its commit")
        q = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in").writeStream
             .foreachBatch(write).option("checkpointLocation", f"{scratch}/cp").trigger(availableNow=True).start())
        q.awaitTermination(120)
        return seen
    with pytest.raises(Exception, match="lost after its commit"):
        run(2)
    assert 1 in run(0)  # the batch that was committed before the loss comes again
    same(kept.profile(vt.read(spark, f"{scratch}/p"), SPEC), roll.profile(spark.createDataFrame(data, SCHEMA), SPEC))
