"""Hand-made edge tables (FIXTURES.md section 3) with hand-computed answers."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from aerostat.functions.calendar import calendar_columns
from aerostat.functions.scalar import alert_level, cast_by_class, right_closed_bin, status_band
from aerostat.operators import windows as win
from aerostat.operators.rollups import daily_rollup
from aerostat.operators.split import time_split
from aerostat.schemas import SeriesSpec
from aerostat.sources import payload as pl

T0 = dt.datetime(2024, 1, 1, 0, 0)


def h(i):
    return T0 + dt.timedelta(hours=i)


def series(spark, rows):
    return spark.createDataFrame(rows, "e string, ts timestamp, id long, v double")


@pytest.mark.parametrize("bucket", [None, "1 hour", "1 day"])
def test_edge_rolling(spark, bucket):
    spec = SeriesSpec(entity=("e",), ts="ts", order=("id",), target="v", bucket=bucket)
    rows = [("a", h(0), 1, 1.0), ("a", h(1), 2, None), ("a", h(2), 3, 3.0), ("a", h(3), 4, 4.0),
            ("a", h(4), 5, 5.0), ("a", h(5), 6, 6.0),
            ("b", h(0), 1, 10.0),                                    # entity with one row
            ("c", h(0), 2, 2.0), ("c", h(0), 1, 1.0), ("c", h(1), 3, 3.0)]  # equal ts, different id
    out = win.rolling_features(series(spark, rows), spec, "v", "mean", [3], "v").orderBy("e", "ts", "id").collect()
    got = {(r.e, r.id): r.v_rolling_mean_3 for r in out}
    assert got[("a", 3)] is None and got[("a", 4)] is None      # null inside the window
    assert got[("a", 5)] == pytest.approx(4.0) and got[("a", 6)] == pytest.approx(5.0)
    assert got[("a", 1)] is None and got[("a", 2)] is None      # fewer than n rows
    assert got[("b", 1)] is None
    assert got[("c", 3)] == pytest.approx(2.0)                  # (1 + 2 + 3) / 3, id breaks the tie
    lag = win.lag_features(series(spark, rows), spec, "v", [1], "v").collect()
    lg = {(r.e, r.id): r.v_lag_1 for r in lag}
    assert lg[("c", 2)] == 1.0 and lg[("c", 1)] is None and lg[("c", 3)] == 2.0


@pytest.mark.parametrize("bucket", [None, "1 hour"])
def test_edge_change(spark, bucket):
    spec = SeriesSpec(entity=("e",), ts="ts", order=("id",), target="v", bucket=bucket)
    rows = [("a", h(0), 1, 10.0), ("a", h(1), 2, None), ("a", h(2), 3, 0.0), ("a", h(3), 4, 0.0),
            ("a", h(4), 5, 5.0), ("b", h(0), 1, None), ("b", h(1), 2, 4.0), ("b", h(2), 3, 6.0)]
    out = {(r.e, r.id): (r.v_change, r.v_change_rate)
           for r in win.change_features(series(spark, rows), spec, "v", "v").collect()}
    # pandas: [10, nan, 0, 0, 5] -> diff [nan, nan, nan, 0, 5]; padded pct [nan, 0, -100, nan(0/0), inf->NULL]
    assert out[("a", 1)] == (None, None)
    assert out[("a", 2)] == (None, 0.0)
    assert out[("a", 3)][0] is None and out[("a", 3)][1] == pytest.approx(-100.0)
    assert out[("a", 4)] == (0.0, None)     # zero base
    assert out[("a", 5)] == (5.0, None)     # zero base: reference gives inf, ours NULL
    assert out[("b", 2)] == (None, None)    # leading null: nothing to pad from
    assert out[("b", 3)][1] == pytest.approx(50.0)


def test_edge_bins(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 0.5, 2.0, 5.0, 10.0, 100.0, 101.0, None, -1.0]], "w double")
    got = [r.b for r in df.select(right_closed_bin(F.col("w")).alias("b")).collect()]
    assert got == [None, 0, 0, 1, 2, 3, None, None, None]


def test_edge_bands_and_alert_modes(spark):
    vals = [50.0, 50.1, 100.0, 150.0, 200.0, 300.0, 301.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    b = status_band(F.col("x"))
    out = df.select(b["label"].alias("s"), alert_level(F.col("x"), True).alias("inc"),
                    alert_level(F.col("x"), False).alias("strict")).collect()
    assert [r.s for r in out] == ["Good", "Moderate", "Moderate", "Unhealthy for Sensitive", "Unhealthy",
                                  "Very Unhealthy", "Hazardous"]
    assert [r.inc for r in out] == ["none", "none", "unhealthy", "hazardous", "hazardous", "hazardous", "hazardous"]
    assert [r.strict for r in out] == ["none", "none", "none", "unhealthy", "hazardous", "hazardous", "hazardous"]


def test_edge_round_half_even(spark):
    spec = SeriesSpec(entity=("e",), ts="ts", target="v")
    rows = [("a", h(0), 1, 0.0), ("a", h(1), 2, 1.0), ("b", h(0), 1, 1.0), ("b", h(1), 2, 2.0),
            ("c", h(0), 1, 2.0), ("c", h(1), 2, 3.0)]
    out = {r.e: r.avg_value for r in daily_rollup(series(spark, rows), spec, "v").collect()}
    assert out == {"a": 0.0, "b": 2.0, "c": 2.0}


def test_edge_calendar(spark):
    days = [dt.datetime(2024, 1, 1, hh) for hh in (6, 7, 9, 10, 16, 17, 19, 20)]   # Monday
    days += [dt.datetime(2024, 1, 7, 12), dt.datetime(2024, 12, 31, 0)]            # Sunday; day 366
    days += [dt.datetime(2023, m, 15, 12) for m in range(1, 13)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp")
    out = df.select(*[c.alias(n) for n, c in calendar_columns("ts").items()]).collect()
    assert [r.is_rush_hour for r in out[:8]] == [0, 1, 1, 0, 0, 1, 1, 0]
    assert out[0].day_of_week == 0 and out[0].is_weekend == 0
    assert out[8].day_of_week == 6 and out[8].is_weekend == 1
    assert out[9].day_of_year == 366
    assert [r.season for r in out[10:]] == [0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 3, 0]


def test_edge_split_sizes(spark):
    spec = SeriesSpec(entity=("e",), ts="ts", order=("id",), target="v")
    rows = []
    for name, n in [("n1", 1), ("n4", 4), ("n5", 5), ("n6", 6)]:
        rows += [(name, h(i * 7), i, float(i)) for i in range(n)]   # spans several day buckets
    out = time_split(series(spark, rows), spec).groupBy("e").agg(
        F.sum(F.when(F.col("split") == "train", 1).otherwise(0)).alias("tr"), F.count("*").alias("n")).collect()
    got = {r.e: (r.tr, r.n) for r in out}
    assert got == {"n1": (0, 1), "n4": (3, 4), "n5": (4, 5), "n6": (4, 6)}
    assert time_split(series(spark, []), spec).count() == 0


def test_edge_payload(spark):
    schema = "city string, hourly struct<time: array<string>, a: array<double>, b: array<double>>"
    rows = [("ok", (["2025-01-01T00:00", "2025-01-01T01:00"], [1.0, None], [3.0, 4.0])),
            ("unequal", (["2025-01-01T00:00", "2025-01-01T01:00"], [1.0], [3.0, 4.0])),
            ("missing", (["2025-01-01T00:00"], [1.0], None)),
            ("empty", ([], [], []))]
    p = spark.createDataFrame(rows, schema)
    good, bad = pl.split_unequal(p, ["time", "a", "b"])
    assert sorted(r.city for r in bad.collect()) == ["missing", "unequal"]
    out = pl.explode_payload(good, ["a", "b"]).orderBy("timestamp").collect()
    assert [(r.city, r.timestamp, r.a, r.b) for r in out] == [
        ("ok", dt.datetime(2025, 1, 1, 0), 1.0, 3.0), ("ok", dt.datetime(2025, 1, 1, 1), None, 4.0)]


def test_time_axis_n_in_n_out(spark):
    df = spark.createDataFrame([("x", 1735689600, 3600, ["a"], [[1.0, None, 3.0]])],
                               "city string, start_epoch long, interval_seconds int, names array<string>, "
                               "values array<array<double>>")
    out = pl.time_axis(df, ["a"]).orderBy("timestamp").collect()
    assert [r.timestamp for r in out] == [dt.datetime(2025, 1, 1, 0), dt.datetime(2025, 1, 1, 1),
                                          dt.datetime(2025, 1, 1, 2)]
    assert [r.a for r in out] == [1.0, None, 3.0]


def test_cast_by_class_overflow(spark):
    df = spark.createDataFrame([(2**40, 1.5)], "big long, f float")
    r = cast_by_class(df).collect()[0]
    assert r.big is None and r.f == 1.5
    assert dict(cast_by_class(df).dtypes) == {"big": "int", "f": "double"}


def test_edge_gap_grid(spark):
    from aerostat.operators.grid import hourly_grid
    spec = SeriesSpec(entity=("e",), ts="ts", target="v")
    rows = [("a", h(0), 1, 1.0), ("a", h(1), 2, 2.0), ("a", h(3), 3, 4.0)]   # hour 2 missing
    g = hourly_grid(series(spark, rows).drop("id"), spec).orderBy("ts")
    lag = win.lag_features(g, spec, "v", [1], "v").orderBy("ts").collect()
    assert [r.v for r in lag] == [1.0, 2.0, None, 4.0]
    assert lag[3].v_lag_1 is None          # row lag 1 = hour lag 1 after gap fill
    assert not math.isnan(lag[1].v_lag_1)


def test_edge_watermark(spark):
    from aerostat.operators import incremental as inc
    spec = SeriesSpec(entity=("e",), ts="ts", order=("id",), target="v")
    now = F.lit(h(10)).cast("timestamp")
    stored = series(spark, [("future", h(15), 1, 1.0), ("equal", h(10), 1, 1.0), ("past", h(7), 1, 1.0)])
    wm = inc.high_watermark(stored, spec)
    everyone = spark.createDataFrame([("future",), ("equal",), ("past",), ("new",)], "e string")
    r = {x.e: x for x in inc.fetch_ranges(wm, now, entities=everyone).collect()}
    assert r["future"].last_ts == h(9) and r["future"].next_ts == h(10) and r["future"].due   # clamped
    assert r["equal"].next_ts == h(11) and not r["equal"].due                                 # nothing to fetch
    assert r["past"].next_ts == h(8) and r["past"].due
    assert r["new"].last_ts is None and r["new"].next_ts == h(10) - dt.timedelta(days=7) and r["new"].due
    # late row and a duplicate key with a different value
    landed = series(spark, [("past", h(6), 2, 9.0), ("past", h(7), 3, 5.0), ("past", h(8), 4, 2.0)])
    fresh, late = inc.split_incoming(landed, wm, spec)
    assert sorted(x.id for x in fresh.collect()) == [4] and sorted(x.id for x in late.collect()) == [2, 3]
    kept = {(x.ts, x.id, x.v) for x in inc.union_keep_first(stored, landed, ["e", "ts"], ["id"]).collect()
            if x.e == "past"}
    assert (h(7), 1, 1.0) in kept and (h(7), 3, 5.0) not in kept       # stored row wins
    # empty table: everything is fresh, duplicates inside the batch keep the first
    empty = stored.limit(0)
    fresh2, late2 = inc.split_incoming(landed, inc.high_watermark(empty, spec), spec)
    assert fresh2.count() == 3 and late2.count() == 0
    assert inc.union_keep_first(None, landed.unionByName(landed), ["e", "ts"], ["id"]).count() == 3


def test_far_off_time_fills_in_chunks(spark, monkeypatch):
    from aerostat.operators import grid
    spec = SeriesSpec(entity=("e",), ts="ts", target="v")
    rows = series(spark, [("a", h(0), 1, 1.0), ("a", h(9000), 2, 2.0), ("a", h(9002), 3, 3.0)]).drop("id")
    out = grid.hourly_grid(rows, spec).orderBy("ts").collect()
    assert [r.ts for r in out] == [h(i) for i in range(9003)]
    assert [(i, r.v) for i, r in enumerate(out) if r.v is not None] == [(0, 1.0), (9000, 2.0), (9002, 3.0)]
