"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from aerostat.functions.calendar import calendar_columns
from aerostat.functions import scalar as sc
from aerostat.operators import alerts
from aerostat.operators import asof
from aerostat.operators import attribution as attr
from aerostat.operators import features as feat
from aerostat.operators import forecast as fc
from aerostat.operators import grid
from aerostat.operators import incremental as inc
from aerostat.operators import metrics as met
from aerostat.operators import rollups as roll
from aerostat.operators import scale
from aerostat.operators import split as split_mod
from aerostat.operators import tree_attribution as trees
from aerostat.operators import windows as win
from aerostat.plans.output import finish
from aerostat.session import prepare, shared_path
from aerostat.schemas import (FORECAST_MIN_ROWS, HORIZON_ERROR_GROWTH, LOOKBACK, PM25_LAGS, ROLLING_MEAN_SIZES,
                              ROLLING_STD_SIZES, SAMPLE_ROWS, SAMPLE_SEED, STALE_AFTER_SECONDS, TARGET_LAGS,
                              WEATHER_RENAMES)
from aerostat.sources import partials as kept
from aerostat.sources import payload as pl
from aerostat.sources import tables as tb
from aerostat.sources import versioned
from aerostat.sources.store import with_date_partition

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn``; the registered callable first applies the session settings it relies on."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)
    QUERIES[fn.__name__] = run
    return fn


U = tb.USER_SPEC
KEY = ["user_id", "ts", "event_id"]


def _station(spark, sf_dir) -> DataFrame:
    return grid.station_series(tb.events(spark, sf_dir))


def _station_grid(spark, sf_dir) -> DataFrame:
    return grid.hourly_grid(_station(spark, sf_dir), grid.STATION_SPEC)


# ---------------------------------------------------------------- step 1: row-level

@query
def calendar_features(spark, sf_dir):
    e = tb.user_series(spark, sf_dir)
    return finish(e.select(*KEY, *[c.alias(n) for n, c in calendar_columns("ts").items()]))


@query
def interaction_features(spark, sf_dir):
    s = _station(spark, sf_dir)
    return finish(s.select("city", "timestamp", *[c.alias(n) for n, c in sc.interaction_columns().items()]))


@query
def bucketize(spark, sf_dir):
    s = _station(spark, sf_dir)
    return finish(s.select("city", "timestamp", "wind_speed",
                           sc.weather_flag_columns()["wind_category"].alias("wind_category")))


@query
def threshold_flags(spark, sf_dir):
    s = _station(spark, sf_dir)
    f = sc.weather_flag_columns()
    return finish(s.select("city", "timestamp", f["is_raining"].alias("is_raining"),
                           f["high_pressure"].alias("high_pressure")))


@query
def cast_by_class(spark, sf_dir):
    return finish(sc.cast_by_class(tb.read_table(spark, sf_dir, "events")))


@query
def status_band(spark, sf_dir):
    e = tb.user_series(spark, sf_dir)
    b = sc.status_band(F.col("value"))
    return finish(e.select("event_id", "value", b["label"].alias("status"), b["color"].alias("color")))


@query
def alert_level(spark, sf_dir):
    e = tb.user_series(spark, sf_dir)
    return finish(e.select("event_id", "value", sc.alert_level(F.col("value"), True).alias("level_inclusive"),
                           sc.alert_level(F.col("value"), False).alias("level_strict")))


# ---------------------------------------------------------------- step 2: windows

def _lags(spark, sf_dir, spec):
    e = tb.user_series(spark, sf_dir)
    st = [lambda cx: {**{f"value_lag_{k}": cx.lag("value", k) for k in TARGET_LAGS},
                      **{f"k_lag_{k}": cx.lag("k", k) for k in PM25_LAGS}}]
    out = win.windowed(e, spec, st, context_rows=max(TARGET_LAGS + PM25_LAGS), context_cols=["value", "k"])
    return finish(out.select(*KEY, *[f"value_lag_{k}" for k in TARGET_LAGS], *[f"k_lag_{k}" for k in PM25_LAGS]))


@query
def lag_features(spark, sf_dir):
    return _lags(spark, sf_dir, U)


def _means(spark, sf_dir, spec):
    e = tb.user_series(spark, sf_dir)
    out = win.rolling_features(e, spec, "value", "mean", ROLLING_MEAN_SIZES, "value")
    return finish(out.select(*KEY, *[f"value_rolling_mean_{n}" for n in ROLLING_MEAN_SIZES]))


@query
def rolling_mean(spark, sf_dir):
    return _means(spark, sf_dir, U)


@query
def rolling_std(spark, sf_dir):
    e = tb.user_series(spark, sf_dir)
    out = win.rolling_features(e, U, "value", "std", ROLLING_STD_SIZES, "value")
    return finish(out.select(*KEY, *[f"value_rolling_std_{n}" for n in ROLLING_STD_SIZES]))


@query
def rolling_minmax(spark, sf_dir):
    e = tb.user_series(spark, sf_dir)
    st = [lambda cx: {"value_rolling_max_6": cx.guarded(F.max, "value", 6),
                      "value_rolling_min_6": cx.guarded(F.min, "value", 6)}]
    out = win.windowed(e, U, st, context_rows=6, context_cols=["value"])
    return finish(out.select(*KEY, "value_rolling_max_6", "value_rolling_min_6"))


def _changes(spark, sf_dir, spec):
    e = tb.user_series(spark, sf_dir)
    out = win.change_features(e, spec, "value", "value")
    return finish(out.select(*KEY, "value_change", "value_change_rate"))


@query
def change_features(spark, sf_dir):
    return _changes(spark, sf_dir, U)


@query
def forward_fill(spark, sf_dir):
    g = grid.event_counts_grid(tb.events(spark, sf_dir))
    spec = tb.SeriesSpec(entity=("event_type",), ts="hour_ts")  # a grid has one row per slot: no hot series
    out = win.forward_fill(g, spec, ["avg_value"], zero_fill=True)
    return finish(out.select("event_type", "hour_ts", "n_events", "avg_value"))


@query
def lookback_sequences(spark, sf_dir):
    e = tb.user_series(spark, sf_dir)
    seq = win.lookback_sequences(e, U, ["value", "k"], LOOKBACK, "value")
    long = seq.select("user_id", "ts", "event_id", "y", F.posexplode("x").alias("step", "xr"))
    return finish(long.select("user_id", "ts", "event_id", "y", "step",
                              F.col("xr.value").alias("x_value"), F.col("xr.k").alias("x_k")))


# The same queries with every user cut into many buckets: the plan of a series of billions of rows.
CUT = tb.USER_SPEC_CUT


@query
def lag_features_cut(spark, sf_dir):
    return _lags(spark, sf_dir, CUT)


@query
def rolling_mean_cut(spark, sf_dir):
    return _means(spark, sf_dir, CUT)


@query
def change_features_cut(spark, sf_dir):
    return _changes(spark, sf_dir, CUT)


# ---------------------------------------------------------------- step 3: grid, joins, payloads

@query
def hourly_grid(spark, sf_dir):
    g = grid.event_counts_grid(tb.events(spark, sf_dir))
    return finish(g.select("event_type", "hour_ts", "n_events", "avg_value"))


@query
def join_sources(spark, sf_dir):
    """Two hourly feeds joined on the hour; the second comes with its own names, the result with its feed's name in front."""
    partials = grid.hourly_partials(tb.events(spark, sf_dir))
    feed = grid.hourly_weather(partials).withColumnsRenamed({v: k for k, v in WEATHER_RENAMES.items()})
    joined = grid.join_sources(grid.hourly_air(partials), feed.withColumnsRenamed(WEATHER_RENAMES))
    return finish(sc.with_constant_first(joined, "feed", "events"))


@query
def payload_explode(spark, sf_dir):
    p = pl.land_payloads(tb.events(spark, sf_dir))
    good, bad = pl.split_unequal(p, ["time", "value", "k"])
    pl.quarantine(bad, shared_path(spark, f"quarantine-{uuid.uuid4().hex}"), "events")
    out = pl.explode_payload(good, ["value", "k"])
    return finish(out.select(F.col("city").alias("user_id"), F.col("timestamp").alias("ts"), "value", "k"))


PAYLOAD_SCHEMA = T.StructType([T.StructField("city", T.LongType()), T.StructField("hourly", T.StructType([
    T.StructField("time", T.ArrayType(T.StringType())), T.StructField("value", T.ArrayType(T.DoubleType())), T.StructField("k", T.ArrayType(T.DoubleType()))]))])


@query
def payload_quarantine(spark, sf_dir):
    """Landed JSON with defects (every seventh user's broken, uneven or drifted): what is exploded and what is set aside, and why."""
    p = pl.land_payloads(tb.events(spark, sf_dir))
    uneven = p.withColumn("hourly", F.col("hourly").withField("value", F.slice("hourly.value", 2, 1 << 30)))
    drifted = p.withColumn("hourly", F.col("hourly").withField("uv", F.lit("high")))
    text, kind = F.to_json(F.struct("city", "hourly")), F.col("city") % 7
    lines = (p.filter(~kind.isin(3, 4, 5)).select(text.alias("value")).union(p.filter(kind == 3).select(F.expr("left(to_json(struct(city, hourly)), 40)")))
             .union(uneven.filter(kind == 4).select(text)).union(drifted.filter(kind == 5).select(text)))
    path = shared_path(spark, f"landed-{uuid.uuid4().hex}")
    lines.write.text(path)
    good, bad = pl.sort_out(pl.read_landed_json(spark, path, PAYLOAD_SCHEMA), ["time", "value", "k"])
    rows = pl.explode_payload(good, ["value", "k"]).agg(F.lit("exploded").alias("outcome"), F.count(F.lit(1)).alias("n"))
    return finish(rows.union(bad.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))))


@query
def time_axis(spark, sf_dir):
    p = pl.interval_payloads(tb.events(spark, sf_dir))
    out = pl.time_axis(p, ["avg_value", "n_events"])
    return finish(out.select(F.col("city").alias("user_id"), F.col("timestamp").alias("ts"),
                             "avg_value", "n_events"))


# ---------------------------------------------------------------- step 4: pipelines

@query
def features_full(spark, sf_dir):
    out = feat.engineer(_station_grid(spark, sf_dir), grid.STATION_SPEC, mode="training")
    return finish(out)


@query
def features_basic(spark, sf_dir):
    out = feat.basic_features(tb.user_series(spark, sf_dir), U, target="value")
    return finish(out.select(*KEY, "value", *feat.BASIC_FEATURES))

# ---------------------------------------------------------------- step 5: tables and incremental
#
# Scenario over the events table: the stored table holds every row before CUTOFF;
# a landed batch holds every row from OVERLAP_FROM on (one day of overlap, so it
# repeats stored keys); AS_OF is "now" for as-of reads. Together the two parts
# cover the whole table.

CUTOFF = "2024-01-20 00:00:00"
OVERLAP_FROM = "2024-01-19 00:00:00"
AS_OF = "2024-01-25 12:00:00"
LOAD_TIME = "2024-01-19 12:00:00"  # the clock of the load: rows stored from after it are stamped in the future


def _ts(s: str):
    return F.lit(s).cast("timestamp")


def _stored(spark, sf_dir):
    return tb.user_series(spark, sf_dir).filter(F.col("ts") < _ts(CUTOFF)).select("user_id", "ts", "event_id", "value")


def _landed(spark, sf_dir):
    return tb.user_series(spark, sf_dir).filter(F.col("ts") >= _ts(OVERLAP_FROM)).select(
        "user_id", "ts", "event_id", "value")


@query
def watermark(spark, sf_dir):
    return finish(inc.high_watermark(tb.user_series(spark, sf_dir), U))


@query
def fetch_ranges(spark, sf_dir):
    """Ranges due at ``AS_OF``; most users have rows after it, so their watermark is ahead of the clock and clamped."""
    wm = inc.high_watermark(tb.user_series(spark, sf_dir), U)
    return finish(inc.fetch_ranges(wm, _ts(AS_OF)))


@query
def incremental_rows(spark, sf_dir):
    wm = inc.high_watermark(_stored(spark, sf_dir), U)
    fresh, _late = inc.split_incoming(_landed(spark, sf_dir), wm, U, as_of=_ts(LOAD_TIME))
    return finish(fresh)


@query
def late_rows(spark, sf_dir):
    wm = inc.high_watermark(_stored(spark, sf_dir), U)
    _fresh, late = inc.split_incoming(_landed(spark, sf_dir), wm, U, as_of=_ts(LOAD_TIME))
    return finish(late)


@query
def union_dedup(spark, sf_dir):
    old = _stored(spark, sf_dir).withColumn("source", F.lit("stored"))
    new = _landed(spark, sf_dir).withColumn("source", F.lit("landed"))
    return finish(inc.union_keep_first(old, new, key=["user_id", "ts"], order=["event_id"]))


@query
def upsert_latest(spark, sf_dir):
    old = _stored(spark, sf_dir).withColumn("source", F.lit("stored"))
    new = _landed(spark, sf_dir).withColumn("source", F.lit("landed"))
    return finish(inc.upsert_latest(old, new, key=["user_id", "ts"], order=["event_id"]))


@query
def versioned_upsert(spark, sf_dir):
    """The same keyed insert as two commits of a versioned table, read back as its newest version."""
    path = shared_path(spark, f"versioned-{uuid.uuid4().hex}")
    for part, source in ((_stored(spark, sf_dir), "stored"), (_landed(spark, sf_dir), "landed")):
        rows = with_date_partition(part.withColumn("source", F.lit(source)), "ts")
        versioned.upsert(spark, path, rows, ["user_id", "ts"], ["event_id"], ts="ts")
    return finish(versioned.read(spark, path).drop("date"))


@query
def kept_profile(spark, sf_dir):
    """Profile and history size from kept partials, after three batches in any order and one of them again."""
    path = shared_path(spark, f"partials-{uuid.uuid4().hex}")
    e = tb.user_series(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    for number, part in enumerate((2, 0, 1)):
        batch = e.filter(F.pmod(F.hash("event_id"), F.lit(3)) == part)
        for _ in range(2 if number == 1 else 1):
            kept.merge_batch(spark, path, batch, U, number)
    parts = versioned.read(spark, path)
    size = kept.history_size(parts, U, FORECAST_MIN_ROWS).select("user_id", "eligible")
    return finish(win.join_on_keys(kept.profile(parts, U), size, ["user_id"]).select("user_id", "n_rows", "first_ts", "last_ts", "eligible"))


@query
def kept_rollup(spark, sf_dir):
    """Daily rollup of a keyed table from partials that follow its two commits."""
    rows_path, path = (shared_path(spark, f"{n}-{uuid.uuid4().hex}") for n in ("versioned", "partials"))
    for part in (_stored(spark, sf_dir), _landed(spark, sf_dir)):
        versioned.upsert(spark, rows_path, with_date_partition(part, "ts"), ["user_id", "ts"], ["event_id"], ts="ts")
        kept.follow(spark, path, rows_path, U)
    return finish(kept.daily_rollup(versioned.read(spark, path), U))


@query
def dedup_keep_first(spark, sf_dir):
    e = tb.user_series(spark, sf_dir).select("user_id", F.date_trunc("hour", "ts").alias("hour_ts"),
                                             "ts", "event_id", "value")
    return finish(inc.dedup_keep_first(e, key=["user_id", "hour_ts"], order=["ts", "event_id"]))


@query
def series_profile(spark, sf_dir):
    s = split_mod.time_split(tb.user_series(spark, sf_dir), U)
    return finish(roll.profile(s, U, by=["split"]))


# ---------------------------------------------------------------- step 6: as-of reads and alerts

@query
def latest_as_of(spark, sf_dir):
    e = tb.user_series(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    return finish(asof.latest_row(e, U, _ts(AS_OF), fallback=True))


def _last(spark, sf_dir, spec):
    e = tb.user_series(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    return finish(asof.last_n(e, spec, 24, _ts(AS_OF)))


@query
def last_n(spark, sf_dir):
    return _last(spark, sf_dir, U)


@query
def last_n_cut(spark, sf_dir):
    return _last(spark, sf_dir, CUT)


@query
def recent_trend(spark, sf_dir):
    e = tb.user_series(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    return finish(asof.recent_summary(e, U, "value", 24, 6, _ts(AS_OF)).drop("last_ts"))


@query
def staleness(spark, sf_dir):
    e = tb.user_series(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    latest = asof.latest_row(e, U, _ts(AS_OF), fallback=False)
    return finish(asof.staleness(latest, "ts", _ts(AS_OF), STALE_AFTER_SECONDS)
                  .select("user_id", "ts", "age_seconds", "is_stale"))


@query
def min_history(spark, sf_dir):
    return finish(asof.history_size(tb.user_series(spark, sf_dir), U, FORECAST_MIN_ROWS, _ts(AS_OF)))


@query
def daily_rollup(spark, sf_dir):
    return finish(roll.daily_rollup(tb.user_series(spark, sf_dir), U, "value"))


@query
def hash_sample(spark, sf_dir):
    e = tb.user_series(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    return finish(asof.hash_sample(e, ["event_id"], SAMPLE_ROWS, SAMPLE_SEED))


@query
def alert_messages(spark, sf_dir):
    e = tb.user_series(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    return finish(alerts.alert_table(e, U, "value", _ts(AS_OF)))


# ---------------------------------------------------------------- step 7: split, scaling, metrics

def _split(spark, sf_dir, spec):
    s = split_mod.time_split(tb.user_series(spark, sf_dir), spec)
    return finish(s.select(*KEY, "split"))


@query
def split_80_20(spark, sf_dir):
    return _split(spark, sf_dir, U)


@query
def split_80_20_cut(spark, sf_dir):
    return _split(spark, sf_dir, CUT)


@query
def split_global(spark, sf_dir):
    """The reference's form: one time-ordered 80/20 cut over the whole table (all entities together)."""
    e = tb.user_series(spark, sf_dir).select(*KEY)
    return finish(split_mod.global_time_split(e, U))


@query
def minmax_scale(spark, sf_dir):
    s = split_mod.time_split(tb.user_series(spark, sf_dir), U)
    fit = scale.fit_minmax(s.filter(F.col("split") == "train"), ["value", "k"])
    return finish(scale.minmax_transform(s, fit).select(*KEY, "split", "value_scaled", "k_scaled"))


def _baseline_predictions(spark, sf_dir):
    """Deterministic predictors of the current value from earlier rows, plus a fitted linear one."""
    e = tb.user_series(spark, sf_dir).select(*KEY, "value")

    def st(cx):
        prev3 = cx.w.rowsBetween(-3, -1)
        return {"persistence": cx.lag("value", 1),
                "mean3": F.when(F.count("value").over(prev3) == 3, F.avg("value").over(prev3)),
                "seasonal_24": cx.lag("value", 24)}
    f = win.windowed(e, U, [st], context_rows=24, context_cols=["value"])
    s = split_mod.time_split(f, U)
    train = s.filter((F.col("split") == "train"))
    fit = train.agg(F.struct(F.regr_intercept("value", "mean3").alias("a"),
                             F.regr_slope("value", "mean3").alias("b")).alias("f")).scalar()
    scored = s.withColumn("_f", fit)
    return scored, {"persistence": F.col("persistence"), "rolling_mean_3": F.col("mean3"),
                    "seasonal_24": F.col("seasonal_24"), "linear_mean3": F.col("_f.a") + F.col("_f.b") * F.col("mean3")}


BASELINE_PRIORITY = ["linear_mean3", "rolling_mean_3", "persistence", "seasonal_24"]


@query
def regression_metrics(spark, sf_dir):
    scored, predictions = _baseline_predictions(spark, sf_dir)
    return finish(met.common_row_metrics(scored, "value", predictions))


@query
def best_model(spark, sf_dir):
    scored, predictions = _baseline_predictions(spark, sf_dir)
    return finish(met.best_model(met.common_row_metrics(scored, "value", predictions), BASELINE_PRIORITY))


IMPORTANCE_FEATURES = [*[f"value_lag_{k}" for k in TARGET_LAGS], *[f"value_rolling_mean_{n}" for n in ROLLING_MEAN_SIZES],
                       *[f"value_rolling_std_{n}" for n in ROLLING_STD_SIZES], "value_change", "k"]


@query
def top_k_importance(spark, sf_dir):
    e = tb.user_series(spark, sf_dir)

    def st(cx):
        out = {f"value_lag_{k}": cx.lag("value", k) for k in TARGET_LAGS}
        out.update({f"value_rolling_mean_{n}": cx.guarded(F.avg, "value", n) for n in ROLLING_MEAN_SIZES})
        out.update({f"value_rolling_std_{n}": cx.guarded(F.stddev_samp, "value", n) for n in ROLLING_STD_SIZES})
        out["value_change"] = F.col("value") - cx.lag("value", 1)
        return out
    f = win.windowed(e, U, [st], context_rows=24, context_cols=["value"])
    imp = met.correlation_importance(f, IMPORTANCE_FEATURES, "value")
    return finish(met.top_k(imp, 10))


# ---------------------------------------------------------------- step 8: forecasts

HORIZONS = [h for h, *_ in HORIZON_ERROR_GROWTH]


def _station_fit(spark, sf_dir):
    """The gap-filled grid (a row is an hour), and the model fitted on its past."""
    g = _station_grid(spark, sf_dir).select("city", "timestamp", "us_aqi")
    past = g.filter(F.col("timestamp") <= _ts(AS_OF))
    a, b = fc.fit_ar3(fc.ar3_training_rows(past, grid.STATION_SPEC, "us_aqi"))
    return g, a, b


def _station_forecast(spark, sf_dir):
    g, a, b = _station_fit(spark, sf_dir)
    state = fc.forecast_state(g, grid.STATION_SPEC, "us_aqi", _ts(AS_OF))
    return fc.recursive_forecast(state, ["city"], a, b)


@query
def recursive_forecast(spark, sf_dir):
    return finish(_station_forecast(spark, sf_dir))


@query
def peak_alert(spark, sf_dir):
    return finish(roll.peak_alert(_station_forecast(spark, sf_dir), ["city"], "predicted"))


@query
def backtest_by_horizon(spark, sf_dir):
    g, a, b = _station_fit(spark, sf_dir)
    return finish(fc.backtest_by_horizon(g, grid.STATION_SPEC, "us_aqi", a, b, HORIZONS, after=_ts(AS_OF)))


#: a piecewise linear rule in place of a fitted model, so that SQL can compute it: rises carry on by half, falls by a quarter
MOMENTUM = "SELECT *, mean3 + 0.5D * greatest(lag1 - mean3, 0D) - 0.25D * greatest(mean3 - lag1, 0D) AS prediction FROM __THIS__"


@query
def backtest_model(spark, sf_dir):
    """Error by horizon of the recursion of a model (anything with ``transform``) from every hour after ``AS_OF``."""
    made = fc.rolling_forecasts(_station_grid(spark, sf_dir).select("city", "timestamp", "us_aqi"), grid.STATION_SPEC, "us_aqi",
                                SQLTransformer(statement=MOMENTUM), lambda v, t: {"lag1": fc.value_back(v, 0), "mean3": fc.mean_back(v, 3)},
                                HORIZONS, keep=3, after=_ts(AS_OF))
    return finish(fc.errors_by_horizon(made))


@query
def forecast_error_table(spark, sf_dir):
    g, a, b = _station_fit(spark, sf_dir)
    bt = fc.backtest_by_horizon(g, grid.STATION_SPEC, "us_aqi", a, b, [1], after=_ts(AS_OF))
    return finish(fc.forecast_error_rows(bt.select(F.col("rmse").alias("base_rmse"))))


# ---------------------------------------------------------------- step 9: attribution

# A fixed linear model over the reduced feature set (parameters, not fitted here);
# tests feed coefficients fitted by pyspark.ml through the same functions.
DEMO_INTERCEPT = 5.0
DEMO_COEFS = {"hour": 0.2, "day_of_week": -0.5, "month": 0.1, "is_weekend": 1.5,
              "aqi_lag_1h": 0.35, "aqi_lag_6h": 0.05, "aqi_rolling_mean_3h": 0.45}


def _attribution_long(spark, sf_dir):
    """Contributions of every row; the background is the whole table too."""
    f = feat.basic_features(tb.user_series(spark, sf_dir), U, target="value")
    means = attr.background_means(f, list(DEMO_COEFS))
    return attr.linear_attribution(f, "event_id", DEMO_COEFS, DEMO_INTERCEPT, means), f


@query
def attribution_linear(spark, sf_dir):
    long, _ = _attribution_long(spark, sf_dir)
    return finish(long)


@query
def attribution_rank(spark, sf_dir):
    long, _ = _attribution_long(spark, sf_dir)
    return finish(attr.attribution_rank(long))


@query
def attribution_dependence(spark, sf_dir):
    long, _ = _attribution_long(spark, sf_dir)
    return finish(attr.dependence(long, 3).select("event_id", "feature", "feature_value", "contribution"))


@query
def pick_examples(spark, sf_dir):
    long, rows = _attribution_long(spark, sf_dir)
    keyed = rows.withColumn("sample_key", asof.sample_hash(["event_id"], SAMPLE_SEED))
    picks = attr.pick_examples(keyed, "event_id", "value")
    return finish(attr.explain_rows(long, picks, "event_id").select(
        "example", "event_id", "feature", "feature_value", "contribution", "rank"))


# Three fixed small trees (stated, not fitted here): tree, node, left, right, feature, threshold, value. Covers and gains
# come from the table. Tests do the same with fitted forests and boosted trees.
TREE_FEATURES = ["aqi_lag_1h", "aqi_rolling_mean_3h", "hour"]
DEMO_TREES = [
    (0, 0, 1, 2, "aqi_lag_1h", 100.0, None), (0, 1, 3, 4, "hour", 11.0, None), (0, 2, 5, 6, "aqi_rolling_mean_3h", 150.0, None),
    (0, 3, None, None, None, None, 40.0), (0, 4, None, None, None, None, 60.0), (0, 5, None, None, None, None, 120.0), (0, 6, None, None, None, None, 180.0),
    (1, 0, 1, 2, "hour", 17.0, None), (1, 1, None, None, None, None, 10.0), (1, 2, 3, 4, "aqi_lag_1h", 200.0, None),
    (1, 3, None, None, None, None, 20.0), (1, 4, None, None, None, None, 35.0),
    (2, 0, 1, 2, "aqi_lag_1h", 150.0, None), (2, 1, 3, 4, "aqi_lag_1h", 50.0, None), (2, 2, None, None, None, None, 9.0),
    (2, 3, None, None, None, None, 1.0), (2, 4, None, None, None, None, 5.0),
]


def _demo_trees(spark, sf_dir):
    f = feat.basic_features(tb.user_series(spark, sf_dir), U, target="value")
    nodes = spark.createDataFrame([(*n, 1.0, None, None) for n in DEMO_TREES], trees.NODE_SCHEMA)
    return f, trees.fitted_on(nodes, f, TREE_FEATURES, "value")


@query
def tree_attribution(spark, sf_dir):
    """Exact Shapley values of every row under the fixed trees, with the whole table's covers."""
    f, nodes = _demo_trees(spark, sf_dir)
    return finish(trees.tree_attribution(f, "event_id", nodes, TREE_FEATURES))


@query
def native_importance(spark, sf_dir):
    """Native (gain times cover) importances of the fixed trees over the whole table, ranked with a bar."""
    _, nodes = _demo_trees(spark, sf_dir)
    return finish(met.top_k(trees.native_importance(nodes, TREE_FEATURES), 10))


# ---------------------------------------------------------------- a second source: orders by nation

@query
def order_series_features(spark, sf_dir):
    """Daily revenue per nation (orders joined to customer and nation), gap-filled, with lag/rolling/change."""
    o = tb.order_series(spark, sf_dir)
    daily = o.groupBy("nation", F.date_trunc("day", "ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("value").alias("revenue"))
    spec = tb.SeriesSpec(entity=("nation",), ts="day")  # a grid has one row per slot: no hot series
    g = grid.regular_grid(daily, spec, 86400, fill={"n_orders": 0, "revenue": 0.0})
    st = [lambda cx: {"revenue_lag_1": cx.lag("revenue", 1), "revenue_lag_7": cx.lag("revenue", 7),
                      "revenue_rolling_mean_7": cx.guarded(F.avg, "revenue", 7),
                      "revenue_change": F.col("revenue") - cx.lag("revenue", 1)}]
    return finish(win.windowed(g, spec, st, context_rows=7, context_cols=["revenue"]))
