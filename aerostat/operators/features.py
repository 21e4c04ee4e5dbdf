"""The feature pipeline (calendar, lag, rolling, change, ratio, bins) in one window pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from aerostat.functions.calendar import calendar_columns
from aerostat.functions.scalar import interaction_columns, weather_flag_columns
from aerostat.operators.grid import present_columns
from aerostat.operators.windows import WindowContext, change_stages, forward_fill, windowed
from aerostat.schemas import (CONTEXT_ROWS, FEATURE_COLS, NON_FEATURE_COLS, PM25_LAGS, RAW_INPUTS,
                              ROLLING_MEAN_SIZES, ROLLING_MINMAX_SIZE, ROLLING_STD_SIZES, SeriesSpec, TARGET_LAGS)

BASIC_FEATURES = ["hour", "day_of_week", "month", "is_weekend", "aqi_lag_1h", "aqi_lag_6h", "aqi_rolling_mean_3h"]


def _window_stage(target: str, pm25: str | None, subset: set[str] | None):
    def st(cx: WindowContext):
        out = {}
        for k in TARGET_LAGS:
            out[f"aqi_lag_{k}h"] = cx.lag(target, k)
        if pm25:
            for k in PM25_LAGS:
                out[f"pm25_lag_{k}h"] = cx.lag(pm25, k)
        for n in ROLLING_MEAN_SIZES:
            out[f"aqi_rolling_mean_{n}h"] = cx.guarded(F.avg, target, n)
        for n in ROLLING_STD_SIZES:
            out[f"aqi_rolling_std_{n}h"] = cx.guarded(F.stddev_samp, target, n)
        out[f"aqi_rolling_max_{ROLLING_MINMAX_SIZE}h"] = cx.guarded(F.max, target, ROLLING_MINMAX_SIZE)
        out[f"aqi_rolling_min_{ROLLING_MINMAX_SIZE}h"] = cx.guarded(F.min, target, ROLLING_MINMAX_SIZE)
        if subset is not None:
            out = {k: v for k, v in out.items() if k in subset}
        return out
    return st


def engineer(df: DataFrame, spec: SeriesSpec, target: str | None = None, pm25: str | None = "pm2_5",
             subset: Sequence[str] | None = None, mode: str = "training", raw: bool = True) -> DataFrame:
    """Add the derived features to a keyed series.

    ``mode="training"`` drops rows with any NULL (the row count is the caller's
    to observe); ``mode="serving"`` forward-fills every column within its series
    and zero-fills what is left (the serving path recomputes features on the
    latest rows). ``subset`` limits the derived columns (the reduced pipeline).
    ``raw`` adds the ratio/interaction/bin columns that need the weather inputs.
    """
    target = target or spec.target
    sub = set(subset) if subset is not None else None
    if raw and sub is None:
        df = present_columns(df, RAW_INPUTS, 0.0)

    want_change = sub is None or {"aqi_change", "aqi_change_rate"} & sub
    stages = [_window_stage(target, pm25 if (sub is None or {"pm25_lag_6h", "pm25_lag_24h"} & sub) else None, sub)]
    if want_change:
        ch = change_stages(target, "aqi_change", "aqi_change_rate")
        first = stages[0]
        stages = [lambda cx: {**first(cx), **ch[0](cx)}, ch[1]]
    out = windowed(df, spec, stages, context_rows=CONTEXT_ROWS,
                   context_cols=[c for c in (target, pm25) if c and c in df.columns],
                   ffill_cols=[target] if want_change else [])
    if want_change:
        out = out.drop("_pad_cur", "_pad_prev")

    rowwise = dict(calendar_columns(spec.ts))
    if raw and sub is None:
        rowwise.update(interaction_columns())
        rowwise.update(weather_flag_columns())
    if sub is not None:
        rowwise = {k: v for k, v in rowwise.items() if k in sub}
    out = out.withColumns(rowwise)

    if mode == "training":
        out = out.na.drop("any")
    elif mode == "serving":
        fill_cols = [c for c in out.columns if c not in (*spec.entity, *spec.order_cols)]
        out = serving_fill(out, spec, fill_cols)
    return out


def serving_fill(df: DataFrame, spec: SeriesSpec, cols: Sequence[str]) -> DataFrame:
    """Forward fill all ``cols`` within each series, then zero-fill the leading gaps."""
    return forward_fill(df, spec, cols, zero_fill=True)


def basic_features(df: DataFrame, spec: SeriesSpec, target: str | None = None) -> DataFrame:
    """The reduced seven-feature pipeline, rows with NULLs dropped."""
    return engineer(df, spec, target=target, pm25=None, subset=BASIC_FEATURES, raw=False)


def input_columns(df: DataFrame, exclude: Sequence[str] = NON_FEATURE_COLS) -> list[str]:
    """Model inputs as "every column not excluded" (exclude-list projection), in table order."""
    return [c for c in df.columns if c not in set(exclude)]


def model_frame(df: DataFrame, keep: Sequence[str] = ("city", "timestamp", "us_aqi"),
                features: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """Key/label columns plus the 43 inputs in the declared serving order (include-list projection).

    Only the listed columns that exist are taken; models assemble them by name.
    """
    return df.select(*[c for c in keep if c in df.columns], *[c for c in features if c in df.columns])


def drop_incomplete(df: DataFrame, name: str = "dropna") -> tuple[DataFrame, Observation]:
    """Drop rows with any NULL and observe how many went in and came out.

    The counts are collected as a side effect of whatever action runs next
    (``Observation.get``), with no extra pass over the data.
    """
    obs = Observation(name)
    before = df.observe(obs, F.count(F.lit(1)).alias("rows_in"),
                        F.sum(F.when(F.greatest(*[F.col(f"`{c}`").isNull() for c in df.columns]), 1)
                              .otherwise(0)).alias("rows_dropped"))
    return before.na.drop("any"), obs
