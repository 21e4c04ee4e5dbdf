"""Aggregations over series: daily rollup, profile, peak alert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from aerostat.functions.scalar import alert_level
from aerostat.schemas import SeriesSpec


def daily_rollup(df: DataFrame, spec: SeriesSpec, col: str | None = None, decimals: int = 0) -> DataFrame:
    """Mean / max / min per entity and calendar day, rounded half-to-even (``bround``)."""
    c = F.col(col or spec.target)
    return (df.groupBy(*spec.entity, F.to_date(spec.ts).alias("date"))
            .agg(F.bround(F.avg(c), decimals).alias("avg_value"), F.bround(F.max(c), decimals).alias("max_value"),
                 F.bround(F.min(c), decimals).alias("min_value")))


def profile(df: DataFrame, spec: SeriesSpec, by: Sequence[str | Column] = ()) -> DataFrame:
    """Row count, first and last timestamp, per entity (and any extra grouping such as the split)."""
    return (df.groupBy(*spec.entity, *by)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(spec.ts).alias("first_ts"), F.max(spec.ts).alias("last_ts")))


def peak_alert(forecast: DataFrame, entity: Sequence[str], value: str = "predicted", inclusive: bool = False) -> DataFrame:
    """Peak of a forecast per entity and its alert class (the dashboard uses strict > thresholds)."""
    peak = forecast.groupBy(*entity).agg(F.max(value).alias("peak"))
    return peak.withColumn("alert", alert_level(F.col("peak"), inclusive=inclusive))
