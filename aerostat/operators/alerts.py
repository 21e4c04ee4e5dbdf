"""Alert table: latest value as of a time, alert level, recent mean and trend, message text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from aerostat.functions.scalar import alert_level, fmt
from aerostat.operators.asof import recent_summary
from aerostat.schemas import SeriesSpec


def alert_table(df: DataFrame, spec: SeriesSpec, col: str, as_of: Column, inclusive: bool = True,
                recent_rows: int = 24, trend_back: int = 6) -> DataFrame:
    """One row per entity whose latest value (at or before ``as_of``) reaches an alert level.

    Alerts are keyed by (entity, ts, level): re-running for the same hour gives the same rows.
    """
    j = recent_summary(df.select(*spec.entity, *spec.order_cols, col), spec, col, recent_rows, trend_back, as_of)
    j = j.select(*spec.entity, F.col("last_ts").alias(spec.ts), F.col("last_value").alias(col), "recent_avg", "trend")
    lvl = alert_level(F.col(col), inclusive=inclusive)
    j = j.withColumn("level", lvl).filter(F.col("level") != "none")
    msg = F.concat(
        F.lit("["), F.upper("level"), F.lit("] "), F.concat_ws("/", *[F.col(c).cast("string") for c in spec.entity]),
        F.lit(": value "), fmt(F.col(col), 0), F.lit(" at "), F.date_format(spec.ts, "yyyy-MM-dd HH:mm"),
        F.lit("; recent mean "), F.coalesce(fmt(F.col("recent_avg"), 0), F.lit("n/a")),
        F.lit(" ("), F.coalesce(F.col("trend"), F.lit("trend unknown")), F.lit(")"))
    return j.select(*spec.entity, spec.ts, "level", F.col(col).alias("value"), "recent_avg", "trend",
                    msg.alias("message"))
