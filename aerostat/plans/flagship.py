"""The flagship query: the minimum end-to-end slice of the feature pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerostat.functions.calendar import calendar_columns
from aerostat.operators import windows as win
from aerostat.operators.rollups import daily_rollup
from aerostat.plans.output import finish
from aerostat.sources import tables as tb


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events -> per-user lag 1/3/6, guarded rolling mean 3/6, change, calendar -> drop NULL rows -> daily rollup."""
    spec = tb.USER_SPEC
    e = tb.user_series(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    stages = [
        lambda cx: {"lag_1": cx.lag("value", 1), "lag_3": cx.lag("value", 3), "lag_6": cx.lag("value", 6),
                    "rolling_mean_3": cx.guarded(F.avg, "value", 3), "rolling_mean_6": cx.guarded(F.avg, "value", 6),
                    "change": F.col("value") - cx.lag("value", 1)},
    ]
    f = win.windowed(e, spec, stages, context_rows=6, context_cols=["value"])
    cal = calendar_columns("ts")
    f = f.withColumns({k: cal[k] for k in ("hour", "day_of_week", "is_weekend", "is_rush_hour")}).na.drop("any")
    return finish(daily_rollup(f, spec, "value"))
