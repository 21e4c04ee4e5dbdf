"""Calendar features (hour, weekday Monday=0, month, day of year, flags, season)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from aerostat.schemas import RUSH_HOURS, SEASON_OF_MONTH, WEEKEND_FROM_DOW


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int; a NULL predicate counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def calendar_columns(ts: str) -> dict[str, Column]:
    """The seven calendar columns of the timestamp column named ``ts``.

    Written as SQL expression text: one JVM call per column instead of one per operator.
    """
    t = f"`{ts}`"
    rush = " OR ".join(f"hour({t}) BETWEEN {lo} AND {hi}" for lo, hi in RUSH_HOURS)
    season = " ".join(f"WHEN {m} THEN {s}" for m, s in sorted(SEASON_OF_MONTH.items()))
    return {
        "hour": F.expr(f"CAST(hour({t}) AS INT)"),
        "day_of_week": F.expr(f"CAST(weekday({t}) AS INT)"),  # Monday=0 ... Sunday=6
        "month": F.expr(f"CAST(month({t}) AS INT)"),
        "day_of_year": F.expr(f"CAST(dayofyear({t}) AS INT)"),
        "is_weekend": F.expr(f"CAST(coalesce(weekday({t}) >= {WEEKEND_FROM_DOW}, false) AS INT)"),
        "is_rush_hour": F.expr(f"CAST(coalesce({rush}, false) AS INT)"),
        "season": F.expr(f"CAST(CASE month({t}) {season} ELSE 0 END AS INT)"),
    }
