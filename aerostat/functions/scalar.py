"""Row-level expressions: ratios, bins, flags, status bands, alert levels, formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from aerostat.functions.calendar import flag
from aerostat.schemas import (HAZARDOUS_THRESHOLD, HIGH_PRESSURE, RAIN_THRESHOLD, RATIO_EPSILON,
                              STATUS_BANDS, STATUS_TOP, UNHEALTHY_THRESHOLD, WIND_EDGES)


def safe_ratio(num: Column, den: Column, eps: float = RATIO_EPSILON) -> Column:
    """num / (den + eps); NULL instead of an error or infinity on a zero base."""
    return F.try_divide(num, den + F.lit(eps))


def right_closed_bin(x: Column, edges: list[float] = WIND_EDGES) -> Column:
    """Bin index for right-closed intervals (e0,e1], (e1,e2], ...; NULL outside.

    ``Bucketizer`` is left-closed, so the CASE is written out.
    """
    expr = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.cast("int")


def interaction_columns(pm2_5="pm2_5", pm10="pm10", temperature="temperature",
                        humidity="humidity", wind_speed="wind_speed", pressure="pressure") -> dict[str, Column]:
    return {
        "pm25_pm10_ratio": safe_ratio(F.col(pm2_5), F.col(pm10)),
        "temp_humidity": F.col(temperature) * F.col(humidity),
        "wind_pressure": F.col(wind_speed) * F.col(pressure),
        "temp_squared": F.col(temperature) * F.col(temperature),
    }


def weather_flag_columns(wind_speed="wind_speed", precipitation="precipitation",
                         pressure="pressure") -> dict[str, Column]:
    return {
        "wind_category": right_closed_bin(F.col(wind_speed)),
        "is_raining": flag(F.col(precipitation) > F.lit(RAIN_THRESHOLD)),
        "high_pressure": flag(F.col(pressure) > F.lit(HIGH_PRESSURE)),
    }


def status_band(x: Column) -> Column:
    """struct(label, color) of the status band a value falls in (upper bounds inclusive)."""
    label = color = None
    for hi, lab, col in STATUS_BANDS:
        c = x <= F.lit(hi)
        label = F.when(c, F.lit(lab)) if label is None else label.when(c, F.lit(lab))
        color = F.when(c, F.lit(col)) if color is None else color.when(c, F.lit(col))
    label = label.when(x.isNotNull(), F.lit(STATUS_TOP[0]))
    color = color.when(x.isNotNull(), F.lit(STATUS_TOP[1]))
    return F.struct(label.alias("label"), color.alias("color"))


def alert_level(x: Column, inclusive: bool = True,
                hazardous: float = HAZARDOUS_THRESHOLD, unhealthy: float = UNHEALTHY_THRESHOLD) -> Column:
    """'hazardous' / 'unhealthy' / 'none'. ``inclusive`` uses >= (alert job), else > (dashboard)."""
    if inclusive:
        hz, uh = x >= F.lit(hazardous), x >= F.lit(unhealthy)
    else:
        hz, uh = x > F.lit(hazardous), x > F.lit(unhealthy)
    return F.when(hz, F.lit("hazardous")).when(uh, F.lit("unhealthy")).when(x.isNotNull(), F.lit("none"))


def is_stale(ts: Column, as_of: Column, max_age_seconds: int) -> Column:
    """More than ``max_age_seconds`` old, to the microsecond."""
    return (F.unix_micros(as_of) - F.unix_micros(ts)) > F.lit(max_age_seconds * 1_000_000)


def age_seconds(ts: Column, as_of: Column) -> Column:
    return (F.unix_timestamp(as_of) - F.unix_timestamp(ts)).cast("long")


def text_bar(x: Column, scale: int = 50, glyph: str = "#") -> Column:
    """A glyph repeated int(x*scale) times (text importance bar)."""
    n = F.floor(x * F.lit(scale)).cast("int")
    return F.repeat(F.lit(glyph), F.greatest(n, F.lit(0)))


def fmt(x: Column, decimals: int = 2) -> Column:
    """Fixed-point text, rounded half-up through DECIMAL so every engine prints the same digits."""
    return F.format_string(f"%.{decimals}f", F.round(x.cast("decimal(38,12)"), decimals).cast("double"))


def cast_by_class(df: DataFrame, float_to: str = "double", long_to: str = "int") -> DataFrame:
    """Widen every float column and narrow every bigint column (try_cast: NULL on overflow)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.FloatType):
            c = c.try_cast(float_to)
        elif isinstance(f.dataType, T.LongType):
            c = c.try_cast(long_to)
        out.append(c.alias(f.name))
    return df.select(*out)


def cast_overflows(df: DataFrame, long_to: str = "int") -> DataFrame:
    """One row: per bigint column, how many values the narrowing of :func:`cast_by_class` turns into NULL."""
    longs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.LongType)]
    return df.agg(*[F.count(F.when(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(long_to).isNull(), 1)).alias(c) for c in longs])


def with_constant_first(df: DataFrame, name: str, value) -> DataFrame:
    """Insert a constant column in front (e.g. the city of a single-source feed)."""
    return df.select(F.lit(value).alias(name), *[F.col(f"`{c}`") for c in df.columns])


def to_utc(ts: Column, source_tz: str | None = None) -> Column:
    """Wall-clock time in ``source_tz`` -> UTC instant (naive values); None: already UTC."""
    return ts if source_tz is None else F.to_utc_timestamp(ts, source_tz)


def parse_time(text: Column) -> Column:
    """ISO text such as ``2025-01-01T00:00`` -> TIMESTAMP (NULL when unparseable)."""
    return F.try_to_timestamp(text)


def version_label(ts: Column) -> Column:
    """Date version number yyyyMMdd as an int (snapshot and model versions)."""
    return F.date_format(ts, "yyyyMMdd").cast("int")
