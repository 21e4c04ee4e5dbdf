"""Hourly series: tumbling hourly aggregation, the two-source join and the gap-filled grid.

Station binding of the events table (hourly grain). Each event type is a
station (``city``); its hourly aggregates stand in for the pollutant and index
readings. City-wide hourly aggregates over all events stand in for the weather
readings, which (as in the reference) are joined to every station on the hour.
The mapping is fixed below and mirrored by the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from aerostat.schemas import RAW_MEASURES, SeriesSpec

GAP_CHUNK = 4096  # slots of a gap that one generated array holds
STATION_SPEC = SeriesSpec(entity=("city",), ts="timestamp", order=(), target="us_aqi", bucket=None)


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def hourly_partials(events: DataFrame) -> DataFrame:
    """One pass over the events: mergeable sums, counts and extremes per (station, hour).

    Both hourly sources are derived from this table, so the events are scanned
    and parsed once; the city-wide side is a roll-up of these partials.
    """
    v, k = F.col("value"), F.col("k")
    return (events.groupBy(F.col("event_type").alias("city"), hour_of(F.col("ts")).alias("timestamp"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(v).alias("sum_v"), F.count(v).alias("n_v"),
                 F.min(v).alias("min_v"), F.max(v).alias("max_v"), F.sum(k).alias("sum_k"), F.count(k).alias("n_k"),
                 F.min(k).alias("min_k"), F.max(k).alias("max_k")))


def _mean(s: str, n: str) -> Column:
    return F.try_divide(F.col(s), F.col(n).cast("double"))


def _air_columns() -> dict[str, Column]:
    """Pollutant and index readings from one station's hourly partials."""
    return {
        "pm10": F.col("max_k"), "pm2_5": _mean("sum_k", "n_k"), "carbon_monoxide": F.col("min_v"),
        "nitrogen_dioxide": F.col("sum_v"), "ozone": F.col("min_k"), "sulphur_dioxide": F.col("n").cast("double"),
        "us_aqi": _mean("sum_v", "n_v"), "european_aqi": F.col("max_v"),
    }


def _weather_columns(p: str = "") -> dict[str, Column]:
    """City-wide readings from partials rolled up over all stations (columns prefixed ``p``)."""
    return {
        "temperature": _mean(p + "sum_v", p + "n_v") / F.lit(10.0), "humidity": F.col(p + "max_k"),
        "wind_speed": _mean(p + "sum_k", p + "n_k") / F.lit(10.0),
        "pressure": F.lit(1000.0) + _mean(p + "sum_k", p + "n_k") / F.lit(2.0),
        "precipitation": F.col(p + "min_v"), "cloudcover": F.col(p + "n").cast("double"),
    }


_ROLLUP = {"n": F.sum, "sum_v": F.sum, "n_v": F.sum, "min_v": F.min, "sum_k": F.sum, "n_k": F.sum, "max_k": F.max}


def hourly_air(partials: DataFrame) -> DataFrame:
    """Pollutant and index readings per station and hour."""
    return partials.select("city", "timestamp", *[c.alias(n) for n, c in _air_columns().items()])


def hourly_weather(partials: DataFrame) -> DataFrame:
    """City-wide readings per hour, rolled up from the station partials (a small second aggregation)."""
    h = partials.groupBy("timestamp").agg(*[fn(c).alias(c) for c, fn in _ROLLUP.items()])
    return h.select("timestamp", *[c.alias(n) for n, c in _weather_columns().items()])


def join_sources(air: DataFrame, weather: DataFrame) -> DataFrame:
    """Inner equi-join of the two hourly sources on the hour; keys are non-null by construction.

    The weather side has one row per hour; AQE turns the join into a broadcast
    join once that side's real size is known to be small.
    """
    j = air.join(weather, on="timestamp", how="inner")
    return j.select("city", "timestamp", *RAW_MEASURES)


def station_series(events: DataFrame) -> DataFrame:
    """Station readings with the city-wide readings of the same hour.

    Same rows as ``join_sources(hourly_air(p), hourly_weather(p))``, but the
    roll-up is a window over the hour on the partials: the events are scanned
    and aggregated once, and no join is needed (every station hour has its city hour).
    """
    p = hourly_partials(events)
    w = Window.partitionBy("timestamp")
    rolled = p.withColumns({"_w_" + c: fn(c).over(w) for c, fn in _ROLLUP.items()})
    cols = {**_air_columns(), **_weather_columns("_w_")}
    return rolled.select("city", "timestamp", *[cols[c].alias(c) for c in RAW_MEASURES])


def regular_grid(df: DataFrame, spec: SeriesSpec, step_seconds: int = 3600,
                 fill: dict[str, object] | None = None) -> DataFrame:
    """Regular grid per entity from its first to its last slot (times aligned to the step).

    Each row emits itself plus the empty slots up to the next row of its entity
    (``lead`` in one window, then ``explode(sequence(...))``): no span aggregate
    and no join. Empty slots get NULL measures (or ``fill`` values), so a lag of
    k rows is a lag of k slots. Output per entity is bounded by its time span; a very long gap
    (one bad far-off time) is filled in chunks, so no array grows with it. A row without a time has
    no slot: it is kept as it is, once, and opens or closes no gap.
    """
    ts = spec.ts

    def slots(n: int):
        return F.expr(f"INTERVAL {step_seconds * n} SECONDS")
    w = Window.partitionBy(*spec.entity).orderBy(F.col(ts).asc_nulls_last())
    last_slot = F.greatest(F.col(ts), F.coalesce(F.lead(ts).over(w) - slots(1), F.col(ts)))
    values = [c for c in df.columns if c not in (*spec.entity, ts)]
    ex = (df.withColumns({"_first": F.col(ts), "_last": last_slot})
          .withColumn("_from", F.explode_outer(F.sequence("_first", "_last", slots(GAP_CHUNK))))
          .withColumn(ts, F.explode_outer(F.sequence("_from", F.least(F.col("_last"), F.col("_from") + slots(GAP_CHUNK - 1)), slots(1)))))
    out = ex.select(*spec.entity, ts, *[F.when(F.col(ts).eqNullSafe(F.col("_first")), F.col(c)).alias(c) for c in values])
    if fill:
        out = out.fillna(fill)
    return out


def hourly_grid(df: DataFrame, spec: SeriesSpec, fill: dict[str, object] | None = None) -> DataFrame:
    return regular_grid(df, spec, 3600, fill)


def event_counts_grid(events: DataFrame) -> DataFrame:
    """Per event type and hour: event count (0 in gaps) and mean value (NULL in gaps)."""
    hourly = (events.groupBy("event_type", hour_of(F.col("ts")).alias("hour_ts"))
              .agg(F.count(F.lit(1)).alias("n_events"), F.avg("value").alias("avg_value")))
    spec = SeriesSpec(entity=("event_type",), ts="hour_ts")
    return hourly_grid(hourly, spec, fill={"n_events": 0})


def present_columns(df: DataFrame, cols: Sequence[str], default: float = 0.0) -> DataFrame:
    """Add any of ``cols`` that the frame lacks, as a constant."""
    missing = {c: F.lit(default).cast("double") for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df
