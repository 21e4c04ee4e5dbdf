"""Declared schemas, the series key description and fixed values."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class SeriesSpec:
    """How a DataFrame is read as a set of ordered series.

    ``entity``  columns that identify one series (a city, a sensor, a user).
    ``ts``      event-time column (TIMESTAMP, UTC session).
    ``order``   tie-break column(s) after ``ts`` so row order is total.
    ``target``  the measured value most operators work on.
    ``bucket``  optional time bucket ("1 day", "1 hour"): windows are then
                partitioned by (entity, bucket) with the preceding rows carried
                in as context, so one huge series is split over many tasks.
    ``hot_rows`` with a bucket: only entities that hold at least this many rows are
                split, at about every ``hot_rows``-th row; the others stay whole. 0
                splits every entity into time buckets. The answer is exact either way.
    """

    entity: tuple[str, ...]
    ts: str = "ts"
    order: tuple[str, ...] = ()
    target: str = "value"
    bucket: str | None = None
    hot_rows: int = 0

    @property
    def order_cols(self) -> list[str]:
        return [self.ts, *self.order]

    @property
    def key_cols(self) -> list[str]:
        return [*self.entity, *self.order_cols]

    def with_(self, **kw) -> "SeriesSpec":
        return replace(self, **kw)


# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference application's constants for the
# results to agree; they are stated here as plain data, in natural order.
# ---------------------------------------------------------------------------

# Raw measurement columns of the hourly series (pollutants, then weather).
POLLUTANT_COLS = ["pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "ozone", "sulphur_dioxide"]
INDEX_COLS = ["us_aqi", "european_aqi"]
WEATHER_COLS = ["temperature", "humidity", "wind_speed", "pressure", "precipitation", "cloudcover"]
RAW_MEASURES = POLLUTANT_COLS + INDEX_COLS + WEATHER_COLS
RAW_INPUTS = POLLUTANT_COLS + WEATHER_COLS  # the 12 raw model inputs

# Weather payload names and the names they are renamed to.
WEATHER_RENAMES = {
    "temperature_2m": "temperature",
    "relative_humidity_2m": "humidity",
    "wind_speed_10m": "wind_speed",
    "pressure_msl": "pressure",
    "precipitation": "precipitation",
    "cloudcover": "cloudcover",
}

# Lags (in rows of a regular hourly series) and rolling window sizes.
TARGET_LAGS = [1, 3, 6, 12, 24]
PM25_LAGS = [6, 24]
ROLLING_MEAN_SIZES = [3, 6, 12, 24]
ROLLING_STD_SIZES = [6, 24]
ROLLING_MINMAX_SIZE = 6
CONTEXT_ROWS = 24  # longest lookback of any feature

# Season by month: Dec-Feb 0, Mar-May 1, Jun-Aug 2, Sep-Nov 3.
SEASON_OF_MONTH = {12: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: 2, 7: 2, 8: 2, 9: 3, 10: 3, 11: 3}
RUSH_HOURS = [(7, 9), (17, 19)]  # inclusive ranges
WEEKEND_FROM_DOW = 5  # Monday=0 ... Sunday=6

# Wind bins, right-closed: (0,2]->0, (2,5]->1, (5,10]->2, (10,100]->3.
WIND_EDGES = [0.0, 2.0, 5.0, 10.0, 100.0]
RAIN_THRESHOLD = 0.1      # precipitation > 0.1
HIGH_PRESSURE = 1015.0    # pressure > 1015
RATIO_EPSILON = 0.01      # pm2_5 / (pm10 + 0.01)

# Status bands: upper bound (inclusive), label, colour; above the last bound is Hazardous.
STATUS_BANDS = [
    (50.0, "Good", "#00e400"),
    (100.0, "Moderate", "#ffff00"),
    (150.0, "Unhealthy for Sensitive", "#ff7e00"),
    (200.0, "Unhealthy", "#ff0000"),
    (300.0, "Very Unhealthy", "#8f3f97"),
]
STATUS_TOP = ("Hazardous", "#7e0023")

# Alert thresholds.
HAZARDOUS_THRESHOLD = 150.0
UNHEALTHY_THRESHOLD = 100.0

# Assumed RMSE growth by forecast horizon (hours -> multiplier, label, reliability).
HORIZON_ERROR_GROWTH = [
    (1, 1.0, "1 hour", "Excellent"),
    (6, 1.4, "6 hours", "Very Good"),
    (24, 3.0, "24 hours (Day 1)", "Good"),
    (48, 4.8, "48 hours (Day 2)", "Fair"),
    (72, 6.3, "72 hours (Day 3)", "Moderate"),
]
DEFAULT_BASE_RMSE = 0.87

FORECAST_HOURS = 72
FORECAST_HISTORY_ROWS = 200
FORECAST_MIN_ROWS = 100
STALE_AFTER_SECONDS = 6 * 3600
TRAIN_FRACTION = 0.8
LOOKBACK = 24
SAMPLE_ROWS = 500
SAMPLE_SEED = 42

# Model hyper-parameters of the reference's estimators.
RF_PARAMS = dict(numTrees=100, maxDepth=15, minInstancesPerNode=2, seed=42)
GBT_PARAMS = dict(maxIter=100, maxDepth=6, stepSize=0.1, subsamplingRate=0.8, seed=42)

# The 43 model inputs, in the serving order.
FEATURE_COLS = [
    "hour", "day_of_week", "month", "day_of_year", "is_weekend", "is_rush_hour", "season",
    "aqi_lag_1h", "aqi_lag_3h", "aqi_lag_6h", "aqi_lag_12h", "aqi_lag_24h",
    "aqi_rolling_mean_3h", "aqi_rolling_mean_6h", "aqi_rolling_mean_12h", "aqi_rolling_mean_24h",
    "aqi_rolling_std_6h", "aqi_rolling_std_24h", "aqi_rolling_max_6h", "aqi_rolling_min_6h",
    "aqi_change", "aqi_change_rate",
    "pm25_pm10_ratio", "temp_humidity", "wind_pressure",
    "pm25_lag_6h", "pm25_lag_24h",
    "temp_squared", "is_raining", "high_pressure",
    "pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "ozone", "sulphur_dioxide",
    "temperature", "humidity", "wind_speed", "wind_category", "pressure", "precipitation", "cloudcover",
]
# Columns never used as model inputs.
NON_FEATURE_COLS = ["timestamp", "city", "us_aqi", "european_aqi"]
# Model preference on equal RMSE (first wins).
MODEL_PRIORITY = ["lstm", "xgboost", "random_forest"]

# ---------------------------------------------------------------------------
# Declared table schemas.
# ---------------------------------------------------------------------------

AIR_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in POLLUTANT_COLS + INDEX_COLS])),
])

WEATHER_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in WEATHER_RENAMES])),
])

INTERVAL_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("start_epoch", T.LongType()),
    T.StructField("interval_seconds", T.IntegerType()),
    T.StructField("names", T.ArrayType(T.StringType())),
    T.StructField("values", T.ArrayType(T.ArrayType(T.DoubleType()))),
])

RAW_SERIES_SCHEMA = T.StructType(
    [T.StructField("city", T.StringType(), False), T.StructField("timestamp", T.TimestampType(), False)]
    + [T.StructField(c, T.DoubleType()) for c in RAW_MEASURES])

MODEL_METRICS_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("snapshot", T.StringType()),
])
