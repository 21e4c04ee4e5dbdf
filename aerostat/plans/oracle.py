"""DuckDB SQL stating each registered query's semantics independently of the Spark code.

Views ``events``, ``orders``, ``customer``, ``nation``, ... are pre-registered
over the same parquet files. Doubles are rounded to 6 decimals and every
computed column is aliased to the Spark column name.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def r6(x: str) -> str:
    """Round half-up to 6 decimals through DECIMAL, as the Spark side does."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), 6) AS DOUBLE)"

EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events)"""

STATION = EV + """,
air AS (
  SELECT event_type AS city, date_trunc('hour', ts) AS timestamp,
         max(k) AS pm10, avg(k) AS pm2_5, min(value) AS carbon_monoxide, sum(value) AS nitrogen_dioxide,
         min(k) AS ozone, CAST(count(*) AS DOUBLE) AS sulphur_dioxide,
         avg(value) AS us_aqi, max(value) AS european_aqi
  FROM ev GROUP BY 1, 2),
wx AS (
  SELECT date_trunc('hour', ts) AS timestamp,
         avg(value) / 10.0 AS temperature, max(k) AS humidity, avg(k) / 10.0 AS wind_speed,
         1000.0 + avg(k) / 2.0 AS pressure, min(value) AS precipitation, CAST(count(*) AS DOUBLE) AS cloudcover
  FROM ev GROUP BY 1),
st AS (
  SELECT air.city, air.timestamp, pm10, pm2_5, carbon_monoxide, nitrogen_dioxide, ozone, sulphur_dioxide,
         us_aqi, european_aqi, temperature, humidity, wind_speed, pressure, precipitation, cloudcover
  FROM air JOIN wx ON air.timestamp = wx.timestamp)"""

STATION_GRID = STATION + """,
span AS (SELECT city, min(timestamp) AS lo, max(timestamp) AS hi FROM st GROUP BY city),
slots AS (SELECT city, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS timestamp FROM span),
sg AS (
  SELECT s.city, s.timestamp, st.pm10, st.pm2_5, st.carbon_monoxide, st.nitrogen_dioxide, st.ozone,
         st.sulphur_dioxide, st.us_aqi, st.european_aqi, st.temperature, st.humidity, st.wind_speed,
         st.pressure, st.precipitation, st.cloudcover
  FROM slots s LEFT JOIN st ON st.city = s.city AND st.timestamp = s.timestamp)"""

TYPE_GRID = """h AS (
  SELECT event_type, date_trunc('hour', ts) AS hour_ts, count(*) AS n_events, avg(value) AS avg_value
  FROM events GROUP BY 1, 2),
span AS (SELECT event_type, min(hour_ts) AS lo, max(hour_ts) AS hi FROM h GROUP BY 1),
slots AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_ts FROM span),
tg AS (
  SELECT s.event_type, s.hour_ts, coalesce(h.n_events, 0) AS n_events, h.avg_value
  FROM slots s LEFT JOIN h ON h.event_type = s.event_type AND h.hour_ts = s.hour_ts)"""


def _cal(ts: str) -> str:
    return f"""CAST(hour({ts}) AS INTEGER) AS hour,
  CAST(isodow({ts}) - 1 AS INTEGER) AS day_of_week,
  CAST(month({ts}) AS INTEGER) AS month,
  CAST(dayofyear({ts}) AS INTEGER) AS day_of_year,
  CAST(isodow({ts}) IN (6, 7) AS INTEGER) AS is_weekend,
  CAST(hour({ts}) BETWEEN 7 AND 9 OR hour({ts}) BETWEEN 17 AND 19 AS INTEGER) AS is_rush_hour,
  CAST(CASE WHEN month({ts}) IN (12, 1, 2) THEN 0 WHEN month({ts}) IN (3, 4, 5) THEN 1
            WHEN month({ts}) IN (6, 7, 8) THEN 2 ELSE 3 END AS INTEGER) AS season"""


def _guard(fn: str, col: str, n: int, part: str, order: str) -> str:
    frame = f"(PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({col}) OVER {frame} = {n} THEN {fn}({col}) OVER {frame} END"


UW = "PARTITION BY user_id ORDER BY ts, event_id"

ORACLE["calendar_features"] = f"SELECT user_id, ts, event_id, {_cal('ts')} FROM events"

ORACLE["interaction_features"] = f"""WITH {STATION}
SELECT city, timestamp,
  {r6('pm2_5 / (pm10 + 0.01)')} AS pm25_pm10_ratio,
  {r6('temperature * humidity')} AS temp_humidity,
  {r6('wind_speed * pressure')} AS wind_pressure,
  {r6('temperature * temperature')} AS temp_squared
FROM st"""

WIND_CASE = """CAST(CASE WHEN wind_speed > 0 AND wind_speed <= 2 THEN 0
            WHEN wind_speed > 2 AND wind_speed <= 5 THEN 1
            WHEN wind_speed > 5 AND wind_speed <= 10 THEN 2
            WHEN wind_speed > 10 AND wind_speed <= 100 THEN 3 END AS INTEGER)"""

ORACLE["bucketize"] = f"""WITH {STATION}
SELECT city, timestamp, {r6('wind_speed')} AS wind_speed, {WIND_CASE} AS wind_category FROM st"""

ORACLE["threshold_flags"] = f"""WITH {STATION}
SELECT city, timestamp,
  CAST(coalesce(precipitation > 0.1, false) AS INTEGER) AS is_raining,
  CAST(coalesce(pressure > 1015, false) AS INTEGER) AS high_pressure
FROM st"""

ORACLE["cast_by_class"] = f"""SELECT TRY_CAST(event_id AS INTEGER) AS event_id, ts, TRY_CAST(user_id AS INTEGER) AS user_id,
  event_type, {r6('value')} AS value, props FROM events"""

ORACLE["status_band"] = f"""SELECT event_id, {r6('value')} AS value,
  CASE WHEN value <= 50 THEN 'Good' WHEN value <= 100 THEN 'Moderate'
       WHEN value <= 150 THEN 'Unhealthy for Sensitive' WHEN value <= 200 THEN 'Unhealthy'
       WHEN value <= 300 THEN 'Very Unhealthy' WHEN value IS NOT NULL THEN 'Hazardous' END AS status,
  CASE WHEN value <= 50 THEN '#00e400' WHEN value <= 100 THEN '#ffff00'
       WHEN value <= 150 THEN '#ff7e00' WHEN value <= 200 THEN '#ff0000'
       WHEN value <= 300 THEN '#8f3f97' WHEN value IS NOT NULL THEN '#7e0023' END AS color
FROM events"""

ORACLE["alert_level"] = f"""SELECT event_id, {r6('value')} AS value,
  CASE WHEN value >= 150 THEN 'hazardous' WHEN value >= 100 THEN 'unhealthy'
       WHEN value IS NOT NULL THEN 'none' END AS level_inclusive,
  CASE WHEN value > 150 THEN 'hazardous' WHEN value > 100 THEN 'unhealthy'
       WHEN value IS NOT NULL THEN 'none' END AS level_strict
FROM events"""

ORACLE["lag_features"] = f"""WITH {EV}
SELECT user_id, ts, event_id,
  {r6('lag(value, 1) OVER w')} AS value_lag_1, {r6('lag(value, 3) OVER w')} AS value_lag_3,
  {r6('lag(value, 6) OVER w')} AS value_lag_6, {r6('lag(value, 12) OVER w')} AS value_lag_12,
  {r6('lag(value, 24) OVER w')} AS value_lag_24,
  {r6('lag(k, 6) OVER w')} AS k_lag_6, {r6('lag(k, 24) OVER w')} AS k_lag_24
FROM ev WINDOW w AS ({UW})"""

ORACLE["rolling_mean"] = f"""SELECT user_id, ts, event_id,
  {", ".join(f"{r6(_guard('avg', 'value', n, 'user_id', 'ts, event_id'))} AS value_rolling_mean_{n}"
             for n in (3, 6, 12, 24))}
FROM events"""

ORACLE["rolling_std"] = f"""SELECT user_id, ts, event_id,
  {", ".join(f"{r6(_guard('stddev_samp', 'value', n, 'user_id', 'ts, event_id'))} AS value_rolling_std_{n}"
             for n in (6, 24))}
FROM events"""

ORACLE["rolling_minmax"] = f"""SELECT user_id, ts, event_id,
  {r6(_guard('max', 'value', 6, 'user_id', 'ts, event_id'))} AS value_rolling_max_6,
  {r6(_guard('min', 'value', 6, 'user_id', 'ts, event_id'))} AS value_rolling_min_6
FROM events"""

ORACLE["change_features"] = f"""WITH p AS (
  SELECT user_id, ts, event_id, value,
    value - lag(value) OVER ({UW}) AS d,
    last_value(value IGNORE NULLS) OVER ({UW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cur,
    last_value(value IGNORE NULLS) OVER ({UW} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM events)
SELECT user_id, ts, event_id, {r6('d')} AS value_change,
  {r6('100.0 * ((cur - prev) / NULLIF(prev, 0))')} AS value_change_rate
FROM p"""

ORACLE["forward_fill"] = f"""WITH {TYPE_GRID}
SELECT event_type, hour_ts, n_events,
  {r6("""coalesce(last_value(avg_value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY hour_ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)""")} AS avg_value
FROM tg"""

ORACLE["lookback_sequences"] = f"""WITH {EV},
r AS (SELECT user_id, ts, event_id, value, k, row_number() OVER ({UW}) AS rn FROM ev)
SELECT t.user_id, t.ts, t.event_id, {r6('t.value')} AS y, CAST(s.rn - t.rn + 24 AS INTEGER) AS step,
  {r6('s.value')} AS x_value, {r6('s.k')} AS x_k
FROM r t JOIN r s ON s.user_id = t.user_id AND s.rn >= t.rn - 24 AND s.rn < t.rn
WHERE t.rn > 24"""

ORACLE["hourly_grid"] = f"""WITH {TYPE_GRID}
SELECT event_type, hour_ts, n_events, {r6('avg_value')} AS avg_value FROM tg"""

ORACLE["join_sources"] = f"""WITH {STATION}
SELECT 'events' AS feed, city, timestamp, {r6('pm10')} AS pm10, {r6('pm2_5')} AS pm2_5,
  {r6('carbon_monoxide')} AS carbon_monoxide, {r6('nitrogen_dioxide')} AS nitrogen_dioxide,
  {r6('ozone')} AS ozone, {r6('sulphur_dioxide')} AS sulphur_dioxide, {r6('us_aqi')} AS us_aqi,
  {r6('european_aqi')} AS european_aqi, {r6('temperature')} AS temperature, {r6('humidity')} AS humidity,
  {r6('wind_speed')} AS wind_speed, {r6('pressure')} AS pressure, {r6('precipitation')} AS precipitation,
  {r6('cloudcover')} AS cloudcover
FROM st"""

ORACLE["payload_explode"] = f"""WITH {EV}
SELECT user_id, ts, {r6('value')} AS value, {r6('k')} AS k FROM ev"""

ORACLE["payload_quarantine"] = """WITH p AS (
  SELECT user_id, count(*) AS n FROM events GROUP BY user_id, CAST(ts AS DATE)),
o AS (
  SELECT user_id % 7 AS kind, n FROM p)
SELECT 'exploded' AS outcome, CAST(coalesce(sum(n), 0) AS BIGINT) AS n FROM o WHERE kind NOT IN (3, 4)
UNION ALL SELECT CASE kind WHEN 3 THEN 'malformed' WHEN 4 THEN 'unequal arrays or bad times' ELSE 'unknown fields' END, count(*)
FROM o WHERE kind IN (3, 4, 5) GROUP BY kind"""

ORACLE["time_axis"] = f"""WITH h AS (
  SELECT user_id, date_trunc('hour', ts) AS hr, avg(value) AS avg_value, CAST(count(*) AS DOUBLE) AS n_events
  FROM events GROUP BY 1, 2),
d AS (SELECT DISTINCT user_id, date_trunc('day', ts) AS day FROM events),
g AS (SELECT d.user_id, d.day + INTERVAL (r.i) HOUR AS ts FROM d, range(24) AS r(i))
SELECT g.user_id, g.ts, {r6('h.avg_value')} AS avg_value, {r6('h.n_events')} AS n_events
FROM g LEFT JOIN h ON h.user_id = g.user_id AND h.hr = g.ts"""

_FULL_FEATURES = f"""
  {_cal('timestamp')},
  lag(us_aqi, 1) OVER w AS aqi_lag_1h, lag(us_aqi, 3) OVER w AS aqi_lag_3h, lag(us_aqi, 6) OVER w AS aqi_lag_6h,
  lag(us_aqi, 12) OVER w AS aqi_lag_12h, lag(us_aqi, 24) OVER w AS aqi_lag_24h,
  lag(pm2_5, 6) OVER w AS pm25_lag_6h, lag(pm2_5, 24) OVER w AS pm25_lag_24h,
  {_guard('avg', 'us_aqi', 3, 'city', 'timestamp')} AS aqi_rolling_mean_3h,
  {_guard('avg', 'us_aqi', 6, 'city', 'timestamp')} AS aqi_rolling_mean_6h,
  {_guard('avg', 'us_aqi', 12, 'city', 'timestamp')} AS aqi_rolling_mean_12h,
  {_guard('avg', 'us_aqi', 24, 'city', 'timestamp')} AS aqi_rolling_mean_24h,
  {_guard('stddev_samp', 'us_aqi', 6, 'city', 'timestamp')} AS aqi_rolling_std_6h,
  {_guard('stddev_samp', 'us_aqi', 24, 'city', 'timestamp')} AS aqi_rolling_std_24h,
  {_guard('max', 'us_aqi', 6, 'city', 'timestamp')} AS aqi_rolling_max_6h,
  {_guard('min', 'us_aqi', 6, 'city', 'timestamp')} AS aqi_rolling_min_6h,
  pm2_5 / (pm10 + 0.01) AS pm25_pm10_ratio,
  temperature * humidity AS temp_humidity,
  wind_speed * pressure AS wind_pressure,
  us_aqi - lag(us_aqi, 1) OVER w AS aqi_change,
  100.0 * ((last_value(us_aqi IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            - last_value(us_aqi IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
           / NULLIF(last_value(us_aqi IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    AS aqi_change_rate,
  temperature * temperature AS temp_squared,
  {WIND_CASE} AS wind_category,
  CAST(coalesce(precipitation > 0.1, false) AS INTEGER) AS is_raining,
  CAST(coalesce(pressure > 1015, false) AS INTEGER) AS high_pressure"""

ORACLE["features_full"] = f"""WITH {STATION_GRID},
f AS (SELECT sg.*, {_FULL_FEATURES} FROM sg WINDOW w AS (PARTITION BY city ORDER BY timestamp))
SELECT COLUMNS(lambda c: c IN ('city', 'timestamp')),
       {r6("""COLUMNS(lambda c: c NOT IN ('city', 'timestamp', 'hour', 'day_of_week', 'month', 'day_of_year',
             'is_weekend', 'is_rush_hour', 'season', 'wind_category', 'is_raining', 'high_pressure'))""")},
       COLUMNS(lambda c: c IN ('hour', 'day_of_week', 'month', 'day_of_year', 'is_weekend', 'is_rush_hour',
             'season', 'wind_category', 'is_raining', 'high_pressure'))
FROM f WHERE COLUMNS(*) IS NOT NULL"""

ORACLE["features_basic"] = f"""WITH {EV},
f AS (
  SELECT user_id, ts, event_id, event_type, value, k,
    CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
    CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) IN (6, 7) AS INTEGER) AS is_weekend,
    lag(value, 1) OVER w AS aqi_lag_1h, lag(value, 6) OVER w AS aqi_lag_6h,
    {_guard('avg', 'value', 3, 'user_id', 'ts, event_id')} AS aqi_rolling_mean_3h
  FROM ev WINDOW w AS ({UW}))
SELECT user_id, ts, event_id, {r6('value')} AS value, hour, day_of_week, month, is_weekend,
  {r6('aqi_lag_1h')} AS aqi_lag_1h, {r6('aqi_lag_6h')} AS aqi_lag_6h,
  {r6('aqi_rolling_mean_3h')} AS aqi_rolling_mean_3h
FROM f WHERE COLUMNS(*) IS NOT NULL"""


CUTOFF = "TIMESTAMP '2024-01-20 00:00:00'"
OVERLAP_FROM = "TIMESTAMP '2024-01-19 00:00:00'"
AS_OF = "TIMESTAMP '2024-01-25 12:00:00'"

STORED = f"stored AS (SELECT user_id, ts, event_id, value FROM events WHERE ts < {CUTOFF})"
LANDED = f"landed AS (SELECT user_id, ts, event_id, value FROM events WHERE ts >= {OVERLAP_FROM})"
WM = "wm AS (SELECT user_id, max(ts) AS last_ts FROM stored GROUP BY user_id)"

ORACLE["watermark"] = "SELECT user_id, max(ts) AS last_ts FROM events GROUP BY user_id"

LOAD_TIME = "TIMESTAMP '2024-01-19 12:00:00'"
CLAMPED = f"""{WM},
cl AS (SELECT user_id, CASE WHEN last_ts > {LOAD_TIME} THEN {LOAD_TIME} - INTERVAL 1 HOUR ELSE last_ts END AS last_ts FROM wm)"""

ORACLE["fetch_ranges"] = f"""WITH wm AS (SELECT user_id, max(ts) AS last_ts FROM events GROUP BY user_id),
c AS (SELECT user_id, CASE WHEN last_ts > {AS_OF} THEN {AS_OF} - INTERVAL 1 HOUR ELSE last_ts END AS last_ts FROM wm)
SELECT user_id, last_ts, last_ts + INTERVAL 1 HOUR AS next_ts, CAST(last_ts + INTERVAL 1 HOUR AS DATE) AS from_date,
  CAST({AS_OF} AS DATE) AS to_date, last_ts + INTERVAL 1 HOUR <= {AS_OF} AS due
FROM c"""

ORACLE["incremental_rows"] = f"""WITH {STORED}, {LANDED}, {CLAMPED}
SELECT l.user_id, l.ts, l.event_id, {r6('l.value')} AS value
FROM landed l LEFT JOIN cl AS wm ON wm.user_id = l.user_id
WHERE wm.last_ts IS NULL OR l.ts > wm.last_ts"""

ORACLE["late_rows"] = f"""WITH {STORED}, {LANDED}, {CLAMPED}
SELECT l.user_id, l.ts, l.event_id, {r6('l.value')} AS value
FROM landed l JOIN cl AS wm ON wm.user_id = l.user_id
WHERE l.ts <= wm.last_ts"""

_UNION = f"""u AS (
  SELECT user_id, ts, event_id, value, 'stored' AS source, 0 AS prio FROM events WHERE ts < {CUTOFF}
  UNION ALL
  SELECT user_id, ts, event_id, value, 'landed' AS source, 1 AS prio FROM events WHERE ts >= {OVERLAP_FROM})"""

ORACLE["union_dedup"] = f"""WITH {_UNION},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY prio, event_id) AS rn FROM u)
SELECT user_id, ts, event_id, {r6('value')} AS value, source FROM r WHERE rn = 1"""

ORACLE["upsert_latest"] = f"""WITH {_UNION},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY prio DESC, event_id DESC) AS rn FROM u)
SELECT user_id, ts, event_id, {r6('value')} AS value, source FROM r WHERE rn = 1"""

ORACLE["versioned_upsert"] = ORACLE["upsert_latest"]

ORACLE["kept_profile"] = """SELECT user_id, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts, count(*) >= 100 AS eligible
FROM events GROUP BY user_id"""

ORACLE["kept_rollup"] = f"""WITH {_UNION},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY prio DESC, event_id DESC) AS rn FROM u)
SELECT user_id, CAST(ts AS DATE) AS date,
  round_even(avg(value), 0) AS avg_value, round_even(max(value), 0) AS max_value, round_even(min(value), 0) AS min_value
FROM r WHERE rn = 1 GROUP BY user_id, CAST(ts AS DATE)"""

ORACLE["dedup_keep_first"] = f"""WITH r AS (
  SELECT user_id, date_trunc('hour', ts) AS hour_ts, ts, event_id, value,
         row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) AS rn
  FROM events)
SELECT user_id, hour_ts, ts, event_id, {r6('value')} AS value FROM r WHERE rn = 1"""

SPLIT = f"""sp AS (
  SELECT *, CASE WHEN row_number() OVER ({UW}) <= floor(0.8 * count(*) OVER (PARTITION BY user_id))
                 THEN 'train' ELSE 'test' END AS split
  FROM ev)"""

ORACLE["series_profile"] = f"""WITH {EV}, {SPLIT}
SELECT user_id, split, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts FROM sp GROUP BY user_id, split"""

ORACLE["latest_as_of"] = f"""WITH r AS (
  SELECT user_id, ts, event_id, value,
         row_number() OVER (PARTITION BY user_id ORDER BY (ts <= {AS_OF}) DESC, ts DESC, event_id DESC) AS rn
  FROM events)
SELECT user_id, ts, event_id, {r6('value')} AS value FROM r WHERE rn = 1"""

LASTN = f"""ln AS (
  SELECT user_id, ts, event_id, value,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rank_from_end
  FROM events WHERE ts <= {AS_OF})"""

ORACLE["last_n"] = f"""WITH {LASTN}
SELECT user_id, ts, event_id, {r6('value')} AS value, rank_from_end FROM ln WHERE rank_from_end <= 24"""

RECENT = f"""{LASTN},
rs AS (
  SELECT user_id,
    avg(CASE WHEN rank_from_end <= 24 THEN value END) AS recent_avg,
    max(CASE WHEN rank_from_end = 1 THEN value END) AS last_value,
    max(CASE WHEN rank_from_end = 6 THEN value END) AS back_value,
    count(*) AS n_recent
  FROM ln WHERE rank_from_end <= 24 GROUP BY user_id)"""

ORACLE["recent_trend"] = f"""WITH {RECENT}
SELECT user_id, {r6('recent_avg')} AS recent_avg, {r6('last_value')} AS last_value, {r6('back_value')} AS back_value,
  n_recent,
  CASE WHEN back_value IS NULL OR last_value IS NULL THEN NULL
       WHEN last_value > back_value THEN 'increasing' ELSE 'decreasing' END AS trend
FROM rs"""

ORACLE["staleness"] = f"""WITH l AS (SELECT user_id, max(ts) AS ts FROM events WHERE ts <= {AS_OF} GROUP BY user_id)
SELECT user_id, ts, date_diff('second', ts, {AS_OF}) AS age_seconds,
  {AS_OF} > ts + INTERVAL 21600 SECOND AS is_stale
FROM l"""

ORACLE["min_history"] = f"""SELECT user_id, count(*) AS n_rows, count(*) >= 100 AS eligible
FROM events WHERE ts <= {AS_OF} GROUP BY user_id"""

ORACLE["daily_rollup"] = """SELECT user_id, CAST(ts AS DATE) AS date,
  round_even(avg(value), 0) AS avg_value, round_even(max(value), 0) AS max_value, round_even(min(value), 0) AS min_value
FROM events GROUP BY user_id, CAST(ts AS DATE)"""

SAMPLE_KEY = "md5(concat_ws(':', CAST(event_id AS VARCHAR), '42'))"

ORACLE["hash_sample"] = f"""SELECT user_id, ts, event_id, {r6('value')} AS value, {SAMPLE_KEY} AS sample_key
FROM events ORDER BY sample_key, event_id LIMIT 500"""

ORACLE["alert_messages"] = f"""WITH {RECENT},
l AS (
  SELECT user_id, ts, value FROM (
    SELECT user_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events WHERE ts <= {AS_OF}) WHERE rn = 1),
j AS (
  SELECT l.user_id, l.ts, l.value, rs.recent_avg,
    CASE WHEN rs.back_value IS NULL OR rs.last_value IS NULL THEN NULL
         WHEN rs.last_value > rs.back_value THEN 'increasing' ELSE 'decreasing' END AS trend,
    CASE WHEN l.value >= 150 THEN 'hazardous' WHEN l.value >= 100 THEN 'unhealthy' ELSE 'none' END AS level
  FROM l LEFT JOIN rs ON rs.user_id = l.user_id)
SELECT user_id, ts, level, {r6('value')} AS value, {r6('recent_avg')} AS recent_avg, trend,
  '[' || upper(level) || '] ' || CAST(user_id AS VARCHAR) || ': value '
    || printf('%.0f', CAST(round(CAST(value AS DECIMAL(38,12)), 0) AS DOUBLE))
    || ' at ' || strftime(ts, '%Y-%m-%d %H:%M') || '; recent mean '
    || coalesce(printf('%.0f', CAST(round(CAST(recent_avg AS DECIMAL(38,12)), 0) AS DOUBLE)), 'n/a')
    || ' (' || coalesce(trend, 'trend unknown') || ')' AS message
FROM j WHERE level <> 'none'"""

ORACLE["split_80_20"] = f"WITH {EV}, {SPLIT} SELECT user_id, ts, event_id, split FROM sp"

ORACLE["minmax_scale"] = f"""WITH {EV}, {SPLIT},
f AS (SELECT min(value) AS vmin, max(value) AS vmax, min(k) AS kmin, max(k) AS kmax FROM sp WHERE split = 'train')
SELECT user_id, ts, event_id, split,
  {r6("(value - vmin) / CASE WHEN vmax - vmin = 0 THEN 1.0 ELSE vmax - vmin END")} AS value_scaled,
  {r6("(k - kmin) / CASE WHEN kmax - kmin = 0 THEN 1.0 ELSE kmax - kmin END")} AS k_scaled
FROM sp, f"""

BASELINES = f"""{EV},
b AS (
  SELECT user_id, ts, event_id, value,
    lag(value, 1) OVER ({UW}) AS persistence,
    CASE WHEN count(value) OVER ({UW} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3
         THEN avg(value) OVER ({UW} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END AS mean3,
    lag(value, 24) OVER ({UW}) AS seasonal_24,
    CASE WHEN row_number() OVER ({UW}) <= floor(0.8 * count(*) OVER (PARTITION BY user_id))
         THEN 'train' ELSE 'test' END AS split
  FROM ev),
fit AS (SELECT regr_intercept(value, mean3) AS a, regr_slope(value, mean3) AS b FROM b WHERE split = 'train'),
bc AS (SELECT * FROM b WHERE value IS NOT NULL AND persistence IS NOT NULL AND mean3 IS NOT NULL AND seasonal_24 IS NOT NULL),
lg AS (
  SELECT split, 'persistence' AS model, value AS y, persistence AS pred FROM bc
  UNION ALL SELECT split, 'rolling_mean_3', value, mean3 FROM bc
  UNION ALL SELECT split, 'seasonal_24', value, seasonal_24 FROM bc
  UNION ALL SELECT split, 'linear_mean3', value, fit.a + fit.b * mean3 FROM bc, fit),
m AS (
  SELECT model, split, count(*) AS n, sqrt(avg((y - pred) * (y - pred))) AS rmse, avg(abs(y - pred)) AS mae,
    1.0 - sum((y - pred) * (y - pred)) / NULLIF(count(*) * var_pop(y), 0) AS r2
  FROM lg WHERE y IS NOT NULL AND pred IS NOT NULL GROUP BY model, split)"""

ORACLE["regression_metrics"] = f"""WITH {BASELINES}
SELECT model, split, n, {r6('rmse')} AS rmse, {r6('mae')} AS mae, {r6('r2')} AS r2 FROM m"""

ORACLE["best_model"] = f"""WITH {BASELINES}
SELECT model, {r6('rmse')} AS rmse, {r6('mae')} AS mae, {r6('r2')} AS r2 FROM m WHERE split = 'test'
ORDER BY rmse, list_position(['linear_mean3', 'rolling_mean_3', 'persistence', 'seasonal_24'], model) LIMIT 1"""

_IMP_FEATS = [f"value_lag_{k}" for k in (1, 3, 6, 12, 24)] + [f"value_rolling_mean_{n}" for n in (3, 6, 12, 24)] \
    + [f"value_rolling_std_{n}" for n in (6, 24)] + ["value_change", "k"]

ORACLE["top_k_importance"] = f"""WITH {EV},
f AS (
  SELECT value, k,
    {", ".join(f"lag(value, {k}) OVER ({UW}) AS value_lag_{k}" for k in (1, 3, 6, 12, 24))},
    {", ".join(f"{_guard('avg', 'value', n, 'user_id', 'ts, event_id')} AS value_rolling_mean_{n}" for n in (3, 6, 12, 24))},
    {", ".join(f"{_guard('stddev_samp', 'value', n, 'user_id', 'ts, event_id')} AS value_rolling_std_{n}" for n in (6, 24))},
    value - lag(value, 1) OVER ({UW}) AS value_change
  FROM ev),
c AS ({" UNION ALL ".join(f"SELECT '{x}' AS feature, coalesce(abs(corr({x}, value)), 0.0) AS w FROM f" for x in _IMP_FEATS)}),
n AS (SELECT feature, w / sum(w) OVER () AS importance FROM c)
SELECT feature, {r6('importance')} AS importance, repeat('#', CAST(greatest(floor(importance * 50), 0) AS INTEGER)) AS bar
FROM n ORDER BY importance DESC, feature LIMIT 10"""

# ---- forecasts over the station series

STATION_FIT = STATION_GRID + f""",
sw AS (
  SELECT o.city, o.timestamp, (y2.us_aqi + y1.us_aqi + o.us_aqi) / 3.0 AS x, nx.us_aqi AS y
  FROM sg o
  LEFT JOIN sg y1 ON y1.city = o.city AND y1.timestamp = o.timestamp - INTERVAL 1 HOUR
  LEFT JOIN sg y2 ON y2.city = o.city AND y2.timestamp = o.timestamp - INTERVAL 2 HOUR
  LEFT JOIN sg nx ON nx.city = o.city AND nx.timestamp = o.timestamp + INTERVAL 1 HOUR AND nx.timestamp <= {AS_OF}
  WHERE o.timestamp <= {AS_OF}),
fit AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM sw)"""

FORECAST = STATION_FIT + f""",
tail AS (
  SELECT city, timestamp,
         last_value(us_aqi IGNORE NULLS) OVER (PARTITION BY city ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS us_aqi,
         row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) AS rk,
         count(*) OVER (PARTITION BY city) AS n_past
  FROM sg WHERE timestamp <= {AS_OF}),
state AS (
  SELECT city, max(CASE WHEN rk = 1 THEN timestamp END) AS last_ts,
    max(CASE WHEN rk = 3 THEN us_aqi END) AS w1, max(CASE WHEN rk = 2 THEN us_aqi END) AS w2,
    max(CASE WHEN rk = 1 THEN us_aqi END) AS w3
  FROM tail WHERE n_past >= 100 AND rk <= 200 GROUP BY city),
fc AS (
  WITH RECURSIVE rec(city, h, last_ts, w1, w2, w3) AS (
    SELECT city, 0, last_ts, w1, w2, w3 FROM state
    UNION ALL
    SELECT rec.city, rec.h + 1, rec.last_ts, rec.w2, rec.w3, fit.a + fit.b * ((rec.w1 + rec.w2 + rec.w3) / 3.0)
    FROM rec, fit WHERE rec.h < 72)
  SELECT city, CAST(h AS INTEGER) AS horizon_h, last_ts + h * INTERVAL 1 HOUR AS timestamp, w3 AS predicted
  FROM rec WHERE h > 0)"""

ORACLE["recursive_forecast"] = f"""WITH {FORECAST}
SELECT city, horizon_h, timestamp, {r6('predicted')} AS predicted FROM fc"""

ORACLE["peak_alert"] = f"""WITH {FORECAST}
SELECT city, {r6('max(predicted)')} AS peak,
  CASE WHEN max(predicted) > 150 THEN 'hazardous' WHEN max(predicted) > 100 THEN 'unhealthy'
       WHEN max(predicted) IS NOT NULL THEN 'none' END AS alert
FROM fc GROUP BY city"""


def _backtest(horizons: tuple[int, ...]) -> str:
    hs = ", ".join(str(h) for h in horizons)
    return STATION_FIT + f""",
coef AS (
  WITH RECURSIVE cr(h, s1, s2, s3) AS (
    SELECT 0, CAST([0, 1, 0, 0] AS DOUBLE[]), CAST([0, 0, 1, 0] AS DOUBLE[]), CAST([0, 0, 0, 1] AS DOUBLE[])
    UNION ALL
    SELECT cr.h + 1, cr.s2, cr.s3,
      [fit.a + fit.b * ((cr.s1[1] + cr.s2[1] + cr.s3[1]) / 3.0),
       fit.b * ((cr.s1[2] + cr.s2[2] + cr.s3[2]) / 3.0),
       fit.b * ((cr.s1[3] + cr.s2[3] + cr.s3[3]) / 3.0),
       fit.b * ((cr.s1[4] + cr.s2[4] + cr.s3[4]) / 3.0)]
    FROM cr, fit WHERE cr.h < {max(horizons)})
  SELECT h, s3[1] AS k0, s3[2] AS k1, s3[3] AS k2, s3[4] AS k3 FROM cr WHERE h IN ({hs})),
lg AS (
  SELECT hz.h, y2.us_aqi AS y2, y1.us_aqi AS y1, o.us_aqi AS y0, a.us_aqi AS actual
  FROM sg o CROSS JOIN (SELECT unnest([{hs}]) AS h) AS hz
  JOIN sg y1 ON y1.city = o.city AND y1.timestamp = o.timestamp - INTERVAL 1 HOUR
  JOIN sg y2 ON y2.city = o.city AND y2.timestamp = o.timestamp - INTERVAL 2 HOUR
  JOIN sg a ON a.city = o.city AND a.timestamp = o.timestamp + hz.h * INTERVAL 1 HOUR
  WHERE o.timestamp > {AS_OF}),
e AS (
  SELECT lg.h, lg.actual - (k0 + k1 * y2 + k2 * y1 + k3 * y0) AS err FROM lg JOIN coef ON coef.h = lg.h
  WHERE lg.actual IS NOT NULL AND (k0 + k1 * y2 + k2 * y1 + k3 * y0) IS NOT NULL),
bt AS (SELECT CAST(h AS INTEGER) AS horizon_h, sqrt(avg(err * err)) AS rmse, avg(abs(err)) AS mae, count(*) AS n
       FROM e GROUP BY h)"""


ORACLE["backtest_by_horizon"] = f"""WITH {_backtest((1, 6, 24, 48, 72))}
SELECT horizon_h, {r6('rmse')} AS rmse, {r6('mae')} AS mae, n FROM bt"""

ORACLE["backtest_model"] = f"""WITH {STATION_GRID},
fl AS (
  SELECT city, timestamp, us_aqi,
         last_value(us_aqi IGNORE NULLS) OVER (PARTITION BY city ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f
  FROM sg),
og AS (
  SELECT city, timestamp, lag(f, 2) OVER w AS w1, lag(f, 1) OVER w AS w2, f AS w3
  FROM fl WINDOW w AS (PARTITION BY city ORDER BY timestamp)),
fc AS (
  WITH RECURSIVE r(city, origin, h, w1, w2, w3) AS (
    SELECT city, timestamp, 0, w1, w2, w3 FROM og WHERE timestamp > {AS_OF} AND w1 IS NOT NULL
    UNION ALL
    SELECT city, origin, h + 1, w2, w3, m + 0.5 * greatest(w3 - m, 0) - 0.25 * greatest(m - w3, 0)
    FROM (SELECT *, (w1 + w2 + w3) / 3.0 AS m FROM r WHERE h < 72))
  SELECT city, origin, h, w3 AS predicted FROM r WHERE h IN (1, 6, 24, 48, 72)),
e AS (
  SELECT fc.h, a.us_aqi - fc.predicted AS err
  FROM fc JOIN sg a ON a.city = fc.city AND a.timestamp = fc.origin + fc.h * INTERVAL 1 HOUR
  WHERE a.us_aqi IS NOT NULL)
SELECT CAST(h AS INTEGER) AS horizon_h, {r6('sqrt(avg(err * err))')} AS rmse, {r6('avg(abs(err))')} AS mae, count(*) AS n
FROM e GROUP BY h"""

ORACLE["forecast_error_table"] = f"""WITH {_backtest((1,))},
g AS (SELECT * FROM (VALUES (1, 1.0, '1 hour', 'Excellent'), (6, 1.4, '6 hours', 'Very Good'),
        (24, 3.0, '24 hours (Day 1)', 'Good'), (48, 4.8, '48 hours (Day 2)', 'Fair'),
        (72, 6.3, '72 hours (Day 3)', 'Moderate')) AS t(horizon_h, mult, label, reliability)),
t AS (SELECT g.horizon_h, g.label, g.reliability, bt.rmse * g.mult AS rmse FROM g, bt)
SELECT CAST(horizon_h AS INTEGER) AS horizon_h, label, reliability, {r6('rmse')} AS rmse,
  printf('%.2f', CAST(round(CAST(rmse AS DECIMAL(38,12)), 2) AS DOUBLE)) AS expected_rmse,
  '±' || printf('%.2f', CAST(round(CAST(rmse AS DECIMAL(38,12)), 2) AS DOUBLE)) AS error_range
FROM t"""

# ---- attribution over the reduced features

_DEMO = {"hour": 0.2, "day_of_week": -0.5, "month": 0.1, "is_weekend": 1.5,
         "aqi_lag_1h": 0.35, "aqi_lag_6h": 0.05, "aqi_rolling_mean_3h": 0.45}

ATTR = f"""{EV},
f0 AS (
  SELECT user_id, ts, event_id, event_type, value, k,
    CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
    CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) IN (6, 7) AS INTEGER) AS is_weekend,
    lag(value, 1) OVER w AS aqi_lag_1h, lag(value, 6) OVER w AS aqi_lag_6h,
    {_guard('avg', 'value', 3, 'user_id', 'ts, event_id')} AS aqi_rolling_mean_3h
  FROM ev WINDOW w AS ({UW})),
f AS (SELECT * FROM f0 WHERE COLUMNS(*) IS NOT NULL),
s AS (SELECT *, {SAMPLE_KEY} AS sample_key FROM f),
mu AS (SELECT {", ".join(f"avg({c}) AS {c}" for c in _DEMO)} FROM s),
bp AS (
  SELECT s.event_id, s.value, s.sample_key,
    5.0 {"".join(f" + {v} * mu.{c}" for c, v in _DEMO.items())} AS base_value,
    5.0 {"".join(f" + {v} * CAST(s.{c} AS DOUBLE)" for c, v in _DEMO.items())} AS prediction
  FROM s, mu),
lg AS ({" UNION ALL ".join(
    f"SELECT s.event_id, '{c}' AS feature, CAST(s.{c} AS DOUBLE) AS feature_value, "
    f"{v} * (CAST(s.{c} AS DOUBLE) - mu.{c}) AS contribution FROM s, mu" for c, v in _DEMO.items())}),
la AS (SELECT lg.*, bp.base_value, bp.prediction FROM lg JOIN bp ON bp.event_id = lg.event_id)"""

ORACLE["attribution_linear"] = f"""WITH {ATTR}
SELECT event_id, feature, {r6('feature_value')} AS feature_value, {r6('contribution')} AS contribution,
  {r6('base_value')} AS base_value, {r6('prediction')} AS prediction FROM la"""

RANK = """rk AS (SELECT feature, avg(abs(contribution)) AS mean_abs_contribution FROM la GROUP BY feature)"""

ORACLE["attribution_rank"] = f"""WITH {ATTR}, {RANK}
SELECT feature, {r6('mean_abs_contribution')} AS mean_abs_contribution,
  repeat('#', CAST(greatest(floor(mean_abs_contribution * 100), 0) AS INTEGER)) AS bar
FROM rk"""

ORACLE["attribution_dependence"] = f"""WITH {ATTR}, {RANK},
top AS (SELECT feature FROM rk ORDER BY mean_abs_contribution DESC, feature LIMIT 3)
SELECT event_id, feature, {r6('feature_value')} AS feature_value, {r6('contribution')} AS contribution
FROM la WHERE feature IN (SELECT feature FROM top)"""

ORACLE["pick_examples"] = f"""WITH {ATTR},
ordered AS (SELECT event_id, value, row_number() OVER (ORDER BY sample_key) AS pos FROM bp),
picks AS (
  SELECT 'good' AS example, coalesce((SELECT event_id FROM ordered WHERE value < 50 ORDER BY pos LIMIT 1),
                                     (SELECT event_id FROM ordered WHERE pos = 1)) AS event_id
  UNION ALL
  SELECT 'bad', coalesce((SELECT event_id FROM ordered WHERE value > 150 ORDER BY pos LIMIT 1),
                         (SELECT event_id FROM ordered WHERE pos = 2))
  UNION ALL
  SELECT 'random', (SELECT event_id FROM ordered WHERE pos = 3))
SELECT p.example, la.event_id, la.feature, {r6('la.feature_value')} AS feature_value,
  {r6('la.contribution')} AS contribution,
  CAST(row_number() OVER (PARTITION BY p.example ORDER BY abs(la.contribution) DESC, la.feature) AS INTEGER) AS rank
FROM picks p JOIN la ON la.event_id = p.event_id"""


# Fixed trees, nested: (feature, threshold, left, right) or a leaf's value.
_TREES = [
    ("aqi_lag_1h", 100.0, ("hour", 11.0, 40.0, 60.0), ("aqi_rolling_mean_3h", 150.0, 120.0, 180.0)),
    ("hour", 17.0, 10.0, ("aqi_lag_1h", 200.0, 20.0, 35.0)),
    ("aqi_lag_1h", 150.0, ("aqi_lag_1h", 50.0, 1.0, 5.0), 9.0),
]
_TREE_FEATS = ["aqi_lag_1h", "aqi_rolling_mean_3h", "hour"]


def _tree_nodes():
    """(name, condition that a row reaches it, node) of every node."""
    todo = [(f"t{i}", "true", t) for i, t in enumerate(_TREES)]
    for name, cond, node in todo:
        yield name, cond, node
        if isinstance(node, tuple):
            f, t, left, right = node
            todo += [(name + "l", f"{cond} AND {f} <= {t}", left), (name + "r", f"{cond} AND {f} > {t}", right)]


def _known(name, node, subset):
    """The tree's expectation when only the features of ``subset`` are known; columns of ``w`` hold the covers."""
    if not isinstance(node, tuple):
        return str(node)
    f, t, left, right = node
    a, b = _known(name + "l", left, subset), _known(name + "r", right, subset)
    if f in subset:
        return f"CASE WHEN {f} <= {t} THEN {a} ELSE {b} END"
    share = f"(CASE WHEN {name}_n = 0 THEN 0.5 ELSE CAST({name}l_n AS DOUBLE) / {name}_n END)"
    return f"({share} * ({a}) + (1 - {share}) * ({b}))"


_SUBSETS = [tuple(f for i, f in enumerate(_TREE_FEATS) if m >> i & 1) for m in range(8)]
_VALUES = ", ".join(f"{' + '.join(f'({_known(f't{i}', t, sub)})' for i, t in enumerate(_TREES))} AS v{m}" for m, sub in enumerate(_SUBSETS))
_NODE_STATS = f"""{EV},
f0 AS (
  SELECT event_id, value, CAST(hour(ts) AS INTEGER) AS hour, lag(value, 1) OVER w AS aqi_lag_1h, lag(value, 6) OVER w AS aqi_lag_6h, k,
    {_guard('avg', 'value', 3, 'user_id', 'ts, event_id')} AS aqi_rolling_mean_3h
  FROM ev WINDOW w AS ({UW})),
f AS (SELECT * FROM f0 WHERE COLUMNS(*) IS NOT NULL),
w AS (SELECT {", ".join(f"count(*) FILTER (WHERE {c}) AS {n}_n, coalesce(count(*) FILTER (WHERE {c}) * var_pop(value) FILTER (WHERE {c}), 0) AS {n}_q"
                        for n, c, _ in _tree_nodes())} FROM f)"""


def _shapley(i):
    """The weighted differences of the subsets with and without feature ``i`` (weights 1/3, 1/6, 1/3 by size)."""
    return " + ".join(f"(v{m | 1 << i} - v{m}) / {6.0 if bin(m).count('1') == 1 else 3.0}" for m in range(8) if not m >> i & 1)


ORACLE["tree_attribution"] = f"""WITH {_NODE_STATS},
v AS (SELECT event_id, aqi_lag_1h, aqi_rolling_mean_3h, hour, {_VALUES} FROM f, w),
a AS ({" UNION ALL ".join(f"SELECT event_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS feature_value, {_shapley(i)} AS contribution, v0, v7 FROM v" for i, c in enumerate(_TREE_FEATS))})
SELECT event_id, feature, {r6('feature_value')} AS feature_value, {r6('contribution')} AS contribution, {r6('v0')} AS base_value, {r6('v7')} AS prediction FROM a"""

_SPLITS = [(n, node[0]) for n, _, node in _tree_nodes() if isinstance(node, tuple)]
ORACLE["native_importance"] = f"""WITH {_NODE_STATS},
g AS ({" UNION ALL ".join(f"SELECT '{n[:2]}' AS tree, '{c}' AS feature, {n}_q - {n}l_q - {n}r_q AS g FROM w" for n, c in _SPLITS)}),
s AS (SELECT feature, sum(g / t) AS s FROM (SELECT *, sum(g) OVER (PARTITION BY tree) AS t FROM g) GROUP BY feature),
n AS (SELECT feature, s / sum(s) OVER () AS importance FROM s)
SELECT feature, {r6('importance')} AS importance, repeat('#', CAST(greatest(floor(importance * 50), 0) AS INTEGER)) AS bar
FROM n ORDER BY importance DESC, feature LIMIT 10"""


ORACLE["order_series_features"] = f"""WITH o AS (
  SELECT n.n_name AS nation, date_trunc('day', o.o_orderdate) AS day, count(*) AS n_orders,
         sum(o.o_totalprice) AS revenue
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2),
span AS (SELECT nation, min(day) AS lo, max(day) AS hi FROM o GROUP BY nation),
slots AS (SELECT nation, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS day FROM span),
g AS (
  SELECT s.nation, s.day, coalesce(o.n_orders, 0) AS n_orders, coalesce(o.revenue, 0.0) AS revenue
  FROM slots s LEFT JOIN o ON o.nation = s.nation AND o.day = s.day)
SELECT nation, day, n_orders, {r6('revenue')} AS revenue,
  {r6('lag(revenue, 1) OVER (PARTITION BY nation ORDER BY day)')} AS revenue_lag_1,
  {r6('lag(revenue, 7) OVER (PARTITION BY nation ORDER BY day)')} AS revenue_lag_7,
  {r6(_guard('avg', 'revenue', 7, 'nation', 'day'))} AS revenue_rolling_mean_7,
  {r6('revenue - lag(revenue, 1) OVER (PARTITION BY nation ORDER BY day)')} AS revenue_change
FROM g"""

# the forms with cut series give the same rows
for _name in ("lag_features", "rolling_mean", "change_features", "last_n", "split_80_20"):
    ORACLE[_name + "_cut"] = ORACLE[_name]

ORACLE["split_global"] = """SELECT user_id, ts, event_id,
  CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END
    AS split
FROM events"""
