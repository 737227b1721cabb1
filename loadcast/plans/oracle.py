"""DuckDB SQL twins of the catalogue queries (the correctness oracle).

Written for DuckDB over the driver's pre-registered tables.  Engine
differences handled here:
  * DuckDB DAYOFWEEK is 0 = Sunday, Spark's is 1 = Sunday -> ``+ 1``;
  * Spark INT columns are cast to INTEGER (DuckDB returns BIGINT);
  * Spark orders NULLs first ascending, DuckDB last -> ``NULLS FIRST``;
  * averages are exact decimal sums divided by a count, as in the library.
"""

from __future__ import annotations

KEY_FMT = "%Y-%m-%d %H:%M:%S"

LOAD_CTE = f"""
load_data AS (
  SELECT strftime(date_trunc('hour', ts), '{KEY_FMT}') AS datetime_ept,
         CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS mw
  FROM events GROUP BY 1
)"""

WEATHER_CTE = f"""
weather_data AS (
  SELECT strftime(date_trunc('hour', ts), '{KEY_FMT}') AS datetime_ept,
         max(value) AS TEMP,
         CASE WHEN count(*) > 3 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS PRCP,
         CAST(count(*) AS DOUBLE) AS HMDT,
         min(value) AS WND_SPD,
         CAST(1000 + count(*) AS DOUBLE) AS ATM_PRESS
  FROM events
  WHERE event_type = 'error'
  GROUP BY 1
)"""

JOINED_CTE = """
joined_raw AS (
  SELECT l.datetime_ept, TRY_CAST(l.datetime_ept AS TIMESTAMP) AS ts, l.mw,
         w.TEMP, w.PRCP, w.HMDT, w.WND_SPD, w.ATM_PRESS
  FROM load_data l LEFT JOIN weather_data w ON l.datetime_ept = w.datetime_ept
)"""

TIME_CTE = """
features_time AS (
  SELECT *,
         CAST(hour(ts) AS INTEGER) AS hour_of_day,
         CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
         CAST(month(ts) AS INTEGER) AS month_of_year,
         CAST(year(ts) AS INTEGER) AS year_val,
         CASE WHEN dayofweek(ts) + 1 IN (1, 7) THEN 1 ELSE 0 END AS is_weekend
  FROM joined_raw
)"""

WEATHER_FEAT_CTE = """
features_weather AS (
  SELECT *,
         TEMP * TEMP AS temp_squared,
         CASE WHEN PRCP > 0 THEN 1 ELSE 0 END AS is_raining,
         HMDT * TEMP AS humidity_temp_interaction
  FROM features_time
)"""

ORDER_ALL = (
    "ts NULLS FIRST, datetime_ept NULLS FIRST, mw NULLS FIRST, TEMP NULLS FIRST, "
    "PRCP NULLS FIRST, HMDT NULLS FIRST, WND_SPD NULLS FIRST, ATM_PRESS NULLS FIRST"
)


def window_select(src: str, order: str = "ts NULLS FIRST") -> str:
    return f"""
  SELECT *,
         LAG(mw, 1) OVER (ORDER BY {order}) AS load_lag_1h,
         LAG(mw, 24) OVER (ORDER BY {order}) AS load_lag_24h,
         LAG(mw, 168) OVER (ORDER BY {order}) AS load_lag_7d,
         LAG(TEMP, 2) OVER (ORDER BY {order}) AS temp_lag_2h,
         TEMP - LAG(TEMP, 24) OVER (ORDER BY {order}) AS temp_change_24h,
         CAST(sum(CAST(mw AS DECIMAL(18,2))) OVER (ORDER BY {order} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS DOUBLE)
           / NULLIF(count(mw) OVER (ORDER BY {order} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW), 0) AS load_ma_7d
  FROM {src}"""


FINAL_CTE = f"""
windowed AS ({window_select('features_weather')}
),
final_features AS (
  SELECT * FROM windowed WHERE load_lag_7d IS NOT NULL
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


SERIES_CTES = (LOAD_CTE, WEATHER_CTE)
FEATURE_CTES = (LOAD_CTE, WEATHER_CTE, JOINED_CTE, TIME_CTE, WEATHER_FEAT_CTE, FINAL_CTE)


FEATURE_COLS_19 = [
    "TEMP", "PRCP", "HMDT", "WND_SPD", "ATM_PRESS",
    "hour_of_day", "day_of_week", "month_of_year", "year_val", "is_weekend",
    "temp_squared", "is_raining", "humidity_temp_interaction",
    "load_lag_1h", "load_lag_24h", "load_lag_7d", "temp_lag_2h", "temp_change_24h", "load_ma_7d",
]

NUMBERED_CTE = """
numbered AS (
  SELECT * EXCLUDE (datetime_ept), row_number() OVER (ORDER BY ts NULLS FIRST) - 1 AS _rn
  FROM final_features
),
cut AS (SELECT CAST(floor(0.8 * count(*)) AS BIGINT) AS c FROM numbered)"""

SPLIT_CTES = FEATURE_CTES + (NUMBERED_CTE,)


def event_lag_sql(partition: str = "") -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    w = f"{part}ORDER BY ts NULLS FIRST, event_id NULLS FIRST"
    return f"""
SELECT event_id, ts, user_id, value AS mw,
       LAG(value, 1) OVER ({w}) AS lag_1,
       LAG(value, 24) OVER ({w}) AS lag_24,
       LAG(value, 168) OVER ({w}) AS lag_168,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER ({w} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS DOUBLE)
         / NULLIF(count(value) OVER ({w} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW), 0) AS ma_168
FROM events"""


ZONE = "America/New_York"

LOAD_MSG_CTE = f"""
load_msg AS (
  SELECT strftime(date_trunc('hour', ts), '{KEY_FMT}') AS key, event_id AS seq,
         CASE WHEN event_type = 'view' THEN NULL ELSE value END AS current_reading
  FROM events
),
load_kv AS (
  SELECT key, max(seq) AS seq,
         max_by(CAST(epoch_ms(timezone('{ZONE}', CAST(key AS TIMESTAMP))) AS BIGINT), seq) AS timestamp_ms,
         max_by(current_reading, seq) FILTER (WHERE current_reading IS NOT NULL) AS current_reading
  FROM load_msg GROUP BY key
)"""

WEATHER_MSG_CTE = f"""
weather_msg AS (
  SELECT strftime(date_trunc('hour', ts), '{KEY_FMT}') AS key, event_id AS seq,
         value AS temp,
         CASE WHEN event_type = 'error' THEN CAST(0.5 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS prcp,
         CAST(user_id AS DOUBLE) AS hmdt,
         CASE WHEN event_type = 'view' THEN NULL ELSE value END AS wnd_spd,
         CAST(1000 + event_id % 50 AS DOUBLE) AS atm_press
  FROM events
),
weather_kv AS (
  SELECT key, max(seq) AS seq,
         max_by(temp, seq) FILTER (WHERE temp IS NOT NULL) AS temp,
         max_by(prcp, seq) FILTER (WHERE prcp IS NOT NULL) AS prcp,
         max_by(hmdt, seq) FILTER (WHERE hmdt IS NOT NULL) AS hmdt,
         max_by(wnd_spd, seq) FILTER (WHERE wnd_spd IS NOT NULL) AS wnd_spd,
         max_by(atm_press, seq) FILTER (WHERE atm_press IS NOT NULL) AS atm_press
  FROM weather_msg GROUP BY key
)"""

PRED_KV_CTE = f"""
preds AS (SELECT ts, round(load_lag_24h, 2) AS predicted_load_mw FROM final_features),
pred_kv AS (
  SELECT strftime(ts, '{KEY_FMT}') AS row_key, predicted_load_mw AS prediction_value,
         CAST(epoch(timezone('{ZONE}', ts)) AS BIGINT) AS prediction_ts
  FROM preds
)"""

COMBINED_CTE = """
combined AS (
  SELECT p.row_key AS datetime, p.prediction_value AS predicted, a.current_reading AS actual,
         abs(p.prediction_value - a.current_reading) AS error,
         w.temp AS temp, w.hmdt AS humidity, w.wnd_spd AS windSpeed
  FROM pred_kv p
  LEFT JOIN load_kv a ON p.row_key = a.key
  LEFT JOIN weather_kv w ON p.row_key = w.key
)"""

UPSERT_CTE = """
upserts AS (
  SELECT user_id AS key, event_id AS seq,
         CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value, props
  FROM events
)"""

def forecast_cte(start: str | None = None, ahead: int = 24) -> str:
    """``start``: SQL of the first hour (default: the one after the last known); ``ahead``: hours
    from the last known one to the end of the forecast."""
    days = -(-ahead // 24)
    past = f"WHERE ts < ({start})" if start else ""
    last = f"({start}) + INTERVAL 23 HOUR" if start else "max(ts) + INTERVAL 24 HOUR"
    asked = f"_future AND ts >= ({start})" if start else "_future"

    def chain(first: int, n: int) -> str:
        return "coalesce(" + ", ".join(f"LAG(mw, {first + 24 * j}) OVER (ORDER BY ts, _future)" for j in range(n)) + ")"

    return f"""
tail AS (SELECT * FROM joined_raw {past} ORDER BY ts DESC, mw DESC, TEMP DESC, PRCP DESC, HMDT DESC, WND_SPD DESC, ATM_PRESS DESC LIMIT {170 + ahead}),
grid AS (
  SELECT unnest(generate_series(max(ts) + INTERVAL 1 HOUR, {last}, INTERVAL 1 HOUR)) AS ts
  FROM tail
),
both_rows AS (
  SELECT datetime_ept, ts, mw, TEMP, PRCP, HMDT, WND_SPD, ATM_PRESS, false AS _future FROM tail
  UNION ALL
  SELECT strftime(ts, '{KEY_FMT}'), ts, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
         CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), true FROM grid
),
filled AS (
  SELECT datetime_ept, ts, mw,
         coalesce(TEMP, LAG(TEMP, 24) OVER (ORDER BY ts, _future),
                  last_value(TEMP IGNORE NULLS) OVER (ORDER BY ts, _future ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS TEMP,
         coalesce(PRCP, 0.0) AS PRCP, coalesce(HMDT, 50.0) AS HMDT,
         coalesce(WND_SPD, 10.0) AS WND_SPD, coalesce(ATM_PRESS, 1013.0) AS ATM_PRESS, _future
  FROM both_rows
),
fc_time AS (
  SELECT *,
         CAST(hour(ts) AS INTEGER) AS hour_of_day,
         CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
         CAST(month(ts) AS INTEGER) AS month_of_year,
         CAST(year(ts) AS INTEGER) AS year_val,
         CASE WHEN dayofweek(ts) + 1 IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
         TEMP * TEMP AS temp_squared,
         CASE WHEN PRCP > 0 THEN 1 ELSE 0 END AS is_raining,
         HMDT * TEMP AS humidity_temp_interaction
  FROM filled
),
fc AS (
  SELECT * EXCLUDE (_future, load_lag_1h, load_lag_24h),
         {chain(1, days + 1)} AS load_lag_1h, {chain(24, days)} AS load_lag_24h, {asked} AS _future
  FROM ({window_select('fc_time', 'ts, _future')})
)"""


FORECAST_CTE = forecast_cte()


DENSE_CTE = f"""
grid AS (
  SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts
  FROM features_weather WHERE ts IS NOT NULL
),
dense AS (
  SELECT *, false AS _filler FROM features_weather
  UNION ALL BY NAME
  SELECT strftime(g.ts, '{KEY_FMT}') AS datetime_ept, g.ts, true AS _filler
  FROM grid g WHERE g.ts NOT IN (SELECT ts FROM features_weather WHERE ts IS NOT NULL)
),
dense_windowed AS ({window_select('dense')}
)"""


def by_user_sql() -> str:
    w = "PARTITION BY user_id ORDER BY ts NULLS FIRST"
    return f"""
WITH load_u AS (
  SELECT user_id, strftime(date_trunc('hour', ts), '{KEY_FMT}') AS datetime_ept,
         CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS mw
  FROM events GROUP BY 1, 2
),
weather_u AS (
  SELECT user_id, strftime(date_trunc('hour', ts), '{KEY_FMT}') AS datetime_ept,
         max(value) AS TEMP
  FROM events
  WHERE event_type = 'error'
  GROUP BY 1, 2
),
joined_u AS (
  SELECT l.user_id, l.datetime_ept, TRY_CAST(l.datetime_ept AS TIMESTAMP) AS ts, l.mw, w.TEMP
  FROM load_u l LEFT JOIN weather_u w ON l.user_id = w.user_id AND l.datetime_ept = w.datetime_ept
)
SELECT user_id, datetime_ept, mw, TEMP,
       LAG(mw, 1) OVER ({w}) AS load_lag_1h,
       LAG(mw, 24) OVER ({w}) AS load_lag_24h,
       LAG(mw, 168) OVER ({w}) AS load_lag_7d,
       LAG(TEMP, 2) OVER ({w}) AS temp_lag_2h,
       TEMP - LAG(TEMP, 24) OVER ({w}) AS temp_change_24h,
       CAST(sum(CAST(mw AS DECIMAL(18,2))) OVER ({w} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS DOUBLE)
         / NULLIF(count(mw) OVER ({w} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW), 0) AS load_ma_7d
FROM joined_u"""
