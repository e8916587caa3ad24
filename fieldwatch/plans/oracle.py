"""The same queries as plain SQL over the given tables, for DuckDB."""

from fieldwatch.functions.columns import HORIZON_SECONDS
from fieldwatch.operators.history import TARGETS

READINGS = """readings AS (
  SELECT 'SITE_' || lpad(CAST(user_id % 5 + 1 AS VARCHAR), 2, '0') AS site_id,
         CASE WHEN event_id % 2 = 0 THEN 'PM2.5' ELSE 'PM10' END AS pollutant_type,
         ts AS event_time,
         event_id,
         least(value * CAST(5.0 AS DOUBLE), CAST(500.0 AS DOUBLE)) AS concentration,
         event_type
  FROM events
)"""
LIMITS = """limits(pollutant_type, green_min, green_max, yellow_min, yellow_max,
               orange_min, orange_max, red_min, red_max) AS (
  SELECT CAST(column0 AS VARCHAR), CAST(column1 AS DOUBLE), CAST(column2 AS DOUBLE),
         CAST(column3 AS DOUBLE), CAST(column4 AS DOUBLE), CAST(column5 AS DOUBLE),
         CAST(column6 AS DOUBLE), CAST(column7 AS DOUBLE), CAST(column8 AS DOUBLE)
  FROM (VALUES ('PM2.5', 0, 100, 100, 350, 350, 430, 430, 1000),
               ('PM10', 0, 100, 100, 350, 350, 430, 430, 1000)) AS v(
       column0, column1, column2, column3, column4, column5, column6, column7, column8)
)"""
HOURLY = """hourly AS (
  SELECT site_id, pollutant_type, date_trunc('hour', event_time) AS start_time,
         avg(concentration) AS avg_value
  FROM readings GROUP BY ALL
)"""
CLASSIFIED = """classified AS (
  SELECT r.site_id, r.pollutant_type, r.event_time, r.event_id, r.concentration,
         CAST(CASE WHEN concentration >= red_min THEN 2
                   WHEN concentration >= orange_min THEN 1 ELSE 0 END AS INTEGER) AS severity
  FROM readings r LEFT JOIN limits USING (pollutant_type)
)"""
FIXED_ALERTS = """fixed_alerts AS (
  SELECT r.site_id, r.pollutant_type, r.event_time, r.concentration,
         r.concentration AS metric_value, 'hard_threshold' AS metric_name,
         CASE WHEN concentration >= red_min THEN 'red' ELSE 'orange' END AS alert_category
  FROM readings r JOIN limits USING (pollutant_type)
  WHERE concentration >= red_min
     OR (concentration >= orange_min AND concentration < orange_max)
)"""
ROUTED = """routed AS (
  SELECT *, CASE alert_category WHEN 'red' THEN 'alerts_severe'
                                ELSE 'alerts_internal' END AS topic
  FROM fixed_alerts
)"""
TRAINING = """windowed AS (
  SELECT * FROM classified
  WHERE event_time >= (SELECT max(event_time) - INTERVAL 15 DAY FROM readings)
), training AS (
  SELECT site_id, pollutant_type, event_time, event_id,
         concentration / CAST(1000.0 AS DOUBLE) AS concentration_norm,
         CAST(hour(event_time) AS INTEGER) AS hour,
         CAST(isodow(event_time) - 1 AS INTEGER) AS day_of_week,
         severity AS category,
         CAST(lead(severity, 1) OVER series AS DOUBLE) AS target_15m,
         CAST(lead(severity, 4) OVER series AS DOUBLE) AS target_1hr,
         CAST(lead(severity, 12) OVER series AS DOUBLE) AS target_3hr
  FROM windowed
  WINDOW series AS (PARTITION BY site_id, pollutant_type ORDER BY event_time, event_id)
)"""
LATER = ", ".join(
    f"""(SELECT CAST(arg_min(l.severity, (l.event_time, l.event_id)) AS DOUBLE) FROM windowed l
   WHERE l.site_id = w.site_id AND l.pollutant_type = w.pollutant_type
     AND l.event_time >= w.event_time + INTERVAL {HORIZON_SECONDS[name]} SECOND) AS {target}"""
    for name, target in TARGETS.items()
)
NUMBERED = """numbered AS MATERIALIZED (
  SELECT r.site_id, r.pollutant_type, r.event_time, r.event_id, r.concentration,
         epoch_us(r.event_time) AS at,
         row_number() OVER (PARTITION BY r.site_id, r.pollutant_type
                            ORDER BY r.event_time, r.event_id) AS rn
  FROM readings r
)"""
SMOOTHED = """smoothed AS (
  SELECT site_id, pollutant_type, event_time, event_id, concentration, rn,
         concentration AS ema
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.site_id, n.pollutant_type, n.event_time, n.event_id, n.concentration, n.rn,
         CAST(0.3 AS DOUBLE) * n.concentration + (CAST(1.0 AS DOUBLE) - CAST(0.3 AS DOUBLE)) * s.ema
  FROM smoothed s JOIN numbered n
    ON n.site_id = s.site_id AND n.pollutant_type = s.pollutant_type AND n.rn = s.rn + 1
)"""
EMA_ALERTS = f"""WITH RECURSIVE {READINGS}, {LIMITS}, {NUMBERED}, {SMOOTHED}
SELECT site_id, pollutant_type, event_time, concentration, round(ema, 6) AS metric_value,
       'ema' AS metric_name,
       CASE WHEN ema >= orange_min AND ema < orange_max THEN 'orange' ELSE 'red' END
         AS alert_category
FROM smoothed JOIN limits USING (pollutant_type)
WHERE (ema >= orange_min AND ema < orange_max) OR ema >= red_min"""
#: Sums of millionths above 0.8 times the orange limit, which is also the orange level.
SUMMED = """summed AS (
  SELECT site_id, pollutant_type, event_time, event_id, concentration, rn, orange_min, excess,
         greatest(0, excess) AS total
  FROM exceeding WHERE rn = 1
  UNION ALL
  SELECT n.site_id, n.pollutant_type, n.event_time, n.event_id, n.concentration, n.rn, n.orange_min, n.excess,
         greatest(0, s.total + n.excess)
  FROM summed s JOIN exceeding n
    ON n.site_id = s.site_id AND n.pollutant_type = s.pollutant_type AND n.rn = s.rn + 1
)"""
EXCEEDING = """exceeding AS MATERIALIZED (
  SELECT n.*, orange_min,
         CAST(round((concentration - orange_min * CAST(0.8 AS DOUBLE)) * CAST(1e6 AS DOUBLE)) AS BIGINT) AS excess
  FROM numbered n JOIN limits USING (pollutant_type)
)"""
CUSUM_ALERTS = f"""WITH RECURSIVE {READINGS}, {LIMITS}, {NUMBERED}, {EXCEEDING}, {SUMMED}
SELECT site_id, pollutant_type, event_time, concentration, total / CAST(1000000 AS DOUBLE) AS metric_value,
       'cusum' AS metric_name,
       CASE WHEN total >= orange_min * 2000000 THEN 'red' ELSE 'orange' END AS alert_category
FROM summed WHERE total >= orange_min * 1000000"""
HOURLY_ROWS = f"""WITH {READINGS}, {HOURLY}
SELECT site_id, pollutant_type, start_time, round(avg_value, 6) AS avg_value FROM hourly"""
RETAINED = f"""WITH {READINGS}, {HOURLY}
SELECT site_id, pollutant_type, start_time, round(avg_value, 6) AS avg_value FROM hourly
QUALIFY row_number() OVER (PARTITION BY site_id, pollutant_type ORDER BY start_time DESC) <= 25"""
DAILY_ROWS = f"""WITH {READINGS}, {HOURLY}
SELECT site_id, pollutant_type, CAST(CAST(start_time AS DATE) AS VARCHAR) AS log_date,
       round(avg(avg_value), 6) AS daily_avg
FROM hourly GROUP BY 1, 2, 3"""
DAILY_WEIGHTED = f"""WITH {READINGS}
SELECT site_id, pollutant_type, CAST(CAST(event_time AS DATE) AS VARCHAR) AS log_date,
       round(avg(concentration), 9) AS daily_avg, count(*) AS readings
FROM readings GROUP BY 1, 2, 3"""
ENVELOPES = f"""WITH {READINGS}, {LIMITS}, {FIXED_ALERTS}, {ROUTED}
SELECT site_id AS key,
       '{{"site_id":"' || site_id || '","pollutant_type":"' || pollutant_type
       || '","event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
       || '","concentration":' || CAST(concentration AS VARCHAR)
       || ',"metric_value":' || CAST(metric_value AS VARCHAR)
       || ',"metric_name":"' || metric_name
       || '","alert_category":"' || alert_category || '"}}' AS value,
       topic
FROM routed"""


def _fuzzy(max_time: int, delta: int) -> str:
    """One step per reading; the state is the two timers before and after it."""

    def line(limit: str, name: str) -> str:
        slope = f"((0 - {max_time}.0) / ({limit} - ({limit} - {delta}.0)))"
        return (
            f"CAST({slope} AS DOUBLE) AS {name}_slope, "
            f"{max_time}.0 - CAST({slope} AS DOUBLE) * ({limit} - {delta}.0) AS {name}_intercept"
        )

    def due(timer: str, name: str) -> str:
        started = f"(n.at - coalesce({timer}, n.at))"
        return (
            f"{started} / CAST(1000000.0 AS DOUBLE)"
            f" >= n.{name}_slope * n.concentration + n.{name}_intercept"
        )

    def step(orange: str, red: str, source: str) -> str:
        in_red = f"n.concentration < n.red_min AND n.concentration >= n.red_min - {delta}"
        in_orange = f"n.concentration < n.orange_min AND n.concentration >= n.orange_min - {delta}"
        fires_red, fires_orange = due(red, "red"), due(orange, "orange")
        return f"""
  SELECT n.site_id, n.pollutant_type, n.event_time, n.concentration, n.rn,
         CASE WHEN {in_orange} AND NOT ({fires_orange})
              THEN coalesce({orange}, n.at) END AS t_orange,
         CASE WHEN {in_red} AND NOT ({fires_red})
              THEN coalesce({red}, n.at) END AS t_red,
         CASE WHEN n.concentration >= n.red_min THEN 'red'
              WHEN n.concentration >= n.orange_min THEN 'orange' END AS fixed,
         CASE WHEN {in_red} AND {fires_red} THEN 'red'
              WHEN {in_orange} AND {fires_orange} THEN 'orange' END AS timed,
         (n.at - coalesce(CASE WHEN {in_red} THEN {red} ELSE {orange} END, n.at))
           / CAST(1000000.0 AS DOUBLE) AS elapsed
  FROM {source}"""

    unset = "CAST(NULL AS BIGINT)"
    first = step(unset, unset, "lined n WHERE n.rn = 1")
    following = step(
        "w.t_orange",
        "w.t_red",
        "walked w JOIN lined n ON n.site_id = w.site_id "
        "AND n.pollutant_type = w.pollutant_type AND n.rn = w.rn + 1",
    )
    return f"""WITH RECURSIVE {READINGS}, {LIMITS}, {NUMBERED}, lined AS MATERIALIZED (
  SELECT n.*, orange_min, red_min, {line("orange_min", "orange")}, {line("red_min", "red")}
  FROM numbered n JOIN limits USING (pollutant_type)
), walked AS ({first}
  UNION ALL {following}
)
SELECT site_id, pollutant_type, event_time, concentration, concentration AS metric_value,
       'hard_threshold' AS metric_name, fixed AS alert_category
FROM walked WHERE fixed IS NOT NULL
UNION ALL
SELECT site_id, pollutant_type, event_time, concentration, elapsed,
       'fuzzy_zone_' || timed || '_duration', timed
FROM walked WHERE timed IS NOT NULL"""


def _valid_messages(condition: str) -> str:
    return f"""WITH {READINGS}
SELECT CAST(event_id AS VARCHAR) AS sensor_id, site_id, pollutant_type, event_time, concentration,
       'µg/m³' AS unit
FROM readings WHERE {condition}"""


CELL_COUNTS = ", ".join(
    f"count(*) FILTER ({target} = {class_id}) AS rows_{name}_{class_id}"
    for name, target in TARGETS.items()
    for class_id in range(3)
)

CELLS = f"""cells AS (
  SELECT CASE WHEN concentration_norm >= 0.43 THEN 2 WHEN concentration_norm >= 0.35 THEN 1 ELSE 0 END AS bin,
         hour, day_of_week, {CELL_COUNTS}
  FROM training GROUP BY 1, 2, 3
)"""
MAJORITY = " UNION ALL ".join(
    f"""SELECT r.site_id, r.event_time, r.pollutant_type, '{name}' AS timescale,
       CASE WHEN rows_{name}_2 > rows_{name}_0 AND rows_{name}_2 > rows_{name}_1 THEN 'red'
            WHEN rows_{name}_1 > rows_{name}_0 THEN 'orange' ELSE 'green_yellow' END AS predicted_category
FROM readings r LEFT JOIN cells c
  ON c.bin = CASE WHEN r.concentration >= 430 THEN 2 WHEN r.concentration >= 350 THEN 1 ELSE 0 END
  AND c.hour = hour(r.event_time) AND c.day_of_week = isodow(r.event_time) - 1
"""
    for name in TARGETS
)

ORACLE = {
    "scan_readings": _valid_messages("true"),
    "parse_readings": _valid_messages("event_type NOT IN ('error', 'signup', 'click')"),
    "dead_letters": """SELECT CASE event_type WHEN 'error' THEN 'malformed_json'
            WHEN 'click' THEN 'missing_site_id' ELSE 'bad_timestamp' END AS reason,
       count(*) AS messages
FROM events WHERE event_type IN ('error', 'signup', 'click') GROUP BY 1""",
    "thresholds_dim": f"""WITH {READINGS}, {LIMITS}
SELECT pollutant_type, count(*) AS readings, green_min, green_max, yellow_min, yellow_max,
       orange_min, orange_max, red_min, red_max
FROM readings LEFT JOIN limits USING (pollutant_type) GROUP BY ALL""",
    "classify_readings": f"""WITH {READINGS}, {LIMITS}, {CLASSIFIED}
SELECT *, CASE severity WHEN 2 THEN 'red' WHEN 1 THEN 'orange' ELSE 'clean' END
         AS alert_category
FROM classified""",
    "threshold_alerts_internal": f"""WITH {READINGS}, {LIMITS}, {FIXED_ALERTS}
SELECT * FROM fixed_alerts WHERE alert_category = 'orange'""",
    "threshold_alerts_severe": f"""WITH {READINGS}, {LIMITS}, {FIXED_ALERTS}
SELECT * FROM fixed_alerts WHERE alert_category = 'red'""",
    "threshold_alerts": f"WITH {READINGS}, {LIMITS}, {FIXED_ALERTS} SELECT * FROM fixed_alerts",
    "alerts_routed": f"""WITH {READINGS}, {LIMITS}, {FIXED_ALERTS}, {ROUTED}
SELECT * FROM routed""",
    "alert_envelope": ENVELOPES,
    "hourly_avg": HOURLY_ROWS,
    "daily_rollup": DAILY_ROWS,
    "daily_upsert": DAILY_ROWS,
    "daily_weighted": DAILY_WEIGHTED,
    "stream_daily_weighted": DAILY_WEIGHTED,
    "hourly_retained": RETAINED,
    "hourly_upsert": HOURLY_ROWS,
    "latest_readings": f"""WITH {READINGS}
SELECT site_id, pollutant_type, event_time, event_id, concentration FROM readings
WHERE site_id = 'SITE_01'
QUALIFY row_number() OVER (PARTITION BY pollutant_type ORDER BY event_time DESC, event_id DESC)
        <= 50""",
    "ema_series": f"""WITH RECURSIVE {READINGS}, {NUMBERED}, {SMOOTHED}
SELECT site_id, pollutant_type, event_time, event_id, concentration, round(ema, 6) AS ema
FROM smoothed""",
    "ema_alerts": EMA_ALERTS,
    "fuzzy_alerts": _fuzzy(3600, 60),
    "fuzzy_alerts_shipped_settings": _fuzzy(14400, 10),
    "cusum_series": f"""WITH RECURSIVE {READINGS}, {LIMITS}, {NUMBERED}, {EXCEEDING}, {SUMMED}
SELECT site_id, pollutant_type, event_time, event_id, concentration,
       total / CAST(1000000 AS DOUBLE) AS cusum
FROM summed""",
    "cusum_alerts": CUSUM_ALERTS,
    "training_coverage": f"""WITH {READINGS}, span AS (
  SELECT min(event_time) AS min_time, max(event_time) AS max_time,
         (epoch_us(max(event_time)) - epoch_us(min(event_time)))
           / CAST(86400000000.0 AS DOUBLE) AS days
  FROM readings
)
SELECT min_time, max_time, round(days, 6) AS span_days, days >= 5 AS ready FROM span""",
    "training_window": f"""WITH {READINGS}
SELECT site_id, pollutant_type, event_time, event_id, concentration FROM readings
WHERE event_time >= (SELECT max(event_time) - INTERVAL 15 DAY FROM readings)""",
    "forecast_features": f"""WITH {READINGS}
SELECT site_id, pollutant_type, event_time, event_id, concentration,
       concentration / CAST(1000.0 AS DOUBLE) AS concentration_norm,
       CAST(hour(event_time) AS INTEGER) AS hour,
       CAST(isodow(event_time) - 1 AS INTEGER) AS day_of_week
FROM readings""",
    "forecast_training_set": f"""WITH {READINGS}, {LIMITS}, {CLASSIFIED}, {TRAINING}
SELECT * FROM training""",
    "forecast_training_set_by_time": f"""WITH {READINGS}, {LIMITS}, {CLASSIFIED}, windowed AS (
  SELECT * FROM classified
  WHERE event_time >= (SELECT max(event_time) - INTERVAL 15 DAY FROM readings)
)
SELECT site_id, pollutant_type, event_time, event_id,
       concentration / CAST(1000.0 AS DOUBLE) AS concentration_norm,
       CAST(hour(event_time) AS INTEGER) AS hour,
       CAST(isodow(event_time) - 1 AS INTEGER) AS day_of_week,
       severity AS category, {LATER}
FROM windowed w""",
    "label_balance": f"""WITH {READINGS}, {LIMITS}, {CLASSIFIED}, {TRAINING}, labels_ahead AS (
  SELECT '15min' AS timescale, target_15m AS target FROM training
  UNION ALL SELECT '1hr', target_1hr FROM training
  UNION ALL SELECT '3hr', target_3hr FROM training
)
SELECT timescale,
       count(*) FILTER (target = 0) AS class_0,
       count(*) FILTER (target = 1) AS class_1,
       count(*) FILTER (target = 2) AS class_2,
       CAST(count(DISTINCT target) AS INTEGER) AS classes
FROM labels_ahead GROUP BY 1""",
    "forecast_cells": f"WITH {READINGS}, {LIMITS}, {CLASSIFIED}, {TRAINING}, {CELLS} SELECT * FROM cells",
    "forecast_cells_maintained": f"WITH {READINGS}, {LIMITS}, {CLASSIFIED}, {TRAINING}, {CELLS} SELECT * FROM cells",
    "forecast_majority": f"WITH {READINGS}, {LIMITS}, {CLASSIFIED}, {TRAINING}, {CELLS} {MAJORITY}",
    "forecast_alerts": f"""WITH {READINGS}, {LIMITS}
SELECT r.site_id, r.pollutant_type, r.event_time, r.concentration,
       CASE WHEN concentration >= red_min THEN red_min ELSE orange_min END AS metric_value,
       'hard_threshold' AS metric_name,
       CASE WHEN concentration >= red_min THEN 'red' ELSE 'orange' END AS alert_category
FROM readings r JOIN limits USING (pollutant_type) WHERE concentration >= orange_min""",
    "stream_hourly_avg": HOURLY_ROWS,
    # Purchases come last, when the watermark stands two hours behind all else.
    "stream_hourly_late": f"""WITH {READINGS}, mark AS (
  SELECT max(event_time) - INTERVAL 2 HOUR AS mark FROM readings WHERE event_type <> 'purchase'
)
SELECT site_id, pollutant_type, date_trunc('hour', event_time) AS start_time,
       round(avg(concentration), 6) AS avg_value
FROM readings, mark
WHERE event_type <> 'purchase' OR date_trunc('hour', event_time) + INTERVAL 1 HOUR > mark
GROUP BY 1, 2, 3""",
    "stream_hourly_retained": RETAINED,
    "stream_ema_alerts": EMA_ALERTS,
    "stream_ema_from_history": EMA_ALERTS,
    "stream_ema_in_blocks": EMA_ALERTS,
    "stream_cusum_in_blocks": CUSUM_ALERTS,
    "stream_fuzzy_in_blocks": _fuzzy(3600, 60),
    "stream_one_pass": f"""WITH RECURSIVE {READINGS}, {LIMITS}, usable AS (
  SELECT r.*, max(event_time) FILTER (event_type <> 'purchase') OVER (PARTITION BY site_id, pollutant_type) AS reached
  FROM readings r WHERE event_type NOT IN ('error', 'signup', 'click')
), late AS (SELECT * FROM usable WHERE event_type = 'purchase' AND event_time < reached),
taken AS (SELECT * FROM usable WHERE event_id NOT IN (SELECT event_id FROM late)),
{NUMBERED.replace("FROM readings r", "FROM taken r")}, {SMOOTHED}, sent AS (
  SELECT CASE WHEN ema >= red_min THEN 'alerts_severe' ELSE 'alerts_internal' END AS topic, NULL AS reason
  FROM smoothed JOIN limits USING (pollutant_type)
  WHERE (ema >= orange_min AND ema < orange_max) OR ema >= red_min
  UNION ALL SELECT 'dead_letters', 'late_reading' FROM late
  UNION ALL SELECT 'dead_letters', CASE event_type WHEN 'error' THEN 'malformed_json'
                          WHEN 'click' THEN 'missing_site_id' ELSE 'bad_timestamp' END
  FROM readings WHERE event_type IN ('error', 'signup', 'click')
)
SELECT topic, reason, count(*) AS messages FROM sent GROUP BY 1, 2""",
    "stream_ema_state": f"""WITH RECURSIVE {READINGS}, {NUMBERED}, {SMOOTHED}
SELECT site_id, pollutant_type, round(ema, 6) AS ema, event_time AS last_at FROM smoothed
QUALIFY row_number() OVER (PARTITION BY site_id, pollutant_type ORDER BY rn DESC) = 1""",
    "stream_cusum_alerts": CUSUM_ALERTS,
    "stream_fuzzy_alerts": _fuzzy(3600, 60),
    "stream_fuzzy_from_history": _fuzzy(3600, 60),
    "stream_alerts_routed": ENVELOPES,
}
