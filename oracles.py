"""The registered queries in SQL, written independently of the Spark code: plain
window functions over whole series, three-way joins, recursion for the filter."""

from __future__ import annotations

SENSOR = """CASE WHEN event_type IN ('click', 'view') THEN 'IMU' WHEN event_type = 'error' THEN 'ENCODER'
  WHEN event_type = 'purchase' THEN 'GPS' ELSE 'LIDAR' END"""

BASE = f"""
tel AS (SELECT user_id % 8 AS robot_id, event_id, {SENSOR} AS sensor, ts, value,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
imu AS (SELECT robot_id, event_id, sensor, ts AS timestamp, value / 10 AS accel_x, -value / 20 AS accel_y,
  (k - 50) / 1000 AS gyro_z FROM tel WHERE sensor = 'IMU'),
enc AS (SELECT robot_id, event_id, sensor, ts AS timestamp, CAST(k * 10 AS BIGINT) AS ticks
  FROM tel WHERE sensor = 'ENCODER'),
gps AS (SELECT robot_id, event_id, sensor, ts AS timestamp,
  CASE WHEN event_id % 97 = 0 THEN CAST(900 AS DOUBLE) ELSE k / 100 + 40 END AS latitude,
  value / 1000 - 74 AS longitude FROM tel WHERE sensor = 'GPS')"""

HOUR = "time_bucket(INTERVAL 1 HOUR, timestamp)"


DIGITS = {
    "acceleration_mps2": 12, "kf_error_covariance_p": 7, "avg_accel_x": 9, "avg_accel_y": 9, "avg_gyro_z": 9,
    "spread_accel_x": 9, "spread_accel_y": 9, "vibration_index_x": 9, "variance_x": 9, "latitude": 9,
    "longitude": 9, "stddev_latitude": 9, "stddev_longitude": 9, "velocity_mps": 9, "fleet_rmse_drift": 4,
    "fleet_mae_drift": 4, "max_drift": 4, "drift_trend_per_day": 4,
}


def r(expression: str, name: str = "", digits: int | None = None) -> str:
    """Rounded like the Spark side; + 0.0 also turns -0.0 into 0.0."""
    name = name or expression
    digits = DIGITS.get(name, 6) if digits is None else digits
    return f"round({expression}, {digits}) + CAST(0 AS DOUBLE) AS {name}"


def rs(*names: str) -> str:
    return ", ".join(r(name) for name in names)


def seconds(later: str, earlier: str) -> str:
    return f"(epoch_us({later}) - epoch_us({earlier})) / CAST(1000000 AS DOUBLE)"


def silver(keys: str) -> str:
    """Hourly windows per sensor; ``keys`` is '' or 'robot_id, '."""
    return f"""
imu_h AS (SELECT {keys}{HOUR} AS timestamp, avg(accel_x) AS avg_accel_x,
  max(accel_x) - min(accel_x) AS spread_accel_x, stddev_samp(accel_x) AS vibration_index_x,
  avg(accel_y) AS avg_accel_y, max(accel_y) - min(accel_y) AS spread_accel_y, avg(gyro_z) AS avg_gyro_z
  FROM imu GROUP BY ALL),
enc_h AS (SELECT {keys}{HOUR} AS timestamp, CAST(sum(ticks) AS BIGINT) AS total_ticks_per_sec FROM enc GROUP BY ALL),
gps_h AS (SELECT {keys}{HOUR} AS timestamp, avg(latitude) AS latitude, avg(longitude) AS longitude
  FROM gps GROUP BY ALL),
aligned AS (SELECT * FROM imu_h LEFT JOIN enc_h USING ({keys}timestamp) LEFT JOIN gps_h USING ({keys}timestamp))"""


def by(keys: str, *more: str) -> str:
    columns = [*(keys.rstrip(", ").split(", ") if keys else []), *more]
    return f"PARTITION BY {', '.join(columns)} " if columns else ""


def metrics(keys: str) -> str:
    w = f"OVER ({by(keys)}ORDER BY timestamp)"
    return f"""{BASE}, {silver(keys)},
moving AS (SELECT *, total_ticks_per_sec * CAST(0.001745 AS DOUBLE) AS velocity_mps FROM aligned),
lagged AS (SELECT *, lag(velocity_mps) {w} AS pv, coalesce({seconds('timestamp', f'lag(timestamp) {w}')}, 0) AS dt
  FROM moving),
metrics AS (SELECT * EXCLUDE (pv, dt), CASE WHEN dt > 0 THEN (velocity_mps - pv) / dt
  ELSE CAST(0 AS DOUBLE) END AS acceleration_mps2 FROM lagged)"""


LIMITS = """limits AS (SELECT max(abs(avg_accel_x)) * CAST(0.6 AS DOUBLE) AS accel,
  max(total_ticks_per_sec) * CAST(0.001745 AS DOUBLE) * CAST(0.6 AS DOUBLE) AS speed FROM aligned)"""
DYNAMIC = "abs(avg_accel_x) <= (SELECT accel FROM limits) AND velocity_mps <= (SELECT speed FROM limits)"


def master(keys: str) -> str:
    return f"""{metrics(keys)}, {LIMITS},
master AS (SELECT * FROM metrics WHERE timestamp IS NOT NULL AND abs(latitude) <= 90 AND abs(longitude) <= 180
  AND {DYNAMIC})"""


def features(keys: str, gap: int, axes: str = "code", zero_gap: bool = False, reset: bool = True) -> str:
    w = f"({by(keys)}ORDER BY timestamp)"
    here = f"({by(keys, 'session_id')}ORDER BY timestamp ROWS UNBOUNDED PRECEDING)"
    turning = here if reset else f"({by(keys)}ORDER BY timestamp ROWS UNBOUNDED PRECEDING)"
    dt = "coalesce(dt0, 0)" if not zero_gap else "CASE WHEN opens = 1 THEN 0 ELSE dt0 END"
    north = f"(latitude - first(latitude) OVER {here}) * 111000"
    east = f"(longitude - first(longitude) OVER {here}) * (CAST(111000 AS DOUBLE) * CAST(0.7 AS DOUBLE))"
    ax, ay = (north, east) if axes == "code" else (east, north)
    return f"""{master(keys)},
f0 AS (SELECT *, {seconds('timestamp', f'lag(timestamp) OVER {w}')} AS dt0 FROM master),
f1 AS (SELECT *, CASE WHEN dt0 IS NULL OR dt0 > {gap} THEN 1 ELSE 0 END AS opens FROM f0),
f2 AS (SELECT *, CAST(sum(opens) OVER {w} AS BIGINT) AS session_id, {dt} AS dt FROM f1),
f3 AS (SELECT *, sum(radians(avg_gyro_z) * dt) OVER {turning} AS heading_theta FROM f2),
f4 AS (SELECT *, sum(velocity_mps * cos(heading_theta) * dt) OVER {here} AS feature_estimated_path_x,
  sum(velocity_mps * sin(heading_theta) * dt) OVER {here} AS feature_estimated_path_y,
  {ax} AS feature_actual_path_x, {ay} AS feature_actual_path_y FROM f3),
features AS (SELECT * EXCLUDE (dt0, opens, dt, heading_theta), sqrt(
  pow(feature_actual_path_x - feature_estimated_path_x, 2)
  + pow(feature_actual_path_y - feature_estimated_path_y, 2)) AS target_trajectory_drift_meters FROM f4)"""


def far(*names: str) -> str:
    """Paths of hourly steps, which reach thousands of kilometres."""
    return ", ".join(r(name, digits=4) for name in names)


IMU_COLUMNS = (
    "avg_accel_x", "spread_accel_x", "vibration_index_x", "avg_accel_y", "spread_accel_y", "avg_gyro_z",
)
MASTER_COLUMNS = (*IMU_COLUMNS, "latitude", "longitude", "velocity_mps", "acceleration_mps2")
EST = ("feature_estimated_path_x", "feature_estimated_path_y")
ACT = ("feature_actual_path_x", "feature_actual_path_y")
DRIFT = "target_trajectory_drift_meters"
UNKEYED, KEYED, GAP, ROBOT_GAP = "", "robot_id, ", 7200, 86400

HISTORY = """
v AS (SELECT DISTINCT user_id, ts, event_type, value FROM events),
one AS (SELECT user_id, ts, min(struct_pack(event_type := event_type, value := value)) AS s FROM v GROUP BY ALL),
history AS (SELECT user_id, ts, s.event_type AS event_type, s.value AS value, ts AS "__START_AT",
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT" FROM one)"""

FLAGS = """
flags AS (SELECT robot_id, event_id, ts AS timestamp, CAST(sensor = 'IMU' AS INT) AS imu_computed,
  CAST(sensor = 'ENCODER' AS INT) AS encoder_computed, CAST(sensor = 'GPS' AS INT) AS gps_computed,
  accel_x, accel_y, gyro_z, ticks, latitude, longitude
  FROM tel LEFT JOIN (SELECT event_id, accel_x, accel_y, gyro_z FROM imu) USING (event_id)
  LEFT JOIN (SELECT event_id, ticks FROM enc) USING (event_id)
  LEFT JOIN (SELECT event_id, latitude, longitude FROM gps) USING (event_id) WHERE sensor <> 'LIDAR')"""

READINGS = ("accel_x", "accel_y", "gyro_z", "latitude", "longitude")


def sessions(keys: str, source: str, gap: int, order: str = "timestamp, event_id") -> str:
    w = f"({by(keys)}ORDER BY {order})"
    return f"""
s0 AS (SELECT *, {seconds('timestamp', f'lag(timestamp) OVER {w}')} AS dt FROM {source}),
s1 AS (SELECT *, CASE WHEN dt IS NULL OR dt > {gap} THEN 1 ELSE 0 END AS opens FROM s0),
sessions AS (SELECT * EXCLUDE (dt, opens), CAST(sum(opens) OVER {w} AS BIGINT) AS session_id FROM s1)"""


# Event-level dead reckoning per robot: previous IMU and encoder events within the
# session by a window per flag, heading over the whole series.
RECKONED = f"""{BASE}, {FLAGS}, {sessions(KEYED, 'flags', GAP)},
e1 AS (SELECT *, min(timestamp) OVER (PARTITION BY robot_id, session_id) AS session_start,
  CASE WHEN imu_computed = 1 THEN {seconds('timestamp', 'lag(timestamp) OVER p')} END AS imu_dt,
  CASE WHEN encoder_computed = 1 THEN {seconds('timestamp', 'lag(timestamp) OVER p')} END AS enc_dt
  FROM sessions WINDOW p AS (PARTITION BY robot_id, session_id, imu_computed, encoder_computed
    ORDER BY timestamp, event_id)),
e2 AS (SELECT *, coalesce(radians(gyro_z) * imu_dt, 0) AS turn, ticks * CAST(0.001745 AS DOUBLE) AS metres,
  CASE WHEN enc_dt > 0 THEN ticks * CAST(0.001745 AS DOUBLE) / enc_dt END AS velocity_mps FROM e1),
e3 AS (SELECT *, sum(turn) OVER (PARTITION BY robot_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING)
  AS heading_theta, (velocity_mps - lag(velocity_mps) OVER (PARTITION BY robot_id, session_id, encoder_computed
  ORDER BY timestamp, event_id)) / enc_dt AS acceleration_mps2 FROM e2),
reckoned AS (SELECT *,
  sum(coalesce(metres, 0) * cos(heading_theta)) OVER s AS feature_estimated_path_x,
  sum(coalesce(metres, 0) * sin(heading_theta)) OVER s AS feature_estimated_path_y,
  {seconds('timestamp', 'session_start')} AS age
  FROM e3 WINDOW s AS (PARTITION BY robot_id, session_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING))"""

# The filter row by row, as it is defined: predict by the motion, correct at fixes.
FUSED = f"""WITH RECURSIVE {RECKONED},
k0 AS (SELECT *, gps_computed = 1 AND abs(latitude) <= 90 AND abs(longitude) <= 180 AS fix FROM reckoned),
k1 AS (SELECT *, first(CASE WHEN fix THEN latitude END IGNORE NULLS) OVER s AS lat0,
  first(CASE WHEN fix THEN longitude END IGNORE NULLS) OVER s AS lon0,
  row_number() OVER s AS n FROM k0
  WINDOW s AS (PARTITION BY robot_id, session_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING)),
k2 AS MATERIALIZED (SELECT robot_id, event_id, session_id, n, fix, age,
  feature_estimated_path_x AS ex, feature_estimated_path_y AS ey,
  (latitude - lat0) * 111000 AS zx, (longitude - lon0) * (CAST(111000 AS DOUBLE) * CAST(0.7 AS DOUBLE)) AS zy,
  feature_estimated_path_x - coalesce(lag(feature_estimated_path_x) OVER s, 0) AS dx,
  feature_estimated_path_y - coalesce(lag(feature_estimated_path_y) OVER s, 0) AS dy,
  age - coalesce(lag(age) OVER s, 0) AS dt
  FROM k1 WINDOW s AS (PARTITION BY robot_id, session_id ORDER BY n)),
kf AS (
  SELECT robot_id, session_id, CAST(0 AS BIGINT) AS n, CAST(0 AS DOUBLE) AS x, CAST(0 AS DOUBLE) AS y,
    CAST(1 AS DOUBLE) AS p FROM k2 WHERE n = 1
  UNION ALL
  SELECT k2.robot_id, k2.session_id, k2.n,
    CASE WHEN fix THEN kf.x + dx + (p + dt / 2) / (p + dt / 2 + 25) * (zx - kf.x - dx) ELSE kf.x + dx END,
    CASE WHEN fix THEN kf.y + dy + (p + dt / 2) / (p + dt / 2 + 25) * (zy - kf.y - dy) ELSE kf.y + dy END,
    CASE WHEN fix THEN (1 - (p + dt / 2) / (p + dt / 2 + 25)) * (p + dt / 2) ELSE p + dt / 2 END
  FROM kf JOIN k2 ON k2.robot_id = kf.robot_id AND k2.session_id = kf.session_id AND k2.n = kf.n + 1),
fused AS (SELECT k2.*, x, y, p FROM kf JOIN k2 USING (robot_id, session_id, n))"""

TERRAIN = """terrain AS (SELECT *, vibration_index_x * vibration_index_x AS variance_x,
  CASE WHEN vibration_index_x >= 6 THEN 'rough terrain' WHEN spread_accel_x >= 6 THEN 'pothole'
    WHEN abs(avg_gyro_z) >= CAST(0.005 AS DOUBLE) AND abs(acceleration_mps2) <= CAST(0.001 AS DOUBLE)
    THEN 'black ice' ELSE 'normal' END AS terrain FROM {source})"""


def voted(keys: str) -> str:
    hazard = "list_position(['normal', 'rough terrain', 'pothole', 'black ice'], terrain)"
    return f"""votes AS (SELECT {keys}session_id, terrain, count(*) AS votes FROM terrain GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER ({by(keys, 'session_id')}ORDER BY votes DESC, {hazard} DESC) AS place,
  CAST(sum(votes) OVER ({by(keys, 'session_id')}) AS BIGINT) AS session_seconds FROM votes),
labels AS (SELECT {keys}session_id, terrain AS session_terrain, votes AS terrain_seconds, session_seconds
  FROM ranked WHERE place = 1)"""


FLAGGED = f"""{features(UNKEYED, GAP)},
g0 AS (SELECT *, avg({DRIFT}) OVER s AS mean, stddev_samp({DRIFT}) OVER s AS deviation
  FROM features WINDOW s AS (PARTITION BY session_id)),
g1 AS (SELECT *, CASE WHEN abs(avg_accel_x) <= 6 THEN 0 ELSE 1 END
  + CASE WHEN abs(acceleration_mps2) <= CAST(0.0005 AS DOUBLE) THEN 0 ELSE 1 END AS rule_violations,
  CASE WHEN deviation > 0 THEN ({DRIFT} - mean) / deviation END AS z_score FROM g0),
flagged AS (SELECT *, CASE WHEN rule_violations > 0 OR abs(z_score) > 1.5 THEN 1 ELSE 0 END AS is_anomaly FROM g1)"""

PRUNABLE = f"""{FLAGGED},
boring AS (SELECT timestamp FROM flagged WHERE {DRIFT} <= 60000
  AND vibration_index_x * vibration_index_x <= 40 AND is_anomaly = 0)"""

MANIFEST = f"""{PRUNABLE},
events_h AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS timestamp, count(*) AS n FROM tel GROUP BY ALL),
islands AS (SELECT timestamp, n, timestamp - row_number() OVER (ORDER BY timestamp) * INTERVAL 1 HOUR AS island
  FROM boring LEFT JOIN events_h USING (timestamp)),
manifest AS (SELECT min(timestamp) AS seg_start, max(timestamp) + INTERVAL 1 HOUR AS seg_end, count(*) AS seconds,
  CAST(sum(coalesce(n, 0)) AS BIGINT) AS raw_rows, 'zero drift, low variance' AS reason
  FROM islands GROUP BY island)"""

KPIS = f"""{features(KEYED, ROBOT_GAP)},
kpis AS (SELECT robot_id, session_id,
  CASE GROUPING(robot_id, session_id) WHEN 0 THEN 'session' WHEN 1 THEN 'robot' ELSE 'fleet' END AS level,
  count(*) AS seconds, sqrt(avg({DRIFT} * {DRIFT})) AS fleet_rmse_drift, avg(abs({DRIFT})) AS fleet_mae_drift,
  max({DRIFT}) AS max_drift, min(timestamp) AS session_start, max(timestamp) AS session_end
  FROM features GROUP BY ROLLUP (robot_id, session_id) HAVING count(*) > 0)"""

SESSION_EVENTS = f"{BASE}, {FLAGS}, {sessions(KEYED, 'flags', GAP)}"


GATED = """gated AS (SELECT event_id, latitude <= 40.5 AS north, longitude < -73.8 AS west,
  abs(latitude) <= 90 AS on_earth FROM gps)"""
GATE_SUMS = """count(*) FILTER (NOT (north AND west AND on_earth)) AS dropped, count(*) FILTER (NOT north) AS north,
  count(*) FILTER (NOT west) AS west, count(*) FILTER (NOT on_earth) AS on_earth"""
STREAMED = """marks AS (SELECT *, ts AS timestamp, CAST(epoch_us(ts) - epoch_us(lag(ts) OVER ({by}ORDER BY ts)) <= {gap} * 1000000::BIGINT AS INT)
  AS same FROM tel),
numbered AS (SELECT *, CAST(sum(1 - coalesce(same, 0)) OVER ({by}ORDER BY ts) AS BIGINT) AS session_id FROM marks)"""

# Queries that cut their series give what the plain ones give.
SAME = {
    "ordered_lag_chunked": "ordered_lag",
    "running_sum_chunked": "running_sum",
    "scd2_history_chunked": "scd2_history",
    "scd2_incremental": "scd2_history",
    "view_refresh": "materialized_view",
    "sessionize_ntz": "sessionize",
    "ml_features_chunked": "ml_features",
    "kalman_fused_chunked": "kalman_fused",
}


def all_oracles() -> dict[str, str]:
    sql = _oracles()
    return {**sql, **{name: sql[plain] for name, plain in SAME.items()}}


def _oracles() -> dict[str, str]:
    base, w = f"WITH {BASE}", "WITH "
    imu_rounded = rs("accel_x", "accel_y", "gyro_z")
    return {
        "bronze_imu": f"{base} SELECT robot_id, event_id, sensor, {imu_rounded}, timestamp FROM imu",
        "bronze_encoder": f"{base} SELECT robot_id, event_id, sensor, ticks, timestamp FROM enc",
        "bronze_gps": f"{base} SELECT robot_id, event_id, sensor, {rs('latitude', 'longitude')}, timestamp FROM gps",
        "raw_rescue": f"""{base}, line AS (SELECT *, event_id % 50 = 1 AS cut,
  sensor = 'ENCODER' AND event_id % 7 = 0 AS unread FROM tel)
SELECT event_id, CASE WHEN NOT cut THEN sensor END AS sensor, CASE WHEN NOT cut THEN ts END AS ts,
  round(CASE WHEN NOT cut AND sensor = 'IMU' THEN value / 10 END, 6) AS accel_x,
  CASE WHEN NOT cut AND sensor = 'ENCODER' AND NOT unread THEN CAST(k * 10 AS BIGINT) END AS ticks,
  CASE WHEN NOT cut AND event_id % 5 = 0 THEN 'v2' END AS firmware,
  CASE WHEN NOT cut AND sensor = 'LIDAR' THEN CAST(event_id % 100 AS VARCHAR) END AS range_m,
  CASE WHEN NOT cut AND unread THEN 'n/a' END AS unread_ticks,
  CASE WHEN cut THEN 0 ELSE CAST(event_id % 5 = 0 AS INT) + CAST(sensor = 'LIDAR' AS INT) + CAST(unread AS INT)
    END AS rescued, CAST(cut AS INT) AS malformed FROM line""",
        "json_landing": f"""{base}, line AS (SELECT *, event_id % 50 = 1 AS cut,
  sensor = 'ENCODER' AND event_id % 7 = 0 AS unread FROM tel)
SELECT CASE WHEN NOT cut THEN sensor END AS sensor, CASE WHEN NOT cut THEN ts END AS ts,
  round(CASE WHEN NOT cut AND sensor = 'IMU' THEN value / 10 END, 6) AS accel_x,
  CASE WHEN NOT cut AND sensor = 'ENCODER' AND NOT unread THEN CAST(k * 10 AS BIGINT) END AS ticks,
  CASE WHEN cut THEN 0 ELSE CAST(event_id % 5 = 0 AS INT) + CAST(sensor = 'LIDAR' AS INT) + CAST(unread AS INT)
    END AS rescued, CAST(cut AS INT) AS malformed,
  CASE WHEN NOT cut THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS day FROM line""",
        "fixture_csv": f"""{base} SELECT CAST(robot_id AS VARCHAR) AS robot_id, sensor, CAST(ticks AS VARCHAR) AS ticks FROM enc""",
        "temporary_view": f"""{base} SELECT robot_id, count(*) FILTER (abs(latitude) <= 90) AS fixes, count(*) AS readings
  FROM gps GROUP BY robot_id""",
        "stream_table": f"""{base}, {silver(KEYED)} SELECT * FROM enc_h
  WHERE timestamp + INTERVAL 1 HOUR <= (SELECT max(timestamp) FROM enc) - INTERVAL 1 MINUTE""",
        "landing_day": f"""{base} SELECT sensor, count(*) AS events, min(ts) AS first_ts, max(ts) AS last_ts FROM tel
  WHERE event_id % 50 <> 1 AND CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY ALL""",
        "stream_gates": f"{base}, {GATED} SELECT count(*) AS rows, {GATE_SUMS} FROM gated",
        "stream_gate_log": f"""{base}, {GATED}, sums AS (SELECT count(*) AS rows, {GATE_SUMS} FROM gated)
  SELECT measure, counted FROM sums UNPIVOT (counted FOR measure IN (rows, dropped, north, west, on_earth))""",
        "stream_quarantine": f"""{base}, {GATED} SELECT event_id, CASE WHEN north AND west AND on_earth THEN 'kept'
  ELSE 'quarantined' END AS route, concat_ws(',', CASE WHEN NOT north THEN 'north' END,
  CASE WHEN NOT west THEN 'west' END, CASE WHEN NOT on_earth THEN 'on_earth' END) AS broken FROM gated""",
        "late_rows": f"""{base} SELECT event_id, sensor, CASE WHEN sensor = 'LIDAR' AND time_bucket(INTERVAL 1 HOUR, ts)
  + INTERVAL 1 HOUR <= (SELECT max(ts) FROM tel WHERE sensor <> 'LIDAR') - INTERVAL 1 MINUTE
  THEN 'late' ELSE 'kept' END AS route FROM tel""",
        "stream_session_ids": f"""{base}, {STREAMED.format(by='PARTITION BY robot_id ', gap=7200)}
  SELECT robot_id, event_id, timestamp, session_id FROM numbered
  WHERE timestamp <= (SELECT date_trunc('millisecond', max(ts)) FROM tel) - INTERVAL 1 MINUTE""",
        "stream_session_ids_unkeyed": f"""{base}, {STREAMED.format(by='', gap=1200)}
  SELECT event_id, timestamp, session_id FROM numbered
  WHERE timestamp <= (SELECT date_trunc('millisecond', max(ts)) FROM tel) - INTERVAL 1 MINUTE""",
        "sensor_counts": f"{base} SELECT sensor, count(*) AS events FROM tel GROUP BY ALL",
        "null_profile": f"""{base} SELECT sensor, count(*) AS events,
  count(*) FILTER (sensor <> 'IMU') AS null_accel_x, count(*) FILTER (sensor <> 'IMU') AS null_accel_y,
  count(*) FILTER (sensor <> 'IMU') AS null_gyro_z, count(*) FILTER (sensor <> 'ENCODER') AS null_ticks,
  count(*) FILTER (sensor <> 'GPS') AS null_lat, count(*) FILTER (sensor <> 'GPS') AS null_lon
  FROM tel GROUP BY ALL""",
        "quality_bounds": f"""{base} SELECT event_id, sensor, {rs('latitude', 'longitude')}, timestamp FROM gps
  WHERE abs(latitude) <= 90 AND abs(longitude) <= 180""",
        "acceleration_bounds": f"""{base} SELECT event_id, sensor, {imu_rounded}, timestamp FROM imu
  WHERE abs(accel_x) <= 8 AND abs(accel_y) <= 8""",
        "quality_gates": f"""{w}{metrics(UNKEYED)} SELECT timestamp, {rs('avg_accel_x', 'latitude', 'velocity_mps')}
  FROM metrics WHERE timestamp IS NOT NULL AND coalesce(abs(latitude) <= 90 AND abs(longitude) <= 180, true)
  AND coalesce(abs(avg_accel_x) <= 15, true) AND coalesce(velocity_mps <= 45, true)""",
        "dynamic_rules": f"""{w}{metrics(UNKEYED)}, {LIMITS}
  SELECT timestamp, {rs('avg_accel_x', 'velocity_mps')} FROM metrics WHERE {DYNAMIC}""",
        "resample_imu": f"""{base}, {silver(UNKEYED)}, n AS (SELECT {HOUR} AS timestamp, count(*) AS sample_count
  FROM imu GROUP BY ALL) SELECT timestamp, {rs(*IMU_COLUMNS)}, sample_count FROM imu_h JOIN n USING (timestamp)""",
        "resample_imu_1s": f"""{base}, one AS (SELECT robot_id, date_trunc('second', timestamp) AS timestamp,
  avg(accel_x) AS avg_accel_x, max(accel_x) - min(accel_x) AS spread_accel_x,
  stddev_samp(accel_x) AS vibration_index_x, avg(accel_y) AS avg_accel_y,
  max(accel_y) - min(accel_y) AS spread_accel_y, avg(gyro_z) AS avg_gyro_z, count(*) AS sample_count
  FROM imu GROUP BY ALL) SELECT robot_id, timestamp, {rs(*IMU_COLUMNS)}, sample_count FROM one""",
        "resample_encoder": f"{base}, {silver(KEYED)} SELECT * FROM enc_h",
        "resample_encoder_cumulative": f"""{base} SELECT {HOUR} AS timestamp,
  max(ticks) - min(ticks) AS total_ticks_per_sec FROM enc GROUP BY ALL""",
        "resample_gps": f"""{base}, {silver(KEYED)} SELECT robot_id, timestamp, {rs('latitude', 'longitude')}
  FROM gps_h""",
        "gps_stability": f"""{base}, one AS (SELECT {HOUR} AS timestamp, avg(latitude) AS latitude,
  avg(longitude) AS longitude, stddev_samp(latitude) AS stddev_latitude, stddev_samp(longitude) AS stddev_longitude
  FROM gps GROUP BY ALL)
  SELECT timestamp, {rs('latitude', 'longitude', 'stddev_latitude', 'stddev_longitude')} FROM one""",
        "scd2_history": f"{w}{HISTORY} SELECT * FROM history",
        "expect_or_drop": f"""{base} SELECT event_id, sensor, {rs('latitude', 'longitude')}, timestamp FROM gps
  WHERE latitude > 0""",
        "fallback_rules": f"""{w}{metrics(UNKEYED)} SELECT timestamp, {rs('avg_accel_x', 'velocity_mps')} FROM metrics
  WHERE abs(avg_accel_x) <= 15 AND velocity_mps <= 45""",
        "ordered_lead_chunked": """SELECT event_id, ts, value, lead(value) OVER w AS next_value,
  lead(ts) OVER w AS next_ts FROM events WINDOW w AS (ORDER BY ts, event_id)""",
        "fill_gaps_drop": f"""{base}, {silver(KEYED)} SELECT robot_id, timestamp, {rs('latitude', 'longitude')},
  total_ticks_per_sec FROM aligned WHERE latitude IS NOT NULL AND total_ticks_per_sec IS NOT NULL""",
        "scd2_current": f"""{w}{HISTORY} SELECT * EXCLUDE ("__START_AT", "__END_AT") FROM history
  WHERE "__END_AT" IS NULL""",
        "scd2_as_of": f"""{w}{HISTORY} SELECT * FROM history WHERE "__START_AT" <= TIMESTAMP '2024-01-15'
  AND ("__END_AT" IS NULL OR "__END_AT" > TIMESTAMP '2024-01-15')""",
        "scd2_silver": f"""{base}, {silver(UNKEYED)} SELECT timestamp, {rs(*IMU_COLUMNS)},
  timestamp AS "__START_AT", CAST(NULL AS TIMESTAMP) AS "__END_AT" FROM imu_h""",
        "event_stream_flags": f"""{base}, {FLAGS} SELECT robot_id, event_id, timestamp, imu_computed,
  encoder_computed, gps_computed, {rs(*READINGS)}, ticks FROM flags""",
        "event_stream_coalesced": f"""{base}, {FLAGS} SELECT robot_id, date_trunc('minute', timestamp) AS timestamp,
  max(imu_computed) AS imu_computed, max(encoder_computed) AS encoder_computed, max(gps_computed) AS gps_computed,
  {', '.join(r(f'max({name})', name) for name in READINGS)}, max(ticks) AS ticks
  FROM flags GROUP BY robot_id, date_trunc('minute', timestamp)""",
        "stream_bronze_gps": f"""{base} SELECT event_id, sensor, {rs('latitude', 'longitude')}, timestamp
  FROM gps""",
        "stream_resample_imu": f"""{base}, {silver(UNKEYED)} SELECT timestamp, {rs(*IMU_COLUMNS)} FROM imu_h
  WHERE timestamp + INTERVAL 1 HOUR <= (SELECT max(timestamp) FROM imu) - INTERVAL 1 MINUTE""",
        "stream_session_summary": f"""{w}{SESSION_EVENTS}, done AS (SELECT robot_id, session_id,
  min(timestamp) AS session_start, max(timestamp) AS session_end, count(*) AS events FROM sessions GROUP BY ALL)
  SELECT robot_id, session_start, session_end, events FROM done
  WHERE session_end + INTERVAL 2 HOUR <= (SELECT max(timestamp) FROM flags) - INTERVAL 1 MINUTE""",
        "ordered_lag": """SELECT event_id, user_id, ts, value, lag(value) OVER w AS prev_value,
  lag(ts) OVER w AS prev_ts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
        "running_sum": f"""{base} SELECT *, CAST(sum(ticks) OVER (PARTITION BY robot_id ORDER BY timestamp, event_id
  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS odometer FROM enc""",
        "running_first": f"""{base}, o AS (SELECT *, first(latitude) OVER w AS origin_lat,
  first(longitude) OVER w AS origin_lon FROM gps
  WINDOW w AS (PARTITION BY robot_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING))
  SELECT robot_id, event_id, sensor, {rs('latitude', 'longitude', 'origin_lat', 'origin_lon')}, timestamp FROM o""",
        "fill_gaps": f"""{base}, {silver(KEYED)}, filled AS (SELECT robot_id, timestamp,
  last_value(latitude IGNORE NULLS) OVER w AS latitude, last_value(longitude IGNORE NULLS) OVER w AS longitude,
  last_value(total_ticks_per_sec IGNORE NULLS) OVER w AS total_ticks_per_sec FROM aligned
  WINDOW w AS (PARTITION BY robot_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING))
  SELECT robot_id, timestamp, {rs('latitude', 'longitude')}, total_ticks_per_sec FROM filled""",
        "sessionize": f"""{base}, raw AS (SELECT robot_id, event_id, ts AS timestamp FROM tel),
  {sessions(KEYED, 'raw', GAP)} SELECT * FROM sessions""",
        "sessionize_two_level": f"""{base}, raw AS (SELECT event_id, ts AS timestamp FROM tel),
  {sessions(UNKEYED, 'raw', 600)} SELECT * FROM sessions""",
        "session_summary": f"""{w}{SESSION_EVENTS}, done AS (SELECT robot_id, session_id,
  min(timestamp) AS session_start, max(timestamp) AS session_end, count(*) AS events,
  CAST(sum(gps_computed) AS BIGINT) AS fixes FROM sessions GROUP BY ALL)
  SELECT robot_id, session_start, session_end, events, fixes FROM done""",
        "aligned_join": f"""{base}, {silver(KEYED)} SELECT robot_id, timestamp, {rs(*IMU_COLUMNS)},
  total_ticks_per_sec, {rs('latitude', 'longitude')} FROM aligned""",
        "aligned_one_pass": f"""{base}, {silver(KEYED)} SELECT robot_id, timestamp, {rs(*IMU_COLUMNS)},
  total_ticks_per_sec, {rs('latitude', 'longitude')} FROM aligned""",
        "delta_seconds": f"""{base}, {silver(KEYED)} SELECT robot_id, timestamp, coalesce(
  {seconds('timestamp', 'lag(timestamp) OVER (PARTITION BY robot_id ORDER BY timestamp)')}, 0) AS delta_t_sec
  FROM imu_h""",
        "kinetic_metrics": f"""{w}{metrics(UNKEYED)} SELECT timestamp, {rs(*MASTER_COLUMNS)}, total_ticks_per_sec
  FROM metrics""",
        "kinetic_master": f"""{w}{master(UNKEYED)} SELECT timestamp, {rs(*MASTER_COLUMNS)}, total_ticks_per_sec
  FROM master""",
        "heading": f"""{w}{features(UNKEYED, GAP)} SELECT timestamp, session_id, {r('heading_theta')} FROM f3""",
        "heading_global": f"""{w}{features(KEYED, ROBOT_GAP, zero_gap=True, reset=False)}
  SELECT robot_id, timestamp, session_id, {r('heading_theta')} FROM f3""",
        "estimated_path": f"{w}{features(UNKEYED, GAP)} SELECT timestamp, session_id, {far(*EST)} FROM features",
        "actual_path": f"{w}{features(UNKEYED, GAP)} SELECT timestamp, session_id, {rs(*ACT)} FROM features",
        "trajectory_drift": f"""{w}{features(UNKEYED, GAP, 'east_north', True)}
  SELECT timestamp, session_id, {far(DRIFT)} FROM features""",
        "ml_features": f"""{w}{features(UNKEYED, GAP)} SELECT timestamp, session_id, total_ticks_per_sec,
  {rs(*MASTER_COLUMNS, *ACT)}, {far(*EST, DRIFT)} FROM features""",
        "ml_features_keyed": f"""{w}{features(KEYED, ROBOT_GAP)} SELECT robot_id, timestamp, session_id,
  total_ticks_per_sec, {rs(*MASTER_COLUMNS, *ACT)}, {far(*EST, DRIFT)} FROM features""",
        "dead_reckoned_events": f"""{w}{RECKONED} SELECT robot_id, event_id, session_id,
  {rs('velocity_mps', 'acceleration_mps2', 'heading_theta', *EST)} FROM reckoned""",
        "kalman_predicted": f"""{w}{RECKONED} SELECT robot_id, event_id, {r(EST[0], 'kf_state_x')},
  {r(EST[1], 'kf_state_y')}, {r('1 + age / 2', 'kf_error_covariance_p')} FROM reckoned""",
        "kalman_fused": f"""{FUSED} SELECT robot_id, event_id, session_id, {r('x', 'kf_state_x', 4)},
  {r('y', 'kf_state_y', 4)}, {r('p', 'kf_error_covariance_p')} FROM fused""",
        "localization_features": f"""{FUSED} SELECT robot_id, event_id, session_id, {r('ex', EST[0])},
  {r('ey', EST[1])}, {r('x', 'feature_corrected_path_x', 4)}, {r('y', 'feature_corrected_path_y', 4)},
  {r('sqrt(pow(ex - x, 2) + pow(ey - y, 2))', DRIFT, 4)} FROM fused""",
        "fleet_kpis": f"""{w}{KPIS} SELECT robot_id, session_id, level, seconds,
  {rs('fleet_rmse_drift', 'fleet_mae_drift', 'max_drift')}, session_start, session_end FROM kpis""",
        "drift_trend": f"""{w}{KPIS} SELECT robot_id, count(*) AS sessions, {r(
            "regr_slope(fleet_rmse_drift, epoch_us(session_start) / CAST(86400000000 AS DOUBLE))",
            'drift_trend_per_day')} FROM kpis WHERE level = 'session' GROUP BY robot_id""",
        "terrain": f"""{w}{master(UNKEYED)}, {TERRAIN.format(source='master')}
  SELECT timestamp, {r('variance_x')}, terrain FROM terrain""",
        "session_terrain": f"""{w}{features(UNKEYED, GAP)}, {TERRAIN.format(source='features')}, {voted(UNKEYED)}
  SELECT * FROM labels""",
        "terrain_features": f"""{w}{features(KEYED, ROBOT_GAP)}, {TERRAIN.format(source='features')}, {voted(KEYED)}
  SELECT robot_id, timestamp, session_id, session_terrain FROM features LEFT JOIN labels USING (robot_id, session_id)""",
        "anomaly_flags": f"""{w}{FLAGGED} SELECT timestamp, session_id, rule_violations, {r('z_score')}, is_anomaly
  FROM flagged""",
        "pruning_manifest": f"{w}{MANIFEST} SELECT * FROM manifest",
        "pruned_events": f"""{w}{PRUNABLE} SELECT event_id, sensor, ts FROM tel
  WHERE time_bucket(INTERVAL 1 HOUR, ts) NOT IN (SELECT timestamp FROM boring)""",
        "materialized_view": f"""{base} SELECT robot_id, event_id, sensor, {rs('latitude', 'longitude')}, timestamp
  FROM gps""",
    }
