"""The operators on the test tables, one query each.

The ``events`` table stands in for a fleet's telemetry (see ``telemetry``). Its
events lie minutes apart, so most queries use hourly windows and gaps in hours;
``resample_imu_1s`` and the event-level queries keep the real grid. Doubles are
rounded, since sums depend on their order in the last digits."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odotrack.functions.constants import WATERMARK
from odotrack.operators.bronze import (
    bronze_encoder,
    bronze_gps,
    bronze_imu,
    null_profile,
    sensor_counts,
)
from odotrack.operators.events import event_stream
from odotrack.operators.fleet import (
    TerrainThresholds,
    apply_pruning,
    classify_terrain,
    drift_trend,
    flag_anomalies,
    fleet_kpis,
    pruning_manifest,
    session_terrain,
    with_terrain,
)
from odotrack.operators.fusion import kalman_fuse, localization_features, reckon_events
from odotrack.operators.history import as_of, current_version, scd2_history
from odotrack.operators.kinematics import align, delta_seconds, gates, kinetic_metrics
from odotrack.operators.ordered import (
    MAX_ROWS,
    fill_gaps,
    ordered_lag,
    ordered_lead,
    running_first,
    running_sum,
)
from odotrack.operators.quality import (
    acceleration_rules,
    expect_all_or_drop,
    expect_or_drop,
    load_rules,
    sensor_bounds,
)
from odotrack.operators.resample import (
    resample_aligned,
    resample_encoder,
    resample_gps,
    resample_imu,
)
from odotrack.operators.trajectory import (
    dead_reckoning,
    gps_path,
    heading,
    sessionize,
    trajectory_features,
)
from odotrack.plans.medallion import features_from_raw, master_from_raw
from odotrack.plans.telemetry import json_lines, sensor_metadata, telemetry
from odotrack.schemas import RAW
from odotrack.session import shared_folder, stage
from odotrack.sources.fixtures import load_fixture
from odotrack.sources.raw_json import read_lines, rescue
from odotrack.sources.tables import (
    DAY,
    Intake,
    dated,
    materialize,
    read_table,
    refresh_parts,
    register,
    within,
    write_stream,
)
from odotrack.streaming.history import read_history, stream_history
from odotrack.streaming.progress import progress_log, read_progress
from odotrack.streaming.routes import (
    BROKEN,
    ROUTE,
    gate_counts,
    gate_stream,
    quarantine,
    read_route,
    split_late,
)
from odotrack.streaming.session_ids import merge_spans, stream_sessionize, write_sessions
from odotrack.streaming.sessions import session_summary

HOUR, GAP, ROBOT, ROBOT_GAP = "1 hour", "2 hours", ["robot_id"], "24 hours"
AS_OF = datetime(2024, 1, 15, tzinfo=timezone.utc)
FILTER = {"q": 0.5, "r": 25.0, "p0": 1.0}
TERRAIN = TerrainThresholds(rough_vibration=6.0, pothole_spread=6.0, ice_gyro=0.005, ice_acceleration=0.001)
CUT = 500  # rows per chunk where a query is to cut its series
EPS_DRIFT, EPS_VARIANCE = 60_000.0, 40.0


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(_events(spark, sf_dir))


def _rules(aligned: DataFrame) -> dict[str, str]:
    return load_rules(sensor_metadata(aligned))


# Decimals a result is rounded to. Averages of short decimals end in a 5 now and
# then; these lie behind that digit, and before the digits that depend on the order
# of summation.
DIGITS = {
    "acceleration_mps2": 12,
    "kf_error_covariance_p": 7,
    **dict.fromkeys(
        [
            "avg_accel_x",
            "avg_accel_y",
            "avg_gyro_z",
            "spread_accel_x",
            "spread_accel_y",
            "vibration_index_x",
            "variance_x",
            "latitude",
            "longitude",
            "stddev_latitude",
            "stddev_longitude",
            "velocity_mps",
        ],
        9,
    ),
    **dict.fromkeys(["fleet_rmse_drift", "fleet_mae_drift", "max_drift", "drift_trend_per_day"], 4),
}


# Paths of hourly steps reach thousands of kilometres.
FAR = dict.fromkeys(
    ["feature_estimated_path_x", "feature_estimated_path_y", "target_trajectory_drift_meters"], 4
)


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    places = {**DIGITS, **digits}
    doubles = [field.name for field in df.schema if isinstance(field.dataType, T.DoubleType)]
    # Adding 0.0 turns a rounded -0.0 into 0.0.
    return df.withColumns({name: F.round(name, places.get(name, 6)) + F.lit(0.0) for name in doubles})


def _hourly(raw: DataFrame, keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        resample_imu(bronze_imu(raw, keys), HOUR, keys=keys),
        resample_encoder(bronze_encoder(raw, keys), HOUR, keys=keys),
        resample_gps(bronze_gps(raw, keys), HOUR, keys=keys),
    )


def _master(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The gated master, staged: several scans follow."""
    return stage(master_from_raw(raw, keys, _rules, HOUR))


def _features(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return features_from_raw(raw, keys, _rules, HOUR, ROBOT_GAP if keys else GAP)


# Bronze ----------------------------------------------------------------------


def q_bronze_imu(spark, sf_dir):
    return _rounded(bronze_imu(_raw(spark, sf_dir), ["robot_id", "event_id"]))


def q_bronze_encoder(spark, sf_dir):
    return bronze_encoder(_raw(spark, sf_dir), ["robot_id", "event_id"])


def q_bronze_gps(spark, sf_dir):
    return _rounded(bronze_gps(_raw(spark, sf_dir), ["robot_id", "event_id"]))


def q_raw_rescue(spark, sf_dir):
    rescued = rescue(json_lines(_events(spark, sf_dir)), RAW)
    extra = F.col("_rescued_data")
    return _rounded(
        rescued.select(
            "event_id",
            "sensor",
            "ts",
            F.col("data.accel_x").alias("accel_x"),
            F.col("data.ticks").alias("ticks"),
            extra["firmware"].alias("firmware"),
            extra["data.range_m"].alias("range_m"),
            extra["data.ticks"].alias("unread_ticks"),
            F.coalesce(F.size(extra), F.lit(0)).alias("rescued"),
            F.col("_malformed").isNotNull().cast("int").alias("malformed"),
        )
    )


def q_sensor_counts(spark, sf_dir):
    return sensor_counts(_raw(spark, sf_dir))


def q_null_profile(spark, sf_dir):
    return null_profile(_raw(spark, sf_dir).select("sensor", "data.*"), "sensor")


# Quality ---------------------------------------------------------------------


def q_quality_bounds(spark, sf_dir):
    gps = bronze_gps(_raw(spark, sf_dir), ["event_id"])
    return _rounded(expect_all_or_drop(gps, sensor_bounds()["GPS"]))


def q_acceleration_bounds(spark, sf_dir):
    imu = bronze_imu(_raw(spark, sf_dir), ["event_id"])
    return _rounded(expect_all_or_drop(imu, acceleration_rules(8.0)))


def q_quality_gates(spark, sf_dir):
    """All gates of the kinetic master with NULLs kept, on the three-way join."""
    metrics = kinetic_metrics(stage(align(*_hourly(_raw(spark, sf_dir)))))
    kept = expect_all_or_drop(metrics, gates(), on_null="keep")
    return _rounded(kept.select("timestamp", "avg_accel_x", "latitude", "velocity_mps"))


def q_expect_or_drop(spark, sf_dir):
    gps = bronze_gps(_raw(spark, sf_dir), ["event_id"])
    return _rounded(expect_or_drop(gps, "north", "latitude > 0"))


def q_fallback_rules(spark, sf_dir):
    """The threshold table is not there."""
    rules = load_rules(lambda: spark.read.parquet(f"{sf_dir}/sensor_metadata.parquet"))
    aligned = stage(resample_aligned(_raw(spark, sf_dir), HOUR))
    kept = expect_all_or_drop(kinetic_metrics(aligned), rules)
    return _rounded(kept.select("timestamp", "avg_accel_x", "velocity_mps"))


def q_dynamic_rules(spark, sf_dir):
    aligned = stage(resample_aligned(_raw(spark, sf_dir), HOUR))
    kept = expect_all_or_drop(kinetic_metrics(aligned), _rules(aligned))
    return _rounded(kept.select("timestamp", "avg_accel_x", "velocity_mps"))


# Silver ----------------------------------------------------------------------


def q_resample_imu(spark, sf_dir):
    return _rounded(resample_imu(bronze_imu(_raw(spark, sf_dir)), HOUR, samples=True))


def q_resample_imu_1s(spark, sf_dir):
    return _rounded(resample_imu(bronze_imu(_raw(spark, sf_dir), ROBOT), keys=ROBOT, samples=True))


def q_resample_encoder(spark, sf_dir):
    return resample_encoder(bronze_encoder(_raw(spark, sf_dir), ROBOT), HOUR, keys=ROBOT)


def q_resample_encoder_cumulative(spark, sf_dir):
    return resample_encoder(bronze_encoder(_raw(spark, sf_dir)), HOUR, mode="cumulative")


def q_resample_gps(spark, sf_dir):
    return _rounded(resample_gps(bronze_gps(_raw(spark, sf_dir), ROBOT), HOUR, keys=ROBOT))


def q_gps_stability(spark, sf_dir):
    return _rounded(resample_gps(bronze_gps(_raw(spark, sf_dir)), HOUR, stability=True))


def _history(spark, sf_dir, **options):
    changes = _events(spark, sf_dir).select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value"
    )
    # Every change arrives twice; one version of it counts.
    return scd2_history(changes.unionByName(changes), ["user_id"], "ts", **options)


def q_scd2_history(spark, sf_dir):
    return _history(spark, sf_dir)


def q_scd2_history_chunked(spark, sf_dir):
    return _history(spark, sf_dir, max_rows=5)


def q_scd2_current(spark, sf_dir):
    return current_version(_history(spark, sf_dir))


def q_scd2_as_of(spark, sf_dir):
    return as_of(_history(spark, sf_dir), AS_OF)


def q_scd2_silver(spark, sf_dir):
    imu = resample_imu(bronze_imu(_raw(spark, sf_dir)), HOUR)
    return _rounded(scd2_history(imu, ["timestamp"], "timestamp"))


def q_event_stream_flags(spark, sf_dir):
    return _rounded(event_stream(_raw(spark, sf_dir), keys=["robot_id", "event_id"]))


def q_event_stream_coalesced(spark, sf_dir):
    """Events of a robot's minute put on one timestamp, to give them rows to share."""
    raw = _raw(spark, sf_dir).withColumn("ts", F.date_trunc("minute", "ts"))
    return _rounded(event_stream(raw, coalesce=True, keys=ROBOT))


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see."""
    return f"{shared_folder(spark).rstrip('/')}/odotrack-{name}-{uuid.uuid4().hex}"


def _landed(spark, sf_dir) -> tuple[DataFrame, str]:
    """The raw table that a stream fills from JSON files, two files a batch, and its folder."""
    folder = _folder(spark, "landing")
    json_lines(_events(spark, sf_dir)).select("value").repartition(5).write.text(f"{folder}/files")
    lines = read_lines(spark, f"{folder}/files", streaming=True, most=Intake(files=2))
    raw = dated(rescue(lines, RAW), "ts")
    write_stream(raw, f"{folder}/raw", f"{folder}/checkpoint", partition_by=[DAY]).awaitTermination()
    return read_table(spark, f"{folder}/raw", schema=raw.schema), folder


def q_json_landing(spark, sf_dir):
    """From files to the raw table: limited batches, rescue, a folder a day."""
    raw, extra = _landed(spark, sf_dir)[0], F.col("_rescued_data")
    return _rounded(
        raw.select(
            "sensor",
            "ts",
            F.col("data.accel_x").alias("accel_x"),
            F.col("data.ticks").alias("ticks"),
            F.coalesce(F.size(extra), F.lit(0)).alias("rescued"),
            F.col("_malformed").isNotNull().cast("int").alias("malformed"),
            F.col(DAY).cast("string").alias("day"),
        )
    )


def q_landing_day(spark, sf_dir):
    """One day of the raw table: only that day's folder is listed."""
    raw = within(_landed(spark, sf_dir)[0], "ts", AS_OF, AS_OF + timedelta(days=1))
    return raw.groupBy("sensor").agg(F.count("*").alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def q_scd2_incremental(spark, sf_dir):
    """The history of ``scd2_history``, merged from a stream of two batches that interleave in
    time, each change coming twice."""
    changes = _events(spark, sf_dir).select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value"
    )
    early, folder = F.col("event_type").isin("purchase", "click"), _folder(spark, "history")
    for part in (early, ~early):
        again = changes.filter(part)
        again.unionByName(again).write.mode("append").parquet(f"{folder}/changes")
        stream = read_table(spark, f"{folder}/changes", streaming=True, schema=changes.schema, most=Intake())
        stream_history(stream, f"{folder}/history", f"{folder}/checkpoint", ["user_id"], "ts", 16).awaitTermination()
    return read_history(spark, f"{folder}/history")


def q_view_refresh(spark, sf_dir):
    """A view with a stale day, of which that day alone is recomputed."""
    gps = dated(bronze_gps(_raw(spark, sf_dir), ["robot_id", "event_id"]), "timestamp")
    stale, folder = F.col(DAY) == F.to_date(F.lit(AS_OF)), _folder(spark, "view")
    materialize(gps.withColumn("latitude", F.when(~stale, F.col("latitude"))), folder, ["robot_id"], DAY)
    return _rounded(refresh_parts(gps.filter(stale), folder, DAY, cluster_by=["robot_id"]).drop(DAY))


GATES = {"north": "latitude <= 40.5", "west": "longitude < -73.8", "on_earth": "ABS(latitude) <= 90"}


def _gated(spark, sf_dir) -> DataFrame:
    folder = _folder(spark, "gates")
    raw = _raw(spark, sf_dir)
    raw.repartition(6).write.parquet(f"{folder}/raw")
    stream = read_table(spark, f"{folder}/raw", streaming=True, schema=raw.schema, most=Intake(files=2))
    gps = bronze_gps(stream, ["event_id"])
    gate_stream(gps, GATES, f"{folder}/gps", f"{folder}/checkpoint").awaitTermination()
    return read_route(spark, f"{folder}/gps", quarantine(gps, GATES).drop(ROUTE).schema)


def q_stream_gates(spark, sf_dir):
    """What the gates of a stream drop, counted from what it kept aside."""
    return gate_counts(_gated(spark, sf_dir), GATES)


def q_stream_quarantine(spark, sf_dir):
    """Every row of a gated stream: where it went, and the rules it broke."""
    routed = _gated(spark, sf_dir)
    return routed.select("event_id", F.col(ROUTE).alias("route"), F.array_join(BROKEN, ",").alias("broken"))


def q_stream_gate_log(spark, sf_dir):
    """The same counts as the stream itself reports them, batch by batch."""
    folder, raw = _folder(spark, "gate-log"), _raw(spark, sf_dir)
    raw.repartition(6).write.parquet(f"{folder}/raw")
    stream = read_table(spark, f"{folder}/raw", streaming=True, schema=raw.schema, most=Intake(files=2))
    gps = expect_all_or_drop(bronze_gps(stream, ["event_id"]), GATES, observation="gps_gate")
    with progress_log(spark, f"{folder}/log"):
        write_stream(gps, f"{folder}/gps", f"{folder}/checkpoint").awaitTermination()
    log = read_progress(spark, f"{folder}/log").filter("gate = 'gps_gate'")
    return log.groupBy("measure").agg(F.sum("value").alias("counted"))


def q_late_rows(spark, sf_dir):
    """Events of a stream, parted by whether their hour had ended when they came. All of
    one sensor come after the others."""
    raw, folder = _raw(spark, sf_dir), _folder(spark, "late")
    events = raw.select("event_id", "sensor", F.col("ts").alias("timestamp"))
    behind = F.col("sensor") == "LIDAR"
    for part in (~behind, behind):
        events.filter(part).write.mode("append").parquet(f"{folder}/events")
        stream = read_table(spark, f"{folder}/events", streaming=True, schema=events.schema, most=Intake())
        split_late(stream, f"{folder}/parted", f"{folder}/checkpoint", every=HOUR).awaitTermination()
    return read_route(spark, f"{folder}/parted", events.schema).select("event_id", "sensor", F.col(ROUTE).alias("route"))


def _stream_sessions(spark, sf_dir, keys: Sequence[str]) -> DataFrame:
    events, folder = _raw(spark, sf_dir).select("robot_id", "event_id", F.col("ts").alias("timestamp")), _folder(spark, "sessions")
    events.write.parquet(f"{folder}/events")
    stream = read_table(spark, f"{folder}/events", streaming=True, schema=events.schema, most=Intake())
    numbered = stream_sessionize(stream, GAP if keys else "20 minutes", keys, span="6 hours")
    write_sessions(numbered, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(numbered.schema).parquet(f"{folder}/table")


def q_stream_session_ids(spark, sf_dir):
    """Session ids of a robot's rows, as the watermark passes them."""
    return _stream_sessions(spark, sf_dir, ROBOT)


def q_stream_session_ids_unkeyed(spark, sf_dir):
    """Session ids of one series, numbered by spans of six hours that are then joined."""
    return merge_spans(_stream_sessions(spark, sf_dir, ()), "20 minutes").drop("robot_id")


def _stream(spark, sf_dir, run: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """A streaming query over the events, worked off into a folder and read back."""
    events = _events(spark, sf_dir)
    reader = spark.readStream.schema(events.schema)
    # A table is a folder of part files or one file; a stream reads folders.
    inside = any(not file.endswith("/events.parquet") for file in events.inputFiles())
    if inside:
        stream = reader.parquet(f"{sf_dir}/events.parquet")
    else:
        stream = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    folder = _folder(spark, name)
    result = run(telemetry(stream))
    write_stream(result, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{folder}/table")


def q_stream_bronze_gps(spark, sf_dir):
    return _rounded(_stream(spark, sf_dir, lambda raw: bronze_gps(raw, ["event_id"]), "gps"))


def q_stream_resample_imu(spark, sf_dir):
    """As ``resample_imu``, without the windows still open behind the watermark."""
    return _rounded(
        _stream(spark, sf_dir, lambda raw: resample_imu(bronze_imu(raw), HOUR, WATERMARK), "imu")
    )


def q_stream_session_summary(spark, sf_dir):
    def run(raw):
        events = event_stream(raw, keys=ROBOT)
        return session_summary(events, [F.count("*").alias("events")], GAP, ROBOT)

    return _stream(spark, sf_dir, run, "sessions")


# Ordered ---------------------------------------------------------------------


def q_ordered_lag(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    return ordered_lag(events, {"prev_value": "value", "prev_ts": "ts"}, ["ts", "event_id"], ["user_id"])


def q_ordered_lag_chunked(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    previous = {"prev_value": "value", "prev_ts": "ts"}
    return ordered_lag(events, previous, ["ts", "event_id"], ["user_id"], max_rows=5)


def q_ordered_lead_chunked(spark, sf_dir):
    """Next events of everyone, in one series."""
    events = _events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    return ordered_lead(events, {"next_value": "value", "next_ts": "ts"}, ["ts", "event_id"], max_rows=CUT)


def q_running_sum_chunked(spark, sf_dir):
    encoder = bronze_encoder(_raw(spark, sf_dir), ["robot_id", "event_id"])
    order = ["timestamp", "event_id"]
    return running_sum(encoder, {"odometer": F.col("ticks")}, order, ROBOT, max_rows=CUT // 10)


def q_running_sum(spark, sf_dir):
    encoder = bronze_encoder(_raw(spark, sf_dir), ["robot_id", "event_id"])
    return running_sum(encoder, {"odometer": F.col("ticks")}, ["timestamp", "event_id"], ROBOT)


def q_running_first(spark, sf_dir):
    gps = bronze_gps(_raw(spark, sf_dir), ["robot_id", "event_id"])
    origins = {"origin_lat": F.col("latitude"), "origin_lon": F.col("longitude")}
    return _rounded(running_first(gps, origins, ["timestamp", "event_id"], ROBOT))


def q_fill_gaps(spark, sf_dir):
    aligned = stage(resample_aligned(_raw(spark, sf_dir), HOUR, ROBOT))
    filled = fill_gaps(aligned, ["latitude", "longitude", "total_ticks_per_sec"], keys=ROBOT)
    return _rounded(filled.select("robot_id", "timestamp", "latitude", "longitude", "total_ticks_per_sec"))


def q_fill_gaps_drop(spark, sf_dir):
    aligned = resample_aligned(_raw(spark, sf_dir), HOUR, ROBOT)
    known = fill_gaps(aligned, ["latitude", "total_ticks_per_sec"], how="drop")
    return _rounded(known.select("robot_id", "timestamp", "latitude", "longitude", "total_ticks_per_sec"))


def q_sessionize_ntz(spark, sf_dir):
    """Timestamps without a time zone, in ranges."""
    ts = F.col("ts").cast("timestamp_ntz").alias("timestamp")
    raw = _raw(spark, sf_dir).select("robot_id", "event_id", ts)
    return sessionize(raw, GAP, ROBOT, ["timestamp", "event_id"], max_rows=CUT // 10)


def q_sessionize(spark, sf_dir):
    raw = _raw(spark, sf_dir).select("robot_id", "event_id", F.col("ts").alias("timestamp"))
    return sessionize(raw, GAP, ROBOT, ["timestamp", "event_id"])


def q_sessionize_two_level(spark, sf_dir):
    """All events as one series, cut into ranges."""
    raw = _raw(spark, sf_dir).select("event_id", F.col("ts").alias("timestamp"))
    ranges = spark.sparkContext.defaultParallelism
    return sessionize(raw, "10 minutes", order=["timestamp", "event_id"], parts=ranges)


def q_session_summary(spark, sf_dir):
    events = event_stream(_raw(spark, sf_dir), keys=ROBOT)
    aggs = [F.count("*").alias("events"), F.sum("gps_computed").alias("fixes")]
    return session_summary(events, aggs, GAP, ROBOT)


# Gold ------------------------------------------------------------------------


def q_aligned_join(spark, sf_dir):
    return _rounded(align(*_hourly(_raw(spark, sf_dir), ROBOT), keys=ROBOT))


def q_aligned_one_pass(spark, sf_dir):
    return _rounded(resample_aligned(_raw(spark, sf_dir), HOUR, ROBOT))


def q_delta_seconds(spark, sf_dir):
    imu = stage(resample_imu(bronze_imu(_raw(spark, sf_dir), ROBOT), HOUR, keys=ROBOT))
    return delta_seconds(imu, ROBOT).select("robot_id", "timestamp", "delta_t_sec")


def q_kinetic_metrics(spark, sf_dir):
    return _rounded(kinetic_metrics(stage(align(*_hourly(_raw(spark, sf_dir))))))


def q_kinetic_master(spark, sf_dir):
    return _rounded(master_from_raw(_raw(spark, sf_dir), rules=_rules, every=HOUR))


def q_heading(spark, sf_dir):
    master = _master(_raw(spark, sf_dir))
    return _rounded(heading(master, gap=GAP, max_rows=MAX_ROWS).select("timestamp", "session_id", "heading_theta"))


def q_heading_global(spark, sf_dir):
    master = _master(_raw(spark, sf_dir), ROBOT)
    turned = heading(master, keys=ROBOT, gap=ROBOT_GAP, reset_per_session=False, zero_gap_dt=True)
    return _rounded(turned.select("robot_id", "timestamp", "session_id", "heading_theta"))


def q_estimated_path(spark, sf_dir):
    path = dead_reckoning(_master(_raw(spark, sf_dir)), gap=GAP)
    places = path.select("timestamp", "session_id", "feature_estimated_path_x", "feature_estimated_path_y")
    return _rounded(places, **FAR)


def q_actual_path(spark, sf_dir):
    path = gps_path(_master(_raw(spark, sf_dir)), gap=GAP, max_rows=MAX_ROWS)
    return _rounded(path.select("timestamp", "session_id", "feature_actual_path_x", "feature_actual_path_y"))


def q_trajectory_drift(spark, sf_dir):
    """Drift with the options on: GPS east/north, no step over session gaps."""
    master = _master(_raw(spark, sf_dir))
    features = trajectory_features(master, gap=GAP, axes="east_north", zero_gap_dt=True, max_rows=MAX_ROWS)
    return _rounded(features.select("timestamp", "session_id", "target_trajectory_drift_meters"), **FAR)


def q_ml_features(spark, sf_dir):
    return _rounded(_features(_raw(spark, sf_dir)), **FAR)


def q_ml_features_chunked(spark, sf_dir):
    features = trajectory_features(_master(_raw(spark, sf_dir)), gap=GAP, max_rows=CUT // 5)
    return _rounded(features, **FAR)


def q_ml_features_keyed(spark, sf_dir):
    return _rounded(_features(_raw(spark, sf_dir), ROBOT), **FAR)


# Localization ----------------------------------------------------------------


def q_dead_reckoned_events(spark, sf_dir):
    events = event_stream(_raw(spark, sf_dir), keys=["robot_id", "event_id"])
    reckoned = reckon_events(events, ROBOT, GAP)
    return _rounded(
        reckoned.select(
            "robot_id",
            "event_id",
            "session_id",
            "velocity_mps",
            "acceleration_mps2",
            "heading_theta",
            "feature_estimated_path_x",
            "feature_estimated_path_y",
        )
    )


def q_kalman_predicted(spark, sf_dir):
    events = event_stream(_raw(spark, sf_dir), keys=["robot_id", "event_id"])
    fused = kalman_fuse(events, **FILTER, use_gps=False, keys=ROBOT, gap=GAP)
    return _rounded(fused.select("robot_id", "event_id", "kf_state_x", "kf_state_y", "kf_error_covariance_p"))


def q_kalman_fused(spark, sf_dir):
    return _fused(spark, sf_dir)


def q_kalman_fused_chunked(spark, sf_dir):
    return _fused(spark, sf_dir, max_rows=CUT // 5)


def _fused(spark, sf_dir, **options):
    events = event_stream(_raw(spark, sf_dir), keys=["robot_id", "event_id"])
    fused = kalman_fuse(events, **FILTER, keys=ROBOT, gap=GAP, **options)
    states = fused.select(
        "robot_id", "event_id", "session_id", "kf_state_x", "kf_state_y", "kf_error_covariance_p"
    )
    return _rounded(states, kf_state_x=4, kf_state_y=4)


def q_localization_features(spark, sf_dir):
    events = event_stream(_raw(spark, sf_dir), keys=["robot_id", "event_id"])
    features = localization_features(events, **FILTER, keys=ROBOT, gap=GAP)
    paths = features.select(
        "robot_id",
        "event_id",
        "session_id",
        "feature_estimated_path_x",
        "feature_estimated_path_y",
        "feature_corrected_path_x",
        "feature_corrected_path_y",
        "target_trajectory_drift_meters",
    )
    return _rounded(
        paths, feature_corrected_path_x=4, feature_corrected_path_y=4, target_trajectory_drift_meters=4
    )


# Fleet -----------------------------------------------------------------------


def q_fleet_kpis(spark, sf_dir):
    return _rounded(fleet_kpis(_features(_raw(spark, sf_dir), ROBOT), ROBOT))


def q_drift_trend(spark, sf_dir):
    kpis = fleet_kpis(_features(_raw(spark, sf_dir), ROBOT), ROBOT)
    return _rounded(drift_trend(kpis, ROBOT))


def q_terrain(spark, sf_dir):
    labelled = classify_terrain(_master(_raw(spark, sf_dir)), TERRAIN)
    return _rounded(labelled.select("timestamp", "variance_x", "terrain"))


def q_session_terrain(spark, sf_dir):
    return session_terrain(classify_terrain(_features(_raw(spark, sf_dir)), TERRAIN))


def q_terrain_features(spark, sf_dir):
    features = stage(_features(_raw(spark, sf_dir), ROBOT))
    labels = session_terrain(classify_terrain(features, TERRAIN), ROBOT)
    return with_terrain(features, labels, ROBOT).select("robot_id", "timestamp", "session_id", "session_terrain")


def _flagged(spark, sf_dir):
    features = stage(_features(_raw(spark, sf_dir)))
    rules = {"calm": "ABS(avg_accel_x) <= 6.0", "steady": "ABS(acceleration_mps2) <= 0.0005"}
    return flag_anomalies(features, rules, z_max=1.5)


def q_anomaly_flags(spark, sf_dir):
    flagged = _flagged(spark, sf_dir)
    return _rounded(flagged.select("timestamp", "session_id", "rule_violations", "z_score", "is_anomaly"))


def _manifest(spark, sf_dir):
    flagged = _flagged(spark, sf_dir)
    return pruning_manifest(flagged, _raw(spark, sf_dir), EPS_DRIFT, EPS_VARIANCE, every=HOUR)


def q_pruning_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir)


def q_pruned_events(spark, sf_dir):
    kept = apply_pruning(_raw(spark, sf_dir), stage(_manifest(spark, sf_dir)))
    return kept.select("event_id", "sensor", "ts")


def q_materialized_view(spark, sf_dir):
    """Bronze GPS written as files clustered by robot and time, and read back."""
    gps = bronze_gps(_raw(spark, sf_dir), ["robot_id", "event_id"])
    folder = _folder(spark, "view")
    return _rounded(materialize(gps, folder, ["robot_id", "timestamp"]))


def q_fixture_csv(spark, sf_dir):
    """Bronze encoder written as fixture files and loaded: every column is text."""
    encoder = bronze_encoder(_raw(spark, sf_dir), ROBOT)
    folder = f"{_folder(spark, 'fixture')}.csv"
    encoder.select("robot_id", "sensor", "ticks").write.csv(folder, header=True)
    return load_fixture(spark, folder)


def q_temporary_view(spark, sf_dir):
    """A named step that is not stored, read by name from SQL."""
    name = f"bronze_gps_{uuid.uuid4().hex}"
    register(bronze_gps(_raw(spark, sf_dir), ROBOT), name)
    fixes = read_table(spark, name).filter("ABS(latitude) <= 90").groupBy("robot_id").agg(F.count("*").alias("fixes"))
    return fixes.join(spark.sql(f"SELECT robot_id, count(*) AS readings FROM {name} GROUP BY robot_id"), "robot_id")


def q_stream_table(spark, sf_dir):
    """A table that one stream appends to, read by the next as it is: bronze, then silver by
    hours that have ended."""
    events, folder = _raw(spark, sf_dir), _folder(spark, "chain")
    events.write.parquet(f"{folder}/raw")
    raw = read_table(spark, f"{folder}/raw", streaming=True, schema=events.schema)
    bronze = dated(bronze_encoder(raw, ROBOT), "timestamp")
    write_stream(bronze, f"{folder}/bronze", f"{folder}/c1", partition_by=[DAY]).awaitTermination()
    stored = read_table(spark, f"{folder}/bronze", streaming=True, schema=bronze.schema).drop(DAY)
    silver = resample_encoder(stored, HOUR, WATERMARK, keys=ROBOT)
    write_stream(silver, f"{folder}/silver", f"{folder}/c2").awaitTermination()
    return read_table(spark, f"{folder}/silver", schema=silver.schema)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name.removeprefix("q_"): run for name, run in globals().items() if name.startswith("q_")}
