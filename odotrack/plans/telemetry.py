"""A general ``events`` table (event_id, ts, user_id, event_type, value, props) read
as robot telemetry, so the operators can run on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odotrack.functions.constants import TICKS_TO_METERS


def telemetry(events: DataFrame) -> DataFrame:
    """Raw events (``robot_id, event_id, sensor, ts, data``) out of table events.

    Clicks and views are IMU readings, errors encoder and purchases GPS readings;
    sign-ups are a sensor nobody knows. ``k`` is the number in ``props``."""
    k = F.get_json_object("props", "$.k").cast("double")
    kind = F.col("event_type")
    sensor = (
        F.when(kind.isin("click", "view"), "IMU")
        .when(kind == "error", "ENCODER")
        .when(kind == "purchase", "GPS")
        .otherwise("LIDAR")
    )

    def of(name: str, value):
        return F.when(F.col("sensor") == name, value)

    named = events.select(
        (F.col("user_id") % 8).alias("robot_id"),
        "event_id",
        sensor.alias("sensor"),
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
        k.alias("k"),
    )
    data = F.struct(
        of("IMU", F.col("value") / 10).alias("accel_x"),
        of("IMU", -F.col("value") / 20).alias("accel_y"),
        of("IMU", (F.col("k") - 50) / 1000).alias("gyro_z"),
        of("ENCODER", F.col("k") * 10).cast("long").alias("ticks"),
        of("GPS", F.when(F.col("event_id") % 97 == 0, 900.0).otherwise(F.col("k") / 100 + 40)).alias("lat"),
        of("GPS", F.col("value") / 1000 - 74).alias("lon"),
    )
    return named.select("robot_id", "event_id", "sensor", "ts", data.alias("data"))


def sensor_metadata(aligned: DataFrame, share: float = 0.6) -> DataFrame:
    """A threshold table (``axis``, ``critical_max_threshold``) at a share of the
    largest values seen on aligned windows."""
    limits = aligned.agg(
        (F.max(F.abs("avg_accel_x")) * share).alias("accel_x"),
        (F.max("total_ticks_per_sec") * TICKS_TO_METERS * share).alias("velocity_mps"),
        F.max("latitude").alias("latitude"),
    )
    return limits.unpivot([], ["accel_x", "velocity_mps", "latitude"], "axis", "critical_max_threshold")


def json_lines(events: DataFrame) -> DataFrame:
    """The events as JSON text (``event_id, value``) with the drift a fleet shows: a
    new sensor's field, a new top-level field, a reading that is no number, and
    lines that were cut off."""
    raw = telemetry(events)
    data = F.col("data")
    range_m = F.when(F.col("sensor") == "LIDAR", F.col("event_id") % 100)

    def line(ticks):
        payload = F.struct(
            data["accel_x"].alias("accel_x"),
            ticks.alias("ticks"),
            data["lat"].alias("lat"),
            range_m.alias("range_m"),
        )
        time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        firmware = F.when(F.col("event_id") % 5 == 0, "v2")
        return F.to_json(
            F.struct("sensor", time.alias("ts"), payload.alias("data"), firmware.alias("firmware"))
        )

    unread = (F.col("event_id") % 7 == 0) & data["ticks"].isNotNull()
    text = F.when(unread, line(F.lit("n/a"))).otherwise(line(data["ticks"]))
    cut = F.when(F.col("event_id") % 50 == 1, F.substr(text, F.lit(1), F.length(text) - 1))
    return raw.select("event_id", F.coalesce(cut, text).alias("value"))
