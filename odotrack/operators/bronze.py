"""Raw events to one typed stream per sensor. Stateless, so the same functions
serve batch and streaming and never shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odotrack.functions.columns import nested

# output column -> (path in the raw event, type)
IMU_FIELDS = {
    "accel_x": ("data.accel_x", "double"),
    "accel_y": ("data.accel_y", "double"),
    "gyro_z": ("data.gyro_z", "double"),
}
ENCODER_FIELDS = {"ticks": ("data.ticks", "long")}
GPS_FIELDS = {"latitude": ("data.lat", "double"), "longitude": ("data.lon", "double")}


def extract_sensor(
    raw: DataFrame,
    sensor: str,
    fields: dict[str, tuple[str, str]],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Events of one sensor with its fields cast; text that does not parse as
    the type becomes NULL instead of failing the stream."""
    return raw.filter(F.col("sensor") == sensor).select(
        *keys,
        F.col("sensor").cast("string").alias("sensor"),
        *(nested(raw, path).try_cast(kind).alias(name) for name, (path, kind) in fields.items()),
        F.col("ts").try_cast("timestamp").alias("timestamp"),
    )


def bronze_imu(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return extract_sensor(raw, "IMU", IMU_FIELDS, keys)


def bronze_encoder(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return extract_sensor(raw, "ENCODER", ENCODER_FIELDS, keys)


def bronze_gps(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return extract_sensor(raw, "GPS", GPS_FIELDS, keys)


def sensor_counts(raw: DataFrame) -> DataFrame:
    return raw.groupBy("sensor").agg(F.count("*").alias("events"))


def null_profile(df: DataFrame, by: str, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL counts of every column per value of ``by``."""
    columns = [name for name in df.columns if name != by] if columns is None else columns
    return df.groupBy(by).agg(
        F.count("*").alias("events"),
        *(F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in columns),
    )
