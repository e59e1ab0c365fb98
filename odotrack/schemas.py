"""The table contracts."""

from __future__ import annotations

from pyspark.sql import types as T

_double, _long, _string, _time = T.DoubleType(), T.LongType(), T.StringType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


PAYLOAD = _struct(
    accel_x=_double, accel_y=_double, gyro_z=_double, ticks=_long, lat=_double, lon=_double
)
RAW = _struct(sensor=_string, ts=_time, data=PAYLOAD)
RAW_AS_MAP = _struct(sensor=_string, data=T.MapType(_string, _string), ts=_time)

BRONZE_IMU = _struct(
    sensor=_string, accel_x=_double, accel_y=_double, gyro_z=_double, timestamp=_time
)
BRONZE_ENCODER = _struct(sensor=_string, ticks=_long, timestamp=_time)
BRONZE_GPS = _struct(sensor=_string, latitude=_double, longitude=_double, timestamp=_time)

SILVER_IMU = _struct(
    timestamp=_time,
    avg_accel_x=_double,
    spread_accel_x=_double,
    vibration_index_x=_double,
    avg_accel_y=_double,
    spread_accel_y=_double,
    avg_gyro_z=_double,
)
SILVER_ENCODER = _struct(timestamp=_time, total_ticks_per_sec=_long)
SILVER_GPS = _struct(timestamp=_time, latitude=_double, longitude=_double)

SENSOR_METADATA = _struct(axis=_string, critical_max_threshold=_double)


def keyed(schema: T.StructType, **keys: T.DataType) -> T.StructType:
    """``schema`` with partition key columns in front, e.g. ``robot_id``."""
    return T.StructType([*_struct(**keys).fields, *schema.fields])
