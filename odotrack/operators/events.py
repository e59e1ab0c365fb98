"""The event stream: one row per raw event with a flag per sensor. Nothing is
resampled or filled; a field whose sensor did not fire is NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odotrack.functions.columns import nested
from odotrack.functions.constants import WATERMARK
from odotrack.operators.bronze import ENCODER_FIELDS, GPS_FIELDS, IMU_FIELDS
from odotrack.operators.quality import EVENT_RULES, expect_all_or_drop

FLAGS = {"IMU": "imu_computed", "ENCODER": "encoder_computed", "GPS": "gps_computed"}
READINGS = {"IMU": IMU_FIELDS, "ENCODER": ENCODER_FIELDS, "GPS": GPS_FIELDS}


def event_stream(
    raw: DataFrame,
    coalesce: bool = False,
    keys: Sequence[str] = (),
    watermark: str = WATERMARK,
) -> DataFrame:
    """Flagged events that pass the event gates; unknown sensors fire no flag and
    so are dropped. With ``coalesce`` events of one key and microsecond share a row."""
    flags = {
        flag: F.when(F.col("sensor") == sensor, 1).otherwise(0) for sensor, flag in FLAGS.items()
    }
    readings = {
        name: F.when(F.col("sensor") == sensor, nested(raw, path).try_cast(kind))
        for sensor, fields in READINGS.items()
        for name, (path, kind) in fields.items()
    }
    events = raw.select(
        *keys,
        F.col("ts").try_cast("timestamp").alias("timestamp"),
        *(value.alias(name) for name, value in {**flags, **readings}.items()),
    )
    events = expect_all_or_drop(events, EVENT_RULES)
    if not coalesce:
        return events
    return (
        events.withWatermark("timestamp", watermark)
        .groupBy(*keys, "timestamp")
        .agg(*(F.max(name).alias(name) for name in [*flags, *readings]))
    )
