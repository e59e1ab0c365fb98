"""Sensor streams on a regular grid: one row per (keys, window).

All aggregates combine map-side, so a hot robot or a hot second reaches the
shuffle as one partial row per task. On a stream the same functions run behind a
watermark and emit a window once it is final."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odotrack.functions.columns import nested, window_start
from odotrack.functions.constants import RESAMPLE_EVERY, SENSORS, WATERMARK
from odotrack.operators.bronze import ENCODER_FIELDS, GPS_FIELDS, IMU_FIELDS


def resample(
    df: DataFrame,
    aggs: Sequence[Column],
    every: str = RESAMPLE_EVERY,
    watermark: str = WATERMARK,
    keys: Sequence[str] = (),
) -> DataFrame:
    """``aggs`` per tumbling window, stamped with the window's start. Rows
    without a timestamp belong to no window.

    A stream needs the window struct to know when a window is over; a batch groups
    by the start alone, which hashes faster."""
    if not df.isStreaming:
        start = window_start("timestamp", every)
        dated = df.filter(F.col("timestamp").isNotNull())
        return dated.withColumn("timestamp", start).groupBy(*keys, "timestamp").agg(*aggs)
    grouped = (
        df.withWatermark("timestamp", watermark)
        .groupBy(*keys, F.window("timestamp", every))
        .agg(*aggs)
    )
    results = [name for name in grouped.columns if name not in {*keys, "window"}]
    return grouped.select(*keys, F.col("window.start").alias("timestamp"), *results)


def _spread(value: Column) -> Column:
    return F.max(value) - F.min(value)


def imu_aggregates(x: Column, y: Column, gyro: Column) -> list[Column]:
    return [
        F.avg(x).alias("avg_accel_x"),
        _spread(x).alias("spread_accel_x"),
        F.stddev_samp(x).alias("vibration_index_x"),
        F.avg(y).alias("avg_accel_y"),
        _spread(y).alias("spread_accel_y"),
        F.avg(gyro).alias("avg_gyro_z"),
    ]


def encoder_aggregates(ticks: Column, mode: str = "increment") -> list[Column]:
    """``increment`` adds readings up, ``cumulative`` takes a counter's advance."""
    if mode not in ("increment", "cumulative"):
        raise ValueError(f"mode must be 'increment' or 'cumulative', not {mode!r}")
    total = F.sum(ticks) if mode == "increment" else _spread(ticks)
    return [total.alias("total_ticks_per_sec")]


def gps_aggregates(latitude: Column, longitude: Column, stability: bool = False) -> list[Column]:
    aggs = [F.avg(latitude).alias("latitude"), F.avg(longitude).alias("longitude")]
    if stability:
        aggs += [
            F.stddev_samp(latitude).alias("stddev_latitude"),
            F.stddev_samp(longitude).alias("stddev_longitude"),
        ]
    return aggs


def _counted(aggs: list[Column], samples: bool) -> list[Column]:
    return [*aggs, F.count("*").alias("sample_count")] if samples else aggs


def resample_imu(
    imu: DataFrame,
    every: str = RESAMPLE_EVERY,
    watermark: str = WATERMARK,
    keys: Sequence[str] = (),
    samples: bool = False,
) -> DataFrame:
    aggs = imu_aggregates(F.col("accel_x"), F.col("accel_y"), F.col("gyro_z"))
    return resample(imu, _counted(aggs, samples), every, watermark, keys)


def resample_encoder(
    encoder: DataFrame,
    every: str = RESAMPLE_EVERY,
    watermark: str = WATERMARK,
    keys: Sequence[str] = (),
    mode: str = "increment",
    samples: bool = False,
) -> DataFrame:
    aggs = encoder_aggregates(F.col("ticks"), mode)
    return resample(encoder, _counted(aggs, samples), every, watermark, keys)


def resample_gps(
    gps: DataFrame,
    every: str = RESAMPLE_EVERY,
    watermark: str = WATERMARK,
    keys: Sequence[str] = (),
    stability: bool = False,
    samples: bool = False,
) -> DataFrame:
    aggs = gps_aggregates(F.col("latitude"), F.col("longitude"), stability)
    return resample(gps, _counted(aggs, samples), every, watermark, keys)


def resample_aligned(
    raw: DataFrame,
    every: str = RESAMPLE_EVERY,
    keys: Sequence[str] = (),
    mode: str = "increment",
) -> DataFrame:
    """Resample all three sensors and left-join them on the IMU windows, in one
    scan and one shuffle of the raw events.

    The same rows as resampling each sensor and aligning the results, without
    reading the raw table three times or joining: every aggregate looks at its
    own sensor's rows only, and windows without an IMU row are dropped."""

    fields = dict(zip(SENSORS, (IMU_FIELDS, ENCODER_FIELDS, GPS_FIELDS)))
    # The sensor as a number, so that its text is compared once per row.
    number = F.lit(None).cast("int")
    for i, sensor in enumerate(SENSORS, 1):
        number = F.when(F.col("sensor") == sensor, i).otherwise(number)
    numbered = raw.filter(F.col("sensor").isin(*SENSORS)).withColumn("_sensor", number)
    readings = numbered.select(
        *keys,
        F.col("ts").try_cast("timestamp").alias("timestamp"),
        "_sensor",
        *(
            F.when(F.col("_sensor") == i, nested(raw, path).try_cast(kind)).alias(name)
            for i, sensor in enumerate(SENSORS, 1)
            for name, (path, kind) in fields[sensor].items()
        ),
    )
    aggs = [
        *imu_aggregates(F.col("accel_x"), F.col("accel_y"), F.col("gyro_z")),
        *encoder_aggregates(F.col("ticks"), mode),
        *gps_aggregates(F.col("latitude"), F.col("longitude")),
        F.min("_sensor").alias("_least"),
    ]
    # IMU is sensor 1, so a window has an IMU row if that is the least.
    return resample(readings, aggs, every, keys=keys).filter("_least = 1").drop("_least")
