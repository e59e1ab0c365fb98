"""Sensors aligned on their windows, with velocity and acceleration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from odotrack.functions.columns import null_safe, seconds_between
from odotrack.functions.constants import TICKS_TO_METERS
from odotrack.operators.ordered import MAX_ROWS, Chunked, chunked, lag_scan, scan
from odotrack.operators.quality import (
    FALLBACK_RULES,
    HEARTBEAT_RULES,
    SPATIAL_RULES,
    expect_all_or_drop,
)


def align(imu: DataFrame, encoder: DataFrame, gps: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """IMU windows with the encoder's and GPS's of the same window, if there are any."""
    if not keys:
        return imu.join(encoder, "timestamp", "left").join(gps, "timestamp", "left")

    joined, group = null_safe(imu, keys)
    for other in (encoder, gps):
        joined = joined.join(null_safe(other, keys)[0].drop(*keys), [*group, "timestamp"], "left")
    joined = joined.drop(*group)
    return joined.select(*keys, *(name for name in joined.columns if name not in keys))


def velocity(df: DataFrame, ticks_to_meters: float = TICKS_TO_METERS) -> DataFrame:
    return df.withColumn("velocity_mps", F.col("total_ticks_per_sec") * F.lit(ticks_to_meters))


def elapsed(previous: str | Column) -> Column:
    """Seconds since the previous row; 0 where there is none."""
    return F.coalesce(seconds_between("timestamp", previous), F.lit(0.0))


def delta_seconds(
    df: DataFrame, keys: Sequence[str] = (), span: str | None = None, max_rows: int | None = MAX_ROWS
) -> DataFrame:
    chunks = chunked(df, ["timestamp"], keys, span, max_rows)
    timed = scan(chunks, lag_scan(chunks, {"_previous": "timestamp"})).plain()
    return timed.withColumn("delta_t_sec", elapsed("_previous")).drop("_previous")


def accelerated(chunks: Chunked) -> Chunked:
    """Adds ``acceleration_mps2`` and keeps the chunking."""
    previous = {"_previous_v": "velocity_mps", "_previous_ts": "timestamp"}
    lagged = scan(chunks, lag_scan(chunks, previous))
    dt = elapsed("_previous_ts")
    change = (F.col("velocity_mps") - F.col("_previous_v")) / dt
    return chunks.using(
        lagged.df.withColumn("acceleration_mps2", F.when(dt > 0, change).otherwise(0.0)).drop(*previous)
    )


def acceleration(
    df: DataFrame, keys: Sequence[str] = (), span: str | None = None, max_rows: int | None = MAX_ROWS
) -> DataFrame:
    """Change of ``velocity_mps`` over the time since the previous row; 0 for the first."""
    return accelerated(chunked(df, ["timestamp"], keys, span, max_rows)).plain()


def gates(rules: Mapping[str, str] | None = None) -> dict[str, str]:
    """The gates of the kinetic master: fixed ones and, from ``rules``, dynamic ones."""
    dynamic = FALLBACK_RULES if rules is None else rules
    return {**HEARTBEAT_RULES, **SPATIAL_RULES, **dynamic}


def kinetic_metrics(
    aligned: DataFrame, keys: Sequence[str] = (), span: str | None = None, max_rows: int | None = MAX_ROWS
) -> DataFrame:
    """Velocity and acceleration on the aligned windows, before any gate."""
    return acceleration(velocity(aligned), keys, span, max_rows)


def kinetic_master(
    imu: DataFrame,
    encoder: DataFrame,
    gps: DataFrame,
    keys: Sequence[str] = (),
    rules: Mapping[str, str] | None = None,
    on_null: str = "drop",
    span: str | None = None,
    max_rows: int | None = MAX_ROWS,
    observation: Observation | None = None,
) -> DataFrame:
    """Aligned, with metrics, gated. The gates come last, so a row's acceleration
    refers to its predecessor whether or not that one passes. ``observation`` counts
    what they drop."""
    metrics = kinetic_metrics(align(imu, encoder, gps, keys), keys, span, max_rows)
    return expect_all_or_drop(metrics, gates(rules), on_null, observation)
