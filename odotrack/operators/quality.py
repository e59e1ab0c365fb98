"""Named quality gates: SQL predicates that keep rows, with counts of the rest."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from odotrack.functions.columns import all_of
from odotrack.functions.constants import FALLBACK_ACCEL_X, FALLBACK_VELOCITY

HEARTBEAT_RULES = {"valid_heartbeat_timestamp": "timestamp IS NOT NULL"}
SPATIAL_RULES = {"valid_spatial_bounds": "ABS(latitude) <= 90.0 AND ABS(longitude) <= 180.0"}
EVENT_RULES = {
    "valid_timestamp": "timestamp IS NOT NULL",
    "valid_flags": "imu_computed IN (0, 1) AND encoder_computed IN (0, 1) AND gps_computed IN (0, 1)",
    "sensor_fired": "NOT (imu_computed = 0 AND encoder_computed = 0 AND gps_computed = 0)",
}

# metadata axis -> (rule name, predicate around the threshold)
DYNAMIC_RULES = {
    "accel_x": ("chassis_vibration_safety", "ABS(avg_accel_x) <= {limit}"),
    "velocity_mps": ("operational_velocity_safety", "velocity_mps <= {limit}"),
}
FALLBACK_RULES = {
    "chassis_vibration_safety": f"ABS(avg_accel_x) <= {FALLBACK_ACCEL_X}",
    "operational_velocity_safety": f"velocity_mps <= {FALLBACK_VELOCITY}",
}


def acceleration_rules(limit: float = 50.0, x: str = "accel_x", y: str = "accel_y") -> dict[str, str]:
    return {"valid_acceleration": f"ABS({x}) <= {limit} AND ABS({y}) <= {limit}"}


def sensor_bounds(
    accel_limit: float = 200.0, gyro_limit: float = 2000.0, ticks_min: int = 0
) -> dict[str, dict[str, str]]:
    """Outlier limits per sensor, to be applied to the typed sensor streams."""
    return {
        "IMU": {
            **acceleration_rules(accel_limit),
            "valid_gyro": f"ABS(gyro_z) <= {gyro_limit}",
        },
        "ENCODER": {"valid_ticks": f"ticks >= {ticks_min}"},
        "GPS": dict(SPATIAL_RULES),
    }


def passes(predicate: str, on_null: str = "drop") -> Column:
    """Never NULL: a predicate that cannot be decided counts as ``on_null`` says."""
    if on_null not in ("drop", "keep"):
        raise ValueError(f"on_null must be 'drop' or 'keep', not {on_null!r}")
    return F.coalesce(F.expr(predicate), F.lit(on_null == "keep"))


def expect_all_or_drop(
    df: DataFrame,
    rules: Mapping[str, str],
    on_null: str = "drop",
    observation: Observation | str | None = None,
) -> DataFrame:
    """Rows that meet every rule. With an observation (a name on a stream) the
    scan itself also counts ``rows``, ``dropped`` and the failures of each rule."""
    if not rules:
        return df
    checks = {name: passes(predicate, on_null) for name, predicate in rules.items()}
    kept = all_of(list(checks.values()))
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(~kept).alias("dropped"),
            *(F.count_if(~check).alias(name) for name, check in checks.items()),
        )
    if on_null == "drop":
        # A filter drops NULL by itself, and a plain comparison reaches the scan.
        kept = all_of([F.expr(predicate) for predicate in rules.values()])
    return df.filter(kept)


def expect_or_drop(
    df: DataFrame,
    name: str,
    predicate: str,
    on_null: str = "drop",
    observation: Observation | str | None = None,
) -> DataFrame:
    return expect_all_or_drop(df, {name: predicate}, on_null, observation)


def load_rules(
    metadata: DataFrame | Callable[[], DataFrame],
    mapping: Mapping[str, tuple[str, str]] | None = None,
    fallback: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Rules from a metadata table (``axis``, ``critical_max_threshold``).

    At most one row per mapped axis reaches the driver: of several thresholds the
    strictest counts, NULL and infinite ones are skipped. An empty table gives no rules; a
    table that cannot be read gives the fallback."""
    mapping = DYNAMIC_RULES if mapping is None else mapping
    fallback = FALLBACK_RULES if fallback is None else fallback
    try:
        table = metadata() if callable(metadata) else metadata
        limits = {
            row["axis"]: row["limit"]
            for row in table.filter(F.col("axis").isin(list(mapping)))
            .groupBy("axis")
            .agg(F.min("critical_max_threshold").alias("limit"))
            .collect()
        }
    except Exception:
        # Whatever keeps the table from being read, the gates must still stand.
        return dict(fallback)
    return {
        name: predicate.format(limit=limits[axis])
        for axis, (name, predicate) in mapping.items()
        if limits.get(axis) is not None and math.isfinite(limits[axis])
    }
