"""Fleet intelligence: drift KPIs, terrain, anomalies and data pruning.

Groups here are sessions, and one may hold a large share of all rows. So session
statistics are aggregates (combined map-side) joined back, never windows that
would put a session into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odotrack.functions.columns import all_of, duration_micros, null_safe, window_start
from odotrack.functions.constants import RESAMPLE_EVERY
from odotrack.operators.ordered import MAX_ROWS, chunked, scan, segment_scan, session_scan
from odotrack.operators.quality import passes
from odotrack.operators.trajectory import DRIFT

# Labels from the most to the least hazardous; ties of a session go to the former.
TERRAINS = ("black ice", "pothole", "rough terrain", "normal")


def fleet_kpis(features: DataFrame, keys: Sequence[str] = (), anomaly: str | None = None) -> DataFrame:
    """Drift error per session, per robot and for the fleet (``level``).

    ``fleet_rmse_drift`` and ``fleet_mae_drift`` with the session's range and the
    rows behind them; with ``anomaly``, a 0/1 column, also the share of anomalous
    rows. Sessions are aggregated first, the upper levels from those."""
    error = F.col(DRIFT)
    flagged = F.sum(anomaly) if anomaly else F.lit(None).cast("long")
    sessions = features.groupBy(*keys, "session_id").agg(
        F.count("*").alias("_rows"),
        F.count(error).alias("_n"),
        F.sum(error * error).alias("_squares"),
        F.sum(F.abs(error)).alias("_absolute"),
        F.max(error).alias("_worst"),
        F.min("timestamp").alias("_start"),
        F.max("timestamp").alias("_end"),
        flagged.alias("_flagged"),
    )
    depth = F.grouping_id()
    levels = F.when(depth == 0, "session").otherwise("robot")
    if not keys:
        levels = F.when(depth == 0, "session").otherwise("fleet")
    else:
        levels = F.when(depth == 2 ** (len(keys) + 1) - 1, "fleet").otherwise(levels)
    kpis = sessions.rollup(*keys, "session_id").agg(
        levels.alias("level"),
        depth.alias("_depth"),
        F.sum("_rows").alias("seconds"),
        F.sqrt(F.sum("_squares") / F.sum("_n")).alias("fleet_rmse_drift"),
        (F.sum("_absolute") / F.sum("_n")).alias("fleet_mae_drift"),
        F.max("_worst").alias("max_drift"),
        F.min("_start").alias("session_start"),
        F.max("_end").alias("session_end"),
        (F.sum("_flagged") / F.sum("_rows")).alias("anomaly_share"),
    )
    # Of several keys only the full key is a robot.
    kpis = kpis.filter(F.col("_depth").isin(0, 1, 2 ** (len(keys) + 1) - 1)).drop("_depth")
    return kpis if anomaly else kpis.drop("anomaly_share")


def drift_trend(kpis: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares slope of session RMSE over session start, in metres per day."""
    days = F.unix_micros("session_start") / F.lit(86_400e6)
    sessions = kpis.filter(F.col("level") == "session")
    return sessions.groupBy(*keys).agg(
        F.count("*").alias("sessions"),
        F.regr_slope("fleet_rmse_drift", days).alias("drift_trend_per_day"),
    )


@dataclass(frozen=True)
class TerrainThresholds:
    rough_vibration: float = 3.0
    pothole_spread: float = 4.0
    ice_gyro: float = 30.0
    ice_acceleration: float = 0.5


def classify_terrain(df: DataFrame, thresholds: TerrainThresholds | None = None) -> DataFrame:
    """Adds ``variance_x`` and ``terrain``. The first that applies: rough terrain
    (strong vibration), pothole (a jolt without it), black ice (turning without
    accelerating), normal. What is unknown does not apply."""
    limit = thresholds or TerrainThresholds()
    vibration = F.col("vibration_index_x")
    slides = (F.abs("avg_gyro_z") >= limit.ice_gyro) & (F.abs("acceleration_mps2") <= limit.ice_acceleration)
    terrain = (
        F.when(vibration >= limit.rough_vibration, "rough terrain")
        .when(F.col("spread_accel_x") >= limit.pothole_spread, "pothole")
        .when(slides, "black ice")
        .otherwise("normal")
    )
    return df.withColumns({"variance_x": vibration * vibration, "terrain": terrain})


def session_terrain(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The most frequent terrain of every session; ties go to the more hazardous."""
    hazard = F.array_position(F.array(*(F.lit(name) for name in TERRAINS)), F.col("terrain"))
    votes = df.groupBy(*keys, "session_id", "terrain").agg(F.count("*").alias("votes"))
    first = F.max(F.struct("votes", (-hazard).alias("rank"), "terrain"))
    return votes.groupBy(*keys, "session_id").agg(
        first["terrain"].alias("session_terrain"),
        first["votes"].alias("terrain_seconds"),
        F.sum("votes").alias("session_seconds"),
    )


def _left_join(df: DataFrame, other: DataFrame, keys: Sequence[str], on: Sequence[str], how: str) -> DataFrame:
    """Equi-join on keys that may be NULL, and on columns that match as usual."""
    left, group = null_safe(df, keys)
    right = null_safe(other, keys)[0].drop(*keys)
    return left.join(right, [*group, *on], how).drop(*group)


def with_terrain(features: DataFrame, terrain: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Session terrain labels back on the feature rows."""
    labels = terrain.select(*keys, "session_id", "session_terrain")
    joined = _left_join(features, labels, keys, ["session_id"], "left")
    return joined.select(*features.columns, "session_terrain")


def flag_anomalies(
    df: DataFrame,
    rules: Mapping[str, str],
    z_max: float = 3.0,
    keys: Sequence[str] = (),
    column: str = DRIFT,
    on_null: str = "drop",
) -> DataFrame:
    """Adds ``rule_violations`` (how many rules the row breaks), ``z_score`` of
    ``column`` against its session and ``is_anomaly`` (0/1): breaks a rule or lies
    more than ``z_max`` deviations off. Rows are labelled, none is dropped."""
    session = df.groupBy(*keys, "session_id").agg(
        F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_deviation")
    )
    broken = sum(
        (F.when(passes(predicate, on_null), 0).otherwise(1) for predicate in rules.values()),
        start=F.lit(0),
    )
    score = F.when(F.col("_deviation") > 0, (F.col(column) - F.col("_mean")) / F.col("_deviation"))
    joined = _left_join(df, session, keys, ["session_id"], "left")
    flagged = joined.withColumns({"rule_violations": broken, "z_score": score})
    odd = (F.col("rule_violations") > 0) | F.coalesce(F.abs("z_score") > z_max, F.lit(False))
    return flagged.select(
        *df.columns, "rule_violations", "z_score", odd.cast("int").alias("is_anomaly")
    )


def pruning_manifest(
    features: DataFrame,
    raw: DataFrame,
    eps_drift: float,
    eps_variance: float,
    keys: Sequence[str] = (),
    every: str = RESAMPLE_EVERY,
    span: str | None = None,
) -> DataFrame:
    """Segments of consecutive windows with next to no drift and little variance,
    with the raw rows behind them. A window with unknown drift or variance, or
    marked in ``is_anomaly``, is kept. Nothing is deleted: see ``apply_pruning``."""
    boring = [
        F.col(DRIFT) <= eps_drift,
        F.col("vibration_index_x") * F.col("vibration_index_x") <= eps_variance,
    ]
    if "is_anomaly" in features.columns:
        boring.append(F.col("is_anomaly") == 0)
    windows = features.filter(all_of(boring)).select(*keys, "timestamp")
    events = (
        raw.select(*keys, F.col("ts").try_cast("timestamp").alias("ts"))
        .withColumn("timestamp", window_start("ts", every))
        .groupBy(*keys, "timestamp")
        .agg(F.count("*").alias("raw_rows"))
    )
    counted = _left_join(windows, events, keys, ["timestamp"], "left").select(*keys, "timestamp", "raw_rows")
    # Windows one step apart are one segment, so a segment is a session with that gap.
    chunks = chunked(counted, ["timestamp"], keys, span)
    islands = scan(chunks, session_scan(chunks, every)).plain()
    end = F.timestamp_micros(F.unix_micros(F.max("timestamp")) + duration_micros(every))
    return (
        islands.groupBy(*keys, "session_id")
        .agg(
            F.min("timestamp").alias("seg_start"),
            end.alias("seg_end"),
            F.count("*").alias("seconds"),
            F.sum(F.coalesce("raw_rows", F.lit(0))).alias("raw_rows"),
        )
        .withColumn("reason", F.lit("zero drift, low variance"))
        .drop("session_id")
    )


def apply_pruning(
    raw: DataFrame,
    manifest: DataFrame,
    keys: Sequence[str] = (),
    span: str | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Raw rows outside the manifest's segments, by a sweep along time: a segment is two
    edges among the rows, however long it is, and a row is dropped while more have been
    entered than left. Segments may overlap. Rows without a time are in none."""
    moment = F.col("ts").try_cast("timestamp")
    rows = raw.withColumns({"_moment": moment, "_is_row": F.lit(1), "_edge": F.lit(0)})
    sides = F.array(*(F.struct(F.col(c).alias("at"), F.lit(n).alias("step")) for c, n in (("seg_start", 1), ("seg_end", -1))))
    # At one moment edges come before rows: segments hold their start, not their end.
    edges = manifest.select(*keys, F.explode(sides).alias("_side")).select(
        *keys, F.col("_side.at").alias("_moment"), F.lit(0).alias("_is_row"), F.col("_side.step").alias("_edge")
    )
    both = rows.unionByName(edges, allowMissingColumns=True)
    chunks = chunked(both, ["_moment", "_is_row"], keys, span, max_rows)
    swept = scan(chunks, segment_scan(chunks, sums={"_inside": F.col("_edge")})).plain()
    return swept.filter((F.col("_is_row") == 1) & (F.col("_inside") == 0)).select(*raw.columns)
