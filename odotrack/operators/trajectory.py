"""Drive sessions, dead reckoning, GPS paths and the drift between them.

A dead-reckoned pose is a running product of small rigid motions: turn, then
step. Such motions compose, so a chunk can be integrated in its own frame, as if
it began at the origin heading along x, and be rotated and shifted into place by
the pose the chunks before it end in. That gives heading and path of a session of
any length from one pass over the rows and one row per chunk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odotrack.functions.columns import add_nullable, duration_micros, seconds_between
from odotrack.functions.constants import LONGITUDE_FACTOR, METERS_PER_DEGREE, SESSION_GAP
from odotrack.operators.ordered import (
    FIRST,
    MAX_ROWS,
    Chunked,
    Scan,
    chunked,
    scan,
    segment_scan,
    session_scan,
)

HEADING = "heading_theta"
ESTIMATED = ("feature_estimated_path_x", "feature_estimated_path_y")
ACTUAL = ("feature_actual_path_x", "feature_actual_path_y")
DRIFT = "target_trajectory_drift_meters"


def sessionize(
    df: DataFrame,
    gap: str = SESSION_GAP,
    keys: Sequence[str] = (),
    order: Sequence[str] = ("timestamp",),
    span: str | None = None,
    max_rows: int | None = MAX_ROWS,
    parts: int | None = None,
) -> DataFrame:
    """Adds ``session_id``: 1, 2, 3 … in time order, a new one after more than ``gap``."""
    chunks = chunked(df, order, keys, span, max_rows, parts)
    return scan(chunks, session_scan(chunks, gap)).plain().drop("prev_ts", "session_start")


def pose_scan(chunks: Chunked, turn: Column, step: Column, reset_per_session: bool = True) -> Scan:
    """Heading and position from a turn (radians) and a step (metres) per row.

    Sums skip NULLs and are NULL only while nothing has been added, as SQL has
    it: heading is NULL until the first known turn, and steps made without a
    heading do not count. So the local frame keeps apart the steps made before the
    chunk's first known turn (``_ahead``, along the local x axis): they count only
    if a heading is carried in."""
    sid = "session_id"
    turning = chunks.segment(sid) if reset_per_session else chunks.rows(sid)
    turning, moving = turning.rowsBetween(FIRST, 0), chunks.segment(sid).rowsBetween(FIRST, 0)
    local = [
        {
            "_phi": F.coalesce(F.sum(turn).over(turning), F.lit(0.0)),
            "_turned": F.count(turn).over(turning) > 0,
        },
        {
            "_x": F.sum(F.when(F.col("_turned"), step * F.cos("_phi"))).over(moving),
            "_y": F.sum(F.when(F.col("_turned"), step * F.sin("_phi"))).over(moving),
            "_ahead": F.sum(F.when(~F.col("_turned"), step)).over(moving),
        },
    ]

    def placed(theta: Column, known: Column) -> tuple[Column, Column]:
        x = F.when(known, add_nullable(F.col("_x"), F.col("_ahead"))).otherwise(F.col("_x"))
        y = F.when(x.isNotNull(), F.coalesce(F.col("_y"), F.lit(0.0)))
        return x * F.cos(theta) - y * F.sin(theta), x * F.sin(theta) + y * F.cos(theta)

    step_back = chunks.chain()
    to_here = chunks.chain(sid).rowsBetween(FIRST, 0)
    headed = chunks.chain(sid) if reset_per_session else chunks.chain()
    headed_before, headed_to_here = headed.rowsBetween(FIRST, -1), headed.rowsBetween(FIRST, 0)
    end_x, end_y = placed(F.col("_theta_before"), F.col("_known_before"))
    chain = [
        {
            "_theta_before": F.coalesce(F.sum("_phi").over(headed_before), F.lit(0.0)),
            "_known_before": F.coalesce(F.bool_or("_turned").over(headed_before), F.lit(False)),
            "_theta_end": F.sum("_phi").over(headed_to_here),
            "_known_end": F.bool_or("_turned").over(headed_to_here),
        },
        {"_end_x": end_x, "_end_y": end_y},
        {"_sum_x": F.sum("_end_x").over(to_here), "_sum_y": F.sum("_end_y").over(to_here)},
        {
            "_in_session": F.lag(sid).over(step_back),
            "_in_theta": F.lag("_theta_end").over(step_back),
            "_in_known": F.lag("_known_end").over(step_back),
            "_in_x": F.lag("_sum_x").over(step_back),
            "_in_y": F.lag("_sum_y").over(step_back),
        },
    ]

    goes_on = F.coalesce(F.col(sid) == F.col("_in_session"), F.lit(False))
    inherits = goes_on if reset_per_session else F.lit(True)
    theta = F.coalesce(F.when(inherits, F.col("_in_theta")), F.lit(0.0))
    known = F.coalesce(F.when(inherits, F.col("_in_known")), F.lit(False))
    x, y = placed(theta, known)
    return Scan(
        local=local,
        tail=[sid, "_phi", "_turned", "_x", "_y", "_ahead"],
        chain=chain,
        carry=["_in_session", "_in_theta", "_in_known", "_in_x", "_in_y"],
        out={
            HEADING: F.when(F.col("_turned") | known, theta + F.col("_phi")),
            ESTIMATED[0]: add_nullable(x, F.when(goes_on, F.col("_in_x"))),
            ESTIMATED[1]: add_nullable(y, F.when(goes_on, F.col("_in_y"))),
        },
        leading=[sid],
    )


def origin_scan(chunks: Chunked) -> Scan:
    """A session's first latitude and longitude; a NULL first fix stays NULL."""
    return segment_scan(
        chunks,
        "session_id",
        firsts={"_origin_lat": F.col("latitude"), "_origin_lon": F.col("longitude")},
    )


def session_elapsed(gap: str = SESSION_GAP, zero_gap_dt: bool = False) -> Column:
    """Seconds since the previous row, from ``prev_ts``. By default the first row of
    a later session is given the whole gap; ``zero_gap_dt`` gives it 0."""
    dt = seconds_between("timestamp", "prev_ts")
    if zero_gap_dt:
        dt = F.when(dt <= duration_micros(gap) / 1e6, dt)
    return F.coalesce(dt, F.lit(0.0))


def offset_metres(
    lat: Column,
    lon: Column,
    lat0: Column,
    lon0: Column,
    meters_per_degree: float = METERS_PER_DEGREE,
    lon_factor: float = LONGITUDE_FACTOR,
    axes: str = "code",
) -> tuple[Column, Column]:
    """Position relative to an origin on a flat earth. ``axes="code"`` puts latitude
    on x, ``"east_north"`` longitude."""
    north = (lat - lat0) * F.lit(meters_per_degree)
    east = (lon - lon0) * F.lit(meters_per_degree * lon_factor)
    if axes == "code":
        return north, east
    if axes == "east_north":
        return east, north
    raise ValueError(f"axes must be 'code' or 'east_north', not {axes!r}")


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def drift(df: DataFrame) -> DataFrame:
    """Adds the distance between the estimated and the actual path."""
    path = [F.col(name) for name in (*ACTUAL, *ESTIMATED)]
    return df.withColumn(DRIFT, distance(*path))


def dead_reckoning(
    df: DataFrame,
    keys: Sequence[str] = (),
    gap: str = SESSION_GAP,
    reset_per_session: bool = True,
    zero_gap_dt: bool = False,
    span: str | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Adds ``session_id``, ``heading_theta`` and the estimated path."""
    chunks = chunked(df, ["timestamp"], keys, span, max_rows)
    return reckoned(chunks, gap, reset_per_session, zero_gap_dt).plain()


def heading(df: DataFrame, **options) -> DataFrame:
    return dead_reckoning(df, **options).drop(*ESTIMATED)


def gps_path(
    df: DataFrame,
    keys: Sequence[str] = (),
    gap: str = SESSION_GAP,
    meters_per_degree: float = METERS_PER_DEGREE,
    lon_factor: float = LONGITUDE_FACTOR,
    axes: str = "code",
    span: str | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Adds ``session_id`` and the GPS path in metres from the session's start."""
    chunks = chunked(df, ["timestamp"], keys, span, max_rows)
    chunks = scan(chunks, session_scan(chunks, gap))
    chunks = scan(chunks, origin_scan(chunks))
    placed = _actual(chunks.plain(), meters_per_degree, lon_factor, axes)
    return placed.drop("prev_ts", "session_start")


def trajectory_features(
    df: DataFrame,
    keys: Sequence[str] = (),
    gap: str = SESSION_GAP,
    reset_per_session: bool = True,
    zero_gap_dt: bool = False,
    meters_per_degree: float = METERS_PER_DEGREE,
    lon_factor: float = LONGITUDE_FACTOR,
    axes: str = "code",
    span: str | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Sessions, estimated path, GPS path and drift label on kinetic rows.

    Three scans of (keys, chunk) partitions: sessions from the timestamps alone,
    then poses and origins together, then the rows with both joined in."""
    chunks = chunked(df, ["timestamp"], keys, span, max_rows)
    return features_of(
        chunks, gap, reset_per_session, zero_gap_dt, meters_per_degree, lon_factor, axes
    )


def features_of(
    chunks: Chunked,
    gap: str = SESSION_GAP,
    reset_per_session: bool = True,
    zero_gap_dt: bool = False,
    meters_per_degree: float = METERS_PER_DEGREE,
    lon_factor: float = LONGITUDE_FACTOR,
    axes: str = "code",
) -> DataFrame:
    """``trajectory_features`` of a table that is already cut."""
    chunks = reckoned(chunks, gap, reset_per_session, zero_gap_dt, origins=True)
    return drift(_actual(chunks.plain(), meters_per_degree, lon_factor, axes)).drop(HEADING)


def reckoned(
    chunks: Chunked, gap: str, reset_per_session: bool, zero_gap_dt: bool, origins: bool = False
) -> Chunked:
    chunks = scan(chunks, session_scan(chunks, gap))
    dt = session_elapsed(gap, zero_gap_dt)
    turn, step = F.radians("avg_gyro_z") * dt, F.col("velocity_mps") * dt
    scans = [pose_scan(chunks, turn, step, reset_per_session)]
    if origins:
        scans.append(origin_scan(chunks))
    chunks = scan(chunks, *scans)
    return chunks.using(chunks.df.drop("prev_ts", "session_start"))


def _actual(df: DataFrame, meters_per_degree: float, lon_factor: float, axes: str) -> DataFrame:
    places = [F.col(name) for name in ("latitude", "longitude", "_origin_lat", "_origin_lon")]
    x, y = offset_metres(*places, meters_per_degree, lon_factor, axes)
    return df.withColumns({ACTUAL[0]: x, ACTUAL[1]: y}).drop("_origin_lat", "_origin_lon")
