"""Sensor fusion on event rows: dead reckoning without GPS, a Kalman filter with
it, and the drift of the one against the other.

The filter's state is the position and a scalar covariance P. Between fixes the
position moves with the dead-reckoned path and P grows by ``q`` per second; a fix
pulls the position by K = P / (P + r). Written as the correction c = filtered −
dead-reckoned position, the motion drops out: c changes at fixes only,
c += K (fix − dead-reckoned − c). So the sequential part sees the GPS rows alone.

It is not sequential over a series either. A run of fixes acts on any state (c, P) it may
start from as a fixed linear-fractional map, kept as seven numbers, and such maps compose
(Särkkä and García-Fernández, "Temporal Parallelization of Bayesian Smoothers", 2021). A
session's first fix forgets what came before. So a robot's fixes are one sequence of maps,
and their running composition is a tree:

    fixes -> runs of RUN fixes -> runs of RUN runs -> one list a robot

Going up, each run is folded to its map by an aggregate over a sorted array; going down,
each is folded again from the state it begins in, which gives the states its members begin
in. Both are built-in functions over groups of at most RUN rows; the list at the top has
one entry for RUN * RUN fixes. A row then takes up the state behind the latest fix before
it, by the number of that fix."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odotrack.functions.columns import seconds_between
from odotrack.functions.constants import SESSION_GAP, TICKS_TO_METERS
from odotrack.operators.ordered import (
    MAX_ROWS,
    Chunked,
    chunked,
    hold_scan,
    scan,
    segment_scan,
    session_scan,
)
from odotrack.operators.quality import SPATIAL_RULES, passes
from odotrack.operators.trajectory import (
    DRIFT,
    ESTIMATED,
    distance,
    offset_metres,
    pose_scan,
)
from odotrack.session import stage

#: Maps that are folded in one go.
RUN = 256
STATE = ("kf_state_x", "kf_state_y")
COVARIANCE = "kf_error_covariance_p"
CORRECTED = ("feature_corrected_path_x", "feature_corrected_path_y")

# Among events of one microsecond motion is applied before the fix that corrects
# it; the readings make the order total, up to rows that are equal anyway.
TIES = ("_rank", "_first", "_second", "_third")


def _ties() -> list[Column]:
    imu, encoder = F.col("imu_computed") == 1, F.col("encoder_computed") == 1
    return [
        F.when(imu, 0).when(encoder, 1).otherwise(2),
        F.coalesce("accel_x", F.col("ticks").cast("double"), "latitude"),
        F.coalesce("accel_y", "longitude"),
        F.col("gyro_z"),
    ]


def reckon_events(
    events: DataFrame,
    keys: Sequence[str] = (),
    gap: str = SESSION_GAP,
    reset_heading: bool = False,
    ticks_to_meters: float = TICKS_TO_METERS,
    span: str | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """GPS-denied localization: sessions, velocity, acceleration, heading and the
    estimated path of every event from IMU and encoder alone.

    A gyro reading turns the robot for the time since the session's previous IMU
    event; an encoder reading moves it by its ticks. Velocity and acceleration are
    known at encoder events that have a predecessor in the session. The heading
    runs on across sessions unless ``reset_heading``."""
    chunks = _reckoned(events, keys, gap, reset_heading, ticks_to_meters, span, max_rows)
    return chunks.plain().drop(*TIES, "_origin_lat", "_origin_lon", "_fix_ts", "_fix_no")


def kalman_fuse(
    events: DataFrame,
    q: float = 0.5,
    r: float = 25.0,
    p0: float = 0.0,
    use_gps: bool = True,
    keys: Sequence[str] = (),
    gap: str = SESSION_GAP,
    reset_heading: bool = False,
    axes: str = "code",
    ticks_to_meters: float = TICKS_TO_METERS,
    span: str | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """``reckon_events`` with the filter's position ``kf_state_x/y`` and covariance.

    ``q`` is process noise in m²/s, ``r`` measurement noise in m², ``p0`` the
    covariance at a session's start. Fixes are taken in metres from the session's
    first; those out of bounds or incomplete are ignored. Without GPS the filter
    only predicts."""
    chunks = _reckoned(events, keys, gap, reset_heading, ticks_to_meters, span, max_rows)
    fix = passes(f"gps_computed = 1 AND {SPATIAL_RULES['valid_spatial_bounds']}")
    since_start = seconds_between("timestamp", "session_start")
    hidden = [*TIES, "_origin_lat", "_origin_lon", "_fix_ts"]
    if not use_gps:
        return (
            chunks.plain()
            .withColumns({STATE[0]: F.col(ESTIMATED[0]), STATE[1]: F.col(ESTIMATED[1])})
            .withColumn(COVARIANCE, F.lit(float(p0)) + F.lit(float(q)) * since_start)
            .drop(*hidden, "_fix_no")
        )

    places = [F.col(name) for name in ("latitude", "longitude", "_origin_lat", "_origin_lon")]
    x, y = offset_metres(*places, axes=axes)
    prepared = chunks.df.withColumns(
        {
            "_fix": fix,
            "_mx": F.when(fix, x - F.col(ESTIMATED[0])),
            "_my": F.when(fix, y - F.col(ESTIMATED[1])),
            "_first_fix": F.col("_fix_ts").isNull(),
            # Seconds of prediction before a fix, and since the session began.
            "_wait": seconds_between("timestamp", F.coalesce("_fix_ts", "session_start")),
            "_age": since_start,
        }
    ).drop(*hidden)
    staged = chunks.using(stage(prepared))
    fused = _filtered(staged, float(q), float(r), float(p0))
    return fused.withColumns(
        {
            STATE[0]: F.col(ESTIMATED[0]) + F.col("_cx"),
            STATE[1]: F.col(ESTIMATED[1]) + F.col("_cy"),
        }
    ).drop("_cx", "_cy")


def localization_features(events: DataFrame, **options) -> DataFrame:
    """Both feature stores in one table: the estimated path (IMU and encoder), the
    corrected path (all three) and the drift between them. Options as in
    ``kalman_fuse``."""
    fused = kalman_fuse(events, **options)
    paths = [F.col(name) for name in (*ESTIMATED, *STATE)]
    return fused.withColumns(
        {CORRECTED[0]: F.col(STATE[0]), CORRECTED[1]: F.col(STATE[1]), DRIFT: distance(*paths)}
    )


def _reckoned(
    events: DataFrame,
    keys: Sequence[str],
    gap: str,
    reset_heading: bool,
    ticks_to_meters: float,
    span: str | None,
    max_rows: int | None,
) -> Chunked:
    imu, encoder = F.col("imu_computed") == 1, F.col("encoder_computed") == 1
    chunks = chunked(events.withColumns(dict(zip(TIES, _ties()))), ["timestamp", *TIES], keys, span, max_rows)

    time = F.col("timestamp")
    readings = {"_imu_ts": F.when(imu, time), "_encoder_ts": F.when(encoder, time)}
    chunks = scan(chunks, session_scan(chunks, gap), hold_scan(chunks, readings, current=False))

    def since(previous: str):
        return F.when(F.col(previous) >= F.col("session_start"), seconds_between("timestamp", previous))

    metres = F.when(encoder, F.col("ticks") * F.lit(ticks_to_meters))
    wait = since("_encoder_ts")
    turn = F.when(imu, F.radians("gyro_z") * since("_imu_ts"))
    fix = passes(f"gps_computed = 1 AND {SPATIAL_RULES['valid_spatial_bounds']}")
    chunks = chunks.using(
        chunks.df.withColumns(
            {
                "velocity_mps": F.when(wait > 0, metres / wait),
                "_turn": F.coalesce(turn, F.lit(0.0)),
                "_step": F.coalesce(metres, F.lit(0.0)),
                "_wait": wait,
            }
        )
    )
    poses = pose_scan(chunks, F.col("_turn"), F.col("_step"), reset_heading)
    known = segment_scan(
        chunks,
        "session_id",
        first_known={
            "_origin_lat": F.when(fix, F.col("latitude")),
            "_origin_lon": F.when(fix, F.col("longitude")),
        },
        held_before={"_previous_v": F.col("velocity_mps"), "_fix_ts": F.when(fix, time)},
    )
    numbers = segment_scan(chunks, sums={"_fix_no": F.when(fix, F.lit(1))})
    chunks = scan(chunks, poses, known, numbers)
    change = (F.col("velocity_mps") - F.col("_previous_v")) / F.col("_wait")
    return chunks.using(
        chunks.df.withColumn("acceleration_mps2", change).drop(
            "_previous_v", "_imu_ts", "_encoder_ts", "_turn", "_step", "_wait", "prev_ts"
        )
    )


# The filter ------------------------------------------------------------------

MAP = ("a", "bx", "by", "c", "hx", "hy", "j")  # one run of fixes as a map of (c, P)
HELPERS = ("_fix", "_mx", "_my", "_first_fix", "_wait", "_age", "_fix_no")


def _struct(**fields: Column) -> Column:
    return F.struct(*(value.alias(name) for name, value in fields.items()))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _compose(i: Column, k: Column) -> Column:
    """The map of run ``i`` followed by run ``k``."""

    def given(d: Column) -> Column:
        return _struct(
            a=k["a"] * i["a"] / d,
            bx=k["a"] * (i["bx"] + i["c"] * k["hx"]) / d + k["bx"],
            by=k["a"] * (i["by"] + i["c"] * k["hy"]) / d + k["by"],
            c=k["a"] * k["a"] * i["c"] / d + k["c"],
            hx=i["a"] * (k["hx"] - k["j"] * i["bx"]) / d + i["hx"],
            hy=i["a"] * (k["hy"] - k["j"] * i["by"]) / d + i["hy"],
            j=i["a"] * i["a"] * k["j"] / d + i["j"],
        )

    return _bind(1.0 + i["c"] * k["j"], given)


def _apply(state: Column, k: Column) -> Column:
    """The state (x, y, p) behind run ``k``."""

    def given(d: Column) -> Column:
        return _struct(
            x=k["a"] * (state["x"] + state["p"] * k["hx"]) / d + k["bx"],
            y=k["a"] * (state["y"] + state["p"] * k["hy"]) / d + k["by"],
            p=k["a"] * k["a"] * state["p"] / d + k["c"],
        )

    return _bind(1.0 + state["p"] * k["j"], given)


def _map_of_fix(q: float, r: float, p0: float) -> Column:
    """What one fix does. Behind a session's first one nothing before it counts."""
    noise = F.lit(q) * F.col("_wait")
    s = noise + F.lit(r)
    step = _struct(
        a=F.lit(r) / s,
        bx=noise / s * F.col("_mx"),
        by=noise / s * F.col("_my"),
        c=noise * F.lit(r) / s,
        hx=F.col("_mx") / s,
        hy=F.col("_my") / s,
        j=1.0 / s,
    )
    zero = F.lit(0.0)
    known = _struct(a=zero, bx=zero, by=zero, c=F.lit(p0), hx=zero, hy=zero, j=zero)
    return F.when(F.col("_first_fix"), _compose(known, step)).otherwise(step)


def _runs(members: DataFrame, group: Sequence[str]) -> DataFrame:
    """Members (group, ``at``, ``map``) in runs of ``RUN``: (group, ``at``, ``members``,
    ``map``), the map of the whole run. Written, as both ways through the tree read them."""
    sorted_members = F.sort_array(F.collect_list(F.struct("at", "map")))
    runs = members.groupBy(*group, F.floor(F.col("at") / RUN).cast("long").alias("run")).agg(sorted_members.alias("members"))
    one, zero = F.lit(1.0), F.lit(0.0)
    idle = _struct(a=one, bx=zero, by=zero, c=zero, hx=zero, hy=zero, j=zero)
    whole = F.aggregate("members", idle, lambda so_far, member: _compose(so_far, member["map"]))
    return stage(runs.select(*group, F.col("run").alias("at"), "members", whole.alias("map")))


def _states(runs: DataFrame, group: Sequence[str]) -> DataFrame:
    """Runs (group, ``members``, ``state`` they begin in) to (group, ``at``, ``before``,
    ``after``): the states their members begin and end in."""
    moved = "array<struct<at:bigint,before:struct<x:double,y:double,p:double>,after:struct<x:double,y:double,p:double>>>"

    def step(so_far: Column, member: Column) -> Column:
        def given(after: Column) -> Column:
            entry = _struct(at=member["at"], before=so_far["state"], after=after)
            return _struct(state=after, out=F.concat(so_far["out"], F.array(entry)))

        return _bind(_apply(so_far["state"], member["map"]), given)

    start = _struct(state=F.col("state"), out=F.array().cast(moved))
    folded = F.aggregate("members", start, step, lambda so_far: so_far["out"])
    return runs.select(*group, F.explode(folded).alias("_s")).select(*group, "_s.at", "_s.before", "_s.after")


def _after_fixes(fixes: DataFrame, group: Sequence[str]) -> DataFrame:
    """The state behind every fix: (group, ``at``, ``after``)."""
    low = _runs(fixes.select(*group, "at", "map"), group)
    high = _runs(low.select(*group, "at", "map"), group)
    zero = F.lit(0.0)
    ends = F.sort_array(F.collect_list(F.struct("at", "map")))
    series = high.groupBy(*group).agg(ends.alias("members")).withColumn("state", _struct(x=zero, y=zero, p=zero))

    def down(runs: DataFrame, above: DataFrame) -> DataFrame:
        begun = above.select(*group, "at", F.col("before").alias("state"))
        return _states(runs.drop("map").join(begun, [*group, "at"]), group)

    return down(low, down(high, _states(series, group))).select(*group, "at", "after")


def _filtered(chunks: Chunked, q: float, r: float, p0: float) -> DataFrame:
    rows, group = chunks.df, [*chunks.group] or ["_all"]
    if not chunks.group:
        rows = rows.withColumn("_all", F.lit(0))
    number = F.coalesce("_fix_no", F.lit(0)).cast("long")
    fixes = rows.filter("_fix").withColumns({"at": number - 1, "map": _map_of_fix(q, r, p0)})
    own = fixes.select(*group, "at", F.col("session_id").alias("_fixed_in"), F.col("_age").alias("_fixed_at"))
    states = _after_fixes(fixes, group).join(own, [*group, "at"]).select(
        *group, (F.col("at") + 1).alias("_at"), "after", "_fixed_in", "_fixed_at"
    )
    # Rows before the first fix have none to look for; they must not meet in one task.
    astray = -1 - F.pmod(F.xxhash64("timestamp", "_age"), F.lit(1 << 16))
    joined = rows.withColumn("_at", F.when(number > 0, number).otherwise(astray)).join(states, [*group, "_at"], "left")
    # A row goes on from its session's latest fix, else from the session's start.
    fixed = F.coalesce(F.col("_fixed_in") == F.col("session_id"), F.lit(False))

    def since(name: str, start: float) -> Column:
        return F.when(fixed, F.col(f"after.{name}")).otherwise(F.lit(start))

    waited = F.when(fixed, F.col("_age") - F.col("_fixed_at")).otherwise(F.col("_age"))
    fused = joined.withColumns(
        {"_cx": since("x", 0.0), "_cy": since("y", 0.0), COVARIANCE: since("p", p0) + F.lit(q) * waited}
    )
    return chunks.using(fused.drop(*HELPERS, "_at", "after", "_fixed_in", "_fixed_at", "_all")).plain()
