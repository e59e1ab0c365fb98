"""The chunked filter against a row-by-row one in plain Python."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from odotrack.operators import fusion
from odotrack.operators.events import event_stream
from odotrack.operators.fusion import kalman_fuse, localization_features, reckon_events

T0 = datetime(2026, 5, 10, 14, 32, 27)
SCHEMA = "robot int, id int, sensor string, ts timestamp, data struct<accel_x:double,accel_y:double,gyro_z:double,ticks:long,lat:double,lon:double>"
Q, R, P0 = 0.3, 4.0, 2.0


def drive(rng, robot, size, first_id):
    second, rows = 0.0, []
    for i in range(size):
        second += rng.choice([0.0, 0.1, 0.1, 0.1, 0.3, 1.0, 5.0, 5.5, 20.0]) if i else 0.0
        sensor = rng.choice(["IMU", "IMU", "IMU", "ENCODER", "ENCODER", "GPS"])
        data = [None] * 6
        if sensor == "IMU":
            data[:3] = [rng.uniform(-2, 2), rng.uniform(-2, 2), None if rng.random() < 0.1 else rng.uniform(-50, 50)]
        elif sensor == "ENCODER":
            data[3] = None if rng.random() < 0.1 else rng.randrange(200, 900)
        else:
            data[4] = 200.0 if rng.random() < 0.1 else 40 + rng.uniform(-1, 1) / 1e4
            data[5] = None if rng.random() < 0.1 else -74 + rng.uniform(-1, 1) / 1e4
        rows.append((robot, first_id + i, sensor, T0 + timedelta(microseconds=round(second * 1e6)), tuple(data)))
    return rows


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    rows = drive(rng, 1, 300, 0) + drive(rng, 2, 40, 1000) + drive(rng, None, 30, 2000)
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def events(spark, rows):
    return event_stream(spark.createDataFrame(rows, SCHEMA), keys=["robot", "id"]).cache()


def expected(rows, use_gps=True, reset=False):
    """id -> (session, heading, est x, est y, kf x, kf y, P), event by event."""
    rank = {"IMU": 0, "ENCODER": 1, "GPS": 2}
    low = float("-inf")
    result = {}
    for robot in (1, 2, None):
        mine = [row for row in rows if row[0] == robot]
        mine.sort(key=lambda r: (r[3], rank[r[2]], [low if v is None else v for v in r[4]]))
        session, last, heading = 0, None, 0.0
        for _, number, sensor, ts, (_, _, gyro, ticks, lat, lon) in mine:
            if last is None or (ts - last).total_seconds() > 5:
                session += 1
                imu_ts = origin = None
                x = y = kx = ky = 0.0
                p, now = P0, ts
                heading = 0.0 if reset else heading
            last = ts
            p += Q * (ts - now).total_seconds()
            now = ts
            if sensor == "IMU":
                if imu_ts is not None and gyro is not None:
                    heading += math.radians(gyro) * (ts - imu_ts).total_seconds()
                imu_ts = ts
            if sensor == "ENCODER" and ticks is not None:
                dx, dy = (ticks * 0.001745 * f(heading) for f in (math.cos, math.sin))
                x, y, kx, ky = x + dx, y + dy, kx + dx, ky + dy
            if use_gps and sensor == "GPS" and lat is not None and lon is not None and abs(lat) <= 90:
                origin = origin or (lat, lon)
                gain = p / (p + R)
                kx += gain * ((lat - origin[0]) * 111000.0 - kx)
                ky += gain * ((lon - origin[1]) * 111000.0 * 0.7 - ky)
                p *= 1 - gain
            result[number] = (session, heading, x, y, kx, ky, p)
    return result


COLUMNS = [
    "session_id",
    "heading_theta",
    "feature_estimated_path_x",
    "feature_estimated_path_y",
    "kf_state_x",
    "kf_state_y",
    "kf_error_covariance_p",
]
LAYOUTS = [("1 hour", 1_000_000), ("2 seconds", None), ("37 seconds", None), ("1 hour", 20)]


@pytest.mark.parametrize("span, max_rows", LAYOUTS)
@pytest.mark.parametrize("use_gps, reset", [(True, False), (True, True), (False, False)])
def test_filter(events, rows, span, max_rows, use_gps, reset):
    fused = kalman_fuse(
        events, Q, R, P0, use_gps, keys=["robot"], reset_heading=reset, span=span, max_rows=max_rows
    )
    wanted = expected(rows, use_gps, reset)
    got = {row.id: row for row in fused.collect()}
    assert set(got) == set(wanted)
    # Events of one kind and microsecond that differ only in what their order
    # decides may swap; there are none in this table.
    for number, values in wanted.items():
        assert [got[number][name] for name in COLUMNS] == pytest.approx(list(values), abs=1e-7), number


@pytest.mark.parametrize("span, max_rows", LAYOUTS[1:])
def test_without_keys(events, rows, span, max_rows):
    one = events.filter("robot = 1").drop("robot")
    wanted = expected([row for row in rows if row[0] == 1])
    fused = kalman_fuse(one, Q, R, P0, span=span, max_rows=max_rows)
    for row in fused.collect():
        assert [row[name] for name in COLUMNS] == pytest.approx(list(wanted[row.id]), abs=1e-7)


def test_trees_of_any_height(events, rows, monkeypatch):
    """Runs of three fixes, so a robot's fixes make runs of runs and a list above them."""
    monkeypatch.setattr(fusion, "RUN", 3)
    wanted = expected(rows)
    fused = kalman_fuse(events, Q, R, P0, keys=["robot"]).collect()
    assert len(fused) == len(wanted) and sum(r.gps_computed for r in fused if r.robot == 1) > 27
    for row in fused:
        assert [row[name] for name in COLUMNS] == pytest.approx(list(wanted[row.id]), abs=1e-7)


def test_no_python_and_no_group_of_all_rows(events):
    fused = kalman_fuse(events, Q, R, P0, keys=["robot"], max_rows=None)
    plan = fused._jdf.queryExecution().optimizedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan


def test_covariance_grows_without_fixes(events):
    blind = events.filter("gps_computed = 0")
    fused = kalman_fuse(blind, Q, R, P0, keys=["robot"])
    grown = F.lit(P0) + F.lit(Q) * (F.unix_micros("timestamp") - F.unix_micros("session_start")) / 1e6
    assert fused.filter(F.abs(F.col("kf_error_covariance_p") - grown) > 1e-9).isEmpty()
    assert fused.filter(F.abs(F.col("kf_state_x") - F.col("feature_estimated_path_x")) > 1e-9).isEmpty()


def test_feature_table(events):
    features = localization_features(events, q=Q, r=R, p0=P0, keys=["robot"], span="10 seconds", max_rows=None)
    assert features.columns[: len(events.columns)] == events.columns
    assert features.count() == events.count()
    added = set(features.columns) - set(events.columns)
    assert {
        "session_id",
        "velocity_mps",
        "acceleration_mps2",
        "heading_theta",
        "kf_state_x",
        "kf_state_y",
        "kf_error_covariance_p",
        "feature_estimated_path_x",
        "feature_estimated_path_y",
        "feature_corrected_path_x",
        "feature_corrected_path_y",
        "target_trajectory_drift_meters",
    } <= added
    assert not [name for name in added if name.startswith("_")]
    gap = F.hypot(
        F.col("feature_estimated_path_x") - F.col("feature_corrected_path_x"),
        F.col("feature_estimated_path_y") - F.col("feature_corrected_path_y"),
    )
    assert features.filter(F.abs(gap - F.col("target_trajectory_drift_meters")) > 1e-9).isEmpty()


def test_velocity_from_ticks(spark):
    rows = [
        (1, i, "ENCODER", T0 + timedelta(seconds=s), (None, None, None, t, None, None))
        for i, (s, t) in enumerate([(0, 1000), (0.5, 1000), (1.5, 3000), (20, 500)])
    ]
    reckoned = reckon_events(event_stream(spark.createDataFrame(rows, SCHEMA), keys=["id"]), span="1 second", max_rows=None)
    got = [(r.velocity_mps, r.acceleration_mps2) for r in reckoned.orderBy("id").collect()]
    assert got[0] == (None, None) and got[3] == (None, None)
    assert got[1] == (pytest.approx(3.49), None)
    assert got[2] == (pytest.approx(5.235), pytest.approx(1.745))
