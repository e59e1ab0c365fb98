"""Fleet operators on small tables, by hand."""

import math
from datetime import datetime, timedelta

import pytest

from odotrack.operators.fleet import (
    TerrainThresholds,
    apply_pruning,
    classify_terrain,
    drift_trend,
    flag_anomalies,
    fleet_kpis,
    pruning_manifest,
    session_terrain,
    with_terrain,
)

T0 = datetime(2026, 5, 10, 23, 59, 50)
DRIFT = "target_trajectory_drift_meters"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def test_kpis(spark):
    rows = [(1, 1, at(0), 3.0), (1, 1, at(1), 4.0), (1, 2, at(9), None), (2, 1, at(0), 5.0), (None, 1, at(0), 1.0)]
    df = spark.createDataFrame(rows, f"robot int, session_id long, timestamp timestamp, {DRIFT} double")
    kpis = fleet_kpis(df, ["robot"]).collect()
    sessions = {(r.robot, r.session_id): r for r in kpis if r.level == "session"}
    assert set(sessions) == {(1, 1), (1, 2), (2, 1), (None, 1)}
    assert sessions[1, 1].fleet_rmse_drift == pytest.approx(math.sqrt(12.5))
    assert sessions[1, 1].fleet_mae_drift == 3.5
    assert (sessions[1, 1].seconds, sessions[1, 1].session_end) == (2, at(1))
    assert sessions[1, 2].fleet_rmse_drift is None
    robots = {r.robot: r for r in kpis if r.level == "robot"}
    assert set(robots) == {1, 2, None} and robots[1].fleet_mae_drift == 3.5 and robots[1].seconds == 3
    (fleet,) = [r for r in kpis if r.level == "fleet"]
    assert fleet.fleet_mae_drift == pytest.approx(13 / 4)
    assert fleet.fleet_rmse_drift == pytest.approx(math.sqrt(51 / 4))


def test_kpis_without_keys_and_with_anomalies(spark):
    rows = [(1, at(0), 3.0, 1), (1, at(1), 4.0, 0)]
    df = spark.createDataFrame(rows, f"session_id long, timestamp timestamp, {DRIFT} double, odd int")
    kpis = {r.level: r for r in fleet_kpis(df, anomaly="odd").collect()}
    assert set(kpis) == {"session", "fleet"}
    assert kpis["fleet"].anomaly_share == 0.5


def test_trend(spark):
    day = timedelta(days=1)
    rows = [(1, n, T0 + n * day, 10.0 + 2 * n) for n in range(5)] + [(2, 0, T0, 1.0)]
    df = spark.createDataFrame(rows, f"robot int, session_id long, timestamp timestamp, {DRIFT} double")
    got = {r.robot: r for r in drift_trend(fleet_kpis(df, ["robot"]), ["robot"]).collect()}
    assert got[1].sessions == 5 and got[1].drift_trend_per_day == pytest.approx(2.0)
    assert got[2].drift_trend_per_day is None


def test_terrain(spark):
    rows = [
        (1, 5.0, 9.0, 0.0, 0.0),
        (1, 1.0, 9.0, 0.0, 0.0),
        (1, None, 9.0, 0.0, 0.0),
        (1, 1.0, 0.0, -40.0, 0.1),
        (2, 1.0, 0.0, -40.0, 2.0),
        (2, 1.0, 0.0, 50.0, None),
        (2, None, None, None, None),
        (2, 3.0, 0.0, 0.0, 0.0),
    ]
    columns = "session_id long, vibration_index_x double, spread_accel_x double, avg_gyro_z double, acceleration_mps2 double"
    df = classify_terrain(spark.createDataFrame(rows, columns))
    got = [row.terrain for row in df.collect()]
    assert got == ["rough terrain", "pothole", "pothole", "black ice", "normal", "normal", "normal", "rough terrain"]
    assert df.first().variance_x == 25.0
    labels = session_terrain(df)
    assert {(r.session_id, r.session_terrain, r.terrain_seconds) for r in labels.collect()} == {
        (1, "pothole", 2),
        (2, "normal", 3),
    }
    joined = with_terrain(df, labels)
    assert joined.count() == 8 and joined.columns == [*df.columns, "session_terrain"]
    assert classify_terrain(df, TerrainThresholds(rough_vibration=10)).filter("terrain = 'rough terrain'").isEmpty()


def test_terrain_ties_go_to_the_hazard(spark):
    df = spark.createDataFrame([(1, None, "normal"), (1, None, "black ice")], "session_id long, robot int, terrain string")
    labels = session_terrain(df, ["robot"])
    assert labels.first().session_terrain == "black ice"
    assert with_terrain(df, labels, ["robot"]).filter("session_terrain = 'black ice'").count() == 2


def test_anomalies(spark):
    rows = [(1, 1.0, float(v)) for v in (0, 0, 0, 0, 0, 0, 0, 0, 0, 90)] + [(2, 99.0, 1.0), (2, None, 1.0)]
    df = spark.createDataFrame(rows, f"session_id long, avg_accel_x double, {DRIFT} double")
    got = flag_anomalies(df, {"calm": "ABS(avg_accel_x) <= 15"}, z_max=2.5)
    assert got.count() == 12
    odd = {(r.session_id, r.avg_accel_x, r[DRIFT]) for r in got.filter("is_anomaly = 1").collect()}
    assert odd == {(1, 1.0, 90.0), (2, 99.0, 1.0), (2, None, 1.0)}
    assert got.filter("session_id = 2 AND z_score IS NOT NULL").isEmpty()  # no spread, no score
    kept = flag_anomalies(df, {"calm": "ABS(avg_accel_x) <= 15"}, z_max=2.5, on_null="keep")
    assert kept.filter("is_anomaly = 1").count() == 2


@pytest.fixture(scope="module")
def tables(spark):
    """Seconds 0..19 across midnight, boring but for 5, 6 (drift), 12 (unknown) and
    17 (anomalous), with four IMU events each."""
    rows = [(7, at(s), None if s == 12 else 9.0 if s in (5, 6) else 0.1, 0.1, int(s == 17)) for s in range(20)]
    features = spark.createDataFrame(
        rows, f"robot int, timestamp timestamp, {DRIFT} double, vibration_index_x double, is_anomaly int"
    )
    raw = [("IMU", 7, at(s / 4)) for s in range(-4, 84)] + [("GPS", 8, at(1)), ("GPS", None, at(1)), ("GPS", 7, None)]
    return features, spark.createDataFrame(raw, "sensor string, robot int, ts timestamp")


class TestPruning:
    def manifest(self, tables, **options):
        return pruning_manifest(*tables, 1.0, 0.5, ["robot"], **options)

    @pytest.mark.parametrize("span", ["1 day", "3 seconds"])
    def test_segments(self, tables, span):
        rows = self.manifest(tables, span=span).orderBy("seg_start").collect()
        assert [(r.robot, r.seg_start, r.seg_end, r.seconds, r.raw_rows) for r in rows] == [
            (7, at(0), at(5), 5, 20),
            (7, at(7), at(12), 5, 20),
            (7, at(13), at(17), 4, 16),
            (7, at(18), at(20), 2, 8),
        ]

    def test_pruned(self, tables):
        features, raw = tables
        kept = apply_pruning(raw, self.manifest(tables), ["robot"])
        assert kept.columns == raw.columns
        assert kept.count() == raw.count() - 64
        times = {r.ts for r in kept.filter("robot = 7 AND ts IS NOT NULL").collect()}
        wanted = {at(s / 4) for s in range(-4, 84) if not 0 <= s < 80 or s // 4 in (5, 6, 12, 17)}
        assert times == wanted
        assert kept.filter("sensor = 'GPS'").count() == 3

    def test_nothing_to_prune(self, tables):
        features, raw = tables
        empty = pruning_manifest(features, raw, -1.0, 0.5, ["robot"])
        assert empty.isEmpty()
        assert apply_pruning(raw, empty, ["robot"]).count() == raw.count()
