"""Kinematics and trajectories on small tables, against plain windows and by hand."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from odotrack.operators.kinematics import (
    acceleration,
    align,
    delta_seconds,
    gates,
    kinetic_master,
    velocity,
)
from odotrack.operators.quality import FALLBACK_RULES
from odotrack.operators.trajectory import (
    dead_reckoning,
    drift,
    gps_path,
    heading,
    trajectory_features,
)

T0 = datetime(2026, 5, 10, 14, 32, 27)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def silver(spark):
    imu = [(at(i), 9.8 + 0.01 * i, -2.1 + 0.005 * i, 0.05 + 0.001 * i) for i in range(10)]
    encoder = [(at(i), 1000 + 50 * i) for i in range(10)]
    gps = [(at(i), 40.7128 + 0.0001 * i, -74.0060 + 0.0001 * i) for i in range(10)]
    return (
        spark.createDataFrame(imu, "timestamp timestamp, avg_accel_x double, avg_accel_y double, avg_gyro_z double"),
        spark.createDataFrame(encoder, "timestamp timestamp, total_ticks_per_sec long"),
        spark.createDataFrame(gps, "timestamp timestamp, latitude double, longitude double"),
    )


@pytest.fixture(scope="module")
def kinetic(spark):
    rows = [
        (at(i), 9.8 + 0.01 * i, 0.05 + 0.001 * i, 1.0 + 0.01 * i, 40.7128 + 0.0001 * i, -74.0060 + 0.0001 * i)
        for i in range(20)
    ]
    return spark.createDataFrame(
        rows,
        "timestamp timestamp, avg_accel_x double, avg_gyro_z double, velocity_mps double, "
        "latitude double, longitude double",
    )


class TestKinematics:
    def test_left_join_keeps_every_imu_second(self, spark, silver):
        imu, encoder, gps = silver
        sparse = align(imu, encoder.filter(F.col("timestamp") < F.lit(at(4))), gps.limit(0))
        assert sparse.count() == 10
        assert sparse.filter("total_ticks_per_sec IS NULL").count() == 6
        assert sparse.filter("latitude IS NULL").count() == 10
        assert sparse.columns[0] == "timestamp"

    def test_keys_may_be_null(self, silver):
        keyed = [df.withColumn("robot", F.lit(None).cast("int")) for df in silver]
        assert align(*keyed, keys=["robot"]).filter("latitude IS NOT NULL").count() == 10

    def test_velocity_and_acceleration(self, silver):
        imu, encoder, gps = silver
        rows = acceleration(velocity(align(imu, encoder, gps))).orderBy("timestamp").collect()
        assert rows[0].velocity_mps == pytest.approx(1.745)
        assert rows[0].acceleration_mps2 == 0.0
        assert rows[1].acceleration_mps2 == pytest.approx(50 * 0.001745)

    def test_acceleration_needs_both_velocities(self, spark):
        rows = [(at(0), 1.0), (at(2), None), (at(3), 4.0), (at(5), 8.0)]
        df = spark.createDataFrame(rows, "timestamp timestamp, velocity_mps double")
        got = [row.acceleration_mps2 for row in acceleration(df, span="1 second").orderBy("timestamp").collect()]
        assert got == [0.0, None, None, 2.0]

    def test_delta_seconds(self, spark):
        df = spark.createDataFrame([(at(0),), (at(0.25),), (at(86400),)], "timestamp timestamp")
        got = [row.delta_t_sec for row in delta_seconds(df).orderBy("timestamp").collect()]
        assert got == [0.0, 0.25, 86399.75]

    def test_gates_pass_the_fixture(self, silver):
        assert kinetic_master(*silver).count() == 10

    def test_gates_drop_seconds_without_gps_or_encoder(self, silver):
        imu, encoder, gps = silver
        some = gps.filter(F.col("timestamp") >= F.lit(at(3)))
        dropped = kinetic_master(imu, encoder, some)
        assert dropped.count() == 7
        assert kinetic_master(imu, encoder, some, on_null="keep").count() == 10
        # The first row kept refers to a predecessor that was not.
        first = dropped.orderBy("timestamp").first()
        assert first.acceleration_mps2 == pytest.approx(50 * 0.001745)

    def test_rules(self):
        assert set(gates()) == {"valid_heartbeat_timestamp", "valid_spatial_bounds", *FALLBACK_RULES}
        assert set(gates({})) == {"valid_heartbeat_timestamp", "valid_spatial_bounds"}


class TestTrajectory:
    def test_one_session(self, kinetic):
        rows = trajectory_features(kinetic).orderBy("timestamp").collect()
        assert {row.session_id for row in rows} == {1}
        assert rows[0].feature_actual_path_x == 0.0 and rows[0].feature_actual_path_y == 0.0
        assert rows[0].target_trajectory_drift_meters == 0.0
        assert rows[1].feature_actual_path_x == pytest.approx(0.0001 * 111000.0)
        assert rows[1].feature_actual_path_y == pytest.approx(0.0001 * 111000.0 * 0.7)

    def test_columns(self, kinetic):
        assert trajectory_features(kinetic).columns == [
            *kinetic.columns,
            "session_id",
            "feature_estimated_path_x",
            "feature_estimated_path_y",
            "feature_actual_path_x",
            "feature_actual_path_y",
            "target_trajectory_drift_meters",
        ]

    def test_straight_path_never_goes_back(self, kinetic):
        straight = kinetic.withColumn("avg_gyro_z", F.lit(0.0))
        xs = [row.feature_estimated_path_x for row in dead_reckoning(straight).orderBy("timestamp").collect()]
        assert xs == sorted(xs) and xs[0] == 0.0

    def test_first_row_of_a_later_session_gets_the_gap(self, spark):
        rows = [(at(0), 0.0, 2.0, 40.0, -74.0), (at(10), 0.0, 2.0, 40.0, -74.0)]
        df = spark.createDataFrame(
            rows, "timestamp timestamp, avg_gyro_z double, velocity_mps double, latitude double, longitude double"
        )
        second = trajectory_features(df).orderBy("timestamp").collect()[1]
        assert (second.session_id, second.feature_estimated_path_x) == (2, 20.0)
        second = trajectory_features(df, zero_gap_dt=True).orderBy("timestamp").collect()[1]
        assert (second.session_id, second.feature_estimated_path_x) == (2, 0.0)

    def test_heading_resets_with_the_session(self, spark):
        rows = [(at(s), 90.0, 1.0) for s in (0, 1, 2, 10, 11)]
        df = spark.createDataFrame(rows, "timestamp timestamp, avg_gyro_z double, velocity_mps double")

        def headings(**options):
            rows = heading(df, **options).orderBy("timestamp").collect()
            return [round(row.heading_theta / (math.pi / 2), 9) for row in rows]

        assert headings(zero_gap_dt=True) == [0, 1, 2, 0, 1]
        assert headings() == [0, 1, 2, 8, 9]
        assert headings(reset_per_session=False, zero_gap_dt=True) == [0, 1, 2, 2, 3]
        assert headings(reset_per_session=False, zero_gap_dt=True, span="1 second") == [0, 1, 2, 2, 3]

    def test_axes(self, kinetic):
        code = gps_path(kinetic).orderBy("timestamp").collect()[-1]
        east = gps_path(kinetic, axes="east_north").orderBy("timestamp").collect()[-1]
        assert code.feature_actual_path_x == east.feature_actual_path_y
        assert code.feature_actual_path_y == east.feature_actual_path_x
        with pytest.raises(ValueError):
            gps_path(kinetic, axes="polar")

    def test_null_first_fix_hides_the_session(self, kinetic):
        blind = kinetic.withColumn("latitude", F.when(F.col("timestamp") > F.lit(T0), F.col("latitude")))
        got = trajectory_features(blind, span="3 seconds")
        assert got.filter("target_trajectory_drift_meters IS NOT NULL").isEmpty()
        assert got.filter("feature_actual_path_y IS NULL").isEmpty()

    def test_drift_by_hand(self, spark):
        names = "feature_estimated_path_x double, feature_estimated_path_y double, "
        names += "feature_actual_path_x double, feature_actual_path_y double"
        df = spark.createDataFrame([(5.0, 0.0, 4.0, 3.0), (10.0, 0.0, 9.5, 2.0)], names)
        got = sorted(row.target_trajectory_drift_meters for row in drift(df).collect())
        assert got == pytest.approx([math.sqrt(4.25), math.sqrt(10)])


def plain_features(df, keys, reset):
    """The same definitions, with a task per series."""
    by_key = Window.partitionBy(*keys).orderBy("timestamp")
    dt = F.coalesce(
        (F.unix_micros("timestamp") - F.unix_micros(F.lag("timestamp").over(by_key))) / 1e6, F.lit(0.0)
    )
    first = F.lag("timestamp").over(by_key).isNull()
    df = df.withColumns({"dt": dt, "new": F.when(first | (dt > 5), 1).otherwise(0)})
    df = df.withColumn("session_id", F.sum("new").over(by_key))
    here = Window.partitionBy(*keys, "session_id").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    turning = here if reset else by_key.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("h", F.sum(F.radians("avg_gyro_z") * F.col("dt")).over(turning))
    df = df.withColumns(
        {
            "x": F.sum(F.col("velocity_mps") * F.cos("h") * F.col("dt")).over(here),
            "y": F.sum(F.col("velocity_mps") * F.sin("h") * F.col("dt")).over(here),
            "ax": (F.col("latitude") - F.first("latitude").over(here)) * 111000.0,
            "ay": (F.col("longitude") - F.first("longitude").over(here)) * 111000.0 * 0.7,
        }
    )
    return df.withColumn("d", F.sqrt(F.pow(F.col("ax") - F.col("x"), 2) + F.pow(F.col("ay") - F.col("y"), 2)))


@pytest.mark.parametrize("reset", [True, False])
@pytest.mark.parametrize("keys", [["robot"], []])
@pytest.mark.parametrize("span, max_rows", [("1 second", None), ("13 seconds", None), ("1 day", 9)])
def test_features_match_plain_windows(spark, keys, reset, span, max_rows):
    """NULLs in every input, in particular at session and chunk starts."""
    rng = random.Random(11)

    def maybe(value, rate):
        return None if rng.random() < rate else value

    rows, second = [], 0
    for i in range(400):
        second += rng.choice([1, 1, 1, 1, 2, 5, 6, 30])
        quiet = (i // 7) % 3 == 0  # stretches in which gyro or encoder are mostly absent
        rows.append(
            (
                None if i % 50 == 49 else i % 3 // 2,
                at(second),
                maybe(rng.uniform(-40, 40), 0.8 if quiet else 0.1),
                maybe(rng.uniform(0, 3), 0.7 if (i // 11) % 4 == 0 else 0.1),
                maybe(40 + rng.random() / 100, 0.15),
                maybe(-74 + rng.random() / 100, 0.15),
            )
        )
    df = spark.createDataFrame(
        rows,
        "robot int, timestamp timestamp, avg_gyro_z double, velocity_mps double, latitude double, longitude double",
    )
    keep = ["robot", "timestamp", "session_id"]

    def rounded(table, names):
        return table.select(*keep, *(F.round(c, 7).alias(n) for c, n in names.items()))

    reckoned = dead_reckoning(df, keys, reset_per_session=reset, span=span, max_rows=max_rows)
    plain = plain_features(df, keys, reset).cache()
    got = rounded(
        reckoned, {"heading_theta": "h", "feature_estimated_path_x": "x", "feature_estimated_path_y": "y"}
    )
    wanted = rounded(plain, {"h": "h", "x": "x", "y": "y"})
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()
    assert not wanted.filter("x IS NULL").isEmpty()

    features = trajectory_features(df, keys, reset_per_session=reset, span=span, max_rows=max_rows)
    got = rounded(
        features, {"feature_actual_path_x": "ax", "feature_actual_path_y": "ay", "target_trajectory_drift_meters": "d"}
    )
    wanted = rounded(plain, {"ax": "ax", "ay": "ay", "d": "d"})
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()
    plain.unpersist()
