"""Resampling, histories, and that streams give what batches give."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from odotrack.operators.bronze import bronze_encoder, bronze_gps, bronze_imu
from odotrack.operators.history import as_of, current_version, scd2_history
from odotrack.operators.kinematics import align
from odotrack.operators.resample import (
    resample_aligned,
    resample_encoder,
    resample_gps,
    resample_imu,
)
from odotrack.sources.tables import write_stream
from odotrack.streaming.sessions import session_summary

T0 = datetime(2026, 5, 10, 14, 32, 27)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def bronze(spark):
    stamps = [at(i / 10) for i in range(30)]
    return (
        spark.createDataFrame(
            [("IMU", 9.8 + 0.01 * i, -2.1 + 0.005 * i, 0.05 + 0.001 * i, t) for i, t in enumerate(stamps)],
            "sensor string, accel_x double, accel_y double, gyro_z double, timestamp timestamp",
        ),
        spark.createDataFrame(
            [("ENCODER", 100 + 5 * i, t) for i, t in enumerate(stamps)], "sensor string, ticks long, timestamp timestamp"
        ),
        spark.createDataFrame(
            [("GPS", 40.7128 + 0.0001 * i, -74.0060 + 0.0001 * i, t) for i, t in enumerate(stamps)],
            "sensor string, latitude double, longitude double, timestamp timestamp",
        ),
    )


class TestResample:
    def test_imu(self, bronze):
        rows = resample_imu(bronze[0], samples=True).orderBy("timestamp").collect()
        assert [row.timestamp for row in rows] == [at(0), at(1), at(2)]
        assert [row.sample_count for row in rows] == [10, 10, 10]
        assert [row.spread_accel_x for row in rows] == pytest.approx([0.09] * 3)
        assert rows[0].avg_accel_x == pytest.approx(9.845)
        assert rows[0].vibration_index_x == pytest.approx(0.0302765)

    def test_columns(self, bronze):
        assert resample_imu(bronze[0]).columns == [
            "timestamp",
            "avg_accel_x",
            "spread_accel_x",
            "vibration_index_x",
            "avg_accel_y",
            "spread_accel_y",
            "avg_gyro_z",
        ]

    def test_encoder(self, bronze):
        rows = resample_encoder(bronze[1]).orderBy("timestamp").collect()
        assert [row.total_ticks_per_sec for row in rows] == [1225, 1725, 2225]
        rows = resample_encoder(bronze[1], mode="cumulative").collect()
        assert [row.total_ticks_per_sec for row in rows] == [45, 45, 45]
        with pytest.raises(ValueError):
            resample_encoder(bronze[1], mode="total")

    def test_gps(self, bronze):
        rows = resample_gps(bronze[2], stability=True).orderBy("timestamp").collect()
        assert rows[0].latitude == pytest.approx(40.71325)
        assert all(row.stddev_latitude < 0.01 and row.stddev_longitude < 0.01 for row in rows)

    def test_single_sample_and_no_timestamp(self, spark):
        rows = [("IMU", 1.0, 2.0, 3.0, T0), ("IMU", 1.0, 2.0, 3.0, None)]
        df = spark.createDataFrame(rows, "sensor string, accel_x double, accel_y double, gyro_z double, timestamp timestamp")
        (row,) = resample_imu(df).collect()
        assert row.vibration_index_x is None and row.spread_accel_x == 0.0

    def test_keys(self, bronze):
        two = bronze[1].withColumn("robot_id", F.explode(F.array(F.lit(1), F.lit(None))))
        rows = resample_encoder(two, keys=["robot_id"])
        assert rows.columns == ["robot_id", "timestamp", "total_ticks_per_sec"]
        assert rows.count() == 6

    @pytest.mark.parametrize("keys", [[], ["robot_id"]])
    def test_one_pass_equals_three_and_a_join(self, spark, keys):
        """With seconds that lack a sensor, an unknown sensor and a robot without id."""
        sensor = F.element_at(F.array(*map(F.lit, ["IMU", "ENCODER", "GPS", "LIDAR"])), (F.hash("id") % 2 + 2 + F.col("id") % 2).cast("int"))
        raw = spark.range(400).select(
            sensor.alias("sensor"),
            F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("robot_id"),
            (F.lit(T0).cast("timestamp") + F.make_dt_interval(secs=F.col("id") / 3)).alias("ts"),
            F.struct(
                F.sin("id").alias("accel_x"),
                F.cos("id").alias("accel_y"),
                F.when(F.col("id") % 9 > 0, F.sin(F.col("id") * 2)).alias("gyro_z"),
                F.col("id").alias("ticks"),
                F.cos(F.col("id") * 3).alias("lat"),
                F.sin(F.col("id") * 3).alias("lon"),
            ).alias("data"),
        )
        three = align(
            resample_imu(bronze_imu(raw, keys), keys=keys),
            resample_encoder(bronze_encoder(raw, keys), keys=keys),
            resample_gps(bronze_gps(raw, keys), keys=keys),
            keys,
        )
        one = resample_aligned(raw, keys=keys)
        assert one.columns == three.columns

        def rounded(df):
            return df.withColumns({c: F.round(c, 9) for c, kind in df.dtypes if kind == "double"})

        assert rounded(one).exceptAll(rounded(three)).isEmpty()
        assert rounded(three).exceptAll(rounded(one)).isEmpty()
        assert not one.filter("total_ticks_per_sec IS NULL").isEmpty()

    def test_one_pass_scans_once(self, spark, tmp_path):
        raw = spark.createDataFrame([("IMU", T0, (1.0,))], "sensor string, ts timestamp, data struct<accel_x:double>")
        raw.write.parquet(str(tmp_path / "raw"))
        plan = resample_aligned(spark.read.parquet(str(tmp_path / "raw")))
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan") == 1 and text.count("Exchange") == 1


class TestHistory:
    def test_current(self, spark):
        rows = [(T0, 40.7128, None), (at(1), 40.7138, None), (T0, 40.7120, datetime(2026, 5, 10, 14, 33))]
        df = spark.createDataFrame(rows, "timestamp timestamp, latitude double, __END_AT timestamp")
        df = df.withColumn("__START_AT", F.col("timestamp"))
        assert current_version(df).count() == 2
        assert current_version(df).columns == ["timestamp", "latitude"]

    @pytest.mark.parametrize("max_rows", [1_000_000, 3, None])
    def test_versions(self, spark, max_rows):
        """Out of order, twice, and tied; also with keys cut into chunks."""
        rows = [("a", 3, "z"), ("a", 1, "x"), ("b", 5, "q"), ("a", 2, "y"), ("a", 2, "y"), ("a", 3, "w"), (None, 1, "n")]
        rows += [("hot", i, str(i)) for i in range(20)]
        changes = spark.createDataFrame(rows, "id string, seq long, v string")
        history = scd2_history(changes, ["id"], "seq", max_rows=max_rows)
        got = {tuple(row) for row in history.collect()}
        wanted = {
            ("a", 1, "x", 1, 2),
            ("a", 2, "y", 2, 3),
            ("a", 3, "w", 3, None),
            ("b", 5, "q", 5, None),
            (None, 1, "n", 1, None),
        }
        wanted |= {("hot", i, str(i), i, i + 1 if i < 19 else None) for i in range(20)}
        assert got == wanted
        assert {row.id: row.v for row in current_version(history).collect()} == {"a": "w", "b": "q", None: "n", "hot": "19"}
        assert {row.id: row.v for row in as_of(history, 2).collect()} == {"a": "y", None: "n", "hot": "2"}

    def test_sequence_as_key_never_closes(self, bronze):
        imu = resample_imu(bronze[0])
        history = scd2_history(imu.unionByName(imu), ["timestamp"], "timestamp")
        assert history.count() == 3
        assert current_version(history).exceptAll(imu).isEmpty()

    def test_keys_only(self, spark):
        changes = spark.createDataFrame([("a", 1), ("a", 1), ("a", 4)], "id string, seq int")
        assert {tuple(r) for r in scd2_history(changes, ["id"], "seq").collect()} == {("a", 1, 1, 4), ("a", 4, 4, None)}


def land(folder, name, seconds, mtime):
    """One file of IMU events, with a modification time of its own."""
    lines = [json.dumps({"sensor": "IMU", "ts": str(at(s)), "data": {"accel_x": float(s)}}) for s in seconds]
    path = folder / name
    path.write_text("\n".join(lines))
    os.utime(path, (mtime, mtime))


class TestStreams:
    SCHEMA = "sensor string, ts timestamp, data struct<accel_x:double, accel_y:double, gyro_z:double>"

    def run(self, spark, landing, out, transform):
        stream = spark.readStream.schema(self.SCHEMA).option("maxFilesPerTrigger", 1).json(str(landing))
        query = write_stream(transform(stream), str(out / "table"), str(out / "checkpoint"))
        query.awaitTermination()
        return spark.read.parquet(str(out / "table")), query

    def test_closed_windows_equal_the_batch(self, spark, tmp_path):
        landing = tmp_path / "landing"
        landing.mkdir()
        for n in range(3):
            land(landing, f"{n}.json", [n * 100 + i / 2 for i in range(120)], 1_000_000 + n)
        got, _ = self.run(spark, landing, tmp_path, lambda raw: resample_imu(bronze_imu(raw)))
        batch = resample_imu(bronze_imu(spark.read.schema(self.SCHEMA).json(str(landing))))
        # The last minute stays open: the watermark is 60 s behind 259.5 s.
        closed = batch.filter(F.col("timestamp") + F.expr("INTERVAL 1 SECOND") <= F.lit(at(199.5)))
        assert got.exceptAll(closed).isEmpty() and closed.exceptAll(got).isEmpty()
        assert batch.count() > closed.count() > 0

    def test_late_row_is_dropped_two_batches_on(self, spark, tmp_path):
        landing = tmp_path / "landing"
        landing.mkdir()
        land(landing, "0.json", [0], 1_000_000)
        land(landing, "1.json", [500], 1_000_001)
        land(landing, "2.json", [600], 1_000_002)
        land(landing, "3.json", [100, 700], 1_000_003)
        got, query = self.run(spark, landing, tmp_path, lambda raw: resample_imu(bronze_imu(raw)))
        assert sorted(row.timestamp for row in got.collect()) == [at(0), at(500), at(600)]
        dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
        assert dropped == 1

    def test_files_are_read_once(self, spark, tmp_path):
        landing = tmp_path / "landing"
        landing.mkdir()
        land(landing, "0.json", range(5), 1_000_000)
        got, _ = self.run(spark, landing, tmp_path, bronze_imu)
        assert got.count() == 5
        land(landing, "1.json", range(5, 8), 1_000_001)
        got, _ = self.run(spark, landing, tmp_path, bronze_imu)
        assert got.count() == 8

    def test_sessions(self, spark, tmp_path):
        """A gap of exactly 5 s does not part a session, on a stream as in a batch."""
        landing = tmp_path / "landing"
        landing.mkdir()
        land(landing, "0.json", [0, 2, 7, 13, 14, 300], 1_000_000)
        summary = [F.count("*").alias("events")]
        got, _ = self.run(spark, landing, tmp_path, lambda raw: session_summary(bronze_imu(raw), summary))
        wanted = {(at(0), at(7), 3), (at(13), at(14), 2)}
        assert {tuple(row) for row in got.collect()} == wanted
        batch = session_summary(bronze_imu(spark.read.schema(self.SCHEMA).json(str(landing))), summary)
        assert {tuple(row) for row in batch.collect()} == wanted | {(at(300), at(300), 1)}
