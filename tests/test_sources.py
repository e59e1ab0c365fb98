"""Raw JSON, rescue, tables and the whole pipeline."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from odotrack.operators.bronze import bronze_gps, bronze_imu
from odotrack.operators.quality import expect_all_or_drop
from odotrack.operators.resample import resample_aligned
from odotrack.plans import medallion
from odotrack.plans.medallion import (
    Lake,
    build_gold,
    features_from_raw,
    master_from_raw,
    run_streaming,
    silver_history,
)
from odotrack.schemas import RAW
from odotrack.sources.fixtures import load_fixture
from odotrack.sources.raw_json import (
    frozen_schema,
    infer_schema,
    read_lines,
    read_raw,
    rescue,
)
from odotrack.sources.tables import materialize, read_table, register, write_stream

T0 = datetime(2026, 5, 10, 14, 32, 27)


def event(sensor, seconds, data, **more):
    return json.dumps({"sensor": sensor, "ts": str(T0 + timedelta(seconds=seconds)), "data": data, **more})


class TestRescue:
    def one(self, spark, line):
        return rescue(spark.createDataFrame([(line,)], "value string")).first()

    def test_clean(self, spark):
        row = self.one(spark, event("IMU", 0, {"accel_x": 1.5, "accel_y": None}))
        assert (row.sensor, row.ts, row.data.accel_x, row.data.accel_y) == ("IMU", T0, 1.5, None)
        assert row._rescued_data is None and row._malformed is None

    def test_unknown_fields(self, spark):
        row = self.one(spark, event("IMU", 0, {"accel_x": 1.5, "temp": 3}, firmware="v2", tags=["a"]))
        assert row.data.accel_x == 1.5
        assert row._rescued_data == {"firmware": "v2", "data.temp": "3", "tags": '["a"]'}

    def test_misfits(self, spark):
        row = self.one(spark, event("ENCODER", 0, {"ticks": "many", "accel_x": 2.0}))
        assert (row.sensor, row.data.ticks, row.data.accel_x) == ("ENCODER", None, 2.0)
        assert row._rescued_data == {"data.ticks": "many"}
        row = self.one(spark, '{"sensor": "GPS", "ts": "noon", "data": 5}')
        assert row.sensor == "GPS" and row.ts is None and row.data is None
        assert row._rescued_data == {"ts": "noon", "data": "5"}

    @pytest.mark.parametrize(
        "line", ['{"sensor": "IMU"', "no json", "[1, 2]", "3", '{"x": 1, "x": 2}', '{"data": {"x": 1, "x": 2}}']
    )
    def test_malformed(self, spark, line):
        row = self.one(spark, line)
        assert row._malformed == line and row.sensor is None and row._rescued_data is None

    def test_stream(self, spark, tmp_path):
        (tmp_path / "in").mkdir()
        (tmp_path / "in" / "a.json").write_text(event("IMU", 0, {"accel_x": 1, "temp": 3}) + "\nbroken")
        rescued = rescue(read_lines(spark, str(tmp_path / "in"), streaming=True))
        query = (
            rescued.writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        assert {row._malformed for row in rows} == {None, "broken"}


class TestFiles:
    def test_raw_batch(self, spark, tmp_path):
        path = tmp_path / "raw"
        path.mkdir()
        (path / "a.json").write_text(event("IMU", 0, {"accel_x": 1.5}))
        assert read_raw(spark, str(path), RAW).first().data.accel_x == 1.5
        assert read_raw(spark, str(path)).first().data.accel_x == 1.5
        assert infer_schema(spark, str(path)).fieldNames() == ["data", "sensor", "ts"]

    def test_schema_is_frozen(self, spark, tmp_path):
        path, kept = tmp_path / "raw", str(tmp_path / "schema")
        path.mkdir()
        (path / "a.json").write_text(event("IMU", 0, {"accel_x": 1.5}))
        first = frozen_schema(spark, str(path), kept)
        (path / "b.json").write_text(event("GPS", 0, {"lat": 1.5}, robot_id=3))
        assert frozen_schema(spark, str(path), kept) == first
        assert infer_schema(spark, str(path)) != first

    def test_fixtures(self, spark, tmp_path):
        (tmp_path / "a.json").write_text(json.dumps([{"x": 1}, {"x": 2}]))
        (tmp_path / "a.csv").write_text("x,y\n1,b\n")
        assert load_fixture(spark, str(tmp_path / "a.json")).count() == 2
        row = load_fixture(spark, str(tmp_path / "a.csv")).first()
        assert (row.x, row.y) == ("1", "b")
        with pytest.raises(ValueError):
            load_fixture(spark, str(tmp_path / "a.txt"))

    def test_materialize_replaces(self, spark, tmp_path):
        path = str(tmp_path / "t")
        materialize(spark.range(5), path)
        df = materialize(spark.range(100).withColumn("day", F.col("id") % 2), path, ["id"], "day")
        assert df.count() == 100 and read_table(spark, path).count() == 100

    def test_names(self, spark):
        register(spark.range(3), "three_rows")
        assert read_table(spark, "three_rows").count() == 3


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    """Two robots driving for 4 minutes, one silent for 20 s, plus junk."""
    folder = tmp_path_factory.mktemp("landing")
    for robot in (1, 2):
        lines = []
        for s in range(240):
            if robot == 2 and 100 <= s < 120:
                continue
            for i in range(4):
                lines.append(event("IMU", s + i / 4, {"accel_x": 0.1 * i, "accel_y": 0.2, "gyro_z": (s % 7) - 3.0}, robot_id=robot))
            lines.append(event("ENCODER", s + 0.1, {"ticks": 500 + s}, robot_id=robot))
            lines.append(event("GPS", s + 0.5, {"lat": 40 + s * 1e-5, "lon": -74 + s * 1e-5}, robot_id=robot))
            lines.append(event("LIDAR", s + 0.5, {"range_m": 3}, robot_id=robot))
        (folder / f"{robot}.json").write_text("\n".join(lines))
    return str(folder)


SCHEMA = "sensor string, ts timestamp, robot_id long, data struct<accel_x:double,accel_y:double,gyro_z:double,ticks:long,lat:double,lon:double>"


def rounded(df):
    return df.withColumns({c: F.round(c, 6) for c, kind in df.dtypes if kind == "double"})


def test_pipeline(spark, landing, tmp_path):
    """Streams to bronze and silver, gold by batch; the same as one batch over raw,
    but for the minute the streams still hold back."""
    lake, keys = Lake(str(tmp_path)), ["robot_id"]
    run_streaming(spark, landing, lake, keys, SCHEMA)
    assert read_table(spark, lake.table("bronze_robotics_raw")).count() == 460 * 7
    assert read_table(spark, lake.table("bronze_imu_data")).count() == 460 * 4
    assert read_table(spark, lake.table("silver_event_stream")).count() == 460 * 6
    history = silver_history(spark, lake, "silver_imu_history", keys)
    assert {"__START_AT", "__END_AT"} <= set(history.columns)
    gold = build_gold(spark, lake, keys)
    features = gold["gold_ml_features"]
    assert features.groupBy("robot_id").agg(F.max("session_id").alias("n")).orderBy("robot_id").collect() == [(1, 1), (2, 2)]

    raw = read_raw(spark, landing, SCHEMA)
    batch = features_from_raw(raw, keys)
    last = features.agg(F.max("timestamp")).first()[0]
    batch = batch.filter(F.col("timestamp") <= F.lit(last)).select(features.columns)
    assert features.count() > 300
    assert rounded(features).exceptAll(rounded(batch)).isEmpty()
    assert rounded(batch).exceptAll(rounded(features)).isEmpty()

    # Started again without new files, nothing is added.
    run_streaming(spark, landing, lake, keys, SCHEMA)
    assert read_table(spark, lake.table("bronze_imu_data")).count() == 460 * 4


@pytest.mark.parametrize("max_rows", [100, 40, 3])
@pytest.mark.parametrize("keys", [["robot_id"], []])
def test_cut_series_give_the_same(spark, landing, monkeypatch, keys, max_rows):
    """Wide spans, narrow spans and sampled ranges against whole series."""
    raw = read_raw(spark, landing, SCHEMA)
    whole = rounded(features_from_raw(raw, keys, span="30 seconds")).cache()
    assert whole.count() > 200
    monkeypatch.setattr(medallion, "MAX_ROWS", max_rows)
    cut = rounded(features_from_raw(raw, keys, span="30 seconds"))
    assert cut.columns == whole.columns
    assert cut.exceptAll(whole).isEmpty() and whole.exceptAll(cut).isEmpty()
    whole.unpersist()


def test_stream_counts_what_gates_drop(spark, landing, tmp_path):
    raw = read_raw(spark, landing, SCHEMA, streaming=True)
    gated = expect_all_or_drop(bronze_gps(raw), {"north": "latitude <= 40.001"}, observation="gps_gate")
    query = write_stream(gated, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    seen = query.recentProgress[0].observedMetrics["gps_gate"]
    assert seen["rows"] == 460 and seen["dropped"] == seen["north"] > 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 460 - seen["dropped"]


def test_rules_from_the_data(spark, landing):
    raw = read_raw(spark, landing, SCHEMA)
    seen = []

    def rules(aligned):
        seen.append(set(aligned.columns) == set(resample_aligned(raw, keys=["robot_id"]).columns))
        return {"slow": "velocity_mps <= 1.0"}

    master = master_from_raw(raw, ["robot_id"], rules)
    assert seen == [True]
    assert 0 < master.count() < 460


def test_bronze_prunes_and_pushes_down(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("IMU", T0, 1, (1.0, 2.0, 3.0, 4, 5.0, 6.0))], SCHEMA).write.parquet(path)
    plan = bronze_imu(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(sensor,IMU)" in plan
    assert "accel_x" in plan.split("ReadSchema")[1] and "lat" not in plan.split("ReadSchema")[1]
