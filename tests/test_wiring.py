"""The pipeline's wiring: drift, inferred columns, empty folders, all gold tables."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from odotrack.operators.kinematics import align
from odotrack.plans.medallion import (
    Lake,
    build_gold,
    run_streaming,
    silver_history,
    table_schemas,
)
from odotrack.sources.raw_json import frozen_schema, infer_schema
from odotrack.sources.tables import read_table

SCHEMA = "sensor string, ts timestamp, robot_id long, data struct<accel_x:double,accel_y:double,gyro_z:double,ticks:long,lat:double,lon:double>"
GOLD = {
    "gold_kinetic_master",
    "gold_ml_features",
    "gold_localization_features",
    "gold_terrain_classification",
    "gold_fleet_kpis",
    "gold_pruning_manifest",
}


def line(sensor, second, robot=1, **data):
    ts = f"2026-05-10 08:{second // 60:02d}:{second % 60:02d}"
    return json.dumps({"sensor": sensor, "ts": ts, "robot_id": robot, "data": data})


def drive(seconds=200, robot=1):
    for s in range(seconds):
        yield line("IMU", s, robot, accel_x=1.0 if s % 50 else 9.0, accel_y=0.5, gyro_z=2.0)
        yield line("ENCODER", s, robot, ticks=300 + s)
        yield line("GPS", s, robot, lat=51.0 + s * 1e-5, lon=7.0)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def test_drift_is_rescued(spark, landing, tmp_path):
    odd = [
        '{"sensor":"IMU","ts":"2026-05-10 08:00:01","firmware":"v7","data":{"accel_x":"n/a","range":4}}',
        '{"sensor":"IMU","ts":"2026-05-10',
        "",
        '{"sensor":"GPS","ts":"2026-05-10 08:00:02","data.range":1,"data":{"range":2}}',
    ]
    (landing / "a.json").write_text("\n".join(odd))
    lake = Lake(str(tmp_path / "lake"))
    run_streaming(spark, str(landing), lake, schema="sensor string, ts timestamp, data struct<accel_x:double>")
    raw = read_table(spark, lake.table("bronze_robotics_raw"))
    rows = {row._malformed or row.sensor: row for row in raw.collect()}
    assert len(rows) == 3 and odd[1] in rows
    assert rows["IMU"]._rescued_data == {"firmware": "v7", "data.accel_x": "n/a", "data.range": "4"}
    assert rows["GPS"]._rescued_data == {"`data.range`": "1", "data.range": "2"}
    assert read_table(spark, lake.table("bronze_imu_data")).count() == 1


def test_empty_landing_then_files(spark, landing, tmp_path):
    """No file and no schema: nothing happens. With a schema: empty tables. Files that
    come later are taken up, and the schema stays the one of the first run."""
    lake = Lake(str(tmp_path / "a"))
    run_streaming(spark, str(landing), lake, ["robot_id"])
    assert not (tmp_path / "a").exists()

    run_streaming(spark, str(landing), lake, ["robot_id"], SCHEMA)
    gold = build_gold(spark, lake, ["robot_id"])
    assert set(gold) == GOLD and all(table.isEmpty() for table in gold.values())

    (landing / "a.json").write_text("\n".join(drive(90)))
    run_streaming(spark, str(landing), lake, ["robot_id"])
    assert read_table(spark, lake.table("bronze_gps_data")).count() == 90
    assert not build_gold(spark, lake, ["robot_id"])["gold_ml_features"].isEmpty()


def test_inferred_columns(spark, landing, tmp_path):
    """Keys outside the contract, a sensor without rows, and a line that is no JSON."""
    rows = [text for text in drive(150) if '"GPS"' not in text]
    (landing / "a.json").write_text("\n".join([*rows, "broken"]))
    lake = Lake(str(tmp_path / "lake"))
    run_streaming(spark, str(landing), lake, ["robot_id"])
    raw = read_table(spark, lake.table("bronze_robotics_raw"))
    assert raw.schema["robot_id"].dataType.simpleString() == "bigint"
    assert raw.filter("_malformed = 'broken'").count() == 1 and "_corrupt_record" not in raw.columns
    assert read_table(spark, lake.table("bronze_imu_data")).count() == 150
    # Without fixes the spatial gate lets nothing pass.
    gold = build_gold(spark, lake, ["robot_id"])
    assert gold["gold_kinetic_master"].isEmpty() and gold["gold_localization_features"].count() == 300


def test_all_gold_tables(spark, landing, tmp_path):
    for robot in (1, 2):
        (landing / f"{robot}.json").write_text("\n".join(drive(200, robot)))
    lake, keys = Lake(str(tmp_path / "lake")), ["robot_id"]
    run_streaming(spark, str(landing), lake, keys, SCHEMA)
    seen = Observation("gates")
    metadata = spark.createDataFrame([("accel_x", 5.0)], "axis string, critical_max_threshold double")
    gold = build_gold(spark, lake, keys, metadata=lambda: metadata, observation=seen)
    assert set(gold) == GOLD
    counts = seen.get
    master = gold["gold_kinetic_master"]
    assert master.agg(F.max("avg_accel_x")).first()[0] <= 5.0
    jolts = counts["chassis_vibration_safety"]
    assert counts["rows"] == silver_history(spark, lake, "silver_imu_history", keys).count()
    assert 0 < jolts == counts["dropped"] == counts["rows"] - master.count()
    features = gold["gold_ml_features"].count()
    assert features == master.count() == gold["gold_terrain_classification"].count()
    assert gold["gold_localization_features"].count() == 2 * 200 * 3
    kpis = gold["gold_fleet_kpis"]
    assert kpis.filter("level = 'fleet'").first().seconds == features
    assert kpis.filter("level = 'robot'").count() == 2


def test_keyed_align_from_history_shuffles_each_side_once(spark, tmp_path):
    sides = []
    for name in ("silver_imu_history", "silver_encoder_history", "silver_gps_history"):
        schema = table_schemas(spark, spark.createDataFrame([], SCHEMA).schema, ["robot_id"])[name]
        spark.createDataFrame([], schema).write.parquet(Lake(str(tmp_path)).table(name))
        sides.append(silver_history(spark, Lake(str(tmp_path)), name, ["robot_id"]).drop("__START_AT", "__END_AT"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = align(*sides, keys=["robot_id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 3


def test_no_schema_without_events(spark, landing, tmp_path):
    kept = str(tmp_path / "kept")
    assert frozen_schema(spark, str(landing), kept) is None
    (landing / "a.json").write_text("broken")
    assert "_corrupt_record" not in infer_schema(spark, str(landing)).fieldNames()
    assert frozen_schema(spark, str(landing), kept) is None
    assert frozen_schema(spark, str(tmp_path / "nowhere"), kept) is None
    (landing / "b.json").write_text('{"x": 1}')
    assert frozen_schema(spark, str(landing), kept).fieldNames() == ["x"]
