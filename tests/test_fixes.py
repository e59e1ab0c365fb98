"""Cases that once went wrong."""

import os
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from odotrack.operators.history import as_of, scd2_history
from odotrack.operators.quality import expect_or_drop, load_rules
from odotrack.plans.queries import all_queries
from odotrack.schemas import RAW
from odotrack.sources.raw_json import rescue
from odotrack.streaming.sessions import session_summary

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
def test_streams_read_folder_tables(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    query = all_queries()["stream_bronze_gps"]
    one, parts = (query(spark, d).orderBy("event_id").collect() for d in (FOLDER, str(tmp_path)))
    assert one == parts and one


def test_gate_reaches_the_scan(spark, tmp_path):
    spark.range(10).select(F.col("id").cast("double").alias("velocity_mps")).write.parquet(f"{tmp_path}/t")
    kept = expect_or_drop(spark.read.parquet(f"{tmp_path}/t"), "speed", "velocity_mps <= 4.5")
    assert "LessThanOrEqual(velocity_mps,4.5)" in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 5


def test_infinite_threshold_is_no_rule(spark):
    rows = [("accel_x", float("inf")), ("velocity_mps", 40.0)]
    rules = load_rules(spark.createDataFrame(rows, "axis string, critical_max_threshold double"))
    assert len(rules) == 1 and "40.0" in next(iter(rules.values()))


def test_history_of_rows_with_maps(spark):
    rows = [("a", 1, {"x": "2"}), ("a", 1, {"x": "1"}), ("a", 2, None)]
    history = scd2_history(spark.createDataFrame(rows, "id string, seq int, extra map<string,string>"), ["id"], "seq")
    assert [(r.seq, r.extra) for r in history.orderBy("seq").collect()] == [(1, {"x": "1"}), (2, None)]


def test_as_of_wants_a_time_zone(spark):
    with pytest.raises(ValueError, match="time zone"):
        as_of(spark.createDataFrame([], "__START_AT timestamp, __END_AT timestamp"), datetime(2024, 1, 15))


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
def test_as_of_does_not_depend_on_the_machine(tmp_path):
    code = (
        "from odotrack.session import get_spark; from odotrack.plans.queries import all_queries; "
        "s = get_spark(**{'spark.master': 'local[2]', 'spark.sql.shuffle.partitions': '2'}); "
        f"rows = all_queries()['scd2_as_of'](s, '{FOLDER}').selectExpr('sum(hash(user_id, event_type, value))'); "
        "print('SUM', rows.first()[0])"
    )
    sums = {
        [x for x in subprocess.run(
            [sys.executable, "-c", code], cwd=Path(__file__).parent.parent, env=os.environ | {"TZ": zone},
            capture_output=True, text=True, check=True,
        ).stdout.splitlines() if x.startswith("SUM")][0]
        for zone in ("UTC", "America/New_York")
    }
    assert len(sums) == 1


def test_sessions_of_a_batch_drop_rows_without_time(spark):
    rows = [(datetime(2024, 1, 1), ), (None,)]
    summary = session_summary(spark.createDataFrame(rows, "timestamp timestamp"), [F.count("*").alias("n")])
    assert [r.n for r in summary.collect()] == [1]


def test_rescue_tells_names_with_dots_from_paths(spark):
    lines = spark.createDataFrame([('{"sensor":"GPS","data.range_m":1,"data":{"range_m":2}}',)], "value string")
    assert rescue(lines, RAW).first()._rescued_data == {"`data.range_m`": "1", "data.range_m": "2"}
