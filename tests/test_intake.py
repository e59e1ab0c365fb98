"""Limited intake, tables by day, committed tables and histories, routed streams."""

import json
import os
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from odotrack.operators.bronze import bronze_gps, bronze_imu
from odotrack.operators.history import END, current_version, scd2_history
from odotrack.operators.quality import expect_all_or_drop
from odotrack.operators.resample import resample_imu
from odotrack.operators.trajectory import sessionize
from odotrack.plans.medallion import RAW_TABLE, Lake, lake_table, run_streaming
from odotrack.sources import committed as store
from odotrack.sources.committed import committed, expire, read_committed, refresh, replace, versions
from odotrack.sources.raw_json import infer_schema, read_lines, sample_files
from odotrack.sources.tables import (
    DAY,
    Intake,
    dated,
    materialize,
    read_table,
    refresh_parts,
    within,
    write_stream,
)
from odotrack.streaming.history import BUCKET, merge_history, read_history
from odotrack.streaming.progress import progress_log, read_progress
from odotrack.streaming.routes import (
    BATCH,
    BROKEN,
    KEPT,
    LATE,
    QUARANTINED,
    ROUTE,
    broken_rules,
    gate_counts,
    gate_stream,
    quarantine,
    read_route,
    split_late,
)
from odotrack.streaming.session_ids import merge_spans, stream_sessionize, write_sessions

T0 = datetime(2026, 5, 10, 22, 0, 0)
SCHEMA = "sensor string, ts timestamp, robot_id long, data struct<accel_x:double,accel_y:double,gyro_z:double,ticks:long,lat:double,lon:double>"


def line(second, sensor="IMU", robot=1, **data):
    ts = None if second is None else str(T0 + timedelta(seconds=second))
    return json.dumps({"sensor": sensor, "ts": ts, "robot_id": robot, "data": data or {"accel_x": 1.0}})


def land(folder, name, lines, mtime):
    path = folder / name
    path.write_text("\n".join(lines))
    os.utime(path, (mtime, mtime))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


class TestIntake:
    def test_a_backlog_makes_several_batches_and_the_same_table(self, spark, landing, tmp_path):
        for n in range(6):
            land(landing, f"{n}.json", [line(n * 60 + s) for s in range(20)], 1_000_000 + n)
        counts = {}
        for name, most in (("one", Intake()), ("files", Intake(files=2)), ("bytes", Intake(bytes=2500))):
            lines = read_lines(spark, str(landing), streaming=True, most=most)
            out = tmp_path / name
            query = write_stream(lines, str(out / "t"), str(out / "c"))
            query.awaitTermination()
            counts[name] = sum(p["numInputRows"] > 0 for p in query.recentProgress)
            assert spark.read.schema("value string").parquet(str(out / "t")).count() == 120
        assert counts["one"] == 1 and counts["files"] == 3 and counts["bytes"] > 1

    def test_limits_exclude_each_other(self):
        with pytest.raises(ValueError):
            Intake(files=1, bytes=1)

    def test_inference_reads_a_bounded_sample(self, spark, landing):
        for n in range(20):
            land(landing, f"{n:02d}.json", [json.dumps({f"c{n}": n})] * 10, 1_000_000)
        size = (landing / "00.json").stat().st_size
        sample = sample_files(spark, str(landing), max_bytes=3 * size)
        assert [os.path.basename(f) for f in sample.files] == ["00.json", "01.json", "02.json"]
        assert sample.bytes <= 3 * size
        assert infer_schema(spark, str(landing), max_bytes=3 * size).fieldNames() == ["c0", "c1", "c2"]
        assert len(sample_files(spark, str(landing), max_files=2).files) == 2
        assert len(infer_schema(spark, str(landing))) == 20

    def test_a_first_file_beyond_the_limit_gives_its_first_lines(self, spark, landing):
        land(landing, "a.json", ['{"x": 1}'] * 50 + ['{"y": 2}'], 1_000_000)
        assert sample_files(spark, str(landing), max_bytes=10).bytes > 10
        assert infer_schema(spark, str(landing), max_bytes=10, max_lines=5).fieldNames() == ["x"]
        assert infer_schema(spark, str(landing), max_bytes=10).fieldNames() == ["x", "y"]

    def test_what_the_sample_does_not_show_is_rescued(self, spark, landing, tmp_path):
        land(landing, "a.json", [line(1)], 1_000_000)
        land(landing, "b.json", [json.dumps({"sensor": "IMU", "ts": str(T0), "firmware": "v2"})], 1_000_001)
        lake = Lake(str(tmp_path / "lake"))
        schema = infer_schema(spark, str(landing), max_files=1)
        run_streaming(spark, str(landing), lake, ["robot_id"], schema)
        raw = lake_table(spark, lake, RAW_TABLE, ["robot_id"])
        assert "firmware" not in raw.columns
        assert raw.filter("_rescued_data['firmware'] = 'v2'").count() == 1


class TestDays:
    @pytest.fixture
    def lake(self, spark, landing, tmp_path):
        """Seconds on both sides of midnight, and one row without a time."""
        land(landing, "a.json", [line(s) for s in range(0, 14_400, 100)] + [line(None)], 1_000_000)
        lake = Lake(str(tmp_path / "lake"))
        run_streaming(spark, str(landing), lake, ["robot_id"], SCHEMA, most=Intake(files=1))
        return lake

    def test_streaming_tables_have_a_folder_a_day(self, spark, lake):
        for name in (RAW_TABLE, "bronze_imu_data", "silver_imu_history", "silver_event_stream"):
            days = {n for n in os.listdir(lake.table(name)) if n.startswith(f"{DAY}=")}
            assert {f"{DAY}=2026-05-10", f"{DAY}=2026-05-11"} <= days
            assert DAY not in lake_table(spark, lake, name, ["robot_id"]).columns
        assert lake_table(spark, lake, RAW_TABLE, ["robot_id"]).count() == 145

    def test_bounds_on_time_list_only_the_files_of_their_days(self, spark, lake):
        midnight = datetime(2026, 5, 11, tzinfo=timezone.utc)
        part = lake_table(spark, lake, "bronze_imu_data", ["robot_id"], midnight, midnight + timedelta(hours=1))
        assert part.count() == 36
        plan = part._jdf.queryExecution().executedPlan()
        while plan.children().size():
            plan = plan.children().head()
        assert "PartitionFilters: [isnotnull(_day" in plan.verboseStringWithOperatorId().replace("\n", " ") or "_day" in str(plan)
        files = {f.split(f"{DAY}=")[1][:10] for f in _read_files(part)}
        assert files == {"2026-05-11"}

    def test_clustered_tables_are_the_same_sorted(self, spark, landing, tmp_path, lake):
        """Files of a day hold ranges of keys; batches, and rows that come later, add up."""
        land(landing, "b.json", [line(s, robot=r) for s in range(0, 9_000, 300) for r in range(2, 9)], 1_000_001)
        other = Lake(str(tmp_path / "clustered"))
        for most in (Intake(files=1), Intake()):
            run_streaming(spark, str(landing), other, ["robot_id"], SCHEMA, most=most, cluster=True)
        run_streaming(spark, str(landing), lake, ["robot_id"])
        for name in (RAW_TABLE, "bronze_imu_data", "silver_imu_history", "silver_event_stream"):
            ours = lake_table(spark, other, name, ["robot_id"])
            assert rows(ours) == rows(lake_table(spark, lake, name, ["robot_id"])), name
        midnight = datetime(2026, 5, 11, tzinfo=timezone.utc)
        day = lake_table(spark, other, "bronze_imu_data", ["robot_id"], midnight, midnight + timedelta(days=1))
        assert {f.split(f"{DAY}=")[1][:10] for f in _read_files(day)} == {"2026-05-11"}
        files = sorted(_read_files(spark.read.parquet(other.table("bronze_imu_data"))))
        assert len(files) >= 3
        for file in files:
            held = [(r.robot_id, r.timestamp) for r in spark.read.parquet(file).coalesce(1).collect()]
            assert held == sorted(held, key=lambda x: (x[0], x[1] is not None, x[1]))

    def test_bounds_need_time_zones(self, spark):
        with pytest.raises(ValueError):
            within(dated(spark.sql("select timestamp'2026-05-10' as t"), "t"), "t", T0, None)


def _read_files(df):
    """Files whose rows are read, as the scan itself says."""
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


class TestCommitted:
    @pytest.fixture
    def view(self, spark, tmp_path):
        df = spark.range(100).withColumn("day", F.expr("date'2026-05-01' + cast(id % 4 as int)"))
        return df, str(tmp_path / "view")

    def test_one_changed_day_rewrites_one_day(self, spark, view):
        df, path = view
        materialize(df, path, ["id"], "day")
        before = committed(spark, path).parts
        changed = df.filter("day = date'2026-05-02'").withColumn("id", -F.col("id"))
        after = refresh_parts(changed, path, "day")
        assert {n for n, c in committed(spark, path).parts.items() if before[n] != c} == {"day=2026-05-02"}
        assert rows(after) == rows(df.filter("day <> date'2026-05-02'").unionByName(changed))
        assert rows(read_committed(spark, path, 1)) == rows(df)
        one = read_table(spark, path).filter("day = date'2026-05-02'")
        assert {f.split("day=")[1][:10] for f in _read_files(one)} == {"2026-05-02"}

    def test_a_failed_write_leaves_the_version_before(self, spark, view):
        df, path = view
        replace(df, path)
        with pytest.raises(PySparkException):
            replace(df.withColumn("id", F.raise_error(F.lit("broken")).cast("long")), path)
        assert versions(spark, path) == [1] and read_table(spark, path).count() == 100

    def test_a_view_may_be_computed_from_itself(self, spark, view):
        df, path = view
        replace(df, path)
        grown = materialize(read_table(spark, path).withColumn("id", F.col("id") + 1), path)
        assert grown.agg(F.max("id")).first()[0] == 100

    def test_the_second_of_two_writers_fails(self, spark, view, monkeypatch):
        df, path = view
        replace(df, path)
        write = store._write

        def overtaken(*args):
            written = write(*args)
            monkeypatch.setattr(store, "_write", write)
            replace(df.limit(1), path)  # another writer, in the meantime
            return written

        monkeypatch.setattr(store, "_write", overtaken)
        with pytest.raises(store.LostRace):
            replace(df, path)
        assert read_table(spark, path).count() == 1

    def test_parts_are_emptied_by_name_and_null_is_a_part(self, spark, view):
        df, path = view
        replace(df.unionByName(df.limit(3).withColumn("day", F.lit(None).cast("date"))), path, "day")
        assert read_committed(spark, path, parts=[None]).count() == 3
        refresh(df.limit(0), path, "day", [None, date(2026, 5, 1)])
        assert read_table(spark, path).count() == 75
        with pytest.raises(ValueError, match="outside"):
            refresh(df, path, "day", [date(2026, 5, 1)])
        with pytest.raises(ValueError, match="columns"):
            refresh(df.withColumn("more", F.lit(1)), path, "day")
        assert read_table(spark, path).count() == 75

    def test_old_folders_go_when_nobody_names_them(self, spark, view):
        df, path = view
        for _ in range(3):
            replace(df, path, "day")
        assert expire(spark, path, keep=1) == 2
        assert versions(spark, path) == [3] and rows(read_table(spark, path)) == rows(df)
        with pytest.raises(ValueError):
            read_committed(spark, path, 1)

    def test_an_empty_table(self, spark, view):
        df, path = view
        assert replace(df.limit(0), path, "day").parts == {}
        assert read_table(spark, path).dtypes == df.dtypes and read_table(spark, path).isEmpty()


class TestHistory:
    SCHEMA = "id string, seq int, value string"

    def merged(self, spark, path, *batches, buckets=4):
        for batch in batches:
            merge_history(spark.createDataFrame(batch, self.SCHEMA), path, ["id"], "seq", buckets)
        return read_history(spark, path)

    def test_late_and_repeated_changes_fall_into_place(self, spark, tmp_path):
        batches = [
            [("a", 1, "x"), ("b", 5, "y"), ("a", 9, "z")],
            [("a", 4, "late"), ("a", 9, "z"), (None, 2, "no key")],
            [("a", 4, "late"), ("c", 1, None), ("a", 9, "a tie")],
        ]
        got = self.merged(spark, str(tmp_path / "h"), *batches)
        every = spark.createDataFrame([c for batch in batches for c in batch], self.SCHEMA)
        wanted = scd2_history(every, ["id"], "seq")
        assert rows(got.select(wanted.columns)) == rows(wanted)
        assert rows(current_version(got)) == rows(current_version(wanted).select(current_version(got).columns))

    def test_only_touched_buckets_are_written(self, spark, tmp_path):
        path = str(tmp_path / "h")
        self.merged(spark, path, [(f"k{i}", 1, "x") for i in range(40)], buckets=8)
        before = committed(spark, path).parts
        self.merged(spark, path, [("k7", 2, "y")], buckets=8)
        after = committed(spark, path).parts
        assert len(before) == 8 and sum(before[n] != c for n, c in after.items()) == 1

    def test_a_repeated_batch_changes_nothing(self, spark, tmp_path):
        batch = [("a", 1, "x"), ("a", 2, "y")]
        once = rows(self.merged(spark, str(tmp_path / "h"), batch))
        assert rows(self.merged(spark, str(tmp_path / "h"), batch, [])) == once
        assert versions(spark, str(tmp_path / "h")) == [1, 2]

    def test_buckets_stay_out_of_the_result(self, spark, tmp_path):
        got = self.merged(spark, str(tmp_path / "h"), [("a", 1, "x")])
        assert BUCKET not in got.columns and END in got.columns


RULES = {"positive": "accel_x > 0", "small": "accel_x < 10", "timed": "timestamp IS NOT NULL"}


class TestRoutes:
    def stream(self, spark, landing, most=Intake(files=1)):
        return spark.readStream.schema(SCHEMA).options(**most.options()).json(str(landing))

    def test_gates_lose_no_row_and_count_by_batch(self, spark, landing, tmp_path):
        values = [[1.0, -1.0, 20.0], [None, 5.0], [30.0, -2.0, 3.0, 4.0]]
        for n, batch in enumerate(values):
            land(landing, f"{n}.json", [line(s, accel_x=v) for s, v in enumerate(batch)], 1_000_000 + n)
        imu = bronze_imu(self.stream(spark, landing))
        path = str(tmp_path / "gated")
        gate_stream(imu, RULES, path, str(tmp_path / "c")).awaitTermination()
        batch = bronze_imu(spark.read.schema(SCHEMA).json(str(landing)))
        routed = read_route(spark, path, quarantine(batch, RULES).drop(ROUTE).schema)
        assert routed.count() == 9
        kept = read_route(spark, path, quarantine(batch, RULES).drop(ROUTE).schema, KEPT)
        assert rows(kept.select(batch.columns)) == rows(expect_all_or_drop(batch, RULES))
        assert rows(gate_counts(routed, RULES, [BATCH])) == [(0, 3, 2, 1, 1, 0), (1, 2, 1, 1, 1, 0), (2, 4, 2, 1, 1, 0)]
        assert rows(gate_counts(routed, RULES)) == rows(gate_counts(quarantine(batch, RULES), RULES))
        unknown = routed.filter("accel_x IS NULL").first()
        assert unknown[BROKEN] == ["positive", "small"] and unknown[ROUTE] == QUARANTINED

    def test_null_policy_and_no_rules(self, spark):
        df = spark.createDataFrame([(None,), (1.0,)], "accel_x double")
        assert [r[0] for r in df.select(broken_rules({"p": "accel_x > 0"}, "keep")).collect()] == [[], []]
        assert rows(quarantine(df, {}).select(ROUTE)) == [(KEPT,), (KEPT,)]

    def test_late_rows_and_windows_together_are_all_rows(self, spark, landing, tmp_path):
        batches = [[0, 1, 200], [100, 139, 141, 300], [150, 301, None], [239, 241, 400]]
        for n, seconds in enumerate(batches):
            land(landing, f"{n}.json", [line(s) for s in seconds], 1_000_000 + n)
        imu = bronze_imu(self.stream(spark, landing))
        path = str(tmp_path / "parted")
        split_late(imu, path, str(tmp_path / "c")).awaitTermination()
        batch = bronze_imu(spark.read.schema(SCHEMA).json(str(landing)))
        routed = read_route(spark, path, batch.schema)
        late = [(r["timestamp"] - T0).seconds for r in routed.filter(F.col(ROUTE) == LATE).collect() if r["timestamp"]]
        assert sorted(late) == [100, 139, 150, 239]
        assert routed.filter(f"{ROUTE} = 'late' AND timestamp IS NULL").count() == 1
        assert routed.count() == 13

        in_time = read_route(spark, path, batch.schema, KEPT, streaming=True, most=Intake(files=1))
        query = write_stream(resample_imu(in_time, samples=True), str(tmp_path / "w"), str(tmp_path / "wc"))
        query.awaitTermination()
        assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) == 0
        windows = spark.read.parquet(str(tmp_path / "w"))
        assert windows.agg(F.sum("sample_count")).first()[0] == 7  # all in time up to the watermark, 400 s - 60 s

    def test_a_repeated_batch_leaves_what_is_whole(self, spark, landing, tmp_path):
        """The batch was written, but the stream died before it could say so."""
        land(landing, "0.json", [line(500), line(None)], 1_000_000)
        path, checkpoint = tmp_path / "parted", tmp_path / "c"

        def run():
            split_late(bronze_imu(self.stream(spark, landing)), str(path), str(checkpoint)).awaitTermination()
            return sorted(str(f) for f in path.rglob("*.parquet"))

        files = run()
        (checkpoint / "commits" / "0").unlink()
        (checkpoint / "commits" / ".0.crc").unlink(missing_ok=True)
        assert run() == files and len(files) >= 2
        (path / f"{BATCH}=0" / "_SUCCESS").unlink()  # now it was not whole
        (checkpoint / "commits" / "0").unlink()
        (checkpoint / "commits" / ".0.crc").unlink(missing_ok=True)
        again = run()
        assert not set(again) & set(files) and len(again) == len(files)

    def test_split_goes_on_where_it_stopped(self, spark, landing, tmp_path):
        path, checkpoint = str(tmp_path / "parted"), str(tmp_path / "c")
        land(landing, "0.json", [line(500)], 1_000_000)
        split_late(bronze_imu(self.stream(spark, landing)), path, checkpoint).awaitTermination()
        land(landing, "1.json", [line(1), line(450)], 1_000_001)
        split_late(bronze_imu(self.stream(spark, landing)), path, checkpoint).awaitTermination()
        schema = bronze_imu(spark.read.schema(SCHEMA).json(str(landing))).schema
        got = {(r["timestamp"] - T0).seconds: r[ROUTE] for r in read_route(spark, path, schema).collect()}
        assert got == {500: KEPT, 1: LATE, 450: KEPT}


def test_progress_is_kept_as_a_table(spark, landing, tmp_path):
    for n, seconds in enumerate([[0], [500], [600], [100, 700]]):
        land(landing, f"{n}.json", [line(s, accel_x=float(s)) for s in seconds], 1_000_000 + n)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(landing))
    gated = expect_all_or_drop(bronze_imu(stream), {"low": "accel_x < 650"}, observation="imu_gate")
    path = str(tmp_path / "log")
    for name, df in (("gated", gated), ("windows", resample_imu(bronze_imu(stream)))):
        with progress_log(spark, path):
            write_stream(df, str(tmp_path / name), str(tmp_path / f"{name}.c"), name=name).awaitTermination()
    log = read_progress(spark, path)
    totals = log.groupBy("query", "gate", "measure").agg(F.sum("input_rows").alias("n"), F.sum("late_rows"), F.sum("value"))
    found = {(r[0], r[2]): tuple(r)[3:] for r in totals.collect()}
    assert found["gated", None][:2] == (5, 0) and found["windows", None][:2] == (5, 1)
    assert found["gated", "rows"][2] == 5 and found["gated", "dropped"][2] == found["gated", "low"][2] == 1


class TestSessionIds:
    GAP = "5 seconds"

    def run(self, spark, landing, out, keys, span="10 seconds"):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(landing))
        events = stream.select("robot_id", "sensor", F.col("ts").alias("timestamp"))
        numbered = stream_sessionize(events, self.GAP, keys, "1 minutes", span)
        write_sessions(numbered, str(out / "t"), str(out / "c")).awaitTermination()
        return spark.read.schema(numbered.schema).parquet(str(out / "t"))

    def batch(self, spark, landing, keys, until):
        events = spark.read.schema(SCHEMA).json(str(landing)).select("robot_id", "sensor", F.col("ts").alias("timestamp"))
        numbered = sessionize(events.filter("timestamp IS NOT NULL"), self.GAP, keys)
        return numbered.filter(F.col("timestamp") <= F.lit(T0 + timedelta(seconds=until)))

    def test_rows_come_numbered_once_the_watermark_has_passed(self, spark, landing, tmp_path):
        """A gap of exactly 5 s parts nothing, sessions go on over batches, keys may be NULL."""
        land(landing, "0.json", [line(s) for s in (7, 0, 2, 13, 30)] + [line(1, robot=None), line(None)], 1_000_000)
        land(landing, "1.json", [line(s) for s in (20, 14, 33)] + [line(9, robot=None)], 1_000_001)
        land(landing, "2.json", [line(200), line(201, sensor="GPS")], 1_000_002)
        got = self.run(spark, landing, tmp_path, ["robot_id"])
        wanted = self.batch(spark, landing, ["robot_id"], 141)
        assert got.count() == 10
        assert rows(got.select("robot_id", "timestamp", "session_id")) == rows(wanted.select("robot_id", "timestamp", "session_id"))

    def test_started_again_it_goes_on(self, spark, landing, tmp_path):
        land(landing, "0.json", [line(0), line(100)], 1_000_000)
        assert self.run(spark, landing, tmp_path, ["robot_id"]).count() == 1
        land(landing, "1.json", [line(104), line(300)], 1_000_001)
        got = self.run(spark, landing, tmp_path, ["robot_id"])
        assert sorted((r.timestamp - T0).seconds * 10 + r.session_id for r in got.collect()) == [1, 1002, 1042]

    def test_spans_join_to_the_sessions_of_the_whole_series(self, spark, landing, tmp_path):
        """Sessions over one edge and over two, an edge in a gap, a span without rows."""
        land(landing, "0.json", [line(s, robot=s % 3) for s in (1, 8, 9, 12, 17, 21, 30, 31, 55, 58)], 1_000_000)
        land(landing, "1.json", [line(25), line(61), line(70), line(300)], 1_000_001)
        parted = self.run(spark, landing, tmp_path, [])
        got = merge_spans(parted, self.GAP)
        wanted = self.batch(spark, landing, [], 240)
        assert got.count() == 13
        assert rows(got.select("timestamp", "session_id")) == rows(wanted.select("timestamp", "session_id"))


def test_gps_of_a_gated_stream_can_be_read_on(spark, landing, tmp_path):
    """A route is a table that streams read like any other."""
    land(landing, "0.json", [line(s, "GPS", lat=lat, lon=7.0) for s, lat in enumerate((51.0, 95.0, 52.0))], 1_000_000)
    gps = bronze_gps(spark.readStream.schema(SCHEMA).json(str(landing)))
    rules = {"on_earth": "ABS(latitude) <= 90"}
    gate_stream(gps, rules, str(tmp_path / "g"), str(tmp_path / "c")).awaitTermination()
    schema = quarantine(gps, rules).drop(ROUTE).schema
    kept = read_route(spark, str(tmp_path / "g"), schema, KEPT, streaming=True)
    write_stream(kept.drop(BROKEN), str(tmp_path / "out"), str(tmp_path / "oc")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
