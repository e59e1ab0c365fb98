"""The two-level scans against the plain window they replace."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from odotrack.operators import ordered
from odotrack.operators.history import scd2_history
from odotrack.operators.ordered import (
    FIRST,
    chunked,
    fill_gaps,
    ordered_lag,
    ordered_lead,
    running_first,
    running_sum,
)
from odotrack.operators.trajectory import sessionize
from odotrack.session import stage

T0 = datetime(2026, 5, 10, 14, 32, 27)
LAYOUTS = [("10 seconds", None), ("1 day", None), ("1 day", 7)]  # the last is cut by range


@pytest.fixture(scope="module")
def series(spark):
    """Two robots and one without an id; one robot has most rows. NULL values, NULL
    runs at segment starts and gaps of every kind."""
    rng = random.Random(7)
    rows, n = [], 0
    for robot, size in ((1, 120), (2, 25), (None, 20)):
        second = 0.0
        for i in range(size):
            second += rng.choice([0.5, 1.0, 1.0, 3.0, 5.0, 5.000001, 6.0, 40.0])
            value = None if rng.random() < 0.35 else round(rng.uniform(-3, 3), 3)
            rows.append((robot, n, T0 + timedelta(seconds=second), value, i // 9))
            n += 1
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "robot int, id int, timestamp timestamp, v double, part int").cache()


def same(left, right):
    left, right = left.select(sorted(left.columns)), right.select(sorted(right.columns))
    assert left.columns == right.columns
    assert left.exceptAll(right).isEmpty()
    assert right.exceptAll(left).isEmpty()


def windows(keys, *within):
    by_key = Window.partitionBy(*keys).orderBy("timestamp", "id")
    return by_key, Window.partitionBy(*keys, *within).orderBy("timestamp", "id").rowsBetween(FIRST, 0)


OPTIONS = {"order": ["timestamp", "id"]}


@pytest.mark.parametrize("keys", [["robot"], []])
@pytest.mark.parametrize("span, max_rows", LAYOUTS)
class TestAgainstPlainWindows:
    def test_lag_and_lead(self, series, keys, span, max_rows):
        by_key, _ = windows(keys)
        wanted = {"before": "v", "before_ts": "timestamp"}
        got = ordered_lag(series, wanted, keys=keys, span=span, max_rows=max_rows, **OPTIONS)
        same(got, series.withColumns({out: F.lag(c).over(by_key) for out, c in wanted.items()}))
        got = ordered_lead(series, wanted, keys=keys, span=span, max_rows=max_rows, **OPTIONS)
        same(got, series.withColumns({out: F.lead(c).over(by_key) for out, c in wanted.items()}))

    def test_running_sum(self, series, keys, span, max_rows):
        _, to_here = windows(keys)
        got = running_sum(series, {"s": F.col("v")}, keys=keys, span=span, max_rows=max_rows, **OPTIONS)
        wanted = series.withColumn("s", F.sum("v").over(to_here))
        same(*(df.withColumn("s", F.round("s", 9)) for df in (got, wanted)))

    def test_running_first(self, series, keys, span, max_rows):
        _, to_here = windows(keys)
        got = running_first(series, {"f": F.col("v")}, keys=keys, span=span, max_rows=max_rows, **OPTIONS)
        same(got, series.withColumn("f", F.first("v").over(to_here)))

    def test_fill(self, series, keys, span, max_rows):
        _, to_here = windows(keys)
        got = fill_gaps(series, ["v"], keys=keys, span=span, max_rows=max_rows, **OPTIONS)
        same(got, series.withColumn("v", F.last("v", True).over(to_here)))

    def test_sessions(self, series, keys, span, max_rows):
        by_key, to_here = windows(keys)
        gap = F.unix_micros("timestamp") - F.unix_micros(F.lag("timestamp").over(by_key))
        marked = series.withColumn("new", F.when(gap.isNull() | (gap > 5_000_000), 1).otherwise(0))
        wanted = marked.withColumn("session_id", F.sum("new").over(to_here)).drop("new")
        got = sessionize(series, keys=keys, span=span, max_rows=max_rows, **OPTIONS)
        same(got, wanted)


@pytest.mark.parametrize("span, max_rows", LAYOUTS)
def test_segments(series, span, max_rows):
    """Within segments that run on across chunks, and NULLs at their starts."""
    _, to_here = windows(["robot"], "part")
    options = {"keys": ["robot"], "within": "part", "span": span, "max_rows": max_rows, **OPTIONS}
    got = running_sum(series, {"s": F.col("v")}, **options)
    wanted = series.withColumn("s", F.sum("v").over(to_here))
    same(*(df.withColumn("s", F.round("s", 9)) for df in (got, wanted)))
    got = running_first(series, {"f": F.col("v")}, **options)
    same(got, series.withColumn("f", F.first("v").over(to_here)))


def test_session_boundaries(spark):
    """6 s opens a session, 3 s does not, exactly 5 s does not."""
    offsets = [0, 1, 2, 8, 11, 16, 16.000001, 22]
    rows = [(T0 + timedelta(seconds=s),) for s in offsets]
    df = spark.createDataFrame(rows, "timestamp timestamp")
    got = [row.session_id for row in sessionize(df, span="4 seconds").orderBy("timestamp").collect()]
    assert got == [1, 1, 1, 2, 2, 2, 2, 3]


def test_rows_without_time_come_first(spark):
    rows = [(None,), (T0,), (T0 + timedelta(seconds=1),)]
    df = spark.createDataFrame(rows, "timestamp timestamp")
    got = {(row.timestamp, row.session_id) for row in sessionize(df).collect()}
    assert got == {(None, 1), (T0, 2), (T0 + timedelta(seconds=1), 2)}


def test_only_tails_reach_a_single_partition(series):
    """The one single-partition exchange sits above the filter on last rows."""
    plan = sessionize(series, order=["timestamp", "id"], span="1 day", max_rows=None)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("SinglePartition") == 1
    above, below = text.split("SinglePartition")
    assert "Filter _last" in below and "Filter _last" not in above


def test_rows_are_shuffled_once(series):
    """Window and join share the exchange on (keys, chunk): two branches, two
    exchanges of rows, plus the tails' own."""
    plan = sessionize(series, keys=["robot"], order=["timestamp", "id"], span="1 day", max_rows=None)
    text = plan._jdf.queryExecution().executedPlan().toString()
    by_cell = [line for line in text.splitlines() if "hashpartitioning(_key0" in line and "_chunk" in line]
    assert len(by_cell) <= 3


@pytest.fixture
def hot(spark):
    """A third of all rows are copies of one row, another third is one robot's."""
    copies = spark.range(400).select(F.lit(1).alias("robot"), F.lit(T0).alias("timestamp"), F.lit(1.0).alias("v"))
    after = F.timestamp_micros(F.unix_micros(F.lit(T0).cast("timestamp")) + (F.col("id") + 1) * 2_000_000)
    drive = spark.range(400).select(F.lit(1).alias("robot"), after.alias("timestamp"), F.lit(2.0).alias("v"))
    others = spark.range(400).select((F.col("id") % 40 + 2).cast("int"), after, F.lit(3.0))
    return copies.unionAll(drive).unionAll(others)


def test_copies_are_spread_over_chunks(hot):
    chunks = chunked(hot, ["timestamp"], ["robot"], max_rows=100)
    sizes = [row["count"] for row in chunks.df.groupBy(*chunks.cell).count().collect()]
    assert sum(sizes) == 1200 and len(sizes) >= 10 and max(sizes) <= 200


def test_copies_are_counted_whole(hot):
    total = running_sum(hot, {"s": F.col("v")}, ["timestamp"], ["robot"], max_rows=100)
    assert total.count() == 1200
    assert sorted(row.s for row in total.filter("robot = 1").collect()) == [
        *map(float, range(1, 401)),
        *(400.0 + 2 * n for n in range(1, 401)),
    ]
    sessions = sessionize(hot, keys=["robot"], max_rows=100)
    assert sessions.filter("robot = 1").agg(F.max("session_id")).first()[0] == 1
    assert sessions.columns == [*hot.columns, "session_id"]


def test_one_plan_at_every_size(hot, series):
    """Short series are their own only chunks; long ones are cut, and only those."""
    def pieces(df, order, max_rows, span=None):
        cut = chunked(df, order, ["robot"], span, max_rows)
        return {(r.robot, r._piece is None): r["count"] for r in cut.df.groupBy("robot", F.col("_piece").alias("_piece")).count().collect()}

    whole = pieces(series, ["timestamp", "id"], 1000)
    assert whole == {(1, True): 120, (2, True): 25, (None, True): 20}
    cut = chunked(series, ["timestamp", "id"], ["robot"], None, 60)
    sizes = {}
    for row in cut.df.groupBy("robot", *cut.cell).count().collect():
        sizes.setdefault(row.robot, []).append((row._piece, row["count"]))
    assert len(sizes[1]) == 4 and max(n for _, n in sizes[1]) <= 60
    assert sizes[2] == [(None, 25)] and sizes[None] == [(None, 20)]
    spans = chunked(series, ["timestamp", "id"], ["robot"], "10 seconds", 60).df
    assert spans.filter("_piece IS NULL").isEmpty()

    def joins(max_rows):
        df = ordered_lag(series, {"before": "v"}, ["timestamp", "id"], ["robot"], max_rows=max_rows)
        return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")

    # One with the bounds, one with what chunks inherit; without bounds neither is left.
    assert joins(10_000) == 0 and joins(10) > 0


def test_fill_drop(series):
    assert fill_gaps(series, ["v"], how="drop").filter("v IS NULL").isEmpty()
    with pytest.raises(ValueError):
        fill_gaps(series, ["v"], how="guess")


ORDERS = {
    "timestamp": "timestamp",
    "ntz": "CAST(timestamp AS TIMESTAMP_NTZ)",
    "date": "DATE_ADD(DATE'2024-01-01', id)",
    "bigint": "CAST(id AS BIGINT)",
    "double": "id / 7D",
    "decimal": "CAST(id / 8D AS DECIMAL(12, 3))",
    "string": "FORMAT_STRING('%05d', id)",
    "binary": "ENCODE(FORMAT_STRING('%05d', id), 'UTF-8')",
}


@pytest.mark.parametrize("max_rows", [None, 4_000_000, 40, 2])
@pytest.mark.parametrize("kind", ORDERS)
def test_any_order_type_at_any_size(series, kind, max_rows):
    ordered = series.withColumn("at", F.expr(ORDERS[kind]))
    by_key = Window.partitionBy("robot").orderBy("at", "id")
    expected = ordered.withColumn("previous", F.lag("id").over(by_key)).select("id", "previous")
    span = "1 minute" if kind in ("timestamp", "ntz", "date") else 10
    lagged = ordered_lag(ordered, {"previous": "id"}, ["at", "id"], ["robot"], span, max_rows)
    same(lagged.select("id", "previous"), expected)


@pytest.mark.parametrize("max_rows", [4_000_000, 7, 2])
def test_versions_by_date_and_text(spark, max_rows):
    for cast in ("date", "timestamp_ntz", "timestamp", "string"):
        changes = spark.range(14).select(
            (F.col("id") % 2).alias("k"),
            F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).cast(cast).alias("seq"),
        )
        history = scd2_history(changes, ["k"], "seq", max_rows=max_rows)
        by_key = Window.partitionBy("k").orderBy("seq")
        expected = changes.withColumns({"__START_AT": F.col("seq"), "__END_AT": F.lead("seq").over(by_key)})
        same(history, expected)


@pytest.mark.parametrize("max_rows", [4_000_000, 30, 2])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_sessions_without_time_zone(spark, zone, max_rows):
    """Clock changes of the session's zone make no session and hide none."""
    night = datetime(2024, 3, 10, 1, 0)
    rows = [(i, night + timedelta(minutes=4 * i + (30 if i > 30 else 0))) for i in range(60)]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(rows, "id int, timestamp timestamp_ntz")
        found = sessionize(df, "5 minutes", max_rows=max_rows, span="1 hour").select("id", "session_id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {(r.id, r.session_id) for r in found} == {(i, 1 + (i > 30)) for i in range(60)}


def test_cut_ranges_hold_no_more_than_asked_for(hot):
    cut = chunked(hot, ["timestamp"], ["robot"], "1 day", 50)
    sizes = cut.df.groupBy(*cut.cell).count().agg(F.max("count")).first()[0]
    assert sizes <= 50


@pytest.fixture
def long(spark):
    """Six thousand rows of one series, some without a time."""
    return spark.range(6000).select(
        F.when(F.col("id") >= 30, F.timestamp_micros((F.col("id") * 7919 % 6007) * 1_000_000)).alias("timestamp"), "id"
    )


def test_rows_meet_few_of_the_bounds(long, monkeypatch):
    """However many bounds a series has, no table that rows are joined with holds many in a row."""
    widths = []

    def watched(df):
        table = stage(df)
        arrays = [name for name, kind in table.dtypes if kind.startswith("array")]
        widths.extend(table.agg(F.max(F.size(name))).first()[0] for name in arrays)
        return table

    monkeypatch.setattr(ordered, "stage", watched)
    cut = chunked(long, ["timestamp", "id"], max_rows=10)
    sizes = [row["count"] for row in cut.df.groupBy(*cut.cell).count().collect()]
    assert sum(sizes) == 6000 and max(sizes) <= 10 and len(sizes) > 600
    assert widths and max(widths) <= 64


@pytest.mark.parametrize("fan, most", [(3, 4_000_000), (64, 500), (3, 500)])
def test_trees_and_large_samples(long, hot, monkeypatch, fan, most):
    """Deep trees of bounds, and samples that are cut before they are sorted."""
    monkeypatch.setattr(ordered, "FAN", fan)
    monkeypatch.setattr(ordered, "MAX_ROWS", most)
    cut = chunked(long, ["timestamp", "id"], max_rows=10)
    assert cut.df.groupBy(*cut.cell).count().agg(F.max("count")).first()[0] <= 10
    expected = long.withColumn("before", F.lag("id").over(Window.orderBy("timestamp", "id")))
    same(ordered_lag(long, {"before": "id"}, ["timestamp", "id"], max_rows=10), expected)
    total = running_sum(hot, {"s": F.col("v")}, ["timestamp"], ["robot"], max_rows=100)
    assert sorted(row.s for row in total.filter("robot = 1").collect()) == [
        *map(float, range(1, 401)),
        *(400.0 + 2 * n for n in range(1, 401)),
    ]
    chunks = chunked(hot, ["timestamp"], ["robot"], max_rows=100)
    assert chunks.df.groupBy(*chunks.cell).count().agg(F.max("count")).first()[0] <= 200
