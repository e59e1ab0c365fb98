"""Session ids for the rows of a stream.

``session_summary`` aggregates; here every row comes out once, with the session it is in,
as soon as the watermark has passed it and no earlier row can still arrive. Rows wait in
the state of their key, a timer for the earliest of them wakes the key, and the rows up to
the watermark are numbered in order of time, from the latest time and id kept from before.
State is the rows of one watermark's delay and two numbers a key.

Without keys a stream has no key to be spread by. Its rows are parted by spans of time
instead, each numbered by itself, and ``merge_spans`` joins the sessions that go on over an
edge: the same chain over one row a span as in the batch scans."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from odotrack.functions.columns import duration_micros, micros_of
from odotrack.functions.constants import SESSION_GAP, WATERMARK
from odotrack.sources.tables import write_stream

SPAN, LOCAL = "_span", "_local_session"
_MICROS = "_micros"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Sessions(StatefulProcessor):
    """Numbers the rows of one key as the watermark passes them."""

    def __init__(self, gap: int, inputs: list[str], state: T.StructType, by: list[str]):
        self.gap, self.inputs, self.state, self.by = gap, inputs, state, by
        self.columns = state.fieldNames()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.state)
        self.last = handle.getValueState("last", "micros long, session long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for batch in rows:
            batch.columns = self.inputs  # names come changed if they begin with an underscore
            own = [tuple(_plain(v) for v in row) for row in batch[self.columns].itertuples(index=False)]
            if own:
                self.waiting.appendList(own)
                first = int(batch[_MICROS].min())
                earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            # A timer goes off once the watermark has reached it; times are rounded up.
            self.handle.registerTimer(-(-earliest // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        at = self.columns.index(_MICROS)
        waiting = sorted(self.waiting.get(), key=lambda row: row[at]) if self.waiting.exists() else []
        ready = [row for row in waiting if row[at] <= passed]
        if not ready:
            return
        micros, session = self.last.get() if self.last.exists() else (None, 0)
        numbers = []
        for row in ready:
            if micros is None or row[at] - micros > self.gap:
                session += 1
            micros = row[at]
            numbers.append(session)
        self.last.update((micros, session))
        rest = [tuple(row) for row in waiting[len(ready) :]]
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(-(-rest[0][at] // 1000))
        else:
            self.waiting.clear()
        out = pd.DataFrame([tuple(row) for row in ready], columns=self.columns)
        out[LOCAL] = numbers
        for i, (name, value) in enumerate(zip(self.by, key)):
            out.insert(i, name, [value] * len(out))
        yield out

    def close(self) -> None:
        pass


def _plain(value):
    """What a state row takes: missing values are None, numbers Python's own."""
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    return value.item() if hasattr(value, "item") else value


def _numbered(df: DataFrame, by: Sequence[str], gap: str, watermark: str, time: str) -> DataFrame:
    kind = df.schema[time].dataType
    marked = df.withColumn(_MICROS, micros_of(time, kind)).filter(F.col(_MICROS).isNotNull())
    # The time travels as a number: state and pandas would bring their own time zones.
    others = [f for f in marked.schema.fields if f.name != time and f.name not in by]
    state = T.StructType([T.StructField(f.name, f.dataType) for f in others])
    processor = _Sessions(duration_micros(gap), marked.columns, state, list(by))
    out = T.StructType([*(marked.schema[k] for k in by), *state.fields, T.StructField(LOCAL, T.LongType())])
    numbered = (
        marked.withWatermark(time, watermark)
        .groupBy(*by)
        .transformWithStateInPandas(processor, out, outputMode="Append", timeMode="EventTime")
    )
    back = F.timestamp_micros(_MICROS).cast(kind).alias(time)
    return numbered.select(*(back if c == time else F.col(c) for c in df.columns), LOCAL)


def stream_sessionize(
    df: DataFrame,
    gap: str = SESSION_GAP,
    keys: Sequence[str] = (),
    watermark: str = WATERMARK,
    span: str = "1 hour",
    time: str = "timestamp",
) -> DataFrame:
    """The rows of a stream with ``session_id``, as ``sessionize`` numbers them, once the
    watermark has passed them. Without keys rows have ``_span`` and ``_local_session``
    instead, for ``merge_spans``. Rows without a time and rows behind the watermark are
    dropped. Columns must be numbers, text, booleans or binary, beside the time."""
    if keys:
        return _numbered(df, keys, gap, watermark, time).withColumnRenamed(LOCAL, "session_id")
    place = F.floor(micros_of(time, df.schema[time].dataType) / duration_micros(span)).cast("long")
    return _numbered(df.withColumn(SPAN, place), [SPAN], gap, watermark, time)


def merge_spans(rows: DataFrame, gap: str = SESSION_GAP, time: str = "timestamp") -> DataFrame:
    """Session ids of a whole series from those of its spans: a span's first session goes
    on with the last one before it unless the gap between them is too long."""
    kind = rows.schema[time].dataType
    spans = rows.groupBy(SPAN).agg(F.min(time).alias("_first"), F.max(time).alias("_last"), F.max(LOCAL).alias("_own"))
    along = Window.orderBy(SPAN)  # one row a span
    apart = micros_of("_first", kind) - micros_of("_before", kind)
    goes_on = F.coalesce(apart <= duration_micros(gap), F.lit(False)).cast("long")
    spans = spans.withColumn("_before", F.lag("_last").over(along)).withColumn("_goes_on", goes_on)
    earlier = F.coalesce(F.sum(F.col("_own") - F.col("_goes_on")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select(SPAN, (earlier - F.col("_goes_on")).alias("_base"))
    numbered = rows.join(spans, SPAN).withColumn("session_id", F.col("_base") + F.col(LOCAL))
    return numbered.drop(SPAN, LOCAL, "_base")


def write_sessions(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream of ``stream_sessionize`` to a folder. Its state needs the RocksDB
    store, which the query is given whatever the session uses for others."""
    spark: SparkSession = df.sparkSession
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        return write_stream(df, path, checkpoint, trigger)
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)
