"""Sessions on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odotrack.functions.constants import SESSION_GAP, WATERMARK
from odotrack.operators.ordered import MAX_ROWS
from odotrack.operators.trajectory import sessionize


def session_summary(
    df: DataFrame,
    aggs: Sequence[Column],
    gap: str = SESSION_GAP,
    keys: Sequence[str] = (),
    watermark: str = WATERMARK,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Aggregates per drive session, with its first and last timestamp.

    A stream uses session windows and emits a session once the watermark has
    passed its end; the session merges rows before the shuffle where
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` is set,
    as ``get_spark`` does. A batch numbers sessions with the two-level scan and then
    aggregates map-side, so a session of any size stays spread over tasks."""
    extent = [F.min("timestamp").alias("session_start"), F.max("timestamp").alias("session_end")]
    if not df.isStreaming:
        # A stream drops rows without a time, so a batch does too.
        timed = df.filter(F.col("timestamp").isNotNull())
        sessions = sessionize(timed, gap, keys, max_rows=max_rows)
        return sessions.groupBy(*keys, "session_id").agg(*extent, *aggs).drop("session_id")
    # Spark wants a key beside the session window, and folds a literal away.
    all_rows = F.pmod(F.hash("timestamp"), F.lit(1)).alias("_all")
    grouped = (
        df.withWatermark("timestamp", watermark)
        .groupBy(*(keys or [all_rows]), F.session_window("timestamp", gap))
        .agg(*extent, *aggs)
    )
    return grouped.drop("session_window", "_all")
