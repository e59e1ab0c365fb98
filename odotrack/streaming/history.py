"""Versioned history kept up to date by a stream.

A stored history is a committed table whose parts are buckets of keys. A batch of changes
touches the buckets of its keys: their versions are read, derived anew together with the
changes, and written; all other buckets stay where they are. Changes may come late, out
of order and more than once: a version is what ``scd2_history`` makes of all changes of its
key, and versions with their ranges taken off are those changes. Merging a batch again
after a failure therefore gives the same table.

A batch costs the size of the buckets it touches. Buckets should be as many as keep one
bucket a task's work; where a batch changes few keys, more of them rewrite less."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from odotrack.operators.history import END, START, scd2_history
from odotrack.sources.committed import Version, committed, read_committed, refresh
from odotrack.sources.tables import AVAILABLE

BUCKET = "_bucket"
BUCKETS = 256


def _bucketed(changes: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return changes.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def merge_history(
    changes: DataFrame, path: str, keys: Sequence[str], sequence_by: str, buckets: int = BUCKETS, **options
) -> Version | None:
    """Merge a batch of changes into the history at ``path``, which the first one creates;
    None if there are no changes. ``buckets`` stays what it was at first. Which buckets a
    batch touches is all that reaches the driver."""
    spark, keyed = changes.sparkSession, _bucketed(changes, keys, buckets)
    touched = [row[0] for row in keyed.select(BUCKET).distinct().collect()]
    if not touched:
        return None
    if committed(spark, path) is not None:
        stored = read_committed(spark, path, parts=touched).drop(START, END)
        keyed = keyed.unionByName(stored)
    # A key is in one bucket, so the bucket may stand beside the key.
    history = scd2_history(keyed, [BUCKET, *keys], sequence_by, **options)
    return refresh(history, path, BUCKET, touched)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions of the stored history."""
    return read_committed(spark, path).drop(BUCKET)


def stream_history(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    sequence_by: str,
    buckets: int = BUCKETS,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Merge a stream of changes, batch by batch. By default it works off what is there and
    stops."""

    def merge(batch: DataFrame, _: int) -> None:
        merge_history(batch, path, keys, sequence_by, buckets, **options)

    writer = changes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE)).start()
