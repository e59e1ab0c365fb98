"""Named tables and folders: reads, streaming sinks, materialized views."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from odotrack.sources.committed import committed, is_written, read_committed, refresh, replace


@dataclass(frozen=True)
class Intake:
    """The most a stream over files takes up in one batch: so many files, or so many bytes
    of whole files. A backlog of any size is worked off in batches of that size."""

    files: int | None = None
    bytes: int | None = None

    def __post_init__(self):
        if self.files is not None and self.bytes is not None:
            raise ValueError("a stream is limited by files or by bytes")

    def options(self) -> dict[str, str]:
        named = {"maxFilesPerTrigger": self.files, "maxBytesPerTrigger": self.bytes}
        return {name: str(value) for name, value in named.items() if value is not None}


#: Work off what is there, in as many batches as it takes, and stop.
AVAILABLE = {"availableNow": True}
#: The partition column of streaming tables.
DAY = "_day"
#: The folder of a batch, where batches have their own.
BATCH = "_batch"
#: A batch that a cluster of some hundred cores works off in minutes.
INTAKE = Intake(bytes=64 << 30)


def read_table(
    spark: SparkSession,
    source: str,
    streaming: bool = False,
    schema: T.StructType | None = None,
    most: Intake | None = None,
) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path (anything with a slash).
    A folder takes its present schema unless given one, which an empty folder needs. A
    folder with a manifest is read as its latest version. ``most`` limits what a stream
    takes up at a time."""
    if "/" not in source:
        return spark.readStream.table(source) if streaming else spark.read.table(source)
    if not streaming:
        if committed(spark, source) is not None:
            return read_committed(spark, source)
        return (spark.read.schema(schema) if schema else spark.read).parquet(source)
    reader = spark.readStream.schema(schema or spark.read.parquet(source).schema)
    return reader.options(**(most or Intake()).options()).parquet(source)


def dated(df: DataFrame, time: str) -> DataFrame:
    """``df`` with the day of its event time, NULL where that is none: the folder a
    streaming table keeps the row in."""
    return df.withColumn(DAY, F.to_date(F.col(time).try_cast("timestamp")))


def within(df: DataFrame, time: str, since: datetime | None, until: datetime | None) -> DataFrame:
    """Rows of a dated table from ``since`` to before ``until``, which say their time
    zones. The days are compared too, so files of other days are not even listed."""
    if any(bound is not None and bound.tzinfo is None for bound in (since, until)):
        raise ValueError("a bound on time needs a time zone")
    moment, day = F.col(time).try_cast("timestamp"), F.col(DAY)
    if since is not None:
        df = df.filter((moment >= F.lit(since)) & (day >= F.to_date(F.lit(since))))
    if until is not None:
        df = df.filter((moment < F.lit(until)) & (day <= F.to_date(F.lit(until))))
    return df


def materialize(
    df: DataFrame, path: str, cluster_by: Sequence[str] = (), partition_by: str | None = None
) -> DataFrame:
    """Recompute and replace: readers see the old table until the new one is whole, also
    if ``df`` reads it or the write fails (see ``committed``). ``cluster_by`` writes files
    sorted by those columns, ``partition_by`` a folder for each value."""
    replace(df, path, partition_by, cluster_by)
    return read_committed(df.sparkSession, path)


def refresh_parts(
    df: DataFrame, path: str, part: str, parts: Iterable | None = None, cluster_by: Sequence[str] = ()
) -> DataFrame:
    """Recompute some parts of a materialized view: those that occur in ``df``, or are
    named. No other file is written or read."""
    refresh(df, path, part, parts, cluster_by)
    return read_committed(df.sparkSession, path)


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    partition_by: Sequence[str] = (),
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once. By default it works off
    what is there and stops."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def write_clustered(
    df: DataFrame,
    path: str,
    checkpoint: str,
    cluster_by: Sequence[str],
    partition_by: str = DAY,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream in files sorted by ``cluster_by`` over sampled ranges, which a plain
    stream cannot do: min/max statistics then prune by key inside a day, and a hot key is
    spread over files. Each batch has its own folder; one that is repeated after a failure
    overwrites what is not whole and leaves what is. Read it with ``clustered_schema``."""

    def write(batch: DataFrame, number: int) -> None:
        folder = f"{path}/{BATCH}={number}"
        if is_written(batch.sparkSession, folder):
            return
        order = [partition_by, *cluster_by]
        ranged = batch.repartitionByRange(*order).sortWithinPartitions(*order)
        ranged.write.mode("overwrite").partitionBy(partition_by).parquet(folder)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or AVAILABLE)).start()


def clustered_schema(schema: T.StructType) -> T.StructType:
    """``schema`` with the number of the batch, which is a folder too."""
    return T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])


def register(df: DataFrame, name: str) -> DataFrame:
    """A temporary view: a named step that is not stored."""
    df.createOrReplaceTempView(name)
    return df
