"""Streams that lose no row: what a gate drops, and what comes too late, is kept aside.

A routed table holds every row of a stream once, with the route it took. A batch is written
in one pass, into a folder of its own:

    <path>/_batch=12/_route=kept/…
    <path>/_batch=12/_route=late/…

so readers of one route list only its folders, and counts come from the rows themselves. A
batch that is repeated after a failure overwrites what is not whole, and leaves what is: the
streams that read it on have seen those files."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from odotrack.functions.columns import duration_micros, window_start
from odotrack.functions.constants import RESAMPLE_EVERY, WATERMARK
from odotrack.operators.quality import passes
from odotrack.sources.committed import is_written
from odotrack.sources.tables import AVAILABLE, BATCH, INTAKE, Intake, clustered_schema

ROUTE, BROKEN = "_route", "_broken"
KEPT, LATE, QUARANTINED = "kept", "late", "quarantined"
#: What a batch is routed by: the batch, its number, and where earlier batches left word.
Router = Callable[[DataFrame, int], DataFrame]


def route_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    route: Router,
    trigger: dict | None = None,
    name: str | None = None,
    after: Callable[[SparkSession, int], None] | None = None,
) -> StreamingQuery:
    """Write a stream to a routed table. ``route`` adds ``_route`` to a batch; ``after`` runs
    once the batch is written. By default the stream works off what is there and stops."""

    def write(batch: DataFrame, number: int) -> None:
        folder = f"{path}/{BATCH}={number}"
        if not is_written(batch.sparkSession, folder):
            route(batch, number).write.mode("overwrite").partitionBy(ROUTE).parquet(folder)
        if after:
            after(batch.sparkSession, number)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or AVAILABLE)).start()


def routed_schema(schema: T.StructType) -> T.StructType:
    """``schema`` with the columns of the folders."""
    return T.StructType([*clustered_schema(schema).fields, T.StructField(ROUTE, T.StringType())])


def read_route(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    route: str | None = None,
    streaming: bool = False,
    most: Intake = INTAKE,
) -> DataFrame:
    """Rows of a routed table that took ``route``, or all. ``schema`` is that of the routed
    rows; a batch also has ``_batch`` and ``_route``."""
    whole = routed_schema(schema)
    if streaming:
        table = spark.readStream.schema(whole).options(**most.options()).parquet(path)
    else:
        table = spark.read.schema(whole).parquet(path)
    if route is not None:
        table = table.filter(F.col(ROUTE) == route)
    return table.drop(BATCH, ROUTE) if streaming else table


# Gates -----------------------------------------------------------------------


def broken_rules(rules: Mapping[str, str], on_null: str = "drop") -> Column:
    """Names of the rules that a row breaks, in the rules' order; never NULL."""
    names = [F.when(~passes(predicate, on_null), F.lit(name)) for name, predicate in rules.items()]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def quarantine(df: DataFrame, rules: Mapping[str, str], on_null: str = "drop") -> DataFrame:
    """Every row, with the rules it breaks (``_broken``) and whether it is kept or
    quarantined (``_route``). Batch or stream; ``expect_all_or_drop`` keeps the same rows."""
    marked = df.withColumn(BROKEN, broken_rules(rules, on_null))
    return marked.withColumn(ROUTE, F.when(F.size(BROKEN) == 0, KEPT).otherwise(QUARANTINED))


def gate_stream(
    df: DataFrame,
    rules: Mapping[str, str],
    path: str,
    checkpoint: str,
    on_null: str = "drop",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Write a stream with what its gates drop to a routed table."""
    return route_stream(df, path, checkpoint, lambda batch, _: quarantine(batch, rules, on_null), trigger, name)


def gate_counts(routed: DataFrame, rules: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Rows, dropped rows and failures of each rule, per ``by`` (``_batch``, for one). A
    routed table has them for every stream, without an observation to ask for."""
    return routed.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(ROUTE) != KEPT).alias("dropped"),
        *(F.count_if(F.array_contains(BROKEN, name)).alias(name) for name in rules),
    )


# Late rows -------------------------------------------------------------------


class _Marks:
    """The latest event time up to each batch, one small file a batch."""

    def __init__(self, path: str):
        self.path = path

    def read(self, spark: SparkSession, number: int):
        """Micros, or None if no event has had a time up to that batch."""
        if number < 0:
            return None
        try:
            row = spark.read.schema("latest long").json(f"{self.path}/{BATCH}={number}").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return row and row["latest"]

    def write(self, spark: SparkSession, number: int, latest: int | None) -> None:
        kept = spark.createDataFrame([(latest,)], "latest long").coalesce(1)
        kept.write.mode("overwrite").json(f"{self.path}/{BATCH}={number}")


def split_late(
    df: DataFrame,
    path: str,
    checkpoint: str,
    time: str = "timestamp",
    every: str = RESAMPLE_EVERY,
    watermark: str = WATERMARK,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Part a stream into rows in time and late rows, before its windows are aggregated.

    The watermark of a batch is the latest event time of all batches before it, less
    ``watermark``. A row is late if its window of ``every`` ended at or before that; rows
    without a time are late. A stateful stream over the rows in time never drops one: its
    own watermark is a batch further behind. So late rows and aggregated rows together are
    all rows."""
    marks = _Marks(f"{path}.marks")
    behind, width = duration_micros(watermark), duration_micros(every)
    moment = F.col(time).try_cast("timestamp")

    def route(batch: DataFrame, number: int) -> DataFrame:
        before = marks.read(batch.sparkSession, number - 1)
        in_time = moment.isNotNull()
        if before is not None:
            in_time &= F.unix_micros(window_start(moment, every)) + width > before - behind
        return batch.withColumn(ROUTE, F.when(in_time, KEPT).otherwise(LATE))

    def after(spark: SparkSession, number: int) -> None:
        written = spark.read.schema(df.schema).parquet(f"{path}/{BATCH}={number}")
        seen = written.agg(F.max(F.unix_micros(moment))).first()[0]
        latest = [micros for micros in (marks.read(spark, number - 1), seen) if micros is not None]
        marks.write(spark, number, max(latest, default=None))

    return route_stream(df, path, checkpoint, route, trigger, name, after)
