"""The tables end to end: raw events to bronze, silver and gold.

``run_streaming`` keeps bronze and silver as streaming tables and is started again
whenever new files have landed. ``build_gold`` recomputes gold from silver;
``features_from_raw`` goes from raw events to features in one batch.

The columns of raw events are inferred once and kept with the lake, so every table's
schema is known before its first row: a table without rows is an empty table. What
does not fit those columns is rescued into the raw table.

Streaming tables have a folder a day (``_day``, of the event's time in the session's time
zone), and ``lake_table`` turns bounds on time into bounds on folders. A backlog is worked
off in batches of at most ``Intake``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from odotrack.functions.constants import RESAMPLE_EVERY, SESSION_GAP, WATERMARK
from odotrack.operators.bronze import bronze_encoder, bronze_gps, bronze_imu
from odotrack.operators.events import event_stream
from odotrack.operators.fleet import (
    TerrainThresholds,
    classify_terrain,
    fleet_kpis,
    flag_anomalies,
    pruning_manifest,
    session_terrain,
    with_terrain,
)
from odotrack.operators.fusion import localization_features
from odotrack.operators.history import current_version, scd2_history
from odotrack.operators.kinematics import accelerated, gates, kinetic_master, velocity
from odotrack.operators.ordered import MAX_ROWS, Chunked, chunked
from odotrack.operators.quality import expect_all_or_drop, load_rules
from odotrack.operators.resample import (
    resample_aligned,
    resample_encoder,
    resample_gps,
    resample_imu,
)
from odotrack.operators.trajectory import features_of, trajectory_features
from odotrack.session import stage
from odotrack.sources.raw_json import frozen_schema, keep_schema, kept_schema, read_lines, rescue
from odotrack.sources.tables import (
    BATCH,
    DAY,
    INTAKE,
    Intake,
    clustered_schema,
    dated,
    materialize,
    read_table,
    within,
    write_clustered,
    write_stream,
)

BRONZE: dict[str, Callable[..., DataFrame]] = {
    "bronze_imu_data": bronze_imu,
    "bronze_encoder_data": bronze_encoder,
    "bronze_gps_data": bronze_gps,
}
SILVER: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "silver_imu_history": ("bronze_imu_data", resample_imu),
    "silver_encoder_history": ("bronze_encoder_data", resample_encoder),
    "silver_gps_history": ("bronze_gps_data", resample_gps),
}


RAW_TABLE, EVENTS_TABLE = "bronze_robotics_raw", "silver_event_stream"


@dataclass(frozen=True)
class Lake:
    """Folders of the tables, of their streaming checkpoints and of the raw schema."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{name}"

    def schema(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/schemas/{name}"


def _finish(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        query.awaitTermination()


def _events_in(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Raw events of text lines; blank ones hold none."""
    return rescue(lines.filter(F.trim("value") != ""), schema)


def table_schemas(
    spark: SparkSession, schema: T.StructType, keys: Sequence[str] = ()
) -> dict[str, T.StructType]:
    """Columns of every streaming table that follow from those of raw events, and its day."""
    raw = _events_in(spark.createDataFrame([], "value string"), schema)
    tables = {RAW_TABLE: raw, EVENTS_TABLE: event_stream(raw, keys=keys)}
    tables |= {name: extract(raw, keys) for name, extract in BRONZE.items()}
    for name, (source, resampled) in SILVER.items():
        tables[name] = resampled(tables[source], keys=keys)
    return {name: dated(table, _time_of(name)).schema for name, table in tables.items()}


def _time_of(name: str) -> str:
    return "ts" if name == RAW_TABLE else "timestamp"


def run_streaming(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    keys: Sequence[str] = (),
    schema: T.StructType | str | None = None,
    every: str = RESAMPLE_EVERY,
    watermark: str = WATERMARK,
    most: Intake = INTAKE,
    cluster: bool = False,
) -> None:
    """Work off the landing folder: raw, then bronze, then silver and the flagged
    event stream. Tables of one layer run side by side, and none takes up more than
    ``most`` at a time. With ``cluster`` the files of a day are sorted by ``keys`` and time,
    which costs a shuffle a table; a lake stays as it began.

    ``schema`` holds the columns of raw events. The first run keeps it with the lake,
    or else those inferred from the files that have landed, and later runs go on with
    what was kept. As long as there is neither a schema nor a file, nothing happens.
    Unknown and misfitting fields are in ``_rescued_data`` of the raw table, lines that
    are no event in ``_malformed``."""
    schema = frozen_schema(spark, landing, lake.schema(RAW_TABLE)) if schema is None else (
        keep_schema(spark, lake.schema(RAW_TABLE), schema)
    )
    if schema is None:
        return
    schemas = table_schemas(spark, schema, keys)

    def append(df: DataFrame, name: str) -> StreamingQuery:
        by_day, place = dated(df, _time_of(name)), (lake.table(name), lake.checkpoint(name))
        if cluster:
            return write_clustered(by_day, *place, [*keys, _time_of(name)], name=name)
        return write_stream(by_day, *place, partition_by=[DAY], name=name)

    def source(name: str) -> DataFrame:
        schema = clustered_schema(schemas[name]) if cluster else schemas[name]
        table = read_table(spark, lake.table(name), streaming=True, schema=schema, most=most)
        return table.drop(DAY, BATCH)

    lines = read_lines(spark, landing, streaming=True, most=most)
    _finish([append(_events_in(lines, schema), RAW_TABLE)])
    raw = source(RAW_TABLE)
    queries = [append(extract(raw, keys), name) for name, extract in BRONZE.items()]
    queries.append(append(event_stream(raw, keys=keys), EVENTS_TABLE))
    _finish(queries)
    _finish(
        [
            append(resampled(source(bronze), every=every, watermark=watermark, keys=keys), name)
            for name, (bronze, resampled) in SILVER.items()
        ]
    )


def lake_table(
    spark: SparkSession,
    lake: Lake,
    name: str,
    keys: Sequence[str] = (),
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """A streaming table as it stands, with or without rows. ``since`` and ``until``
    (exclusive) keep the rows of that time, and only files of those days are listed."""
    schema = kept_schema(spark, lake.schema(RAW_TABLE))
    known = table_schemas(spark, schema, keys)[name] if schema is not None else None
    table = read_table(spark, lake.table(name), schema=known)
    return within(table, _time_of(name), since, until).drop(DAY, BATCH)


def silver_history(
    spark: SparkSession,
    lake: Lake,
    name: str,
    keys: Sequence[str] = (),
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """A silver table with its versions, from the change log the stream appended. The
    stream closes a window once, so a window has one row and one version."""
    changes = lake_table(spark, lake, name, keys, since, until)
    return scd2_history(changes, [*keys, "timestamp"], "timestamp", unique=True)


@dataclass(frozen=True)
class GoldLimits:
    """Where the fleet's tables draw their lines."""

    terrain: TerrainThresholds = TerrainThresholds()
    z_max: float = 3.0
    eps_drift: float = 0.0
    eps_variance: float = 0.01


def build_gold(
    spark: SparkSession,
    lake: Lake,
    keys: Sequence[str] = (),
    rules: Mapping[str, str] | None = None,
    gap: str = SESSION_GAP,
    metadata: DataFrame | Callable[[], DataFrame] | None = None,
    observation: Observation | None = None,
    limits: GoldLimits = GoldLimits(),
    every: str = RESAMPLE_EVERY,
) -> dict[str, DataFrame]:
    """Recompute all gold tables from silver, the manifest's row counts from raw.

    Dynamic gates are ``rules``, or worked out from the threshold table ``metadata`` as
    it is now, or the fallback's. ``observation`` counts what the gates of the master
    drop. ``every`` is the window ``run_streaming`` was given."""
    if rules is None and metadata is not None:
        rules = load_rules(metadata)
    imu, encoder, gps = (
        current_version(silver_history(spark, lake, name, keys)) for name in SILVER
    )
    order, gold = [*keys, "timestamp"], {}

    def write(name: str, df: DataFrame, by: Sequence[str]) -> DataFrame:
        gold[name] = materialize(df, lake.table(name), by)
        return gold[name]

    # Written first: sampling for the sort would run the join, and count drops, twice.
    gated = stage(kinetic_master(imu, encoder, gps, keys, rules, observation=observation))
    master = write("gold_kinetic_master", gated, order)
    features = write(
        "gold_ml_features", trajectory_features(master, keys, gap, max_rows=MAX_ROWS), order
    )
    events = lake_table(spark, lake, EVENTS_TABLE, keys)
    write("gold_localization_features", stage(localization_features(events, keys=keys, gap=gap)), order)

    labelled = classify_terrain(features, limits.terrain)
    sessions = session_terrain(labelled, keys)
    write("gold_terrain_classification", with_terrain(labelled, sessions, keys), order)
    flagged = stage(flag_anomalies(features, gates(rules), limits.z_max, keys))
    write("gold_fleet_kpis", fleet_kpis(flagged, keys, "is_anomaly"), ["level", *keys])
    raw = lake_table(spark, lake, RAW_TABLE, keys)
    manifest = pruning_manifest(flagged, raw, limits.eps_drift, limits.eps_variance, keys, every)
    write("gold_pruning_manifest", manifest, [*keys, "seg_start"])
    return gold


Rules = Mapping[str, str] | Callable[[DataFrame], Mapping[str, str]]


def master_from_raw(
    raw: DataFrame,
    keys: Sequence[str] = (),
    rules: Rules | None = None,
    every: str = RESAMPLE_EVERY,
    on_null: str = "drop",
    span: str | None = None,
) -> DataFrame:
    """The kinetic master straight from raw events. The raw table is scanned once:
    sensors are resampled and aligned together and the result, one row per window,
    is staged for the scans that follow. ``rules`` may be worked out from the
    aligned windows by a function."""
    return _master_chunks(raw, keys, rules, every, on_null, span).plain()


def features_from_raw(
    raw: DataFrame,
    keys: Sequence[str] = (),
    rules: Rules | None = None,
    every: str = RESAMPLE_EVERY,
    gap: str = SESSION_GAP,
    span: str | None = None,
    **options,
) -> DataFrame:
    """The feature table straight from raw events. Master and features are cut the same
    way; the master is staged, as the features scan it three times."""
    chunks = _master_chunks(raw, keys, rules, every, "drop", span)
    return features_of(chunks.using(stage(chunks.df)), gap, **options)


def _master_chunks(
    raw: DataFrame, keys: Sequence[str], rules: Rules | None, every: str, on_null: str, span: str | None
) -> Chunked:
    aligned = stage(resample_aligned(raw, every, keys))
    if callable(rules):
        rules = rules(aligned)
    chunks = accelerated(chunked(velocity(aligned), ["timestamp"], keys, span, MAX_ROWS))
    return chunks.using(expect_all_or_drop(chunks.df, gates(rules), on_null))
