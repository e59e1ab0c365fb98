"""Raw JSON events from a landing folder, batch or stream, with drift rescue."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odotrack.schemas import RAW
from odotrack.sources.tables import INTAKE, Intake


#: What inference reads at most: whole files in order of their names up to so many bytes,
#: and of a first file that is larger so many lines of each of its splits.
SAMPLE_FILES, SAMPLE_BYTES, SAMPLE_LINES = 1000, 64 << 20, 10_000


@dataclass(frozen=True)
class Sample:
    """Files that stand for a landing folder, and their bytes."""

    files: list[str]
    bytes: int


def sample_files(
    spark: SparkSession, path: str, max_files: int = SAMPLE_FILES, max_bytes: int = SAMPLE_BYTES
) -> Sample:
    """The first files by name that hold no more than ``max_bytes`` together, and at least
    one if there is any. Names and sizes are listed; nothing is read."""
    listed = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    files, total = [], 0
    for row in listed.orderBy("path").limit(max_files).collect():
        if files and total + row["length"] > max_bytes:
            break
        files.append(row["path"])
        total += row["length"]
    return Sample(files, total)


def infer_schema(
    spark: SparkSession,
    path: str,
    ratio: float = 1.0,
    max_files: int = SAMPLE_FILES,
    max_bytes: int = SAMPLE_BYTES,
    max_lines: int = SAMPLE_LINES,
) -> T.StructType:
    """Column types of the JSON under ``path``, from a bounded sample of its files however
    much has landed; ``ratio`` < 1 samples their rows too. Lines that are no JSON add no
    column. What the sample does not show is rescued later."""
    sample = sample_files(spark, path, max_files, max_bytes)
    reader = spark.read.option("samplingRatio", ratio).option("mode", "DROPMALFORMED")
    if not sample.files:
        return T.StructType([])
    if sample.bytes <= max_bytes:
        return reader.json(sample.files).schema
    lines = spark.read.text(sample.files).limit(max_lines)
    return reader.json(lines.rdd.map(lambda row: row[0])).schema


def kept_schema(spark: SparkSession, schema_path: str) -> T.StructType | None:
    """The schema kept at ``schema_path``, or None."""
    try:
        kept = spark.read.text(schema_path, wholetext=True).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return T.StructType.fromJson(json.loads(kept[0]))


def keep_schema(spark: SparkSession, schema_path: str, schema: T.StructType | str) -> T.StructType:
    """Keep a schema where none is kept yet; the one that is kept counts."""
    kept = kept_schema(spark, schema_path)
    if kept is not None:
        return kept
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(schema_path)
    return schema


def frozen_schema(
    spark: SparkSession, path: str, schema_path: str, ratio: float = 1.0
) -> T.StructType | None:
    """The schema kept at ``schema_path``, inferred on the first call only, so a
    stream restarts with the columns it began with. None while there is no event."""
    kept = kept_schema(spark, schema_path)
    if kept is not None:
        return kept
    try:
        schema = infer_schema(spark, path, ratio)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return keep_schema(spark, schema_path, schema) if len(schema) else None


def read_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    streaming: bool = False,
    most: Intake = INTAKE,
) -> DataFrame:
    """Events as columns. A stream takes up every new file exactly once, by the
    checkpoint of the query that reads it, and ``most`` at a time; it needs a schema, by
    default the contract's."""
    if not streaming:
        return spark.read.json(path, schema=schema) if schema else spark.read.json(path)
    return spark.readStream.schema(schema or RAW).options(**most.options()).json(path)


def read_lines(spark: SparkSession, path: str, streaming: bool = False, most: Intake = INTAKE) -> DataFrame:
    """Events as text lines (``value``), the input of ``rescue``. A stream takes up
    ``most`` at a time."""
    return spark.readStream.options(**most.options()).text(path) if streaming else spark.read.text(path)


def _is_struct(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StructType)


def rescue(lines: DataFrame, schema: T.StructType = RAW, value: str = "value") -> DataFrame:
    """Parse JSON text with a fixed schema and lose nothing.

    ``_rescued_data`` maps the path of every field that is unknown, or whose value
    does not fit its type, to the value's text; NULL if there is none.
    ``_malformed`` holds a line that is no JSON object. Known fields of structs one
    level down (``data.…``) are covered too."""
    as_text = "map<string,string>"
    parsed = lines.withColumns(
        {
            "_row": F.from_json(value, schema),
            "_top": F.when(F.try_parse_json(value).isNotNull(), F.from_json(value, as_text)),
        }
    )
    structs = [field for field in schema if _is_struct(field)]
    parsed = parsed.withColumns(
        {f"_in_{field.name}": F.from_json(F.col("_top")[field.name], as_text) for field in structs}
    )

    def astray(known: list[str], lost: dict[str, Column]):
        """Entries of unknown name, and those whose known field came out NULL."""

        def keep(name: Column, text: Column) -> Column:
            misfit = F.lit(False)
            for field, is_lost in lost.items():
                misfit = misfit | ((name == field) & is_lost)
            return ~name.isin(known) | (misfit & (text != "null"))

        return keep

    def inside(field: T.StructField) -> Column:
        known = field.dataType.fieldNames()
        lost = {name: F.col(f"_row.{field.name}.{name}").isNull() for name in known}
        entries = F.map_filter(f"_in_{field.name}", astray(known, lost))
        prefixed = F.transform_keys(entries, lambda name, _: F.concat(F.lit(f"{field.name}."), name))
        return F.coalesce(prefixed, F.create_map().cast(as_text))

    lost = {
        field.name: F.col(f"_in_{field.name}" if _is_struct(field) else f"_row.{field.name}").isNull()
        for field in schema
    }
    # A dot in a name of the top level must not pass for a path: such names are quoted.
    outer = F.transform_keys(
        F.map_filter("_top", astray(schema.fieldNames(), lost)),
        lambda name, _: F.when(name.contains("."), F.concat(F.lit("`"), name, F.lit("`"))).otherwise(name),
    )
    parsed = parsed.withColumn("_rescued", F.map_concat(outer, *map(inside, structs)))
    others = [name for name in lines.columns if name != value]
    return parsed.select(
        *others,
        *(F.col(f"_row.{name}").alias(name) for name in schema.fieldNames()),
        F.when(F.size("_rescued") > 0, F.col("_rescued")).alias("_rescued_data"),
        F.when(F.col("_top").isNull(), F.col(value)).alias("_malformed"),
    )
