"""Tables that readers always find whole: new folders first, a manifest last.

    <path>/data/odotrack_commit=<id>/day=2026-05-10/part-*.parquet
    <path>/manifests/0000000007.json      the folders that make up version 7

A write puts its rows into a folder of its own and then commits a manifest that names,
for every part of the table, the folder that holds it. Until the manifest is in place
readers see the version before, and after a failed write they go on seeing it. A part is
one value of the ``part`` column, so a refresh rewrites the parts that changed and names
the old folders for all others. A manifest is as long as the table has parts.

The manifest is renamed into place, so it is there in full or not at all. Of two writers
that started from the same version the second fails and has to run again. Folders that
no kept version names stay until ``expire``."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COMMIT = "odotrack_commit"
_WHOLE = ""  # the only part of a table without a part column


class LostRace(RuntimeError):
    """Another writer has committed since this one began."""


@dataclass(frozen=True)
class Version:
    """What a manifest says: ``parts`` maps a folder name such as ``day=2026-05-10`` to the
    commit that wrote it."""

    number: int
    schema: T.StructType
    part: str | None
    parts: dict[str, str]

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "part": self.part, "parts": self.parts})


class _Files:
    """The file system of a path, through Hadoop: whatever Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.fs = self.path().getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def path(self, *names: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))

    def names(self, *folder: str) -> list[str]:
        at = self.path(*folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, *names: str) -> str:
        stream = self.fs.open(self.path(*names))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, text: str, *names: str) -> bool:
        """Write a new file in one step; False if it is there already."""
        *folder, name = names
        temporary = self.path(*folder, f".{uuid.uuid4().hex}")
        stream = self.fs.create(temporary, False)
        stream.write(text.encode())
        stream.close()
        if not self.fs.exists(self.path(*names)) and self.fs.rename(temporary, self.path(*names)):
            return True
        self.fs.delete(temporary, False)
        return False

    def drop(self, *names: str) -> None:
        self.fs.delete(self.path(*names), True)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a job has written the folder to its end."""
    files = _Files(spark, path)
    return files.fs.exists(files.path("_SUCCESS"))


def _number(number: int) -> str:
    return f"{number:010d}.json"


def _versions(files: _Files) -> list[int]:
    return [int(n[:-5]) for n in files.names("manifests") if n.endswith(".json") and not n.startswith(".")]


def _load(files: _Files, number: int) -> Version:
    kept = json.loads(files.read("manifests", _number(number)))
    return Version(number, T.StructType.fromJson(kept["schema"]), kept["part"], kept["parts"])


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    return _versions(_Files(spark, path))


def committed(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The latest version, or the one of that number; None if nothing is committed."""
    files = _Files(spark, path)
    found = _versions(files)
    if not found:
        return None
    if number is not None and number not in found:
        raise ValueError(f"there is no version {number} of {path}")
    return _load(files, found[-1] if number is None else number)


def _folder(part: str, value) -> str:
    """Where a writer puts the rows of one part. Dates, numbers and plain names only, for
    which that is no matter of escapes."""
    text = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
    if not text.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"{value!r} cannot name a part")
    return f"{part}={text}"


def read_committed(
    spark: SparkSession, path: str, number: int | None = None, parts: Iterable | None = None
) -> DataFrame:
    """A version of the table; with ``parts`` only those values of its part column."""
    version = committed(spark, path, number)
    if version is None:
        raise ValueError(f"nothing is committed at {path}")
    folders = version.parts
    if parts is not None:
        wanted = {_folder(version.part, value) for value in parts}
        folders = {name: commit for name, commit in folders.items() if name in wanted}
    if not folders:
        return spark.createDataFrame([], version.schema)
    base = f"{path.rstrip('/')}/data"
    places = [f"{base}/{COMMIT}={commit}/{name}".rstrip("/") for name, commit in folders.items()]
    # The part's type is that of the schema, not the one its folder names suggest.
    reader = spark.read.schema(version.schema).option("basePath", base)
    return reader.parquet(*places).select(*version.schema.fieldNames())


def _write(df: DataFrame, files: _Files, part: str | None, cluster_by: Sequence[str]) -> dict[str, str]:
    """Rows into a folder of their own: its parts by name."""
    commit = uuid.uuid4().hex
    if cluster_by:
        df = df.repartitionByRange(*([part] if part else []), *cluster_by)
        df = df.sortWithinPartitions(*([part] if part else []), *cluster_by)
    elif part:
        # Parts of few rows share a task, one of many is split: few files a part.
        df = df.hint("rebalance", part)
    writer = df.write.partitionBy(part) if part else df.write
    writer.parquet(f"{files.root}/data/{COMMIT}={commit}")
    if not part:
        return {_WHOLE: commit}
    names = files.names("data", f"{COMMIT}={commit}")
    return {name: commit for name in names if name.startswith(f"{part}=")}


def _commit(files: _Files, version: Version) -> None:
    files.fs.mkdirs(files.path("manifests"))
    if not files.put(version.text(), "manifests", _number(version.number)):
        raise LostRace(f"version {version.number} of {files.root} was committed by another writer")


def replace(df: DataFrame, path: str, part: str | None = None, cluster_by: Sequence[str] = ()) -> Version:
    """A version that holds the rows of ``df`` and no others. ``df`` may read the table.

    ``cluster_by`` writes files sorted by those columns over sampled ranges, so min/max
    statistics prune and no key makes a hot file."""
    files = _Files(df.sparkSession, path)
    number = max(_versions(files), default=0) + 1
    version = Version(number, _nullable(df.schema), part, _write(df, files, part, cluster_by))
    _commit(files, version)
    return version


def refresh(
    df: DataFrame, path: str, part: str, parts: Iterable | None = None, cluster_by: Sequence[str] = ()
) -> Version:
    """A version in which the parts that occur in ``df`` are those of ``df``, and all others
    stay where they are. ``parts`` names them instead: rows of ``df`` must be in these, and
    one of these without rows is emptied. A first refresh creates the table."""
    files = _Files(df.sparkSession, path)
    found = _versions(files)
    if not found:
        return replace(df, path, part, cluster_by)
    old, schema = _load(files, found[-1]), _nullable(df.schema)
    if old.part != part:
        raise ValueError(f"{path} is kept by {old.part}, not by {part}")
    if sorted(schema.jsonValue()["fields"], key=str) != sorted(old.schema.jsonValue()["fields"], key=str):
        raise ValueError(f"{path} has other columns: {old.schema.simpleString()}")
    written = _write(df.select(*old.schema.fieldNames()), files, part, cluster_by)
    emptied = set(written)
    if parts is not None:
        emptied = {_folder(part, value) for value in parts}
        if not emptied >= set(written):
            raise ValueError(f"rows outside the parts that were named: {sorted(set(written) - emptied)}")
    kept = {name: commit for name, commit in old.parts.items() if name not in emptied}
    version = Version(old.number + 1, old.schema, part, kept | written)
    _commit(files, version)
    return version


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Drop all versions but the last ``keep``, and the folders that none of these names;
    how many folders went. No write may be under way."""
    files = _Files(spark, path)
    found = _versions(files)
    kept = found[-keep:] if keep > 0 else []
    if not kept:
        raise ValueError("at least one version has to stay")
    named = {f"{COMMIT}={commit}" for number in kept for commit in _load(files, number).parts.values()}
    for number in found[: -len(kept)]:
        files.drop("manifests", _number(number))
    stale = [name for name in files.names("data") if name not in named]
    for name in stale:
        files.drop("data", name)
    return len(stale)


def _nullable(schema: T.StructType) -> T.StructType:
    """The schema as files give it back: every column may be null."""
    return T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in schema])


def _loose(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return _nullable(kind)
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_loose(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_loose(kind.keyType), _loose(kind.valueType))
    return kind
