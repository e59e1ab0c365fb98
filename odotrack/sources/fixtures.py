"""Small fixture files as DataFrames."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession


def load_fixture(spark: SparkSession, path: str) -> DataFrame:
    """A ``.json`` file with a list of records, or a ``.csv`` file with a header
    (all columns are strings)."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix == ".json":
        return spark.read.json(path, multiLine=True)
    if suffix == ".csv":
        return spark.read.csv(path, header=True)
    raise ValueError(f"Unsupported fixture type for: {path}")
