"""Versioned history (slowly changing dimension, type 2) over an append-only
change log. Versions are derived when read, so late and out-of-order changes
fall into place and nothing is rewritten."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odotrack.operators.ordered import MAX_ROWS, chunked, lead_scan, scan

START, END = "__START_AT", "__END_AT"


def _smallest(changes: DataFrame, names: Sequence[str]) -> Column:
    """The smallest of several rows; maps have no order, so rows with one go by their text."""
    row = F.struct(*names)
    if any("map<" in changes.schema[name].dataType.simpleString() for name in names):
        return F.min_by(row, F.to_json(row))
    return F.min(row)


def scd2_history(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    span: str | int | None = None,
    max_rows: int | None = MAX_ROWS,
    unique: bool = False,
) -> DataFrame:
    """Every version of every key with the range of ``sequence_by`` it was valid in.

    One row per (keys, sequence) survives, the smallest of those that tie; with
    ``unique`` the caller vouches that none do, which saves a shuffle. A version is closed by
    the next one of its key; keys with more than ``max_rows`` changes are cut into chunks."""
    keys = list(keys)
    identity = list(dict.fromkeys([*keys, sequence_by]))
    rest = [name for name in changes.columns if name not in identity]
    if unique:
        versions = changes
    elif rest:
        versions = (
            changes.groupBy(*identity)
            .agg(_smallest(changes, rest).alias("_version"))
            .select(*identity, "_version.*")
            .select(*changes.columns)
        )
    else:
        versions = changes.distinct()

    if sequence_by in keys:
        # The sequence is part of the identity, so no key has a second version.
        end = F.lit(None).cast(changes.schema[sequence_by].dataType)
        return versions.withColumns({START: F.col(sequence_by), END: end})

    chunks = chunked(versions, [sequence_by], keys, span, max_rows)
    closed = scan(chunks, lead_scan(chunks, {END: sequence_by})).plain()
    return closed.withColumn(START, F.col(sequence_by)).select(*changes.columns, START, END)


def current_version(history: DataFrame) -> DataFrame:
    return history.filter(F.col(END).isNull()).drop(START, END)


def as_of(history: DataFrame, at: Column | datetime | int) -> DataFrame:
    """The versions valid at one point of the sequence. A datetime must say its time
    zone: without one it would be read in that of the machine."""
    if isinstance(at, datetime) and at.tzinfo is None:
        raise ValueError("as_of needs a datetime with a time zone")
    at = at if isinstance(at, Column) else F.lit(at)
    return history.filter((F.col(START) <= at) & (F.col(END).isNull() | (at < F.col(END))))
