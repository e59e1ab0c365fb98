"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    """Elapsed seconds as a double. The difference is taken in whole
    microseconds, so no precision is lost to the size of the epoch."""
    return (F.unix_micros(as_column(later)) - F.unix_micros(as_column(earlier))) / F.lit(1e6)


def micros_of(value: str | Column, kind: T.DataType) -> Column:
    """Microseconds since the epoch of a date or a timestamp. One without a time zone is
    read field by field, so no change of the clocks in the session's zone moves it."""
    value, day = as_column(value), 86_400_000_000
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.DateType):
        return F.unix_date(value) * F.lit(day).cast("long")
    if isinstance(kind, T.TimestampNTZType):
        minutes = F.hour(value) * 60 + F.minute(value)
        seconds = F.extract(F.lit("SECOND"), value)
        within = minutes * F.lit(60_000_000).cast("long") + (seconds * 1_000_000).cast("long")
        return F.unix_date(value.cast("date")) * F.lit(day).cast("long") + within
    raise TypeError(f"no point in time: {kind.simpleString()}")


def add_nullable(left: Column, right: Column) -> Column:
    """Sum of two partial sums with the NULL rule of SQL SUM: NULL only when both are."""
    return F.coalesce(left + right, left, right)


def duration_micros(text: str) -> int:
    """Microseconds in a duration such as ``5 seconds`` or ``1 hour``."""
    units = {
        "microsecond": 1,
        "millisecond": 1_000,
        "second": 1_000_000,
        "minute": 60_000_000,
        "hour": 3_600_000_000,
        "day": 86_400_000_000,
        "week": 604_800_000_000,
    }
    number, unit = text.strip().split()
    unit = unit.lower().removesuffix("s")
    if unit not in units:
        raise ValueError(f"unsupported duration: {text!r}")
    return round(float(number) * units[unit])


def window_start(time: str | Column, every: str) -> Column:
    """Start of the tumbling window, as ``F.window`` has it, without the struct."""
    micros = F.unix_micros(as_column(time))
    width = F.lit(duration_micros(every)).cast("long")
    return F.timestamp_micros(micros - F.pmod(micros, width))


def nested(df: DataFrame, path: str) -> Column:
    """``a.b`` out of a struct or a map. A field the schema does not have is NULL,
    so one sensor's extraction survives a landing folder without the others."""
    parent, _, leaf = path.rpartition(".")
    if not parent:
        return F.col(path) if path in df.columns else F.lit(None)
    kind = df.schema[parent].dataType
    if isinstance(kind, T.StructType) and leaf not in kind.fieldNames():
        return F.lit(None)
    return F.col(path)


def null_safe(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Columns to partition and join by in place of ``keys``, which may be NULL.

    Each key becomes a value that is never NULL and a flag, so equality works and a
    window, an aggregate and a join by them share one partitioning. Types without a
    plain default are wrapped in a struct, which is never NULL either."""
    columns: dict[str, Column] = {}
    for i, key in enumerate(keys):
        kind = df.schema[key].dataType
        if isinstance(kind, (T.NumericType, T.StringType, T.BooleanType)):
            default = F.lit("") if isinstance(kind, T.StringType) else F.lit(0)
            columns[f"_key{i}"] = F.coalesce(F.col(key), default.cast(kind))
            columns[f"_null{i}"] = F.col(key).isNull()
        else:
            columns[f"_key{i}"] = F.struct(key)
    return df.withColumns(columns), list(columns)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
