"""Words, bindings and bit sets that several operators share."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands between two words: ASCII white space.
GAP = r"[\x20\x09-\x0D]+"


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of anything but ASCII white space; none for null."""
    return F.array_remove(F.split(or_empty(text), GAP), "")


def terms(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits; none for null."""
    return F.array_remove(F.split(F.lower(or_empty(text)), r"[^\p{L}\p{M}\p{N}]+"), "")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer if ``df`` has a column of that name."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used.

    A column that a lambda mentions would be computed for every element."""
    return F.transform(F.array(value), body)[0]


class BitSet:
    """Hashes of a small table as a literal of bounded size, for dropping rows before
    a join. It lets some others through and never drops a member, so its size bounds
    memory and not results."""

    MAX_BITS = 1 << 24

    def __init__(self, hashes: DataFrame, column: str, rows: int, probes: int = 2, per_row: int = 256, most: int = MAX_BITS):
        self.probes, bits = probes, 1 << 12
        while bits < min(most, rows * per_row):
            bits *= 2
        self.bits, words_ = bits, [0] * (bits // 64)
        spots = hashes.select(F.explode(F.array(*self._spots(F.col(column)))).alias("spot"))
        cells = spots.groupBy(F.shiftright("spot", 6).alias("cell")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("spot").bitwiseAND(63).cast("int"))).alias("bits")
        )
        for cell, value in cells.collect():  # at most MAX_BITS / 64 rows
            words_[cell] = value
        self.cells = F.from_json(F.lit(str(words_)), "array<bigint>")

    def _spots(self, value: Column) -> list[Column]:
        return [
            value.bitwiseAND(self.bits - 1),
            F.shiftrightunsigned(value, 34).bitwiseAND(self.bits - 1),
            F.shiftrightunsigned(value, 17).bitwiseAND(self.bits - 1),
        ][: self.probes]

    def may_hold(self, value: Column) -> Column:
        def bit(spot: Column) -> Column:
            cell = F.get(self.cells, F.shiftright(spot, 6).cast("int"))
            return F.call_function("getbit", cell, spot.bitwiseAND(63).cast("int")) == 1

        return reduce(lambda a, b: a & b, map(bit, self._spots(value)))
