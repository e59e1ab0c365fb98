"""Window functions over long ordered series, without a task per series.

``Window.partitionBy(robot).orderBy(time)`` gives one task a whole robot, and no
``partitionBy`` gives one task everything. Here a series is cut into contiguous
chunks. Every chunk is scanned by an ordinary window, each leaves one *tail* row
behind, a window over the tails works out what every chunk inherits, and a join
on the chunk brings that back:

    rows --exchange(keys, chunk)--> local windows ------------+--> join on (keys, chunk)
                                          \\-> tails -> chain --/

The rows are shuffled by (keys, chunk) once; window, tails and join all use that
partitioning. The tails are one row per chunk.

A chunk is a piece of a series with at most about ``max_rows`` rows, found the same way
for every table. A sample of the rows, by a hash of their keys and order, is sorted, and
every so many sampled rows one is a bound. A series with fewer rows has no bounds: it is
its own only chunk, and plain windows are all that it takes part in. The bounds are written
to small tables, the levels of a search tree, so Spark knows their sizes and joins them as
those suggest; a row meets one node of each level and never all bounds of its series.
Bounds tell rows apart by their order, so a hot key and a hot hour are cut wherever their
rows are.

Where the copies of one row fill several chunks, their bounds are equal; the table is then
written with a number for each row, and the copies are dealt over these chunks.

With ``span`` a series is cut at fixed times first, every day for one, and each span then by
its own bounds. That keeps the bounds of one series few where it has thousands of millions
of rows. ``parts`` sorts the table by sampled ranges instead, as many as asked for, and cuts
each by the number of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from math import floor, log2

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odotrack.functions.columns import (
    add_nullable,
    duration_micros,
    micros_of,
    null_safe,
)
from odotrack.session import stage

CHUNK, PIECE = "_chunk", "_piece"
TIE = "_tie"
FIRST = Window.unboundedPreceding
MAX_ROWS = 4_000_000  # of a chunk: some seconds' work for one task
SAMPLED = 64  # rows of the sample that make a chunk
FAN = 64  # bounds in a node of their tree
FIRST_CHUNK = -(2**63)  # rows without an order value sort first


@dataclass(frozen=True)
class Chunked:
    """A DataFrame whose (keys, ``_chunk``, ``_piece``) groups are contiguous in ``order``.

    ``_piece`` is NULL in a series that is its own only chunk."""

    df: DataFrame
    group: tuple[str, ...]  # stand for the keys, never NULL
    order: tuple[str, ...]

    @property
    def cell(self) -> list[str]:
        return [*self.group, CHUNK, PIECE]

    def rows(self, *leading: str):
        """Rows of a chunk in order. ``leading`` names columns that never decrease
        along the order; sorting by them first lets windows that are also
        partitioned by them share the sort."""
        return Window.partitionBy(*self.cell).orderBy(*leading, *self.order)

    def segment(self, *within: str):
        return Window.partitionBy(*self.cell, *within).orderBy(*self.order)

    def chain(self, *within: str):
        """Chunks of a key in order, over tail rows."""
        return Window.partitionBy(*self.group, *within).orderBy(CHUNK, PIECE)

    def place(self) -> Column:
        """The order as one value that is never NULL, for ``max_by``."""
        if len(self.order) > 1:
            return F.struct(*self.order)
        (name,) = self.order
        timed = isinstance(self.df.schema[name].dataType, T.TimestampType)
        value = F.unix_micros(name) if timed else F.col(name)
        return F.coalesce(value, F.lit(FIRST_CHUNK)) if timed else F.struct(value)

    def using(self, df: DataFrame) -> Chunked:
        return replace(self, df=df)

    def plain(self) -> DataFrame:
        return self.df.drop(CHUNK, PIECE, TIE, *self.group)


def chunked(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    span: str | int | None = None,
    max_rows: int | None = MAX_ROWS,
    parts: int | None = None,
) -> Chunked:
    """Cut ``df`` into contiguous chunks per key along ``order``, which should leave no
    ties between rows that differ.

    ``span`` is a duration if the first order column is a date or a timestamp, a number if
    that is one; other types have no spans. With ``max_rows`` None nothing but ``span`` cuts:
    the caller vouches for the rows. ``parts`` cuts by so many sampled ranges of rows."""
    df, names = null_safe(df, keys)
    group, order = tuple(names), tuple(order)
    if parts is not None:
        return _cut_by_range(df, group, order, parts, max_rows or MAX_ROWS)
    axis = df.schema[order[0]].dataType
    if span is None or not isinstance(axis, (T.NumericType, *TIMES)):
        spans, piece = df.withColumn(CHUNK, F.lit(0).cast("long")), F.lit(None).cast("int")
    else:
        position = micros_of(order[0], axis) if isinstance(axis, TIMES) else F.col(order[0])
        width = duration_micros(span) if isinstance(span, str) else span
        place = F.floor(position / F.lit(width)).cast("long")
        # Spans are chunks in any case, so all of them have a number.
        spans, piece = df.withColumn(CHUNK, F.coalesce(place, F.lit(FIRST_CHUNK))), F.lit(0)
    if max_rows is None:
        return Chunked(spans.withColumn(PIECE, piece), group, order)
    return Chunked(_cut(spans, [*group, CHUNK], order, max_rows, piece), group, order)


TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _cut(spans: DataFrame, cell: list[str], order: Sequence[str], max_rows: int, piece: Column) -> DataFrame:
    """``spans`` with ``_piece``: how many bounds of its cell a row is behind, ``piece`` in
    cells without bounds."""
    bounds, last, copies = _bounds(spans, cell, order, max_rows)
    if bounds is None:
        return spans.withColumn(PIECE, piece)
    if copies:
        spans = stage(spans.withColumn(TIE, F.monotonically_increasing_id()))
    top, *below = _tree(bounds, cell, last)
    point, node = F.struct(*order), F.col("_node")
    found = spans.join(top.drop("_node"), cell, "left").withColumn("_node", F.lit(0).cast("long"))
    for nodes in below:
        child = F.when(F.col("_entries").isNotNull(), node * FAN + F.greatest(_reached("_entries", point) - 1, F.lit(0)))
        found = found.withColumn("_node", child).drop("_entries").join(nodes, [*cell, "_node"], "left")
    entry = F.get("_entries", _reached("_entries", point) - 1)
    found = found.withColumns({"_entry": entry, "_cut": F.col("_entries").isNotNull()}).drop("_entries", "_node")
    held = F.pmod(TIE, F.col("_entry._copies") + 1) if copies else F.lit(0)
    # Copies of a row that bounds the chunk are dealt over all that it bounds.
    there = F.col("_entry._upto") - F.col("_entry._copies") + held
    behind = F.when(F.col("_entry._point") == point, there).otherwise(F.coalesce("_entry._upto", F.lit(0)))
    piece = F.when(F.col("_cut"), behind.cast("int")).otherwise(piece)
    return found.withColumn(PIECE, piece).drop("_entry", "_cut", TIE)


def _reached(entries: str, point: Column) -> Column:
    """How many of the sorted ``entries`` are at or before ``point``, by halving."""
    size = F.size(entries)

    def step(found: Column, power: Column) -> Column:
        ahead = found + F.call_function("shiftleft", F.lit(1), power)
        return F.when((ahead <= size) & (F.get(F.col(entries), ahead - 1)["_point"] <= point), ahead).otherwise(found)

    powers = F.sequence(F.floor(F.log2(size)).cast("int"), F.lit(0), F.lit(-1))
    return F.aggregate(powers, F.lit(0), step)


def _tree(bounds: DataFrame, cell: list[str], last: int) -> list[DataFrame]:
    """The bounds as a search tree, a table a level from the top: (cell, ``_node``,
    ``_entries``), at most ``FAN`` sorted entries a node. However many bounds a series has,
    a row meets one node of each level."""
    levels = []
    while True:
        entries = F.sort_array(F.collect_list(F.struct("_point", "_copies", "_upto")))
        nodes = bounds.groupBy(*cell, F.floor(F.col("_at") / FAN).alias("_node")).agg(entries.alias("_entries"))
        levels.append(stage(nodes))
        if last < FAN:
            return levels[::-1]
        bounds = bounds.filter(F.col("_at") % FAN == 0).withColumn("_at", F.floor(F.col("_at") / FAN))
        last //= FAN


def _bounds(
    spans: DataFrame, cell: list[str], order: Sequence[str], max_rows: int
) -> tuple[DataFrame | None, int, bool]:
    """For every cell with more rows, by the sample, than half of ``max_rows``, the order
    values that part it into chunks of so many: where neighbours share the copies of a row,
    they still fit. One in so many rows is sampled that ``SAMPLED`` of them stand for a
    chunk; of short chunks all are, and a large sample is cut by bounds of its own before it
    is sorted. Equal bounds are one row (cell, ``_point``, ``_copies``, ``_upto`` with all
    before it, ``_at``, its number). With the largest number and whether some are equal;
    None if no series has bounds."""
    wanted = max(1, max_rows // 2)
    one_in = max(1, wanted // SAMPLED)
    names = dict.fromkeys([*cell, *order])
    picked = spans.filter(F.pmod(F.xxhash64(*names), F.lit(one_in)) == 0).select(*names)
    part, none = [*cell, PIECE], F.lit(None).cast("int")
    if max_rows < MAX_ROWS:
        sampled = Observation()
        picked = stage(picked.observe(sampled, F.count("*").alias("rows")))
        large = sampled.get["rows"] > MAX_ROWS
        picked = _cut(picked, cell, order, MAX_ROWS, none) if large else picked.withColumn(PIECE, none)
    else:
        picked = picked.withColumn(PIECE, none)
    rank = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
    opens = (F.col("_rank") == 1) & (F.coalesce(PIECE, F.lit(0)) > 0)
    bounds = picked.withColumn("_rank", rank).filter((F.col("_rank") % (wanted // one_in) == 0) | opens)
    bounds = bounds.groupBy(*names).agg(F.count("*").alias("_copies"))
    along = Window.partitionBy(*cell).orderBy(*order)
    numbered = bounds.select(
        *cell,
        F.struct(*order).alias("_point"),
        "_copies",
        F.sum("_copies").over(along.rowsBetween(FIRST, 0)).alias("_upto"),
        (F.row_number().over(along) - 1).cast("long").alias("_at"),
    )
    seen = Observation()
    kept = stage(numbered.observe(seen, F.max("_at").alias("last"), F.max("_copies").alias("copies")))
    last, copies = (seen.get[name] for name in ("last", "copies"))
    return (None, 0, False) if last is None else (kept, last, copies > 1)


def _cut_by_range(
    df: DataFrame, group: tuple[str, ...], order: tuple[str, ...], parts: int, max_rows: int
) -> Chunked:
    """Chunks of at most ``max_rows`` rows whatever the skew: as many sorted ranges as
    asked for, each cut at every so many rows.

    The table is written first, since sampling the bounds reads it once more, and
    since rows read from files can be numbered the same way on every attempt: the
    number parts copies of a row. The result is written because another run would
    sample other bounds."""
    numbered = stage(df).withColumn(TIE, F.monotonically_increasing_id())
    along = [*group, *order, TIE]
    ranged = numbered.repartitionByRange(parts, *along).sortWithinPartitions(*along)
    # The id counts a range's rows in its lower bits; without the lowest it counts chunks.
    chunk = F.shiftright(F.monotonically_increasing_id(), floor(log2(max_rows)))
    cut = stage(ranged.withColumns({CHUNK: chunk, PIECE: F.lit(0)}))
    return Chunked(cut, group, (*order, TIE))


@dataclass(frozen=True)
class Scan:
    """One two-level scan, as columns.

    local  stages of columns over the rows of a chunk
    tail   columns of a chunk's last row that the chain needs
    chain  stages of columns over the tails
    carry  those of them that say what a chunk inherits
    out    the result, from local and carried columns; where a series begins, all
           carried columns may be NULL
    total  the tail as aggregates, if it can be had without sorting the rows"""

    local: list[dict[str, Column]]
    tail: list[str]
    chain: list[dict[str, Column]]
    carry: list[str]
    out: dict[str, Column]
    leading: list[str] = field(default_factory=list)
    total: dict[str, Column] | None = None


def scan(chunks: Chunked, *scans: Scan) -> Chunked:
    """Run the scans together: one pass, one tail row per chunk, one join. A series that
    is its own only chunk inherits nothing and leaves no tail.

    Tails that are aggregates combine before they are shuffled. Others come out of
    the windows over the rows, which so run twice, for the tails on the columns
    these need and for the result; that costs less than writing the rows between."""
    leading = list(dict.fromkeys(name for s in scans for name in s.leading))
    last = F.lead(F.lit(1)).over(chunks.rows(*leading)).isNull()
    rows = chunks.df.withColumn("_last", last)
    for depth in range(max(len(s.local) for s in scans)):
        columns = {}
        for s in scans:
            columns |= s.local[depth] if depth < len(s.local) else {}
        rows = rows.withColumns(columns)

    needed = dict.fromkeys(name for s in scans for name in s.tail)
    if all(s.total for s in scans):
        totals = {name: value for s in scans for name, value in s.total.items()}
        tails = chunks.df.filter(F.col(PIECE).isNotNull()).groupBy(*chunks.cell).agg(*(v.alias(name) for name, v in totals.items()))
    else:
        tails = rows.filter(F.col("_last") & F.col(PIECE).isNotNull()).select(*chunks.cell, *needed)
    for depth in range(max(len(s.chain) for s in scans)):
        columns = {}
        for s in scans:
            columns |= s.chain[depth] if depth < len(s.chain) else {}
        tails = tails.withColumns(columns)
    carried = dict.fromkeys(name for s in scans for name in s.carry)
    carry = tails.select(*chunks.cell, *carried)

    out, temporary = {}, {"_last", *carried}
    for s in scans:
        out |= s.out
        temporary |= {name for columns in s.local for name in columns}
    joined = rows.join(carry, list(chunks.cell), "left").withColumns(out)
    return chunks.using(joined.drop(*(temporary - set(out))))


def lag_scan(chunks: Chunked, columns: dict[str, str]) -> Scan:
    """``{output: input}``: the previous row's value, NULL kept as it is."""
    rows, chain = chunks.rows(), chunks.chain()
    local = {f"_lag_{out}": F.lag(name).over(rows) for out, name in columns.items()}
    return Scan(
        local=[{"_opens": F.lag(F.lit(1)).over(rows).isNull(), **local}],
        tail=list(dict.fromkeys(columns.values())),
        chain=[{f"_in_{out}": F.lag(name).over(chain) for out, name in columns.items()}],
        carry=[f"_in_{out}" for out in columns],
        out={
            out: F.when(F.col("_opens"), F.col(f"_in_{out}")).otherwise(F.col(f"_lag_{out}"))
            for out in columns
        },
        total={name: F.max_by(name, chunks.place()) for name in columns.values()},
    )


def lead_scan(chunks: Chunked, columns: dict[str, str]) -> Scan:
    """``{output: input}``: the next row's value; only a chunk's last row has to
    look into the chunk after it."""
    rows, chain = chunks.rows(), chunks.chain()
    heads = {f"_head_{out}": F.first(name).over(rows.rowsBetween(FIRST, 0)) for out, name in columns.items()}
    local = {f"_lead_{out}": F.lead(name).over(rows) for out, name in columns.items()}
    return Scan(
        local=[{**heads, **local}],
        tail=list(heads),
        chain=[{f"_in_{out}": F.lead(f"_head_{out}").over(chain) for out in columns}],
        carry=[f"_in_{out}" for out in columns],
        out={
            out: F.when(F.col("_last"), F.col(f"_in_{out}")).otherwise(F.col(f"_lead_{out}"))
            for out in columns
        },
        total={f"_head_{out}": F.min_by(name, chunks.place()) for out, name in columns.items()},
    )


def hold_scan(chunks: Chunked, columns: dict[str, Column], current: bool) -> Scan:
    """``{output: input}``: the latest non-NULL value, up to this row if
    ``current``, else strictly before it."""
    rows, before = chunks.rows(), chunks.chain().rowsBetween(FIRST, -1)

    def known(value: Column) -> Column:
        return F.when(value.isNotNull(), chunks.place())

    through = rows.rowsBetween(FIRST, 0)
    local = {f"_held_{out}": F.last(value, True).over(through) for out, value in columns.items()}
    if not current:
        local |= {
            f"_past_{out}": F.last(value, True).over(rows.rowsBetween(FIRST, -1))
            for out, value in columns.items()
        }
    return Scan(
        local=[local],
        tail=[f"_held_{out}" for out in columns],
        chain=[{f"_in_{out}": F.last(f"_held_{out}", True).over(before) for out in columns}],
        carry=[f"_in_{out}" for out in columns],
        out={
            out: F.coalesce(F.col(f"_held_{out}" if current else f"_past_{out}"), F.col(f"_in_{out}"))
            for out in columns
        },
        total={f"_held_{out}": F.max_by(value, known(value)) for out, value in columns.items()},
    )


def segment_scan(
    chunks: Chunked,
    within: str | None = None,
    sums: dict[str, Column] | None = None,
    firsts: dict[str, Column] | None = None,
    first_known: dict[str, Column] | None = None,
    held_before: dict[str, Column] | None = None,
) -> Scan:
    """Running aggregates inside segments of a series.

    ``within`` numbers the segments and never decreases along the order; None
    takes the whole series. ``sums`` and ``firsts`` follow SUM and FIRST over
    ROWS UNBOUNDED PRECEDING, ``first_known`` skips NULLs, ``held_before`` is the
    latest known value strictly before the row."""
    sums, firsts = sums or {}, firsts or {}
    first_known, held_before = first_known or {}, held_before or {}
    inside = [within] if within else []
    segment = chunks.segment(*inside)
    to_here, so_far = segment.rowsBetween(FIRST, 0), chunks.chain(*inside).rowsBetween(FIRST, 0)

    local: dict[str, Column] = {}
    total: dict[str, Column] = {}
    for out, value in sums.items():
        local[f"_sum_{out}"] = F.sum(value).over(to_here)
        total[f"_to_{out}"] = F.sum(f"_sum_{out}").over(so_far)
    for out, value in firsts.items():
        local[f"_first_{out}"] = F.first(value).over(to_here)
        total[f"_to_{out}"] = F.first(f"_first_{out}").over(so_far)
    for out, value in first_known.items():
        local[f"_known_{out}"] = F.first(value, True).over(to_here)
        total[f"_to_{out}"] = F.first(f"_known_{out}", True).over(so_far)
    past = {}
    for out, value in held_before.items():
        local[f"_held_{out}"] = F.last(value, True).over(to_here)
        past[f"_past_{out}"] = F.last(value, True).over(segment.rowsBetween(FIRST, -1))
        total[f"_to_{out}"] = F.last(f"_held_{out}", True).over(so_far)

    step = chunks.chain()
    names = [name.removeprefix("_to_") for name in total]
    inherited = {f"_in_{out}": F.lag(f"_to_{out}").over(step) for out in names}
    inherited["_in_any"] = F.lag(F.lit(1)).over(step)
    goes_on = F.col("_in_any").isNotNull()
    if within:
        inherited["_in_segment"] = F.lag(within).over(step)
        goes_on = goes_on & F.col(within).eqNullSafe(F.col("_in_segment"))

    def carried(out: str) -> Column:
        return F.when(goes_on, F.col(f"_in_{out}"))

    total_of = None
    if not within:
        place = chunks.place()
        total_of = {f"_sum_{out}": F.sum(value) for out, value in sums.items()}
        total_of |= {f"_first_{out}": F.min_by(value, place) for out, value in firsts.items()}
        for kind, by, values in (("known", F.min_by, first_known), ("held", F.max_by, held_before)):
            total_of |= {
                f"_{kind}_{out}": by(value, F.when(value.isNotNull(), place)) for out, value in values.items()
            }

    result = {out: add_nullable(F.col(f"_sum_{out}"), carried(out)) for out in sums}
    result |= {
        out: F.when(goes_on, F.col(f"_in_{out}")).otherwise(F.col(f"_first_{out}")) for out in firsts
    }
    result |= {out: F.coalesce(carried(out), F.col(f"_known_{out}")) for out in first_known}
    result |= {out: F.coalesce(F.col(f"_past_{out}"), carried(out)) for out in held_before}
    return Scan(
        local=[{**local, **past}],
        tail=[*inside, *local],
        chain=[total, inherited],
        carry=list(inherited),
        out=result,
        leading=inside,
        total=total_of,
    )


def session_scan(chunks: Chunked, gap: str) -> Scan:
    """Gaps and islands on the first order column: a row opens a session if it
    has no predecessor or lies strictly more than ``gap`` after it. Sessions count
    1, 2, 3 … per key. Adds ``prev_ts``, ``session_id`` and ``session_start``."""
    time = chunks.order[0]
    kind, limit = chunks.df.schema[time].dataType, F.lit(duration_micros(gap))
    rows, chain = chunks.rows(), chunks.chain()
    to_here, before = rows.rowsBetween(FIRST, 0), chain.rowsBetween(FIRST, -1)

    def opens(previous: str, this: str) -> Column:
        passed = micros_of(this, kind) - micros_of(previous, kind)
        return F.col(previous).isNull() | (passed > limit)

    breaks = F.when(~F.col("_heads") & opens("_near_ts", time), 1).otherwise(0)
    return Scan(
        local=[
            {"_heads": F.lag(F.lit(1)).over(rows).isNull(), "_near_ts": F.lag(time).over(rows)},
            {"_breaks": breaks},
            {
                "_local_session": F.sum("_breaks").over(to_here),
                "_local_start": F.last(F.when(F.col("_breaks") == 1, F.col(time)), True).over(to_here),
                "_head_ts": F.first(time).over(to_here),
            },
        ],
        tail=[time, "_local_session", "_local_start", "_head_ts"],
        chain=[
            {"_far_ts": F.lag(time).over(chain)},
            {"_head_opens": F.when(opens("_far_ts", "_head_ts"), 1).otherwise(0)},
            {
                "_base": F.coalesce(F.sum(F.col("_head_opens") + F.col("_local_session")).over(before), F.lit(0))
                + F.col("_head_opens"),
                "_own_start": F.coalesce("_local_start", F.when(F.col("_head_opens") == 1, F.col("_head_ts"))),
            },
            {
                "_base_start": F.when(F.col("_head_opens") == 1, F.col("_head_ts")).otherwise(
                    F.last("_own_start", True).over(before)
                )
            },
        ],
        carry=["_far_ts", "_base", "_base_start"],
        out={
            "prev_ts": F.when(F.col("_heads"), F.col("_far_ts")).otherwise(F.col("_near_ts")),
            "session_id": F.coalesce("_base", F.lit(1)) + F.col("_local_session"),
            "session_start": F.coalesce("_local_start", "_base_start", "_head_ts"),
        },
    )


# DataFrame in, DataFrame out -------------------------------------------------


def ordered_lag(
    df: DataFrame,
    columns: dict[str, str],
    order: Sequence[str],
    keys: Sequence[str] = (),
    span: str | int | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """``lag(column)`` over a whole series; ``columns`` is ``{output: input}``."""
    chunks = chunked(df, order, keys, span, max_rows)
    return scan(chunks, lag_scan(chunks, columns)).plain()


def ordered_lead(
    df: DataFrame,
    columns: dict[str, str],
    order: Sequence[str],
    keys: Sequence[str] = (),
    span: str | int | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    chunks = chunked(df, order, keys, span, max_rows)
    return scan(chunks, lead_scan(chunks, columns)).plain()


def running_sum(
    df: DataFrame,
    columns: dict[str, Column],
    order: Sequence[str],
    keys: Sequence[str] = (),
    within: str | None = None,
    span: str | int | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """``sum(column)`` from the start of the series, or of its ``within`` segment."""
    chunks = chunked(df, order, keys, span, max_rows)
    return scan(chunks, segment_scan(chunks, within, sums=columns)).plain()


def running_first(
    df: DataFrame,
    columns: dict[str, Column],
    order: Sequence[str],
    keys: Sequence[str] = (),
    within: str | None = None,
    span: str | int | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """``first(column)`` of the series or segment; a NULL first value stays NULL."""
    chunks = chunked(df, order, keys, span, max_rows)
    return scan(chunks, segment_scan(chunks, within, firsts=columns)).plain()


def fill_gaps(
    df: DataFrame,
    columns: Sequence[str],
    how: str = "ffill",
    keys: Sequence[str] = (),
    order: Sequence[str] = ("timestamp",),
    span: str | int | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """NULL gaps: take over the latest known value, or drop the rows."""
    if how == "drop":
        return df.dropna(subset=list(columns))
    if how != "ffill":
        raise ValueError(f"how must be 'ffill' or 'drop', not {how!r}")
    chunks = chunked(df, order, keys, span, max_rows)
    filled = hold_scan(chunks, {name: F.col(name) for name in columns}, current=True)
    return scan(chunks, filled).plain().select(*df.columns)
