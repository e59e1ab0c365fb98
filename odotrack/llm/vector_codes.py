"""Vector codes: product quantisation in integers, nearest entries found by LAESA pivots.

Components become integers, ``floor(256 * x)``, and vectors are cut into equal parts. Each
part position has a codebook; rounds assign every part to its nearest entry (squared
Euclidean distance, ties to the lower index) and move entries to the floor of their parts'
mean.

**Pivots.** A few entries of each first codebook, far from one another, are the position's
pivots for good. Distances from every part to them are computed once and written with the
integers. A round computes only the distances between pivots and entries; for each part and
entry, the largest difference of the two distances to one pivot is a lower bound. Entries
are tried in the order of their bounds, by exact integer distances, until the next bound
exceeds the best distance found. Distances to pivots are kept in single precision; bounds
are lowered by more than its error, so pruning never changes a result.

**On Spark.** Every step is a scan of the written table. Tasks add up their parts per entry
before anything is shuffled, so a copy that fills a third of the table costs what any other
row does; the driver holds codebooks and pivots alone, ``entries * dimension`` numbers
whatever the number of vectors.

Vectors that are null, or hold null, NaN or infinity, are dropped. Vectors are as long as
the longest, rounded up to a multiple of the number of parts; shorter ones are filled with
zeros. Integers beyond 2 ** 24 are cut to that, so that distances fit a long. Null ids
follow all others in the choice of first entries, and equal ids are ordered by their
integers; repeated rows are rows of their own. With fewer vectors than entries all are
entries. Without vectors there are no codebooks. Columns besides the vector are kept, but
for those named like the results."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, LongType, StringType, StructField, StructType

from odotrack.session import stage

SCALE, LARGEST = 256, 1 << 24
PARTS, ENTRIES, ROUNDS, PIVOTS = 16, 64, 2, 4
#: More than the relative error of a distance in single precision.
SLACK = 1e-6
#: Keys that one group of rows is spread over.
SALT = 16
_INTS, _NEAR = "pq_ints", "pq_to_pivots"


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry]`` and the pivots of each part, all integers."""

    entries: np.ndarray
    pivots: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(2).astype(np.float64))


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """For each part the first entry, then always the one farthest from those chosen."""
    chosen = []
    for own in entries:
        at = [0]
        far = _distances(own, own[:1])[:, 0]
        while len(at) < count:
            at.append(int(far.argmax()))
            far = np.minimum(far, _distances(own, own[at[-1:]])[:, 0])
        chosen.append(own[at])
    return np.array(chosen)


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of the nearest entry for each row of ``x``, and how many
    distances were evaluated."""
    between = _distances(pivots, entries).astype(np.float32)
    bounds = np.zeros((len(x), len(entries)), np.float32)
    for near, far in zip(to_pivots.T, between):
        low, high = near[:, None] * np.float32(1 - SLACK), near[:, None] * np.float32(1 + SLACK)
        np.maximum(bounds, low - far * np.float32(1 + SLACK), out=bounds)
        np.maximum(bounds, far * np.float32(1 - SLACK) - high, out=bounds)
    best = np.full(len(x), np.iinfo(np.int64).max)
    label = np.zeros(len(x), np.int64)
    live, evaluated = np.arange(len(x)), 0
    while len(live):
        pick = bounds.argmin(1)
        bound = bounds[np.arange(len(live)), pick].astype(np.float64)
        going = bound * bound * (1 - SLACK) <= best[live]
        if not going.all():
            live, pick, bounds = live[going], pick[going], bounds[going]
        step = x[live] - entries[pick]
        distance = (step * step).sum(1)
        evaluated += len(live)
        nearer = (distance < best[live]) | ((distance == best[live]) & (pick < label[live]))
        best[live[nearer]], label[live[nearer]] = distance[nearer], pick[nearer]
        bounds[np.arange(len(live)), pick] = np.inf
        if not np.isfinite(bounds[:1]).any():
            break  # all entries tried
    return label, best, evaluated


def _matrix(column: pa.Array, dtype, parts: int) -> np.ndarray:
    """A list column as (rows, parts, length)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), parts, -1)


def _assigned(batch: pa.RecordBatch, books: Codebooks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(integers, labels, squared distances) by row and part."""
    parts = len(books.entries)
    ints = _matrix(batch.column(_INTS), np.int64, parts)
    near = _matrix(batch.column(_NEAR), np.float32, parts)
    found = [nearest(ints[:, p], near[:, p], books.entries[p], books.pivots[p]) for p in range(parts)]
    return ints, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _prepared(vectors: DataFrame, column: str, parts: int) -> DataFrame:
    """Vectors that can be coded, as integers of one length."""
    vector = F.col(column).cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.filter(vector.isNotNull() & sound)
    longest = kept.agg(F.max(F.size(vector))).first()[0] or 0
    length = max(parts, -(-longest // parts) * parts)

    def whole(x):
        return F.greatest(F.least(F.floor(x * SCALE), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")

    ints = F.concat(F.transform(vector, whole), F.array_repeat(F.lit(0), F.lit(length) - F.size(vector)))
    return kept.withColumn(_INTS, ints).drop(column)


def _first_entries(rows: DataFrame, id_column: str, parts: int, entries: int) -> np.ndarray:
    """The first codebooks: parts of the ``entries`` smallest ids."""
    first = rows.select(id_column, _INTS).orderBy(F.col(id_column).asc_nulls_last(), _INTS).limit(entries).collect()
    length = len(first[0][_INTS]) // parts if first else 0
    return np.array([r[_INTS] for r in first], np.int64).reshape(len(first), parts, length).transpose(1, 0, 2)


def _with_pivot_distances(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``rows`` with the distances of each part to its pivots, in the order of the parts."""
    parts, count = books.pivots.shape[:2]
    schema = StructType([*rows.schema.fields, StructField(_NEAR, ArrayType(FloatType()))])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints = _matrix(batch.column(_INTS), np.int64, parts)
            near = np.stack([_distances(ints[:, p], books.pivots[p]) for p in range(parts)], 1).astype(np.float32)
            offsets = np.arange(len(ints) + 1, dtype=np.int32) * parts * count
            yield batch.append_column(_NEAR, pa.ListArray.from_arrays(offsets, near.ravel()))

    return rows.mapInArrow(add, schema)


def _moved(rows: DataFrame, books: Codebooks) -> np.ndarray:
    """Entries moved to the floor of their parts' mean; unused ones stay."""
    parts, count, length = books.entries.shape

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, count, length), np.int64)
        members = np.zeros((parts, count), np.int64)
        for batch in batches:
            ints, labels, _ = _assigned(batch, books)
            for p in range(parts):
                members[p] += np.bincount(labels[:, p], minlength=count)
                for k in range(length):
                    # Sums of a batch are exact in double precision.
                    added = np.bincount(labels[:, p], weights=ints[:, p, k], minlength=count)
                    totals[p, :, k] += added.astype(np.int64)
        part, entry = np.nonzero(members)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(part, pa.int32()),
                "entry": pa.array(entry, pa.int32()),
                "members": members[part, entry],
                "totals": pa.array(list(totals[part, entry]), pa.list_(pa.int64())),
            }
        )

    sums = rows.select(_INTS, _NEAR).mapInArrow(add_up, "part int, entry int, members long, totals array<long>")
    place = sums.select("part", "entry", "members", F.posexplode("totals").alias("position", "total"))
    added = place.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("members").alias("members"))
    mean = F.expr("(total - pmod(total, members)) div members")
    moved = books.entries.copy()
    for row in added.select("part", "entry", "position", mean.alias("mean")).collect():  # one a component of an entry
        moved[row["part"], row["entry"], row["position"]] = row["mean"]
    return moved


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """Prepared rows with ``code``, two hexadecimal digits a part, and ``error``."""
    kept = [f for f in rows.schema.fields if f.name not in (_INTS, _NEAR, "code", "error")]
    names = [f.name for f in kept]

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, labels, distances = _assigned(batch, books)
            codes = [bytes(row).hex() for row in labels.astype(np.uint8)]
            own = batch.select(names).append_column("code", pa.array(codes, pa.string()))
            yield own.append_column("error", pa.array(distances.sum(1)))

    schema = StructType([*kept, StructField("code", StringType()), StructField("error", LongType())])
    return rows.mapInArrow(assign, schema)


def decode(codes: DataFrame, books: Codebooks, code: str = "code", into: str = "decoded") -> DataFrame:
    """``codes`` with the vectors that they stand for."""
    table = F.from_json(F.lit(str(books.entries.tolist())), "array<array<array<int>>>")
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(len(books.entries) - 1)),
        lambda p: F.get(F.get(table, p), F.conv(F.substring(F.col(code), p * 2 + 1, F.lit(2)), 16, 10).cast("int")),
    )
    return codes.withColumn(into, F.transform(F.flatten(parts), lambda x: (x + F.lit(0.5)) / SCALE))


def compress(
    vectors: DataFrame,
    vector: str = "embedding",
    id_column: str = "vec_id",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, Codebooks | None]:
    """Codes and errors of all sound vectors, and the codebooks; None without vectors."""
    if not 0 < entries <= 256:
        raise ValueError("a code is two hexadecimal digits")
    clear = vectors.drop(*(c for c in ("code", "error", _INTS, _NEAR) if c in vectors.columns and c != vector))
    rows = _prepared(clear, vector, parts)
    first = _first_entries(rows, id_column, parts, entries)
    if not first.size:
        return rows.select(*(c for c in rows.columns if c != _INTS), F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), None
    books = Codebooks(first, choose_pivots(first, min(pivots, first.shape[1])))
    rows = stage(_with_pivot_distances(rows, books))
    for _ in range(rounds):
        books = Codebooks(_moved(rows, books), books.pivots)
    return encode(rows, books), books


def with_group_error(codes: DataFrame, by: str, into: str, salt: int = SALT) -> DataFrame:
    """``codes`` with the summed error of all rows of their group, nulls being one. Every
    group is spread over ``salt`` keys, for one of them may hold most rows."""
    codes = stage(codes)
    mark = codes.withColumn("pq_salt", F.pmod(F.xxhash64("code", F.monotonically_increasing_id()), F.lit(salt)))
    sums = codes.groupBy(F.col(by).alias("pq_by")).agg(F.sum("error").alias(into))
    sums = sums.withColumn("pq_of", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))).withColumn("pq_of", F.col("pq_of").cast("long"))
    joined = mark.join(sums, F.col(by).eqNullSafe(F.col("pq_by")) & (F.col("pq_salt") == F.col("pq_of")))
    return joined.drop("pq_salt", "pq_by", "pq_of")
