"""Documents in blocks of words, and exact counts of n-grams over all blocks.

A block holds some 2^19 words of whole documents, as places in its own list of different
words. To count, it sends each of its different n-grams once, as a hash with its own
counts; the hash tells the part, and a part adds up what all blocks sent and returns the
sums in the order of what it got. So a block learns the counts of its n-grams without its
documents being moved, a frequent n-gram is one entry a block, and what is shuffled grows
with the text.

Entries are sorted, so that few bytes tell one hash from the next. They are counted in up
to ``PASSES`` ranges of hashes, one after the other, whose shuffles are not there at once.
An n-gram is its 64-bit hash."""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from odotrack.llm.common import or_empty
from odotrack.llm.hashed import SEED
from odotrack.session import stage

#: Words at which a block is full.
WORDS = 1 << 19
#: Documents that are split at a time.
DOCS = 100
#: Words of all documents for each part, but ``PARTS`` for smaller inputs; and words that a part is worth.
PART, PARTS, LEAST = 1 << 20, 64, 1 << 16
PASSES = 4

Values = Sequence[np.ndarray]


def pack(*columns: np.ndarray) -> bytes:
    """Whole numbers byte by byte, so that those alike stand together, and compressed."""
    head, body = [struct.pack("<I", len(columns))], []
    for column in columns:
        bytes_ = np.ascontiguousarray(column, np.uint64).view(np.uint8).reshape(-1, 8)
        width = (int(column.max()).bit_length() + 7) // 8 if len(column) else 0
        head.append(struct.pack("<IB", len(column), width))
        body.append(np.ascontiguousarray(bytes_[:, :width].T).tobytes())
    plain = b"".join(head + body)
    return struct.pack("<I", len(plain)) + pa.compress(plain, codec="zstd", asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    """The columns of ``pack``, in types as small as each allows."""
    plain = pa.decompress(data[4:], struct.unpack_from("<I", data)[0], codec="zstd", asbytes=True)
    columns, at = [], 4 + 5 * struct.unpack_from("<I", plain)[0]
    for k in range(4, at, 5):
        n, width = struct.unpack_from("<IB", plain, k)
        size = next(x for x in (1, 2, 4, 8) if x >= width)  # many columns hold small numbers
        bytes_ = np.zeros((n, size), np.uint8)
        bytes_[:, :width] = np.frombuffer(plain, np.uint8, n * width, at).reshape(width, n).T
        columns.append(bytes_.view(f"<u{size}").reshape(n))
        at += n * width
    return columns


def steps(hashes: np.ndarray) -> np.ndarray:
    """Differences, the first to 0; ``np.cumsum`` undoes it."""
    return np.diff(hashes, prepend=np.uint64(0))


@dataclass
class Block:
    """Words of documents laid end to end: the hash of each, its place in ``vocabulary`` and
    in its document; documents have a number of words and a mark."""

    id: int
    fold: int
    vocabulary: np.ndarray
    tokens: np.ndarray
    sizes: np.ndarray
    marks: np.ndarray
    returned: list[list[np.ndarray]]

    def sums(self, round_: int, n: int) -> list[np.ndarray]:
        """The ``n`` columns of a round, empty if the block had nothing to send."""
        return self.returned[round_] or [np.zeros(0, np.int64)] * n

    def __post_init__(self):
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.tokens)) - np.repeat(self.starts, self.sizes)
        self.words = self.vocabulary[self.tokens]
        self.mark = np.repeat(self.marks, self.sizes)

    def per_document(self, values: np.ndarray, reduce: np.ufunc) -> np.ndarray:
        """``values`` of the words reduced by document, 0 without words."""
        out = np.zeros(len(self.sizes), values.dtype)
        if len(values):
            out[self.sizes > 0] = reduce.reduceat(values, self.starts[self.sizes > 0])
        return out


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of ``texts`` end to end, as ``common.words`` gives them, and each text's number."""
    found = pc.ascii_split_whitespace(texts)
    each, ends = found.flatten(), np.cumsum(pc.list_value_length(found).to_numpy(zero_copy_only=False))
    some = pc.not_equal(each, pa.scalar("", each.type))  # before leading and behind trailing white space
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return each.filter(some), np.diff(before[ends], prepend=0)


def _coded(vocabulary: np.ndarray, tokens: np.ndarray) -> bytes:
    """A block's words, packed. Frequent ones come first: their places are small numbers."""
    order = np.lexsort((vocabulary, -np.frexp(counted(tokens, vocabulary))[1]))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return pack(steps(vocabulary[order]), rank[tokens])


def _values(words: pa.StringArray) -> list[bytes]:
    """The bytes of each word; ``to_pylist`` takes several times as long."""
    if not len(words):
        return []
    bounds = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4).tolist()
    data = words.buffers()[2].to_pybytes()
    return [data[a:b] for a, b in zip(bounds, bounds[1:])]


def make_blocks(docs: DataFrame) -> DataFrame:
    """Written (block, fold, rows, sizes, words, n) of (text, fold, other columns), the others
    in ``rows`` and ``n`` words. A block has documents of one fold."""
    others = [f for f in docs.schema if f.name not in ("text", "fold")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = TaskContext.get().partitionId() << 32, {}

        def block(fold: int) -> pa.RecordBatch:
            nonlocal made
            rows, texts, sizes = held.pop(fold)
            coded = pa.concat_arrays(texts).dictionary_encode()
            each = _values(coded.dictionary)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, each, repeat(SEED)), np.uint64, len(each))
            vocabulary, _, place = distinct(hashes)
            words = _coded(vocabulary, place[coded.indices.to_numpy()])
            table = pa.Table.from_batches(rows).combine_chunks()
            struct_ = pa.StructArray.from_arrays([c.combine_chunks() for c in table.columns], table.column_names)
            made += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([made], pa.int64()),
                    pa.array([fold], pa.int32()),
                    pa.ListArray.from_arrays(pa.array([0, len(struct_)], pa.int32()), struct_),
                    pa.array([pack(np.concatenate(sizes))], pa.binary()),
                    pa.array([words], pa.binary()),
                    pa.array([len(coded)], pa.int64()),
                ],
                ["block", "fold", "rows", "sizes", "words", "n"],
            )

        full: dict[int, int] = {}
        for batch in batches:
            folds, texts = batch["fold"].to_numpy(), batch["text"]
            rest = batch.select([f.name for f in others])
            for at in range(0, len(batch), DOCS):
                for fold in np.unique(folds[at : at + DOCS]).tolist():
                    here = np.flatnonzero(folds[at : at + DOCS] == fold) + at
                    found, n = split(texts.take(pa.array(here)))
                    for held_, new in zip(held.setdefault(fold, ([], [], [])), (rest.take(pa.array(here)), found, n)):
                        held_.append(new)
                    full[fold] = full.get(fold, 0) + len(found)
                    if full[fold] >= WORDS:
                        yield block(fold)
                        full[fold] = 0
        for fold in sorted(held):
            yield block(fold)

    rows = StructType(others).simpleString()
    docs = docs.select(or_empty(F.col("text")).alias("text"), F.col("fold").cast("int"), *(f.name for f in others))
    return stage(docs.mapInArrow(run, f"block long, fold int, rows array<{rows}>, sizes binary, words binary, n long"))


def with_marks(blocks: DataFrame, ids: DataFrame, *keys: str) -> DataFrame:
    """``blocks`` with ``marks``: (pos, mark) of the documents whose ``keys`` stand in
    ``ids`` (keys, mark). Only the keys are shuffled."""
    each = blocks.select("block", F.posexplode("rows").alias("pos", "row")).select("block", "pos", *(f"row.{k}" for k in keys))
    same = [each[k].eqNullSafe(ids[k]) for k in keys]
    marked = each.join(ids, same).groupBy("block").agg(F.collect_list(F.struct("pos", "mark")).alias("marks"))
    return blocks.join(stage(marked), "block", "left")


def only_marked(blocks: DataFrame) -> DataFrame:
    """Written blocks of the marked documents of ``blocks``, without ``rows``. Their ids are below
    0, those of ``make_blocks`` above."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = TaskContext.get().partitionId() << 32, []

        def joined() -> pa.RecordBatch:
            nonlocal made
            made += 1
            fold, words, sizes, marks = held[0][0], *(np.concatenate(x) for x in list(zip(*held))[1:])
            held.clear()
            vocabulary, _, tokens = distinct(words)
            marked = [{"pos": k, "mark": int(m)} for k, m in enumerate(marks)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([-made], pa.int64()),
                    pa.array([fold], pa.int32()),
                    pa.array([pack(sizes)], pa.binary()),
                    pa.array([_coded(vocabulary, tokens)], pa.binary()),
                    pa.array([len(tokens)], pa.int64()),
                    pa.array([marked], pa.list_(pa.struct([("pos", pa.int32()), ("mark", pa.int32())]))),
                ],
                ["block", "fold", "sizes", "words", "n", "marks"],
            )

        for block, _ in opened(batches):
            some = block.marks >= 0
            if held and (held[0][0] != block.fold or sum(len(w) for _, w, *_ in held) >= WORDS):
                yield joined()
            if some.any():
                held.append((block.fold, block.words[block.mark >= 0], block.sizes[some], block.marks[some]))
        if held:
            yield joined()

    marks = "array<struct<pos: int, mark: int>>"
    return stage(blocks.mapInArrow(run, f"block long, fold int, sizes binary, words binary, n long, marks {marks}"))


def with_sums(blocks: DataFrame, *rounds: DataFrame) -> DataFrame:
    """``blocks`` with what each round of ``add_up`` returned to them, as ``sums0``, ``sums1`` ..."""
    for k, sums in enumerate(rounds):
        parts = F.sort_array(F.collect_list(F.struct("part", "sums")))
        own = sums.groupBy("block").agg(F.transform(parts, lambda x: x["sums"]).alias(f"sums{k}"))
        blocks = blocks.join(own, "block", "left")
    return blocks


def opened(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Block, pa.RecordBatch]]:
    """Blocks of ``with_marks`` and ``with_sums``, and the row of each."""
    for batch in batches:
        for k in range(len(batch)):
            row = batch.slice(k, 1)
            at = {n: row[n][0] for n in row.schema.names}
            (sizes,), (vocabulary, tokens) = unpack(at["sizes"].as_py()), unpack(at["words"].as_py())
            marks = np.full(len(sizes), -1)
            for x in at["marks"].as_py() or () if "marks" in at else ():
                marks[x["pos"]] = x["mark"]
            returned = []
            while (name := f"sums{len(returned)}") in at:
                parts = [unpack(p) for p in at[name].as_py() or ()]
                returned.append([np.concatenate(c) for c in zip(*parts)])
            sizes, tokens = sizes.astype(np.int64), tokens.astype(np.int64)
            yield Block(at["block"].as_py(), at["fold"].as_py(), np.cumsum(vocabulary, dtype=np.uint64), tokens, sizes, marks, returned), row


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted different hashes, where one of each is and the place of each one given.
    ``np.unique`` would sort stably, several times slower."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(ordered), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], order[new], place


def only_distinct(hashes: np.ndarray) -> np.ndarray:
    """The first of ``distinct``, which is found in a third of the time."""
    ordered = np.sort(hashes)
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return ordered[new]


def counted(at: np.ndarray, keys: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """How often each key is pointed ``at``."""
    return np.bincount(at, weights, len(keys)).astype(np.int64)


def _places(hashes: list[np.ndarray], counting: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different hashes of the blocks that are ``counting``, and the place of each
    hash of every block among them, behind the last if it is not there."""
    keys, _, own = distinct(np.concatenate([np.zeros(0, np.uint64), *(h for h, c in zip(hashes, counting) if c)]))
    places, at = [], 0
    for each, counts in zip(hashes, counting):
        if counts:
            places.append(own[at : at + len(each)])
            at += len(each)
        else:
            place = np.searchsorted(keys, each)
            known = place < len(keys)
            known[known] = keys[place[known]] == each[known]
            places.append(np.where(known, place, len(keys)))
    return keys, np.concatenate(places)


def add_up(
    blocks: DataFrame,
    n_words: int,
    entries: Callable[[Block, Callable[[np.ndarray], np.ndarray]], tuple[np.ndarray, Values]],
    width: int,
    own: Sequence[int] = (),
    others: Sequence[int] = (),
    first: Sequence[int] = (),
    passes: int = PASSES,
) -> tuple[DataFrame, list[list[dict[str, int]]]]:
    """(block, part, sums) and the figures of each fold's ``width`` values.

    ``entries`` gives a block's sorted different hashes and their values, those of the pass:
    its second argument tells which hashes are. Returned are, for
    each hash, the sums of ``own`` values over blocks of the block's fold, of ``others``
    over those of the other one, and for ``first`` whether the block was dealt the hash
    among those of its fold where the value is not 0. Figures are the different hashes whose
    sum is 1, 2, 3 and 4, all, and the total."""
    parts = max(math.ceil(n_words / PART), min(PARTS, math.ceil(n_words / LEAST)), 1)
    passes = passes if parts >= 4 * passes else 1

    def of(hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)

    def sender(low: int, high: int):
        def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def mine(hashes: np.ndarray) -> np.ndarray:
                parts_ = of(hashes)
                return (parts_ >= low) & (parts_ < high)

            for block, _ in opened(batches):
                hashes, values = entries(block, mine)
                cuts = np.searchsorted(of(hashes), np.arange(low, high + 1))
                sent = [(low + k, slice(a, b)) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.id] * len(sent), pa.int64()),
                        pa.array([block.fold] * len(sent), pa.int32()),
                        pa.array([part for part, _ in sent], pa.int32()),
                        pa.array([pack(steps(hashes[s]), *(v[s] for v in values)) for _, s in sent], pa.binary()),
                    ],
                    ["block", "fold", "part", "entries"],
                )

        return send

    def add(table: pa.Table) -> pa.Table:
        folds, blocks_ = table["fold"].to_numpy(), table["block"].to_numpy()
        got = [unpack(x.as_py()) for x in table["entries"]]
        sizes = [len(x[0]) for x in got]
        keys, place = _places([np.cumsum(x[0], dtype=np.uint64) for x in got], [any(v.any() for v in x[1:]) for x in got])
        fold, figures, columns = np.repeat(folds, sizes).astype(np.int8), [[], []], {}
        for k in range(width):  # one after the other: all would be many times the entries
            values = np.concatenate([x[1 + k] for x in got])
            some = np.flatnonzero(values)
            at, of_, n = place[some], fold[some], values[some]
            sums = np.stack([np.bincount(at[of_ == f], n[of_ == f], len(keys) + 1).astype(np.int64) for f in (0, 1)])
            sums = sums.astype(np.min_scalar_type(sums.max()))
            for f in (0, 1):
                total = sums[f]
                figures[f] += [*((total == n).sum() for n in (1, 2, 3, 4)), (total > 0).sum(), total.sum()]
            if k in own:
                columns["own", k] = sums[fold, place]
            if k in others:
                columns["others", k] = sums[1 - fold, place]
            if k in first:
                dealt = columns["first", k] = np.zeros(len(place), np.uint8)
                dealt[some[np.unique(at * 2 + of_, return_index=True)[1]]] = 1
        columns = [columns[x] for x in [*(("own", k) for k in own), *(("others", k) for k in others), *(("first", k) for k in first)]]
        ends = np.cumsum(sizes)
        packed = [pack(*(c[b - n : b] for c in columns)) for b, n in zip(ends, sizes)]
        stats = [list(map(int, figures[0] + figures[1]))] + [None] * (len(sizes) - 1)
        part = table["part"].combine_chunks()
        return pa.table(
            [pa.array(blocks_), part, pa.array(packed, pa.binary()), pa.array(stats, pa.list_(pa.int64()))],
            ["block", "part", "sums", "figures"],
        )

    found = None
    for k in range(passes):
        sent = blocks.mapInArrow(sender(parts * k // passes, parts * (k + 1) // passes), "block long, fold int, part int, entries binary")
        added = stage(sent.groupBy("part").applyInArrow(add, "block long, part int, sums binary, figures array<long>"))
        found = added if found is None else found.unionByName(added)
    names = ("1", "2", "3", "4", "all", "sum")
    totals = iter(found.agg(*(F.coalesce(F.sum(F.get("figures", F.lit(i))), F.lit(0)) for i in range(2 * width * len(names)))).first())
    return found.drop("figures"), [[dict(zip(names, totals)) for _ in range(width)] for _ in range(2)]
