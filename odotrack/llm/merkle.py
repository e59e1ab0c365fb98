"""Merkle manifest of a dataset, its trees kept in van Emde Boas layout.

Rows are leaves. Leaves of one key, in order, are joined by threes (the last run may be
shorter) until one node remains: the key's subroot. Subroots, in order of the keys, are
joined likewise: the root. A node is the lower-case hexadecimal SHA-256 of its children's
digests as hexadecimal text.

**Layout.** A tree is cut into aligned blocks of ``3 ** HEIGHT`` leaves; block roots are
the leaves of the next round's blocks, and so on. A block is one row: a binary column
holds its digests in van Emde Boas order. A tree of so many levels is split at half
height; the upper part comes first, then each lower part as a whole, both laid out the
same way, so a walk from leaf to root touches few cache lines whatever their size.
``address`` gives a node's place by arithmetic alone; building a block and reading the
siblings on a leaf's path use it. A run without all children leaves places unused.

**On Spark.** Digests of leaves are written once, sorted by sampled ranges of (key, order,
leaf) and numbered by partition, so that a key with a third of all rows is spread over
tasks. A block is a group of at most ``3 ** HEIGHT`` rows by its definition. The number
of rounds is the logarithm of the longest key to that base: the driver learns that length
and nothing else. Proofs go down the same way: each block is grouped with its children and
hands them its path, so whole proofs are never shuffled.

Null keys come before all others, as a key of their own; null order columns come first.
Rows that tie in the order are put in the order of their digests, so repeated rows are
leaves of their own and the result does not depend on how the table is stored. A lone leaf
is its own subroot, with an empty proof. An empty table has no leaves and no root."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from odotrack.session import stage

ARITY, HEIGHT = 3, 5
BLOCK = ARITY**HEIGHT
_BLOCKS = "key string, block long, n_blocks long, height int, nodes binary, root binary"
_PATH = ("before", "after")


def size(levels: int) -> int:
    """Nodes of a whole tree of so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth, index):
    """The place of node ``index`` at ``depth`` (the root is at 0) among those of a tree of
    ``levels``. Takes arrays for ``index``."""
    if levels == 1:
        return index * 0
    upper = levels // 2
    lower = levels - upper
    if depth < upper:
        return address(upper, depth, index)
    width = ARITY ** (depth - upper)
    return size(upper) + index // width * size(lower) + address(lower, depth - upper, index % width)


@cache
def _places(height: int) -> list[np.ndarray]:
    """Addresses of a block's nodes, by depth."""
    return [address(height + 1, depth, np.arange(ARITY**depth)) for depth in range(height + 1)]


def joined(children: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def build_block(leaves: list[bytes], height: int) -> bytes:
    """Digests of a block in van Emde Boas order."""
    nodes = bytearray(32 * size(height + 1))
    level = leaves
    for depth in range(height, -1, -1):
        for place, digest in zip(_places(height)[depth].tolist(), level):
            nodes[32 * place : 32 * place + 32] = digest
        level = [joined(level[i : i + ARITY]) for i in range(0, len(level), ARITY)]
    return bytes(nodes)


def _alive(n: int, height: int) -> list[int]:
    """Nodes in use at each depth of a block with ``n`` leaves."""
    counts = [n]
    for _ in range(height):
        counts.append(-(-counts[-1] // ARITY))
    return counts[::-1]


def siblings(nodes: bytes, height: int, n: int, leaf: int) -> tuple[list[str], list[str]]:
    """From a block's leaf up to its root: hexadecimal digests left and right of the node
    on the path, among the children of its parent."""
    before, after = [], []
    alive = _alive(n, height)
    for depth in range(height, 0, -1):
        first = leaf // ARITY * ARITY
        text = [
            nodes[32 * p : 32 * p + 32].hex()
            for p in _places(height)[depth][first : min(first + ARITY, alive[depth])].tolist()
        ]
        before.append("".join(text[: leaf - first]))
        after.append("".join(text[leaf - first + 1 :]))
        leaf //= ARITY
    return before, after


def _build(group: pa.Table) -> pa.Table:
    """One block from its leaves: (key, block, position, n, digest)."""
    group = group.sort_by("position")
    n = group["n"][0].as_py()
    height = HEIGHT if n > BLOCK else next(h for h in range(HEIGHT + 1) if ARITY**h >= n)
    nodes = build_block(group["digest"].to_pylist(), height)
    return pa.table(
        {
            "key": [group["key"][0].as_py()],
            "block": [group["block"][0].as_py()],
            "n_blocks": [-(-n // BLOCK)],
            "height": pa.array([height], pa.int32()),
            "nodes": [nodes],
            "root": [nodes[:32]],
        }
    )


def _hand_down(children: pa.Table, blocks: pa.Table) -> pa.Table:
    """Children of one block with their paths to the top: their own, then the block's."""
    (block,) = blocks.to_pylist()
    n = children.num_rows
    up = [block["before"], block["after"]]
    flat, offsets = ([], []), [0]
    for position in children["position"].to_pylist():
        own = siblings(block["nodes"], block["height"], n, position % BLOCK)
        for side in (0, 1):
            flat[side].extend(own[side])
            flat[side].extend(up[side])
        offsets.append(len(flat[0]))
    for name, texts in zip(_PATH, flat):
        children = children.append_column(name, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(texts, pa.string())))
    for name in blocks.column_names:
        if name.startswith("top_"):
            children = children.append_column(name, pa.array([block[name]] * n, pa.binary()))
    return children


def field_digest(columns: list[Column]) -> Column:
    """The leaf of a row: each column as ``-`` if null, else its length in UTF-8 bytes, a
    colon and its value as text."""
    texts = [c.cast("string") for c in columns]
    fields = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*fields), 256)


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` with ``position`` in their key, from 0, and ``n``, the key's leaves."""
    by = ["key", *order, "digest", "row"]
    at = leaves.withColumn("row", F.monotonically_increasing_id())
    # The staged rows of one file are a sorted range, numbered on.
    at = stage(at.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()))
    at = at.drop("row").withColumn("file", F.shiftright("at", 33))
    upto = Window.partitionBy("key").orderBy("file")
    runs = at.groupBy("key", "file").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    runs = runs.select(
        "key",
        "file",
        (F.sum("rows").over(upto) - F.col("rows") - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy("key")).alias("n"),
    )
    return at.join(runs, ["key", "file"]).withColumn("position", F.col("at") + F.col("shift")).drop("at", "shift", "file")


@dataclass(frozen=True)
class Forest:
    """Trees of several keys: their leaves and, round by round, their blocks."""

    leaves: DataFrame
    rounds: list[DataFrame]

    def subroots(self) -> DataFrame:
        """(key, digest) of every tree."""
        tops = [b.filter("n_blocks = 1").select("key", F.col("root").alias("digest")) for b in self.rounds]
        roots = tops[0]
        for more in tops[1:]:
            roots = roots.unionByName(more)
        return roots

    def prove(self, tops: DataFrame) -> DataFrame:
        """Leaves with their paths: ``before`` and ``after`` by level, and what ``tops``
        says of their keys: (key, before, after, top_...), the way on from the subroot."""
        above = None
        for blocks in reversed(self.rounds):
            known = blocks.filter("n_blocks = 1").join(tops, "key")
            if above is not None:
                children = blocks.filter("n_blocks > 1").withColumn("position", F.col("block"))
                known = known.unionByName(_paths(children, above).drop("position"))
            above = known
        return _paths(self.leaves, above)


def _paths(children: DataFrame, blocks: DataFrame) -> DataFrame:
    parents = blocks.select("key", F.col("block").alias("parent"), "height", "nodes", *blocks.columns[6:])
    tops = [f for f in parents.schema.fields if f.name in _PATH or f.name.startswith("top_")]
    children = children.withColumn("parent", F.floor(F.col("position") / BLOCK).cast("long"))
    schema = StructType([*children.schema.fields, *tops])
    grouped = children.groupBy("key", "parent").cogroup(parents.groupBy("key", "parent"))
    return grouped.applyInArrow(_hand_down, schema).drop("parent")


def plant(leaves: DataFrame) -> Forest:
    """The trees of numbered leaves: (key, position, n, digest, any others)."""
    rounds, level = [], leaves.select("key", "position", "n", "digest")
    while True:
        block = F.floor(F.col("position") / BLOCK).cast("long")
        built = level.withColumn("block", block).groupBy("key", "block").applyInArrow(_build, _BLOCKS)
        blocks = stage(built)
        rounds.append(blocks)
        most = blocks.agg(F.max("n_blocks")).first()[0]
        if most is None or most <= 1:
            return Forest(leaves, rounds)
        level = blocks.filter("n_blocks > 1").select(
            "key", F.col("block").alias("position"), F.col("n_blocks").alias("n"), F.col("root").alias("digest")
        )


@dataclass(frozen=True)
class Manifest:
    """Trees of the keys, and the tree over them (its only key is empty)."""

    keyed: Forest
    over: Forest
    key: str
    order: list[str]

    def root(self) -> str | None:
        row = self.over.subroots().first()
        return row and row["digest"].hex()

    def prove(self) -> DataFrame:
        """Every row with ``leaf``, ``subroot`` and ``root`` (hexadecimal) and its proof:
        ``before`` and ``after``, for each level the digests left and right of the path."""
        none = F.array().cast("array<string>")
        root = self.over.subroots().select("key", none.alias("before"), none.alias("after"), F.col("digest").alias("top_root"))
        tops = self.over.prove(root).select(
            F.col("of").alias("key"), *_PATH, F.col("digest").alias("top_subroot"), "top_root"
        )
        proved = self.keyed.prove(tops)
        hexed = {new: F.lower(F.hex(old)) for new, old in (("leaf", "digest"), ("subroot", "top_subroot"), ("root", "top_root"))}
        order = [F.col(f"order_{i}").alias(c) for i, c in enumerate(self.order)]
        others = [F.col(c).alias(c[5:]) for c in proved.columns if c.startswith("with_")]
        key = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).alias(self.key)
        return proved.select(key, *order, *(c.alias(n) for n, c in hexed.items()), *_PATH, *others)


def build_manifest(rows: DataFrame, key: str, order: list[str], leaf: Column, **others: Column) -> Manifest:
    """The manifest of ``rows``, whose leaves are ``leaf`` (hexadecimal). ``key`` is cast to
    text; ``others`` are carried along to the proofs."""
    text = F.coalesce(F.concat(F.lit("s"), F.col(key).cast("string")), F.lit(""))  # keeps the order, null first
    ordered = [F.col(c).alias(f"order_{i}") for i, c in enumerate(order)]
    carried = [c.alias(f"with_{name}") for name, c in others.items()]
    leaves = rows.select(text.alias("key"), F.unhex(leaf).alias("digest"), *ordered, *carried)
    leaves = _numbered(stage(leaves), leaves.columns[2 : 2 + len(order)])
    keyed = plant(leaves)
    subroots = keyed.subroots().select(F.lit("").alias("key"), F.col("key").alias("of"), "digest")
    return Manifest(keyed, plant(_numbered(subroots, ["of"])), key, order)


def folded(start: Column) -> Column:
    """The root that ``start`` (hexadecimal) leads to by the proof in the same row."""
    return F.aggregate(
        F.arrays_zip(*_PATH), start, lambda at, step: F.sha2(F.concat(step["before"], at, step["after"]), 256)
    )


def proof_digest() -> Column:
    """Digest of all siblings of the proof in the same row, from leaf to root."""
    return F.sha2(F.array_join(F.zip_with(*_PATH, lambda a, b: F.concat(a, b)), ""), 256)
