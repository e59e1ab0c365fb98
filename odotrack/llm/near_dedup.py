"""Near duplicates by MinHash with tensored banding.

**Keys.** Two collections of ``SIDE`` short sketches, of ``ROWS`` minimum hashes each, are
computed per set. Every pair of one sketch from either collection is the key of a table:
SIDE ** 2 tables from 2 * SIDE sketches. A pair of sets that resemble each other by s
meets in some table with chance (1 - (1 - s ** ROWS) ** SIDE) ** 2, 0.9997 at 0.75. A
sketch that no other set shares can be in no common key, so only shared ones are paired.

**Candidates.** Equal sets are one class, found by a digest of the set, and its smallest
id stands for it. In each bucket, members are compared with the smallest one alone, and
links join classes into components. What is left are members of one bucket in different
components. They are dealt out by the sketches of the first collection, the members
outside a bucket's largest component against all of it, in blocks of bounded size. A
block compares bytes of ``BYTES`` minimum hashes and passes on the pairs whose agreement
a pair at the threshold would fall short of with a chance of 5e-5. Members of one
component need no comparison, so a group of copies costs about one comparison each.
All links are confirmed on the full sets. Components come from label propagation over
written tables; nothing but a count of changes reaches the driver.

**Cases.** Null or empty text has an empty set and links with nothing. Rows that share a
``doc_id`` are one document: they are in one component. A null ``doc_id`` links with
nothing, and its component is null. Repeated rows each get a row. Other columns are not
read by ``near_duplicates``; ``drop_near_duplicates`` passes them through."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odotrack.llm.common import BitSet
from odotrack.llm.shingles import mix, resemble, shingles
from odotrack.session import stage

PERCENT = 75
ROWS, SIDE = 3, 16
#: Minimum hashes of which a byte is kept, and members of a block.
BYTES, MEMBERS = 512, 1024
#: Shingles hashed at a time, for texts of any length.
BLOCK = 1 << 13


@lru_cache(maxsize=4)
def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20_240_601)
    draw = lambda: random.integers(0, 1 << 32, size=(count, 1), dtype=np.uint32)
    return draw(), draw() | np.uint32(1)


def minima(hashes: np.ndarray, count: int) -> np.ndarray:
    """The smallest value of a set, which is not empty, under each of ``count`` hashes."""
    flips, factors = _functions(count)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(count, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(short), BLOCK):
        block = short[None, i : i + BLOCK] ^ flips
        block *= factors
        block ^= block >> np.uint32(15)
        block *= np.uint32(0x2C1B3C6D)
        least = np.minimum(least, block.min(axis=1))
    return mix(least.astype(np.uint64))


def sketches(least: np.ndarray, rows: int, side: int) -> np.ndarray:
    """2 * side sketches."""
    parts = least[: 2 * side * rows].reshape(2 * side, rows)
    joined = np.zeros(2 * side, np.uint64)
    for k in range(rows):
        joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return joined


SKETCH_SCHEMA = "doc_id long, n_shingles long, digest1 long, digest2 long, sketches array<long>, bytes binary"


def _sketcher(rows: int, side: int):
    count = max(BYTES, 2 * side * rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second, all_sketches, kept = [], [], [], [], []
            for text in batch["text"]:
                found = shingles(text.as_py())
                sizes.append(len(found))
                # Sums of two different mixtures tell sets apart, whatever their order.
                first.append(int(found.sum(dtype=np.uint64).astype(np.int64)))
                second.append(int(mix(mix(found)).sum(dtype=np.uint64).astype(np.int64)))
                least = minima(found, count) if len(found) else found
                all_sketches.append(sketches(least, rows, side).view(np.int64) if len(found) else [])
                kept.append((least[:BYTES] & np.uint64(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.array(all_sketches, pa.list_(pa.int64())),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_shingles", "digest1", "digest2", "sketches", "bytes"],
            )

    return run


def least_agreement(percent: int) -> int:
    """Equal bytes that a pair at the threshold has, but for a chance of 5e-5."""
    p = percent / 100 + (1 - percent / 100) / 256
    return math.floor(BYTES * p - 3.9 * math.sqrt(BYTES * p * (1 - p)))


def _block_pairs(rows: dict[str, np.ndarray], wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) of one block: its queries against its members, each pair in the first
    bucket that holds both."""
    query = rows["query"]
    member = ~query
    a, b = [], []
    marks, firsts = rows["bytes"][member], rows["firsts"][member]
    labels, ids, own = rows["label"][member], rows["rep"][member], rows["outside"][member]
    for i in np.flatnonzero(query):
        near = (marks == rows["bytes"][i]).sum(axis=1) >= wanted
        near &= (labels != rows["label"][i]) & (~own | (ids < rows["rep"][i]))
        if near.any():
            near &= (firsts == rows["firsts"][i]).argmax(axis=1) == rows["slot"][i]
            b.append(ids[near])
            a.append(np.full(len(b[-1]), rows["rep"][i]))
    none = np.zeros(0, np.int64)
    return np.concatenate(a or [none]), np.concatenate(b or [none])


def _blocks(side: int, wanted: int):
    """Reads rows in order of their block and holds one block at a time."""

    def columns(table: pa.Table) -> dict[str, np.ndarray]:
        out = {n: table[n].to_numpy() for n in ("slot", "rep", "label", "query", "outside")}
        joined = lambda n: b"".join(table[n].to_pylist())
        out["bytes"] = np.frombuffer(joined("bytes"), np.uint8).reshape(-1, BYTES)
        out["firsts"] = np.frombuffer(joined("firsts"), np.uint32).reshape(-1, side)
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = columns(table)
            keys = np.stack([table[k].to_numpy() for k in ("slot", "sketch", "p", "q")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            pairs = [
                _block_pairs({n: v[i:j] for n, v in rows.items()}, wanted)
                for i, j in zip([0, *cuts], [*cuts, len(table)])
                if j - i > 1
            ]
            if pairs:
                a, b = (np.concatenate(x) for x in zip(*pairs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.maximum(a, b), pa.int64()), pa.array(np.minimum(a, b), pa.int64())], ["a", "b"]
                )

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            keys = np.stack([table[k].to_numpy() for k in ("slot", "sketch", "p", "q")])
            last = int((keys != keys[:, -1:]).any(axis=0)[::-1].argmax())
            at = len(table) - last if (keys != keys[:, -1:]).any() else 0
            if at:
                yield from found(table.slice(0, at))
            rest = table.slice(at)
        if rest is not None and len(rest):
            yield from found(rest)

    return run


def _confirmer(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(maxsize=512)(shingles)  # neighbouring pairs share texts
        for batch in batches:
            keep = [
                resemble(known(a.as_py()), known(b.as_py()), percent)
                for a, b in zip(batch["text_a"], batch["text_b"])
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike, written once."""
    both = pairs.join(
        texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a"
    ).join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    alike = both.select("a", "b", "text_a", "text_b").mapInArrow(_confirmer(percent), "a long, b long")
    return stage(alike)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest id that can be reached over edges (a, b).

    Every round takes the smallest label among the neighbours and then that label's own
    label, so chains halve. Labels are written each round."""
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    both = stage(both)
    while True:
        heard = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("heard"))
        )
        nearer = labels.join(heard, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "heard").alias("component")
        )
        roots = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        fresh = stage(
            nearer.join(roots, "component", "left").select(
                "node", "old", F.least("component", "root").alias("component")
            )
        )
        labels = fresh.select("node", "component")
        if fresh.filter("component <> old").isEmpty():
            return labels


def _labelled(df: DataFrame, labels: DataFrame, column: str, into: str) -> DataFrame:
    named = labels.select(F.col("node").alias(column), F.col("component").alias("_label"))
    return df.join(named, column, "left").withColumn(into, F.coalesce("_label", column)).drop("_label")


def _firsts(side: int) -> Column:
    """32 bits of each sketch of the first collection, for telling where two sets first
    meet, as little-endian bytes."""
    return F.unhex(
        F.array_join(
            F.transform(
                F.slice("sketches", 1, side), lambda x: F.lpad(F.hex(x.bitwiseAND(0xFFFFFFFF)), 8, "0")
            ),
            "",
        )
    )


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, rows: int = ROWS, side: int = SIDE
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sketched = stage(docs.mapInArrow(_sketcher(rows, side), SKETCH_SCHEMA))
    linked = sketched.filter("n_shingles > 0 and doc_id is not null")
    digest = ["digest1", "digest2", "n_shingles"]
    classes = stage(
        linked.groupBy(*digest).agg(
            F.min("doc_id").alias("rep"), F.any_value("sketches").alias("sketches"), F.any_value("bytes").alias("bytes")
        )
    )
    to_class = classes.select(*digest, "rep")

    # Sketches that several classes share, then their pairs: the keys.
    slots = classes.select("rep", F.posexplode("sketches").alias("slot", "sketch"))
    several = slots.groupBy("slot", "sketch").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stage(slots.join(several.drop("n"), ["slot", "sketch"]))
    first = F.col("slot") < side
    mine = F.struct("slot", "sketch")
    keys = stage(
        shared.groupBy("rep")
        .agg(F.collect_list(F.when(first, mine)).alias("x"), F.collect_list(F.when(~first, mine)).alias("y"))
        .select("rep", F.explode("x").alias("x"), "y")
        .select("rep", "x", F.explode("y").alias("y"))
        .select("rep", F.xxhash64("x.slot", "x.sketch", "y.slot", "y.sketch").alias("key"))
    )
    buckets = keys.groupBy("key").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).filter("last > b")
    to_first = stage(
        keys.join(buckets.select("key", "b"), "key")
        .select(F.col("rep").alias("a"), "b")
        .filter("a > b")
        .distinct()
    )
    nodes = stage(to_first.select(F.col("a").alias("doc_id")).union(to_first.select("b")).distinct())
    known = BitSet(nodes.select(F.xxhash64("doc_id").alias("hash")), "hash", nodes.count(), per_row=16, most=1 << 20)
    # The bit set spares most texts the shuffle; the join is what decides.
    texts = stage(docs.filter(known.may_hold(F.xxhash64("doc_id"))).join(nodes, "doc_id", "left_semi"))

    # Rows of one id are one document.
    twice = linked.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    same_id = (
        linked.join(twice, "doc_id")
        .join(to_class, digest)
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        .filter("a <> b")
        .distinct()
    )

    nearest = to_first.groupBy("a").agg(F.min("b").alias("b"))
    edges = _confirmed(nearest, texts, percent).union(stage(same_id))
    labels = components(edges)

    def apart(pairs: DataFrame) -> DataFrame:
        both = _labelled(_labelled(pairs, labels, "a", "label_a"), labels, "b", "label_b")
        return both.filter("label_a <> label_b").select("a", "b")

    rest = apart(to_first.join(nearest, ["a", "b"], "left_anti"))
    edges = edges.union(_confirmed(rest, texts, percent))
    labels = components(edges)

    # Buckets that still hold several components: all but the largest one against all.
    bucket = ["slot", "sketch"]
    members = _labelled(
        shared.filter(first).join(nodes.withColumnRenamed("doc_id", "rep"), "rep"), labels, "rep", "label"
    )
    mixed = (
        members.groupBy(*bucket, "label")
        .agg(F.count("*").alias("n"))
        .groupBy(*bucket)
        .agg(F.count("*").alias("labels"), F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("largest"))
        .filter("labels > 1")
        .select(
            *bucket,
            F.col("largest.label").alias("largest"),
            F.ceil(F.col("n") / MEMBERS).cast("int").alias("ps"),
            F.ceil((F.col("n") - F.col("largest.n")) / MEMBERS).cast("int").alias("qs"),
        )
    )
    payload = classes.select("rep", "bytes", _firsts(side).alias("firsts"))
    dealt = (
        members.join(mixed, bucket)
        .join(payload, "rep")
        .withColumn("outside", F.col("label") != F.col("largest"))
        .withColumn("own_p", F.pmod(F.xxhash64("rep"), F.col("ps")).cast("int"))
        .withColumn("own_q", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("qs")).cast("int"))
    )
    as_member = F.transform(
        F.sequence(F.lit(0), F.col("qs") - 1),
        lambda q: F.struct(F.lit(False).alias("query"), F.col("own_p").alias("p"), q.alias("q")),
    )
    as_query = F.transform(
        F.sequence(F.lit(0), F.col("ps") - 1),
        lambda p: F.struct(F.lit(True).alias("query"), p.alias("p"), F.col("own_q").alias("q")),
    )
    block = [*bucket, "p", "q"]
    blocks = (
        dealt.select(
            *bucket,
            "rep",
            "label",
            "outside",
            "bytes",
            "firsts",
            F.inline(F.when(F.col("outside"), F.concat(as_member, as_query)).otherwise(as_member)),
        )
        .repartition(*block)
        .sortWithinPartitions(*block)
    )
    crossing = (
        blocks.mapInArrow(_blocks(side, least_agreement(percent)), "a long, b long")
        .distinct()
        .join(to_first, ["a", "b"], "left_anti")
    )
    edges = edges.union(_confirmed(crossing, texts, percent))
    labels = components(edges)

    result = _labelled(
        sketched.join(to_class, digest, "left").withColumn(
            "rep", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id"))
        ),
        labels,
        "rep",
        "component_id",
    )
    return result.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component, the one of smallest id; columns as
    they are. Rows without an id stay. Of rows that share an id, each stays."""
    gone = near_duplicates(docs, **options).filter("not kept").select(F.col("doc_id").alias("__flagged_id")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__flagged_id"), "left_anti")
