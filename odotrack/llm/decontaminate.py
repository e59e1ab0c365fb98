"""Benchmark decontamination by spaced seeds.

A seed is a window of tokens of which a fixed mask reads only some; tokens at the other
positions may differ. Test items and documents that agree on a seed are aligned there,
and the tokens around the hit are compared position by position: an overlap counts if
some ``MIN_TOKENS`` in a row (the whole item, if shorter) hold at least ``MIN_PERCENT``
equal tokens. The masks find all such overlaps.

A bit set of the item seeds, of bounded size, drops most document positions before the
join; it never drops a hit. The documents themselves are not shuffled.

Null text is empty and matches nothing; so does an item of fewer than
``MIN_ITEM_TOKENS`` tokens. Items of at most ``WHOLE_TOKENS`` need all of theirs in a row.
Null ids are reported as null. Repeated rows of one document or item are reported once.
Other columns are not read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odotrack.llm.common import BitSet, let, terms

#: 1 is read, 0 may differ. All read the first two tokens, so that one look at a pair rules
#: out most positions. The first family finds every overlap of a whole window of
#: ``MIN_TOKENS`` that counts: each of the 286 ways to change three of thirteen tokens leaves
#: one of these seeds whole. Shorter items have fewer tokens to spare. Substitutions cut their
#: equal tokens into runs, of which one has three tokens or more at any length but for
#: 2 + 2 + 2 of eight, which holds the last mask.
MASKS = ("110111", "111011", "1100001011")
SHORT_MASKS = ("111", "11011")
MIN_TOKENS = 13
MIN_PERCENT = 75
#: Shorter items say too little to tell a leak from a common phrase.
MIN_ITEM_TOKENS = 5
#: An item no longer than this is a leak only as a whole.
WHOLE_TOKENS = 5
#: Tokens looked at on either side of a hit.
CONTEXT = 64


def _offsets(mask: str) -> list[int]:
    return [i for i, read in enumerate(mask) if read == "1"]


def _seed(hashes: Column, at: Column, number: int, mask: str) -> Column:
    """Hash of what the mask reads at a position; null where it does not fit."""
    read = F.xxhash64(F.lit(number), *(F.get(hashes, at + o) for o in _offsets(mask)))
    return F.when(at + len(mask) <= F.size(hashes), read)


def _head(hashes: Column, at: Column) -> Column:
    return F.xxhash64(F.get(hashes, at), F.get(hashes, at + 1))


def _hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(t))


@dataclass(frozen=True)
class Mask:
    """A mask, and the lengths of the items whose seeds it makes."""

    reads: str
    least: int
    most: int


def _masks(masks: tuple[str, ...], short: tuple[str, ...], min_tokens: int) -> list[Mask]:
    """Masks by length of item. An item no longer than ``WHOLE_TOKENS`` is one seed."""
    every = 1 << 30
    return [
        *(Mask(m, min_tokens, every) for m in masks),
        *(Mask(m, WHOLE_TOKENS + 1, min_tokens - 1) for m in short),
        *(Mask("1" * n, n, n) for n in range(MIN_ITEM_TOKENS, WHOLE_TOKENS + 1)),
    ]


def _item_seeds(items: DataFrame, masks: list[Mask]) -> DataFrame:
    """A row per item, position and seed."""

    def placed(h: Column) -> Column:
        def at_position(at: Column) -> Column:
            return F.array(
                *(
                    F.struct(
                        at.alias("item_at"),
                        _head(h, at).alias("head"),
                        F.when(F.size(h).between(m.least, m.most), _seed(h, at, k, m.reads)).alias("seed"),
                    )
                    for k, m in enumerate(masks)
                )
            )

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(h) - 1), at_position))

    seeds = items.select("item_id", "item_key", F.inline(let(_hashes(F.col("item_tokens")), placed)))
    return seeds.filter(F.col("seed").isNotNull())


def _doc_hits(tokens: Column, heads: BitSet, seeds: BitSet, masks: list[Mask]) -> Column:
    """Positions of a document whose seed may be an item's, as array<struct<at, seed>>."""

    def found(h: Column) -> Column:
        possible = F.filter(
            F.sequence(F.lit(0), F.greatest(F.size(h) - 1, F.lit(0))), lambda at: heads.may_hold(_head(h, at))
        )
        all_seeds = F.transform(
            possible,
            lambda at: F.array(
                *(F.struct(at.alias("at"), _seed(h, at, k, m.reads).alias("seed")) for k, m in enumerate(masks))
            ),
        )
        return F.filter(
            F.flatten(all_seeds), lambda x: F.coalesce(seeds.may_hold(x["seed"]), F.lit(False))
        )

    return let(_hashes(tokens), found)


def _best_overlap(document: Column, item: Column, doc_at: Column, length: Column, min_percent: Column) -> Column:
    """The window of ``length`` tokens with most equal ones, as struct(equal,
    negative_start), or null. The two pieces are aligned at ``doc_at``."""

    def windows(equal: Column) -> Column:
        def window(i: Column) -> Column:
            n = F.aggregate(F.slice(equal, i, length), F.lit(0), lambda acc, x: acc + x)
            return F.struct(n.alias("equal"), (-(doc_at + i - 1)).alias("negative_start"))

        last = F.size(equal) - length + 1
        return F.when(
            last >= 1,
            F.array_max(
                F.filter(
                    F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), window),
                    lambda w: w["equal"] * 100 >= length * min_percent,
                )
            ),
        )

    return let(F.zip_with(document, item, lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int")), windows)


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    masks: tuple[str, ...] = MASKS,
    short_masks: tuple[str, ...] = SHORT_MASKS,
    min_tokens: int = MIN_TOKENS,
    min_percent: int = MIN_PERCENT,
    context: int = CONTEXT,
) -> DataFrame:
    """(doc_id, text_hash, item_id, equal_tokens, doc_start) of every document of
    (doc_id, text) that overlaps an item of (item_id, text); one row per pair, with its
    best window. ``text_hash`` tells rows of equal id apart."""
    items = items.select("item_id", terms(F.col("text")).alias("item_tokens"))
    items = items.filter(F.size("item_tokens") >= MIN_ITEM_TOKENS).distinct()
    items = items.withColumn("item_key", F.xxhash64("item_tokens"))
    all_masks = _masks(masks, short_masks, min_tokens)
    seeds = _item_seeds(items, all_masks)
    # Both are literals in the plan, so they are kept small: one position in a hundred that
    # holds no head passes the first, one in two hundred of those that do the second.
    n_seeds, n_heads = seeds.agg(F.count("*"), F.count_distinct("head")).first()
    heads, known = BitSet(seeds, "head", n_heads, 1, per_row=64), BitSet(seeds, "seed", n_seeds, 3, per_row=16)

    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), terms(F.col("text")).alias("tokens"))
    before = F.greatest(F.col("at") - context, F.lit(0))
    # A window that holds the last hit of a block ends so far behind it at most.
    reach = max(min_tokens, *(len(m.reads) for m in all_masks))
    found = (
        split.select("*", F.inline(_doc_hits(F.col("tokens"), heads, known, all_masks)))
        .select(
            "doc_id",
            "text_hash",
            "at",
            "seed",
            before.alias("doc_from"),
            F.slice("tokens", before + 1, F.lit(2 * context + reach)).alias("near"),
        )
        .join(seeds.drop("head"), "seed")
    )
    # Hits of one alignment say the same within a block: one of them is enough.
    keys = ["doc_id", "text_hash", "item_id", "item_key", "shift", "block"]
    hits = (
        found.withColumn("shift", F.col("at") - F.col("item_at"))
        .withColumn("block", F.floor(F.col("item_at") / context))
        .groupBy(*keys)
        .agg(F.min(F.struct("at", "doc_from", "near")).alias("hit"))
        .select(*keys, "hit.*")
        # Seeds go without their items' tokens, which are many times as large.
        .join(items.select("item_key", "item_tokens").distinct(), "item_key")
    )
    # The stretch both sides have around the hit, in item positions.
    start = F.greatest(F.lit(0), F.col("doc_from") - F.col("shift"))
    doc_at = start + F.col("shift")
    aligned = hits.select(
        "doc_id",
        "text_hash",
        "item_id",
        _best_overlap(
            F.slice("near", (doc_at - F.col("doc_from") + 1).cast("int"), F.size("near")),
            F.slice("item_tokens", (start + 1).cast("int"), F.size("item_tokens")),
            doc_at,
            F.least(F.lit(min_tokens), F.size("item_tokens")),
            F.when(F.size("item_tokens") <= WHOLE_TOKENS, F.lit(100)).otherwise(F.lit(min_percent)),
        ).alias("best"),
    )
    return (
        aligned.filter(F.col("best").isNotNull())
        .groupBy("doc_id", "text_hash", "item_id")
        .agg(F.max("best").alias("best"))
        .select(
            "doc_id",
            "text_hash",
            "item_id",
            F.col("best.equal").cast("long").alias("equal_tokens"),
            (-F.col("best.negative_start")).cast("long").alias("doc_start"),
        )
    )


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that overlap an item; columns as they are."""
    marked = overlaps(docs.select("doc_id", "text"), items, **options)
    bad = marked.select(F.col("doc_id").alias("__flagged_id"), F.col("text_hash").alias("__flagged_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__flagged_id")) & (F.xxhash64("text") == F.col("__flagged_hash"))
    return docs.join(bad, same, "left_anti")
