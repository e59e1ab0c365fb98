"""Cross-entropy difference: how much likelier a text is as target than as background.

Two bigram models of one form share a vocabulary, all words of all documents. The background
model counts every document, the target model every trusted one. Either mixes bigram, word
and uniform shares with the same weights. A document's score is its mean loss per word under
the target model less that under the background model: the lower, the more it is like the
target.

Counts are exact, by hash, and grow with the corpus: blocks of documents send their different
words and pairs of neighbours with the counts for both models, get back the sums over all
blocks (``blocks``) and add up the losses of their documents. Sums are of billionths of a nat,
so that they do not depend on their order.

Null text is empty; texts without words score 0. A null id is never trusted. Ids that
``target`` holds twice count once. Without any target document all scores are those of a
uniform target model. Repeated rows count as often as they occur and score alike. Other
columns are not read."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odotrack.llm.blocks import Block, add_up, counted, distinct, make_blocks, opened, with_marks, with_sums
from odotrack.llm.common import let, words
from odotrack.llm.hashed import combine
from odotrack.session import stage

#: Most words that ``frequent_words`` gives.
VOCABULARY = 1 << 16
#: Shares of bigrams, words and the uniform distribution.
WEIGHTS = (0.6, 0.39, 0.01)
#: What stands before the first word.
START = 0
#: Parts of a nat that are summed.
PARTS = 1_000_000_000


def frequent_words(docs: DataFrame, most: int = VOCABULARY) -> list[str]:
    """The most frequent words over all documents, at most ``most``: those at least as
    frequent as the bound allows, found by a histogram of counts instead of a sort."""
    each = docs.select(F.explode(words(F.col("text"))).alias("word"))
    counted = stage(
        each.groupBy("word").agg(F.count("*").alias("n")).withColumn("size", F.floor(F.log2("n") * 32).cast("int"))
    )
    taken, least = 0, None
    for size, n in sorted(counted.groupBy("size").count().collect(), reverse=True):  # 2048 rows at most
        taken += n
        if taken > most:
            break
        least = size
    if least is None:
        return []
    return sorted(w for (w,) in counted.filter(F.col("size") >= least).select("word").collect())


def _pairs(text: Column) -> Column:
    """array<struct<prev, word>> of hashes, one for each word."""
    hashes = F.transform(words(text), lambda w: F.xxhash64(w))

    def paired(h: Column) -> Column:
        return F.transform(
            h, lambda w, i: F.struct(F.coalesce(F.get(h, i - 1), F.lit(START).cast("long")).alias("prev"), w.alias("word"))
        )

    return let(hashes, paired)


def count_pairs(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(prev, word, everywhere, wanted): how often a word follows another in all documents
    of (doc_id, text) and in those whose ids ``target`` holds."""
    ids = target.select(F.col("doc_id").alias("_id")).filter("_id is not null").distinct()
    marked = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_id"), "left")
    each = marked.select(F.col("_id").isNotNull().cast("long").alias("hit"), F.inline(_pairs(F.col("text"))))
    return each.groupBy("prev", "word").agg(F.count("*").alias("everywhere"), F.sum("hit").alias("wanted"))


def _entries(block: Block, mine: object = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words and pairs with how often the block has them everywhere and wanted, and once
    more for words alone; all in one pass."""
    after = np.flatnonzero(block.place > 0)
    hashes = np.concatenate([combine(block.vocabulary), combine(block.words[after - 1], block.words[after])])
    keys, _, at = distinct(hashes)
    n = len(block.vocabulary)
    hit = block.mark >= 0
    places, hits = np.concatenate([at[:n][block.tokens], at[n:]]), np.concatenate([hit, hit[after]])
    alone = at[:n][block.tokens]
    return keys, [
        counted(places, keys),
        counted(places[hits], keys),
        counted(alone, keys),
        counted(alone[hit], keys),
    ]


def _losses(size: int, totals: dict[str, int]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From blocks to the sums of each document's losses, in ``PARTS``."""
    bigram, word, uniform = WEIGHTS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, row in opened(batches):
            after = np.flatnonzero(block.place > 0)
            hashes = np.concatenate([combine(block.vocabulary), combine(block.words[after - 1], block.words[after])])
            _, _, at = distinct(hashes)
            n, parts = len(block.vocabulary), []
            for sums, total in zip(block.sums(0, 2), totals.values()):
                sums = sums.astype(np.int64)
                each = sums[at[:n]][block.tokens]
                alone = each / max(1, total)
                # The first word, and a word after one that the model never saw, have no context.
                context, behind = each[after - 1], alone.copy()
                behind[after] = np.where(context > 0, sums[at[n:]] / np.maximum(context, 1), alone[after])
                loss = -np.log(bigram * behind + word * alone + uniform / (size + 1))
                parts.append(block.per_document(np.rint(loss * PARTS).astype(np.int64), np.add))
            ids = row["rows"].flatten().field("doc_id")
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(block.sizes), pa.array(parts[1]), pa.array(parts[0])],
                ["doc_id", "n_words", "target_parts", "background_parts"],
            )

    return run


def cross_entropy_difference(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, score) of every document of
    (doc_id, text); losses are nats per word, rounded to six digits."""
    blocks = make_blocks(docs.select(F.col("doc_id").cast("long"), "text", F.lit(0).alias("fold")))
    ids = target.select(F.col("doc_id").cast("long")).filter("doc_id is not null").distinct()
    marked = with_marks(blocks, ids.withColumn("mark", F.lit(0)), "doc_id")
    n_words = blocks.agg(F.sum("n")).first()[0] or 0
    sums, ((_, _, words_, wanted), _) = add_up(marked, n_words, _entries, 4, own=(0, 1), passes=1)
    totals = {"everywhere": words_["sum"], "wanted": wanted["sum"]}
    parts = with_sums(blocks, sums).mapInArrow(
        _losses(words_["all"], totals), "doc_id long, n_words long, target_parts long, background_parts long"
    )

    def mean(model: str) -> Column:
        return F.coalesce(F.round(F.col(f"{model}_parts") / F.nullif(F.col("n_words"), F.lit(0)) / PARTS, 6), F.lit(0.0))

    return parts.select(
        "doc_id", "n_words", mean("target").alias("target_loss"), mean("background").alias("background_loss")
    ).withColumn("score", F.round(F.col("target_loss") - F.col("background_loss"), 6))
