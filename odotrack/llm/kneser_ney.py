"""Quality by the perplexity under an interpolated modified Kneser-Ney trigram model.

**Model.** Counts of trigrams of trusted text, continuation counts below them, three
discounts an order, and a uniform distribution over ``VOCABULARY`` words at the bottom, so
that unknown words cost what they should. Counts, contexts and discounts are grouped and
joined by Spark. A second model of the same form is fitted on text
labelled as bad or toxic. Every labelled document is counted, so the models grow with the
corpus. ``fit`` gives them as tables, and they are never written for ``score``.

**Folds.** A hash of the text deals all documents, labelled or not, to ``FOLDS`` folds, and
each is scored by models fitted on the other folds. So no text is scored by a model that
has seen it, at any size of the input, and trusted scores are like those of other clean text.

**Scores.** Every document is scored whole. Blocks of documents (``blocks``) send their
different triples of words, dealt by hash, and get back how often the other fold's trusted text
holds them; then their pairs, then their words. Each different n-gram is dealt to one of the
blocks that hold it, which counts it for its context and for the order below. So a block learns
all that its documents' losses need, however large the models are. Losses are summed in
billionths of a nat, so that the order of the sum does not matter. Scores are
the mean loss per word under
the trusted model, and its ``contrast``, the most that any of its words speaks for rejected
text: the logarithm of the word's share in the bottom order of the rejected model over that
in the trusted one. That order counts the different words before a word, so a passage that
is copied many times counts once. The mean finds text that is no prose, the contrast a few
words in prose.

**Thresholds** are quantiles of either score of all trusted documents, by language, plus a
slack. Documents are rejected above the first by more than the scatter of a text of their
length, or above the second. Scores are rounded to thousandths, so exact quantiles need
bounded state.

Null text is empty: no words, score 0, kept. A null language is a language of its own; a
language without trusted documents rejects nothing. Documents with equal ids and texts
are scored alike; null ids are never trusted or rejected. ``labels`` may hold an id more than
once: one trusted row suffices, and an id that is trusted is not in the rejected text. Other
columns are not read by ``score``; ``keep_good`` passes them on."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odotrack.llm.blocks import LEAST, Block, add_up, counted, distinct, make_blocks, only_distinct, only_marked, opened, with_marks, with_sums
from odotrack.llm.common import words
from odotrack.llm.hashed import HashTable, combine
from odotrack.llm.sample import bounded_sample
from odotrack.session import drop_staged, stage

#: Parts of a nat that are summed.
PARTS = 1_000_000_000
#: Words that a language could have; unknown ones share the last of the mass.
VOCABULARY = 1_000_000
QUANTILE, SLACK = 0.99, 0.25
#: Two standard deviations of a word's loss: the mean of n words scatters by that / sqrt(n).
SPREAD = 8.0
#: Parts of the documents; a part is scored by models of the others.
FOLDS = 2
#: Parts in which the blocks of a fold meet what they asked for.
SHARES = 4
CONTRAST_QUANTILE, CONTRAST_SLACK = 0.99, 0.5

#: Tells which hashes a pass counts.
Mine = Callable[[np.ndarray], np.ndarray]


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled as good and not as toxic."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return labels.filter(good & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def rejected_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled as bad or toxic, and not as trusted elsewhere."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    ids = labels.filter(bad & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return ids.join(trusted_ids(labels), "doc_id", "left_anti")


def _discounts(counts: DataFrame, models: int) -> list[list[float]]:
    """[D1, D2, D3+] of each model from the numbers of its n-grams seen once to four times."""
    rows = counts.filter("c <= 4").groupBy("model", "c").count().collect()
    return [_discount({c: n for m, c, n in rows if m == model}) for model in range(models)]


def _discount(seen: dict[int, int]) -> list[float]:
    """[D1, D2, D3+] from the numbers of n-grams seen once to four times."""
    n1, n2, n3, n4 = (seen.get(k, 0) for k in (1, 2, 3, 4))
    if not n1:
        return [0.5, 0.75, 0.9]  # too little text to estimate them
    y = n1 / (n1 + 2 * n2)
    pairs = ((1, n1, n2), (2, n2, n3), (3, n3, n4))
    raw = [k - (k + 1) * y * b / a if a else k * 0.5 for k, a, b in pairs]
    return [min(max(d, 0.1), k - 0.05) for d, (k, _, _) in zip(raw, pairs)]


def _priced(counts: DataFrame, discounts: list[list[float]]) -> DataFrame:
    """``counts`` with the discount ``d`` of each n-gram."""
    own = F.element_at(F.array(*(F.array(*map(F.lit, d)) for d in discounts)), F.col("model") + 1)
    return counts.withColumn("d", F.element_at(own, F.least("c", F.lit(3)).cast("int")))


@dataclass
class Tables:
    """Models 0, 1, ... as tables: ``shares`` of words ``w``, of ``b, w`` and of ``a, b, w``
    and the masses ``left`` behind contexts ``b`` and ``a, b``, all as (model, words,
    value); and by model the share left for unknown words."""

    shares: list[DataFrame]
    left: list[DataFrame]
    unknown: list[float]


@dataclass
class KneserNey:
    """A small model on the driver: shares of n-grams and masses left behind contexts, by
    hash of the n-gram, and the share left for unknown words."""

    shares: list[HashTable]
    left: list[HashTable]
    unknown: float

    def alone(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's chance in the bottom order, whatever stands before it."""
        return self.unknown / VOCABULARY + self.shares[0].get(combine(hashes), 0.0)

    def losses(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Minus the natural logarithm of each word's chance, for documents laid end to
        end; the first words of each, at ``starts``, have shorter contexts."""
        p = self.alone(hashes)
        before = combine(hashes)
        place = np.arange(len(hashes))
        since = place - np.repeat(starts, np.diff([*starts, len(hashes)]))
        for order in (1, 2):
            # Context of ``order`` words before each word, and with the word itself.
            context = np.zeros_like(hashes)
            context[order:] = before[: len(hashes) - order] if order == 1 else combine(hashes[:-2], hashes[1:-1])
            whole = np.zeros_like(hashes)
            parts = [hashes[k : len(hashes) - order + k] for k in range(order + 1)]
            whole[order:] = combine(*parts)
            left = self.left[order - 1].get(context, 1.0)
            longer = self.shares[order].get(whole, 0.0) + left * p
            p = np.where(since >= order, longer, p)
        return -np.log(p)


def _tables(df: DataFrame, keys: list[str], models: int) -> list[HashTable]:
    """A small table as arrays on the driver, one for each model."""
    rows = df.select("model", *keys, "value").toArrow()
    columns = [rows[k].to_numpy().astype(np.int64).view(np.uint64) for k in keys]
    hashes, values = combine(*columns), rows["value"].to_numpy().astype(np.float32)
    model = rows["model"].to_numpy()
    return [HashTable(hashes[model == m], values[model == m]) for m in range(models)]


def count(samples: DataFrame, models: int) -> Tables:
    """Models 0, 1, ... of the texts in (model, text), all counted and joined together."""
    words_of = samples.select("model", words(F.col("text")).alias("w")).filter("size(w) > 0")
    hashed = words_of.select("model", F.transform("w", lambda w: F.xxhash64(w)).alias("h"))
    last = F.slice("h", 1, F.greatest(F.size("h") - 2, F.lit(0)))
    three = F.transform(last, lambda x, i: F.struct(x.alias("a"), F.get("h", i + 1).alias("b"), F.get("h", i + 2).alias("w")))

    def counted(df: DataFrame, *ngram: str) -> DataFrame:
        return stage(df.groupBy("model", *ngram).agg(F.count("*").alias("c")))

    trigrams = counted(hashed.select("model", F.inline(three)), "a", "b", "w")
    bigrams = counted(trigrams, "b", "w")
    unigrams = counted(bigrams, "w")
    shares, left = [], []
    for counts, context, ngram in ((bigrams, ["b"], ["b", "w"]), (trigrams, ["a", "b"], ["a", "b", "w"])):
        priced = _priced(counts, _discounts(counts, models))
        totals = priced.groupBy("model", *context).agg(F.sum("c").alias("total"), F.sum("d").alias("left"))
        joined = priced.join(totals.drop("left"), ["model", *context])
        shares.append(joined.select("model", *ngram, ((F.col("c") - F.col("d")) / F.col("total")).alias("value")))
        left.append(totals.select("model", *context, (F.col("left") / F.col("total")).alias("value")))

    # The bottom order has one total a model, taken to the driver rather than joined.
    discounts = _discounts(unigrams, models)
    sizes = (F.count(F.when(x, 1)) for x in (F.col("c") == 1, F.col("c") == 2, F.col("c") > 2))
    totals = {m: rest for m, *rest in unigrams.groupBy("model").agg(F.sum("c"), *sizes).collect()}
    of = F.element_at(F.array(*(F.lit(totals.get(m, [1])[0]) for m in range(models))), F.col("model") + 1)
    alone = _priced(unigrams, discounts)
    shares.insert(0, alone.select("model", "w", ((F.col("c") - F.col("d")) / of).alias("value")))

    def unknown(model: int) -> float:
        if model not in totals:
            return 1.0
        total, *seen = totals[model]
        return sum(d * n for d, n in zip(discounts[model], seen)) / total

    return Tables(shares, left, [unknown(m) for m in range(models)])


def train(samples: DataFrame, models: int) -> list[KneserNey]:
    """``count`` of little text, taken to the driver."""
    tables, names = count(samples, models), ("a", "b", "w")
    shares = [_tables(df, [n for n in names if n in df.columns], models) for df in tables.shares]
    left = [_tables(df, [n for n in names if n in df.columns], models) for df in tables.left]
    return [KneserNey([x[m] for x in shares], [x[m] for x in left], tables.unknown[m]) for m in range(models)]


def _fold() -> Column:
    return F.pmod(F.xxhash64("text", F.lit("fold")), F.lit(FOLDS)).cast("int")


def fit(docs: DataFrame, labels: DataFrame, train_bytes: int | None = None) -> Tables:
    """For each fold the models of the trusted (twice the fold) and of the rejected text (one
    more) of all others. A caller may settle for about ``train_bytes`` of each language."""
    kinds = enumerate((trusted_ids(labels), rejected_ids(labels)))
    if train_bytes is None:
        trusted, rejected = (ids.withColumn("kind", F.lit(kind)) for kind, ids in kinds)
        taken = docs.join(trusted.unionByName(rejected), "doc_id").select("text", "kind", _fold().alias("fold"))
    else:
        most = train_bytes * FOLDS // (FOLDS - 1)
        trusted, rejected = (
            bounded_sample(docs, ids, most, "lang").select("text", F.lit(kind).alias("kind"), _fold().alias("fold"))
            for kind, ids in kinds
        )
        taken = trusted.unionByName(rejected)
    scored = F.explode(F.array(*map(F.lit, range(FOLDS))))
    dealt = taken.withColumn("scored", scored).filter("scored <> fold")
    return count(dealt.select((F.col("scored") * 2 + F.col("kind")).alias("model"), "text"), 2 * FOLDS)


def _taken(docs: DataFrame, labels: DataFrame, train_bytes: int | None) -> tuple[DataFrame, list[str]]:
    """(keys, mark) of the documents that ``fit`` counts, 0 for trusted and 1 for rejected
    ones, and the names of the keys."""
    kinds, keys = (trusted_ids(labels), rejected_ids(labels)), ["doc_id"]
    if train_bytes is not None:
        most, keys = train_bytes * FOLDS // (FOLDS - 1), ["doc_id", "lang"]
        kinds = tuple(bounded_sample(docs, ids, most, "lang").select(*keys).distinct() for ids in kinds)
    trusted, rejected = (ids.withColumn("mark", F.lit(kind)) for kind, ids in enumerate(kinds))
    return trusted.unionByName(rejected), keys


class _Grams:
    """The different pairs, if asked for, and triples of a block, or those that are
    ``mine``, their hashes sorted. ``last2`` and ``last3`` tell a word that ends each, ``pair``
    the place of the one that ends with each word, -1 for none; ``triple`` that of each of ``three``."""

    def __init__(self, block: Block, pairs: Mine | None = None, triples: Mine | None = None):
        h, place = block.words, block.place
        if pairs:
            two = np.flatnonzero(place > 0)
            hashes = combine(h[two - 1], h[two])
            here = pairs(hashes)
            self.pairs, some, at = distinct(hashes[here])
            self.last2, self.pair = two[here][some], np.full(len(h), -1)
            self.pair[two[here]] = at
        self.three = np.flatnonzero(place > 1)
        if triples:
            hashes = combine(h[self.three - 2], h[self.three - 1], h[self.three])
            here = triples(hashes)
            self.triples, some, self.triple = distinct(hashes[here])
            self.three = self.three[here]
            self.last3 = self.three[some]


def _all(hashes: np.ndarray) -> np.ndarray:
    return np.ones(len(hashes), bool)


def _by_count(context: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
    """How many n-grams of each context are counted once, twice and more often."""
    return [_counted(context[x], keys) for x in (counts == 1, counts == 2, counts > 2)]


def _counted(at: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """``counted`` without those that are elsewhere."""
    return counted(at[at >= 0], keys)


def _asks(block: Block) -> bool:
    """Whether the block has only documents to score, none to count."""
    return not (block.marks >= 0).any()


def _asked(hashes: np.ndarray, mine: Mine, width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    keys = only_distinct(hashes[mine(hashes)])
    return keys, [np.zeros(len(keys), np.uint8)] * width


def _send_triples(block: Block, mine: Mine) -> tuple[np.ndarray, list[np.ndarray]]:
    if _asks(block):
        ends = np.flatnonzero(block.place > 1)
        return _asked(combine(block.words[ends - 2], block.words[ends - 1], block.words[ends]), mine, 1)
    grams = _Grams(block, triples=mine)
    return grams.triples, [counted(grams.triple[block.mark[grams.three] == 0], grams.triples)]


def _send_pairs(block: Block, mine: Mine) -> tuple[np.ndarray, list[np.ndarray]]:
    """Pairs as contexts: how often trusted text goes on, after how many triples counted once,
    twice and more often; as ends: of how many different triples, and how often in rejected text."""
    if _asks(block):
        ends = np.flatnonzero(block.place > 0)
        return _asked(combine(block.words[ends - 1], block.words[ends]), mine, 6)
    grams = _Grams(block, mine, _all)
    own, _, dealt = block.sums(0, 3)
    here = grams.last3[dealt == 1]  # each different triple is dealt to one block
    keys, marks = grams.pairs, block.mark[grams.three]
    return keys, [
        _counted(grams.pair[grams.three - 1][marks == 0], keys),
        *_by_count(grams.pair[here - 1], own[dealt == 1], keys),
        _counted(grams.pair[here], keys),
        _counted(grams.pair[grams.three][marks == 1], keys),
    ]


def _send_words(block: Block, mine: Mine) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words as contexts and as ends of different pairs, those of rejected text last."""
    if _asks(block):
        return _asked(block.vocabulary, mine, 6)
    keys = np.sort(block.vocabulary)
    grams = _Grams(block, _all)
    own, *_, dealt, rejected = block.sums(0, 8)
    token = np.searchsorted(keys, block.vocabulary)[block.tokens]
    here, c = grams.last2[dealt == 1], own[dealt == 1]
    values = [
        counted(token[here - 1], keys, c),
        *_by_count(token[here - 1], c, keys),
        counted(token[here], keys),
        counted(token[grams.last2[rejected == 1]], keys),
    ]
    some = mine(keys)
    return keys[some], [v[some] for v in values]


def _share(c: np.ndarray, total: np.ndarray, discount: list[float]) -> np.ndarray:
    """What is left of ``c`` of ``total`` behind the discount, 0 for what was not seen."""
    d = np.array([0.0, *discount])[np.minimum(c, 3)]
    return np.where(c > 0, (c - d) / np.maximum(total, 1), 0.0)


def _left(total: np.ndarray, seen: list[np.ndarray], discount: list[float]) -> np.ndarray:
    """The mass left behind a context, all if it was not seen."""
    left = sum(d * n for d, n in zip(discount, seen))
    return np.where(total > 0, left / np.maximum(total, 1), 1.0)


def _scores(model: dict) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From blocks to (columns of the documents, n_words, parts, most): the sum of the losses
    in ``PARTS`` and the largest contrast. ``model``: the discounts of the orders and of
    rejected words, their totals and the shares left for unknown words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, row in opened(batches):
            grams = _Grams(block, _all, _all)
            d1, d2, d3, d_rejected = model["discounts"]
            _, c3, _ = block.sums(0, 3)
            _, total3, *seen3, c2, _, _ = block.sums(1, 8)
            total2, *seen2, c1, c1_rejected = block.sums(2, 6)
            order = np.argsort(np.argsort(block.vocabulary))
            token = order[block.tokens]
            one, other = (
                (u / VOCABULARY + _share(c, np.full(len(c), total), d))[token]
                for c, d, u, total in zip((c1, c1_rejected), (d1, d_rejected), model["unknown"], model["totals"])
            )
            two, ends = one.copy(), np.flatnonzero(block.place > 0)
            left = _left(total2, seen2, d2)[token[ends - 1]]
            two[ends] = _share(c2[grams.pair[ends]], total2[token[ends - 1]], d2) + left * one[ends]
            three, ends = two.copy(), grams.three
            before = grams.pair[ends - 1]
            three[ends] = _share(c3[grams.triple], total3[before], d3) + _left(total3, seen3, d3)[before] * two[ends]
            parts = block.per_document(np.rint(-np.log(three) * PARTS).astype(np.int64), np.add)
            most = block.per_document(np.log(other / one), np.maximum)
            rows = row["rows"].flatten()
            columns = {f.name: rows.field(f.name) for f in rows.type}
            columns |= {"n_words": pa.array(block.sizes), "parts": pa.array(parts), "most": pa.array(most)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _score_fold(asking: DataFrame, counting: DataFrame, fold: int) -> DataFrame:
    """Written (columns of the documents, n_words, parts, most) of the documents of the
    fold's blocks ``asking``, by the text of the other fold's blocks ``counting``."""
    no_marks, columns = F.lit(None).cast(counting.schema["marks"].dataType), ["block", "fold", "sizes", "words", "marks"]
    asked = asking.withColumn("marks", no_marks).select(*columns)
    counted_ = counting.select(*columns)
    n_words = sum(df.agg(F.sum("n")).first()[0] or 0 for df in (asking, counting))

    def send(entries: Callable, width: int, before: DataFrame | None = None, **which) -> tuple[DataFrame, list]:
        """``add_up`` of both; blocks that count have what they got back from the round before."""
        if before is None:
            return add_up(asked.unionByName(counted_), n_words, entries, width, **which)
        with_own = stage(with_sums(counted_, before.filter("block < 0")))
        empty = F.lit(None).cast(with_own.schema["sums0"].dataType)
        out = add_up(asked.withColumn("sums0", empty).unionByName(with_own), n_words, entries, width, **which)
        drop_staged(with_own)
        return out

    triples, of3 = send(_send_triples, 1, others=(0,), own=(0,), first=(0,), passes=2)
    pairs, of2 = send(_send_pairs, 6, triples, others=range(5), own=(4,), first=(4, 5), passes=3)
    words_, of1 = send(_send_words, 6, pairs, others=range(6), passes=2)
    other = 1 - fold
    orders = of1[other][4], of2[other][4], of3[other][0], of1[other][5]
    discounts = [_discount({k: n[str(k)] for k in (1, 2, 3, 4)}) for n in orders]
    unknown, totals = [], []
    for n, d in ((orders[0], discounts[0]), (orders[3], discounts[3])):
        seen = n["1"], n["2"], n["all"] - n["1"] - n["2"]
        totals.append(n["sum"])
        unknown.append(sum(x * k for x, k in zip(d, seen)) / n["sum"] if n["sum"] else 1.0)
    model = {"discounts": discounts, "unknown": unknown, "totals": totals}

    # A share of the blocks at a time is shuffled to meet its sums.
    shares, found = SHARES if n_words >= 4 * SHARES * LEAST else 1, None
    for share in range(shares):
        mine = F.pmod(F.xxhash64("block"), F.lit(shares)) == share
        rounds = [sums.filter((F.col("block") > 0) & mine) for sums in (triples, pairs, words_)]
        scored = with_sums(asking.filter(mine), *rounds).mapInArrow(
            _scores(model), "doc_id long, text_hash long, lang string, n_words long, parts long, most double"
        )
        found = stage(scored) if found is None else found.unionByName(stage(scored))
    drop_staged(triples, pairs, words_)
    return found


def score(docs: DataFrame, labels: DataFrame, train_bytes: int | None = None) -> DataFrame:
    """(doc_id, text_hash, lang, n_words, log_perplexity, contrast) of (doc_id, text, lang),
    by the models that ``fit`` describes."""
    texts = docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("text_hash"),
        F.col("lang").cast("string"),
        "text",
        _fold().alias("fold"),
    )
    taken, keys = _taken(docs, labels, train_bytes)
    taken = stage(taken)

    def made(fold: int) -> DataFrame:
        return make_blocks(texts.filter(F.col("fold") == fold))

    def labelled(blocks: DataFrame) -> DataFrame:
        marked = with_marks(blocks, taken, *keys)
        return only_marked(marked.filter("marks is not null"))

    # One fold after the other, so that what a fold needs is gone when the next one begins.
    blocks = made(1)
    counts = labelled(blocks)
    drop_staged(blocks)
    blocks = made(0)
    first = _score_fold(blocks, counts, 0)
    drop_staged(counts)
    counts = labelled(blocks)
    drop_staged(blocks)
    blocks = made(1)
    found = first.unionByName(_score_fold(blocks, counts, 1))
    drop_staged(blocks, counts, taken)
    mean = F.col("parts") / F.nullif(F.col("n_words"), F.lit(0)) / PARTS
    return found.select(
        "doc_id",
        "text_hash",
        "lang",
        "n_words",
        F.coalesce(F.round(mean, 3), F.lit(0.0)).alias("log_perplexity"),
        F.round("most", 3).alias("contrast"),
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    train_bytes: int | None = None,
    quantile: float = QUANTILE,
    slack: float = SLACK,
) -> DataFrame:
    """``score`` of every document with its language's ``threshold`` and
    ``contrast_threshold``, and ``kept``."""
    docs, trusted = docs.select("doc_id", "text", "lang"), trusted_ids(labels)
    scored = stage(score(docs, labels, train_bytes))
    limits = (
        scored.filter("n_words > 0")
        .join(trusted, "doc_id", "left_semi")
        .groupBy(F.col("lang").alias("_lang"))
        .agg(
            (F.percentile("log_perplexity", F.lit(quantile)) + slack).alias("threshold"),
            (F.percentile("contrast", F.lit(CONTRAST_QUANTILE)) + CONTRAST_SLACK).alias("contrast_threshold"),
        )
    )
    return (
        scored.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left")
        .drop("_lang")
        .withColumn("kept", _keeps())
    )


def _keeps() -> Column:
    scatter = SPREAD / F.sqrt(F.greatest("n_words", F.lit(1)))
    near = F.col("log_perplexity") <= F.col("threshold") + scatter
    near &= F.col("contrast") <= F.col("contrast_threshold")
    return F.coalesce(near | (F.col("n_words") == 0), F.lit(True))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without those that ``judge`` rejects; columns as they are."""
    bad = judge(docs, labels, **options).filter("not kept")
    bad = bad.select(F.col("doc_id").alias("__flagged_id"), F.col("text_hash").alias("__flagged_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__flagged_id")) & (F.xxhash64("text") == F.col("__flagged_hash"))
    return docs.join(bad, same, "left_anti")
