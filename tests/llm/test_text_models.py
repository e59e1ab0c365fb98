"""Token counts, byte-level BPE and the two language models."""

import math
import pickle
import random
import time
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cases import FOLDER, TEXTS, documents, empty
from odotrack.llm import blocks, byte_bpe, cross_entropy, kneser_ney
from odotrack.llm.hashed import HashTable, combine, word_ids
from odotrack.llm.quality_rules import keep_by_rules
from odotrack.llm.sample import bounded_sample
from odotrack.llm.token_counts import TextCounter, count_tokens
from odotrack.session import shared_folder, stage

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LETTERS = [*"  \n\t'stre<|>éñß中日  12,.!?abcdehing\U0001f600́\\\"\x1c\x85\x00", "<|endoftext|>", "'re", " the", "  "]


def some_texts(n, seed=3):
    random.seed(seed)
    return ["".join(random.choices(LETTERS, k=random.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def counter():
    return TextCounter(open(JSON, "rb").read())


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


# Token counts


def test_counts_equal_the_library(counter):
    library = Tokenizer.from_file(JSON)
    for text in some_texts(4000) + ["a" * 5000, " " * 300, "ab" * 2000]:
        wanted = len(library.encode(text, add_special_tokens=False).ids)
        for chunk in (1 << 16, 1, 7):
            if chunk > 1 or len(text) < 100:
                assert counter.count(text, chunk) == wanted, (text, chunk)


def test_scan_gives_the_count_up_to_each_cut(counter):
    text = "It was  late, and\nthe rain didn't stop. " * 20
    maps = [counter.chunk_map(text[i : i + 33]) for i in range(0, len(text), 33)]
    for i, mapped in enumerate(counter.scan(maps)):
        assert counter.total(mapped) == counter.count(text[: (i + 1) * 33])


def test_tables_are_thrown_away_when_full(counter, monkeypatch):
    monkeypatch.setattr("odotrack.llm.token_counts.MAX_TRANSITIONS", 50)
    fresh = TextCounter(open(JSON, "rb").read())
    for text in some_texts(200, 5):
        assert fresh.count(text) == counter.count(text)


def test_counts_on_odd_tables(spark):
    library = Tokenizer.from_file(JSON)
    docs = documents(spark).withColumn("n_tokens", F.lit("clash"))
    for row in count_tokens(docs, JSON, chunk=1000).collect():
        assert row.n_tokens == len(library.encode(row.text or "", add_special_tokens=False).ids)
    assert count_tokens(empty(docs), JSON).count() == 0


# Byte-level BPE


def test_merges_equal_the_library(encoding):
    coder = byte_bpe.TextCoder(RANKS, public_tokenizers.PATTERN, {})
    for text in some_texts(4000, 4) + ["a" * 3000, "x-" * 500, "thekjhas" * 400]:
        assert np.frombuffer(coder.encode(text), np.int32).tolist() == encoding.encode_ordinary(text)


def test_both_ways_encode_and_decode(spark, encoding):
    texts = spark.createDataFrame(enumerate(some_texts(300, 6)), "doc_id long, text string")
    docs = documents(spark).select("doc_id", "text", "ids").union(texts.withColumn("ids", F.lit("clash")))
    docs = docs.withColumn("decoded", F.lit("clash"))
    for row in byte_bpe.encode_and_decode(docs, RANKS, public_tokenizers.PATTERN, 40).collect():
        assert row.ids == encoding.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()
    bpe = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    folded = docs.filter("length(text) < 1000").withColumn("ids", bpe.encode(F.col("text")))
    for row in folded.withColumn("decoded", bpe.decode(F.col("ids"))).collect():
        assert row.ids == encoding.encode_ordinary(row.text) and bytes(row.decoded) == row.text.encode()
    assert byte_bpe.encode_and_decode(empty(docs), RANKS, public_tokenizers.PATTERN).count() == 0


def test_unknown_ids_decode_to_null(spark):
    bpe = byte_bpe.ByteBpe({b"a": 0, b"b": 2}, public_tokenizers.PATTERN)
    ids = spark.createDataFrame([([0, 2],), ([1],), ([3],), ([-1],), ([],), (None,)], "ids array<int>")
    got = [r[0] and bytes(r[0]) for r in ids.select(bpe.decode(F.col("ids"))).collect()]
    assert got == [b"ab", None, None, None, b"", None]


# Kneser-Ney


def brute_losses(train, text):
    """The model by its definition, with dictionaries."""
    runs = [t.split() for t in train]
    tri = Counter(tuple(w[i : i + 3]) for w in runs for i in range(len(w) - 2))
    bi = Counter(t[1:] for t in tri)
    uni = Counter(t[1:] for t in bi)
    orders = []
    for counts in (uni, bi, tri):
        n = Counter(counts.values())
        if n[1]:
            y = n[1] / (n[1] + 2 * n[2])
            raw = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k * 0.5 for k in (1, 2, 3)]
            d = [min(max(x, 0.1), k - 0.05) for k, x in zip((1, 2, 3), raw)]
        else:
            d = [0.5, 0.75, 0.9]
        total, left = Counter(), Counter()
        for gram, c in counts.items():
            total[gram[:-1]] += c
            left[gram[:-1]] += d[min(c, 3) - 1]
        orders.append((counts, d, total, left))

    def chance(gram):
        counts, d, total, left = orders[len(gram) - 1]
        below = chance(gram[1:]) if len(gram) > 1 else 1 / kneser_ney.VOCABULARY
        if not total[gram[:-1]]:
            return below
        c = counts[gram]
        share = (c - d[min(c, 3) - 1]) / total[gram[:-1]] if c else 0.0
        return share + left[gram[:-1]] / total[gram[:-1]] * below

    words = text.split()
    return [-math.log(chance(tuple(words[max(0, i - 2) : i + 1]))) for i in range(len(words))]


def test_kneser_ney_equals_its_definition(spark):
    random.seed(1)
    train = [" ".join(random.choices("abcdefgh", [8, 7, 6, 5, 4, 3, 2, 1], k=40)) for _ in range(30)]
    docs = spark.createDataFrame(enumerate(train), "doc_id long, text string")
    (model,) = kneser_ney.train(docs.withColumn("model", F.lit(0)), 1)
    tests = ["a b c d e", "a", "z z z", "a b z c d h h h a", train[0]]
    hashes = [word_ids(t) for t in tests]
    sizes = np.array(list(map(len, hashes)))
    got = model.losses(np.concatenate(hashes), np.cumsum(sizes) - sizes)
    assert np.allclose(got, np.concatenate([brute_losses(train, t) for t in tests]), rtol=1e-4)


def test_classifier_tells_noise_from_text(spark):
    random.seed(2)
    words = [f"w{i}" for i in range(60)]
    text = lambda: " ".join(random.choices(words, [1 / (i + 1) for i in range(60)], k=80))
    noise = lambda: " ".join(f"q{random.random()}" for _ in range(80))
    rows = [(i, text() if i % 5 else noise(), "en" if i % 2 else None) for i in range(400)]
    rows += [(1000, None, "en"), (1001, "", "xx"), (None, text(), "en"), (1002, noise(), "no labels"), (1, rows[1][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("threshold", F.lit("clash"))
    labels = spark.createDataFrame(
        [(i, 1, None) for i in range(300) if i % 5] + [(1, 1, 0), (2, 1, 1), (None, 1, 0), (5, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    judged = kneser_ney.judge(docs, labels, train_bytes=4000).collect()
    assert len(judged) == len(rows)
    for row in judged:
        held_out_noise = row.doc_id is not None and row.doc_id < 1000 and row.doc_id % 5 == 0
        assert row.kept != held_out_noise, row
    kept = kneser_ney.keep_good(docs, labels, train_bytes=4000)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 80
    assert kneser_ney.judge(empty(docs), labels).count() == 0
    assert kneser_ney.keep_good(docs, empty(labels)).count() == len(rows)


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_unseen_clean_documents_are_kept_at_every_scale(spark, scale):
    folder = FOLDER.replace("sf0.001", scale)
    if not Path(folder).exists():
        pytest.skip("no test tables here")
    docs = keep_by_rules(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = kneser_ney.judge(docs, labels)
    unlabelled = judged.join(labels, "doc_id", "left_anti").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    trusted = judged.join(kneser_ney.trusted_ids(labels), "doc_id").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert unlabelled > 0.9 and trusted > 0.98


def test_words_of_rejected_text_are_found_in_prose(spark):
    random.seed(4)
    words = [f"w{i}" for i in range(300)]
    prose = lambda: random.choices(words, [1 / (i + 1) for i in range(300)], k=100)

    def insulting():
        text = prose()
        for at in random.sample(range(100), 3):
            text[at] = random.choice(["fool", "knave", "rogue"])
        return text

    rows = [(i, " ".join(insulting() if i % 8 == 0 else prose()), "en" if i % 2 else "de") for i in range(800)]
    rows += [(1000, " ".join(prose() + ["knave"] + prose()), "fr"), (1001, " ".join(prose() + ["knave"] + prose()), "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in kneser_ney.judge(docs, labels).collect()}
    assert not any(kept[i] for i in range(0, 800, 8)) and not kept[1001]
    assert kept[1000]  # no trusted text of its language
    assert sum(kept[i] for i in range(800) if i % 8) >= 695
    toxic = [(i, 1, 1) for i in range(0, 600, 8)]
    alone = kneser_ney.judge(docs, spark.createDataFrame(toxic, labels.schema)).filter("not kept")
    assert alone.count() == 0


@pytest.mark.skipif(not Path(FOLDER.replace("sf0.001", "sf0.01")).exists(), reason="no test tables here")
def test_toxic_documents_are_found(spark):
    folder = FOLDER.replace("sf0.001", "sf0.01")
    docs = keep_by_rules(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = kneser_ney.judge(docs, labels).join(labels, "doc_id")
    share = F.avg((~F.col("kept")).cast("int"))
    assert judged.filter("quality = 1 and toxic = 1").agg(share).first()[0] > 0.6
    assert judged.filter("quality = 1 and toxic = 0").agg(share).first()[0] <= 0.01


def test_no_text_is_scored_by_a_model_that_has_seen_it(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(20)), "en") for i in range(60)]
    docs = spark.createDataFrame(rows + [(100 + i, t, g) for i, t, g in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    for row in kneser_ney.judge(docs, labels).collect():
        assert row.log_perplexity > 12, row


def test_models_count_all_labelled_text(spark):
    """A language has more than 1.2 MB of trusted text; the words of every document count."""
    random.seed(5)
    common = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*random.choices(common, k=400), f"rare{i // 2}"] * 2), "en") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1200)], "doc_id long, quality int, toxic int")
    assert sum(len(t) for _, t, _ in rows) > 3_000_000
    models = kneser_ney.fit(docs, labels)
    known = {w: word_ids(w)[0].astype(np.int64) for w in {f"rare{i // 2}" for i in range(1200)}}
    found = {r.w for r in models.shares[0].filter("model % 2 = 0").select("w").distinct().collect()}
    assert sum(int(h) in found for h in known.values()) == 600


def test_joined_scores_equal_the_definition(spark):
    """Every document by the texts of the other fold, short and empty ones too."""
    random.seed(6)
    draw = lambda n: " ".join(random.choices("abcdefgh", [8, 7, 6, 5, 4, 3, 2, 1], k=n))
    rows = [(i, draw(random.choice([1, 2, 3, 40])), "en" if i % 3 else None) for i in range(90)]
    rows += [(100, None, "en"), (101, " \n", "en"), (None, "a b q", "de"), (5, rows[5][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    folds = {r.text: r.fold for r in docs.select("text", kneser_ney._fold().alias("fold")).collect()}
    train = {f: [t for i, t, _ in rows if i is not None and i < 60 and i % 4 and folds[t] != f] for f in (0, 1)}
    texts = {(i, t, g) for i, t, g in rows}
    judged = kneser_ney.judge(docs, labels).collect()
    assert len(judged) == len(rows)
    by_id = {i: (t, folds[t]) for i, t, g in texts}
    for row in judged:
        text, fold = by_id[row.doc_id]
        wanted = brute_losses(train[fold], text or "")
        assert row.n_words == len(wanted)
        assert abs(row.log_perplexity - (sum(wanted) / len(wanted) if wanted else 0)) < 2e-3, row


def test_a_fold_is_gone_before_the_next_one(spark, monkeypatch):
    """Blocks of all documents, and all that these had got back, were kept to the end."""
    random.seed(14)
    rows = [(i, " ".join(f"w{int(20_000 * random.random() ** 3)}" for _ in range(300)), "en") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 8 > 0), 0) for i in range(600)], "doc_id long, quality int, toxic int")
    folder = Path(shared_folder(spark).removeprefix("file:"))
    staged = lambda: sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    before = staged()
    blocks.make_blocks(docs.select("doc_id", "text", kneser_ney._fold().alias("fold")))
    whole, most = staged() - before, 0
    before = staged()

    def watched(df):
        nonlocal most
        out = stage(df)
        most = max(most, staged() - before)
        return out

    monkeypatch.setattr(blocks, "stage", watched)
    monkeypatch.setattr(kneser_ney, "stage", watched)
    judged = kneser_ney.judge(docs, labels)
    assert judged.count() == 1500
    assert staged() - before < 0.2 * whole
    assert most < 1.5 * whole


def test_scores_do_not_depend_on_blocks_and_passes(spark, monkeypatch):
    random.seed(15)
    draw = lambda n: " ".join(random.choices("abcdefghijkl", range(1, 13), k=n))
    rows = [(i, draw(random.choice([0, 1, 2, 40, 150])), "en" if i % 3 else None) for i in range(150)]
    docs = spark.createDataFrame([*rows, rows[7], (None, "a b z", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(90)], "doc_id long, quality int, toxic int")
    scores = lambda: sorted(map(repr, kneser_ney.judge(docs, labels).collect()))
    wanted = scores()
    monkeypatch.setattr(blocks, "WORDS", 200)
    monkeypatch.setattr(blocks, "DOCS", 5)
    for module in (blocks, kneser_ney):
        monkeypatch.setattr(module, "LEAST", 100)
    assert scores() == wanted


def test_a_part_sorts_only_what_is_counted():
    """Hashes of blocks that only ask were sorted with the others."""
    counted = [np.array([3, 5, 9], np.uint64), np.array([5, 7], np.uint64)]
    asked = [np.array([1, 5, 8], np.uint64), np.array([9, 11], np.uint64)]
    keys, place = blocks._places([counted[0], asked[0], counted[1], asked[1]], [True, False, True, False])
    assert keys.tolist() == [3, 5, 7, 9]
    assert place.tolist() == [0, 1, 3, 4, 1, 4, 1, 2, 3, 4]
    keys, place = blocks._places(asked, [False, False])
    assert len(keys) == 0 and not place.any()


def test_hash_table_finds_all_and_nothing_else():
    keys = combine(np.arange(5000, dtype=np.uint64))
    table = HashTable(keys, np.arange(5000, dtype=np.float32))
    again = pickle.loads(pickle.dumps(table))
    for t in (table, again):
        assert (t.get(keys, -1) == np.arange(5000)).all()
        assert (t.get(combine(np.arange(5000, 9000, dtype=np.uint64)), -1) == -1).all()
    assert HashTable(keys[:0], np.zeros(0)).get(keys[:3], 7).tolist() == [7, 7, 7]


def test_sample_is_bounded_by_group(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("x" * 50).alias("text"), (F.col("id") % 2).alias("g"))
    ids = docs.select("doc_id").filter("doc_id < 1500")
    sizes = {r.g: r["count"] for r in bounded_sample(docs, ids, 10_000, "g").groupBy("g").count().collect()}
    assert all(120 < n < 280 for n in sizes.values()) and len(sizes) == 2
    assert bounded_sample(docs, ids, 1 << 30).count() == 1500


# Cross-entropy difference


def brute_scores(rows, target, vocabulary):
    counts = Counter(w for _, t in rows for w in (t or "").split())
    known = {w: i for i, w in enumerate(sorted(counts), 1)}
    assert len(known) <= vocabulary

    def model(texts):
        one, two = Counter(), Counter()
        for t in texts:
            ids = [known[w] for w in (t or "").split()]
            one.update(ids)
            two.update(zip(ids, ids[1:]))
        return one, two, max(1, sum(one.values()))

    def loss(m, ids):
        (one, two, total), (a, b, c) = m, cross_entropy.WEIGHTS
        out = []
        for i, w in enumerate(ids):
            p = b * one[w] / total + c / (len(known) + 1)
            h = ids[i - 1]
            p += a * (two[h, w] / one[h] if i and one[h] else one[w] / total)
            out.append(-math.log(p))
        return sum(out) / len(out) if out else 0.0

    all_texts, wanted = model(t for _, t in rows), model(t for i, t in rows if i in target)
    ids = [[known[w] for w in (t or "").split()] for _, t in rows]
    return [loss(wanted, x) - loss(all_texts, x) for x in ids]


def test_scores_equal_their_definition(spark):
    random.seed(9)
    rows = [(i, " ".join(random.choices("abcdefg" if i % 2 else "efghijk", k=30))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "a b"), (1, rows[1][1]), (102, "wort " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    target = spark.createDataFrame([(i,) for i in range(1, 60, 2)] + [(1,), (None,)], "doc_id long")
    got = cross_entropy.cross_entropy_difference(docs, target).collect()
    wanted = brute_scores(rows, set(range(1, 60, 2)), 1000)
    assert np.allclose(
        sorted(r.score for r in got), sorted(wanted), atol=2e-6
    )
    low = {r.doc_id: r.score for r in got}
    assert max(low[i] for i in range(1, 60, 2)) < min(low[i] for i in range(0, 60, 2))
    assert cross_entropy.cross_entropy_difference(empty(docs), target).count() == 0
    assert cross_entropy.cross_entropy_difference(docs, empty(target)).count() == len(rows)


def test_scores_are_exact_for_many_words_and_pairs(spark):
    random.seed(11)
    rows = [(i, " ".join(f"w{int(90_000 * random.random() ** 3)}" for _ in range(400))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = docs.select("doc_id").filter("doc_id % 3 = 0")
    pairs = cross_entropy.count_pairs(docs, target)
    wanted = Counter(p for _, t in rows for w in [t.split()] for p in zip(w, w[1:]))
    assert len(wanted) > 1 << 18 and len({w for p in wanted for w in p}) > 1 << 16
    assert pairs.filter(f"prev != {cross_entropy.START}").count() == len(wanted)
    scored = cross_entropy.cross_entropy_difference(docs, target)
    got = {r.doc_id: r.score for r in scored.collect()}
    true = brute_scores(rows, set(range(0, 1500, 3)), 1 << 20)
    assert np.allclose([got[i] for i, _ in rows], true, atol=2e-6)


def written(spark):
    """Bytes of all tables that ``stage`` has written."""
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    return sum(f.stat().st_size for f in folder.glob("odotrack-stage-*/*.parquet"))


def test_scores_take_less_disk_than_the_text(spark):
    """A table of all pairs took several times the text."""
    random.seed(12)
    rows = [(i, " ".join(f"w{int(60_000 * random.random() ** 3)}" for _ in range(800))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = written(spark)
    scored = cross_entropy.cross_entropy_difference(docs, docs.select("doc_id").filter("doc_id % 3 = 0"))
    assert scored.count() == 1500
    assert written(spark) - before < sum(len(t) for _, t in rows)


def test_shuffles_of_a_stage_go_with_it(spark):
    def kept():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {str(blocks.apply(i)) for i in range(blocks.size()) if "shuffle_" in str(blocks.apply(i))}

    before = kept()
    df = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(100):  # files go in the background
        if not kept() - before:
            break
        time.sleep(0.1)
    assert not kept() - before
    assert df.count() == 7 and df.filter("count > 0").count() == 7


def test_blocks_of_any_size_count_alike(spark, monkeypatch):
    """Documents longer than a block, many parts, several passes, both folds."""
    random.seed(13)
    texts = [" ".join(random.choices("abcdefghij", k=random.choice([0, 1, 2, 30, 300]))) for _ in range(120)]
    docs = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(texts)], "doc_id long, text string, fold int")
    monkeypatch.setattr(blocks, "WORDS", 100)
    monkeypatch.setattr(blocks, "DOCS", 5)

    def entries(block, mine):
        keys = np.sort(block.vocabulary)
        at, here = np.searchsorted(keys, block.words), mine(keys)
        counts = np.bincount(at, minlength=len(keys)), np.bincount(at[block.mark == 3], minlength=len(keys))
        return keys[here], [c[here] for c in counts]

    def back(batches):
        for block, row in blocks.opened(batches):
            own, other, first = block.sums(0, 3)
            for k, key in enumerate(np.sort(block.vocabulary)):
                columns = [[block.fold], [int(key.astype(np.int64))], [int(own[k])], [int(other[k])], [int(first[k])]]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["fold", "w", "own", "other", "first"])

    made = blocks.make_blocks(docs)
    marked = blocks.with_marks(made, docs.filter("doc_id < 60").select("doc_id", F.lit(3).alias("mark")), "doc_id")
    n = made.agg(F.sum("n")).first()[0]
    assert n == sum(len(t.split()) for t in texts) and made.count() > 20
    monkeypatch.setattr(blocks, "LEAST", n // 40)
    sums, figures = blocks.add_up(marked, n, entries, 2, own=(0,), others=(1,), first=(1,))
    rows = blocks.with_sums(marked, sums).mapInArrow(back, "fold long, w long, own long, other long, first long").collect()
    for fold in (0, 1):
        own = Counter(w for i, t in enumerate(texts) if i % 2 == fold for w in t.split())
        other = Counter(w for i, t in enumerate(texts) if i % 2 != fold and i < 60 for w in t.split())
        known = {int(word_ids(w)[0].astype(np.int64)): w for w in own}
        here = [r for r in rows if r.fold == fold]
        assert all(r.own == own[known[r.w]] and r.other == other[known[r.w]] for r in here)
        assert sum(r.first for r in here) == sum(1 for w in known.values() if any(w in t.split() for t in texts[fold:60:2]))
        assert figures[fold][0]["all"] == len(own) and figures[fold][0]["sum"] == sum(own.values())


def test_frequent_words_keep_their_bound(spark):
    rows = [(" ".join(f"w{i}" for i in range(n)),) for n in (5, 20, 100)]
    docs = spark.createDataFrame(rows, "text string")
    assert cross_entropy.frequent_words(docs, 20) == sorted(f"w{i}" for i in range(20))
    assert len(cross_entropy.frequent_words(docs, 1000)) == 100
