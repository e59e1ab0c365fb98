"""Near duplicates against all pairs, archives against zipfile, the pipeline."""

import io
import random
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cases import FOLDER, TEXTS, documents, empty
from odotrack.llm import near_dedup, warc_zip
from odotrack.llm.shingles import resemble, shingles


def brute_components(rows):
    """By all pairs of rows; rows of one id are one document."""
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if resemble(x, y, 75):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in parent}


def copies(seed, n, share):
    random.seed(seed)
    base = [f"{random.choice('abcdefgh')}{random.randint(0, 400)}" for _ in range(120)]
    return [" ".join(w if random.random() > share else f"z{random.random()}" for w in base) for _ in range(n)]


def test_components_equal_all_pairs(spark):
    texts = copies(1, 40, 0.02) + copies(2, 60, 0.03) + copies(3, 30, 0.01) + copies(4, 40, 0.05)
    texts += texts[:20] + copies(5, 1, 0) * 30 + ["one two", "one two", "ONE two", "one  two\n", "two one"]
    order = list(range(len(texts)))
    random.shuffle(order)
    rows = list(zip(order, texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs).collect()}
    wanted = brute_components(rows)
    assert {i: r.component_id for i, r in got.items()} == wanted
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(shingles(t)) for i, t in rows}


def test_blocks_find_what_the_first_comparisons_miss(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "MEMBERS", 8)  # several blocks a bucket
    rows = list(enumerate(copies(11, 120, 0.035)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert got == brute_components(rows)


def test_shingles_by_hand():
    assert len(shingles("a b c d e f a b c d e")) == 7 - 1
    assert len(shingles("A b")) == 1 and (shingles("A b") == shingles("a\tB ")).all()
    assert len(shingles(None)) == len(shingles(" \n")) == 0
    assert not np.intersect1d(shingles("a b"), shingles("a b c")).size
    assert len(shingles("é É")) == 1 and (shingles("é") != shingles("É")).all()


def test_sketches_agree_as_often_as_sets_do():
    random = np.random.default_rng(4)
    agreed = []
    for _ in range(200):
        x = random.integers(0, 1 << 64, size=400, dtype=np.uint64)
        a, b = near_dedup.minima(x[:350], 512), near_dedup.minima(x[50:], 512)
        agreed.append((a == b).mean())
    assert abs(np.mean(agreed) - 0.75) < 0.01


def test_near_duplicates_on_odd_tables(spark):
    docs = documents(spark)
    rows = near_dedup.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS)
    found = {r.doc_id: r.component_id for r in rows}
    assert found[2] == found[1] == 1 and found[3] == 3 and found[4] == 4 and found[7] == 7 and found[None] is None
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in TEXTS if i != 2)
    assert near_dedup.near_duplicates(empty(docs)).count() == 0


def test_rows_of_one_id_join_their_components(spark):
    a, b = copies(21, 1, 0)[0], copies(22, 1, 0)[0]
    rows = [(5, a), (5, b), (2, a), (9, b), (9, "something else")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in near_dedup.near_duplicates(docs).collect()} == {2}


# Archives


def pages(spark):
    rows = [
        (3, "http://a/\nx", "<p>same</p>"),
        (1, "http://b", "<p>same</p>"),
        (1, "http://b", "<p>same</p>"),
        (2, None, None),
        (4, "http://é", ""),
        (None, "http://c", "<p>same</p>"),
        (None, "http://c", "nobody has\r\n\r\nthis é"),
        (5, "http://d", "x" * 300_000),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("archive", F.lit("clash"))


@pytest.mark.parametrize("roll", [1, warc_zip.ROLL])
def test_pages_come_back(spark, roll):
    table = pages(spark)
    archives = warc_zip.write_archives(table, roll=roll)
    rows = warc_zip.read_archives(archives).collect()
    assert sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes) for r in rows) == sorted(
        [
            ("3", "revisit", "1", 11),
            ("1", "response", "None", 11),
            ("1", "response", "None", 11),
            ("2", "response", "None", 0),
            ("4", "revisit", "2", 0),
            ("None", "revisit", "1", 11),
            ("None", "response", "None", 21),
            ("5", "response", "None", 300_000),
        ]
    )
    assert [r.payload for r in rows if r.payload_bytes == 21] == ["nobody has\r\n\r\nthis é".encode()]
    assert len({r.payload_digest for r in rows if r.payload_bytes == 11}) == 1
    assert archives.agg(F.sum("n_records")).first()[0] == 8
    with zipfile.ZipFile(archives.first().archive.removeprefix("file:")) as package:
        assert package.namelist() == [warc_zip.DATA, warc_zip.INDEX] and package.testzip() is None


def test_short_payloads_are_all_responses(spark):
    rows = warc_zip.read_archives(warc_zip.write_archives(pages(spark), min_bytes=12), payload=False).collect()
    assert {r.record_type for r in rows} == {"response"} and "payload" not in rows[0]


def test_no_pages(spark):
    assert warc_zip.read_archives(warc_zip.write_archives(empty(pages(spark)))).count() == 0


class Bytes(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_directory_of_many_members_and_comment():
    out = Bytes()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
        for i in range(66_000):  # more than the plain end record can count
            package.writestr(f"m{i}", f"text {i}")
        package.writestr("packed", "x" * 100, zipfile.ZIP_DEFLATED)
        package.comment = b"PK a comment"
    directory = warc_zip.ZipDirectory(out)
    assert len(directory.members) == 66_001
    assert directory.read(*directory.locate("m65999")) == b"text 65999"
    with pytest.raises(ValueError, match="compressed"):
        directory.locate("packed")


def test_wide_sizes_come_from_the_extra_field():
    extra = struct.pack("<HHI", 9, 4, 0) + struct.pack("<HHQQ", 1, 16, 1 << 33, 1 << 34)
    assert warc_zip._wide(extra, [0xFFFFFFFF, 5, 0xFFFFFFFF]) == [1 << 33, 5, 1 << 34]
    with pytest.raises(ValueError, match="not a ZIP"):
        warc_zip.ZipDirectory(Bytes(b"nothing"))


# The pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sizes = []
    for name, apply in corpus_pipeline.STAGES:
        kept = corpus_pipeline.stage(apply(spark, docs, FOLDER))
        if name != "byte-level BPE":
            assert kept.columns == docs.columns
        sizes.append(kept.count())
        if name == "near duplicates":
            rows = docs.select("doc_id", "text").collect()
            wanted = brute_components(rows)
            assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(i for i, c in wanted.items() if i == c)
        docs = kept
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    assert docs.filter("not exact or n_tokens <> size(ids)").count() == 0
    final = corpus_pipeline.run(spark, FOLDER)
    assert {(r.doc_id, r.n_tokens) for r in final.collect()} == {(r.doc_id, r.n_tokens) for r in docs.collect()}


def test_stages_stand_odd_rows(spark):
    docs = documents(spark).withColumn("source", F.lit("s"))
    for frame in (docs, empty(docs)):
        for _, apply in corpus_pipeline.STAGES:
            apply(spark, frame, FOLDER).collect()
