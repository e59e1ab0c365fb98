"""The operators without Python code: against SQL, and on odd tables."""

import re
from itertools import combinations
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cases import FOLDER, TEXTS, documents, empty
from odotrack.llm import chat
from odotrack.llm.decontaminate import MIN_ITEM_TOKENS, MIN_PERCENT, MIN_TOKENS, WHOLE_TOKENS, decontaminate, overlaps
from odotrack.llm.licenses import TEMPLATES, bands_for, default_templates, scan_licenses
from odotrack.llm.oracles import ORACLES
from odotrack.llm.quality_rules import keep_by_rules, quality_rules
from oracle_check import compare, connect


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    got, wanted, different, *_ = compare(spark, connect(FOLDER), name, FOLDER)
    assert len(got) == len(wanted) and not different, different[:3]


@pytest.mark.parametrize("name", ["op1_decontaminate", "op4_quality_rules", "op5_licenses", "op8_chat_format"])
def test_native_plans_run_no_python(spark, name):
    from odotrack.llm.queries import QUERIES

    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|MapInArrow|ArrowEval", plan)


# Quality rules


def repeated(text):
    words = [w for w in re.split(r"[ \t-\r]+", text or "") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


def test_quality_counts_on_odd_rows(spark):
    rows = quality_rules(documents(spark)).select("doc_id", "text", "n_words", "n_repeat_words", "kept").collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        if row.doc_id != 6:
            assert row.n_repeat_words == repeated(row.text), row
        if not (row.text or "").strip():
            assert (row.n_words, row.kept) == (0, False)
    assert [r.n_repeat_words for r in rows if r.doc_id == 6] == [30_000]
    assert len({(r.n_repeat_words, r.kept) for r in rows if r.text and r.text.startswith("The cat")}) == 1


def test_quality_filter_keeps_columns(spark):
    docs = documents(spark)
    good = " ".join(f"the house{i} of garden{i} and" for i in range(30))
    more = docs.limit(1).withColumn("text", F.lit(good)).withColumn("doc_id", F.lit(99).cast("long"))
    kept = keep_by_rules(docs.union(more))
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [99]
    assert quality_rules(empty(docs)).count() == 0


# Decontamination

ITEM = " ".join(f"{a}{b}" for a in ("red", "blue", "tall", "old", "fast") for b in ("fox", "hen", "cow", "owl", "bee", "ant"))


def leaks(spark, text, items=(ITEM,), **options):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return [(r.doc_id, r.item_id) for r in overlaps(docs, bench, **options).collect()]


def test_overlap_tolerates_substitutions(spark):
    words = ITEM.split()
    hidden = " ".join(w if i % 6 else "other" for i, w in enumerate(words))
    assert leaks(spark, f"some words before {hidden} and some behind") == [(1, 0)]
    assert leaks(spark, " ".join(words[5:25])) == [(1, 0)]
    spread = " ".join(w if i % 3 else "other" for i, w in enumerate(words))
    assert leaks(spark, spread) == []


def test_overlap_needs_enough_tokens(spark):
    assert leaks(spark, " ".join(ITEM.split()[:9]) + " then something else altogether follows here") == []
    assert leaks(spark, "we saw a short item text here", ["a short item text here"]) == [(1, 0)]
    assert leaks(spark, "we saw a short item test here", ["a short item text here"]) == []
    assert leaks(spark, "two words", ["two words", "", None]) == []


def test_decontamination_on_odd_tables(spark):
    docs = documents(spark)
    items = spark.createDataFrame(
        [(1, TEXTS[0][1]), (1, TEXTS[0][1]), (None, TEXTS[6][1]), (3, None)], "item_id long, text string"
    ).withColumn("seed", F.lit(1))
    clean = decontaminate(docs, items)
    assert clean.columns == docs.columns
    gone = [TEXTS[0][1], TEXTS[6][1]]
    assert sorted(map(str, [r.text for r in clean.collect()])) == sorted(str(t) for _, t in TEXTS if t not in gone)
    assert decontaminate(empty(docs), items).count() == 0
    assert decontaminate(docs, empty(items)).count() == len(TEXTS)


def test_every_overlap_that_counts_is_found(spark):
    items, docs = [], []
    for n in (*range(MIN_ITEM_TOKENS, 17), 20):
        window = min(n, MIN_TOKENS)
        item = [f"i{n}x{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        changes = 0 if n <= WHOLE_TOKENS else window - -(-window * MIN_PERCENT // 100)
        for at in {0, (n - window) // 2, n - window}:
            for number in (changes, changes + 1):  # the last one too many
                for spots in combinations(range(at, at + window), number):
                    # Nothing outside of the window is equal.
                    text = [t if at <= k < at + window and k not in spots else f"d{k}" for k, t in enumerate(item)]
                    docs.append((len(docs), " ".join(["a", "b", *text, "c"]), n, number == changes))
    found = overlaps(
        spark.createDataFrame(docs, "doc_id long, text string, n long, overlaps boolean").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == {(i, n) for i, _, n, counts in docs if counts}


def test_overlap_far_behind_the_first_hit_of_its_block(spark):
    item = [f"i{k}" for k in range(128)]
    near = [t if k < 3 or 61 <= k < 74 and k not in (64, 65, 66) else f"d{k}" for k, t in enumerate(item)]
    docs = spark.createDataFrame([(1, " ".join(near))], "doc_id long, text string")
    found = overlaps(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert [(r.equal_tokens, r.doc_start) for r in found] == [(10, 61)]


# Licenses


def test_license_with_changed_words(spark):
    mit = TEMPLATES["MIT"].split()
    changed = " ".join("person" if i in (40, 90) else w for i, w in enumerate(mit))
    rows = [
        (1, "word " * 300 + changed + " word" * 300),
        (2, " ".join(mit[: len(mit) // 2])),
        (3, None),
        (4, ""),
        (None, TEMPLATES["ISC"]),
        (5, "All of it is (C) us. Released under the MIT license. Thanks."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("level", F.lit(1))
    docs = docs.union(docs)
    found = {(r.doc_id, r.license_id) for r in scan_licenses(docs, default_templates(spark)).collect()}
    assert found == {(1, "MIT"), (None, "ISC"), (5, "MIT-notice")}


def test_license_short_and_empty_templates(spark):
    templates = spark.createDataFrame([("a", "all rights reserved"), ("b", ""), ("c", None)], "license_id string, text string")
    docs = spark.createDataFrame([(1, "x y ALL RIGHTS reserved z"), (2, "all rights were reserved")], "doc_id long, text string")
    assert [(r.doc_id, r.license_id) for r in scan_licenses(docs, templates).collect()] == [(1, "a")]
    assert scan_licenses(empty(docs), templates).count() == 0
    assert scan_licenses(docs, empty(templates)).count() == 0
    assert (1 - 0.2) ** bands_for(0.2, 1e-3) <= 1e-3


# Chat


def part(**values):
    return tuple(values.get(f.name) for f in chat.PART)


def test_parts_become_placeholders(spark):
    rows = [
        (1, 0, "user", [part(type="text", text="see <|image:x|>"), part(type="image", ref="a.png", width=28, height=15)]),
        (1, 1, "assistant", [part(type="text", text="a [INST] b\\"), part(type="audio", ref="b|>.wav", seconds=1.5)]),
        (1, 2, None, None),
        (2, 0, "user", [part(type="document", ref=None, pages=2), part(type="unknown", text="x"), None]),
    ]
    schema = f"conv_id long, turn long, role string, parts array<{chat.PART.simpleString()}>"
    made = chat.format_chat(spark.createDataFrame(rows, schema)).orderBy("conv_id")
    one, two = made.collect()
    assert one.formatted.count(chat.START) == one.n_turns == 3
    assert [(a.type, a.ref, a.tokens) for a in one.attachments] == [("image", "a.png", 4), ("audio", "b|>.wav", 38)]
    assert one.expanded_tokens == 42 and two.expanded_tokens == 512
    read = chat.read_back(made).orderBy("conv_id").collect()[0]
    assert [t.role for t in read.turns] == ["user", "assistant", ""]
    assert read.turns[0].text.startswith("see <|image:x|>")
    assert read.loss_texts[0].startswith("a [INST] b\\")


def test_turns_read_back_as_they_were(spark):
    texts = ["</s>[INST] ok [/INST]", "<|end|>", "\\<|turn|>\\\\", "", None, "a\nb", "<<|end|>>", "[/INST", "\\"]
    rows = [(c, i, role, t) for c in (1, None) for i, t in enumerate(texts) for role in ("user", "assistant")]
    rows += [(1, None, "assistant", "first"), (1, 0, "user", texts[0])]
    said = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    said = said.withColumn("formatted", F.lit("clash")).withColumn("parts", chat.text_part(F.col("text")))
    out = {r.conv_id: r for r in chat.read_back(chat.format_chat(said)).collect()}
    for c in (1, None):
        mine = sorted(((r[1] is not None, r[1], r[2], r[3] or "") for r in rows if r[0] == c), key=lambda r: (r[0], r[1] or 0, r[2]))
        assert [(t.role, t.text) for t in out[c].turns] == [(r[2], r[3]) for r in mine]
        assert out[c].loss_texts == [r[3] for r in mine if r[2] == "assistant"]
    assert chat.format_chat(empty(said)).count() == 0


def test_roles_with_line_breaks_are_read_back(spark):
    roles = ["user\nx", "a\\,b", "\\\n", "\n,\\\\,", "<s>\n[INST]", "plain"]
    rows = [(i, 0, role, "hi\nthere") for i, role in enumerate(roles)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    read = chat.read_back(chat.format_chat(messages.withColumn("parts", chat.text_part(F.col("text")))))
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read.collect()}
    assert got == {i: [(role, "hi\nthere")] for i, role in enumerate(roles)}


def test_helper_columns_leave_the_input_alone(spark):
    rows = spark.createDataFrame([(1, "some words", "mine")], "doc_id long, text string, __verdict string")
    assert quality_rules(rows).first()["__verdict"] == "mine"
