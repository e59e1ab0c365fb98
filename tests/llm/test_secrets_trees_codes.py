"""Secret scans, Merkle manifests and vector codes, against their definitions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import FOLDER, TEXTS, documents, empty
from odotrack.llm import merkle, vector_codes
from odotrack.llm.queries import op11_secret_scan, op12_merkle, op13_vector_codes
from odotrack.llm.secret_scan import BASE, Automaton, Rule, scan_secrets

# Secrets

#: Each kind as a regular expression whose first group is counted, in the rules' order.
PATTERNS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
    "access": ("(AKIA[A-Z0-9]+)", 18),
    "hex": ("([0-9a-f]+)", 16),
    "github": ("(gh[opsu]_[0-9A-Za-z]+)", 40),
    "google": (r"(AIza[0-9A-Za-z_\-]+)", 39),
    "slack": (r"(xox[abpr]-[0-9A-Za-z\-]+)", 16),
    "jwt": (r"(eyJ[0-9A-Za-z_\-]+\.eyJ[0-9A-Za-z_\-]+\.[0-9A-Za-z_\-]+)", 32),
    "private_key": ("(-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----)", 1),
}
BITS = [
    *("password", "PassWord", "secret", "token", "api_key", "apikey", "=", ":", " ", "'", '"', "AKIA", "A", "Z9", "0f"),
    *("deadbeef" * 2, "abcdefabcdef0123", "x", "é", "\n", "=abcdefghijkl", "gh", "ghp_", "a" * 36, "AIza", "Bz_-" * 9),
    *("xoxb-", "1234-5678", "eyJ", ".eyJ", ".", "hdr", "-----", "BEGIN ", "RSA ", "PRIVATE KEY", "日本", "\x00"),
    "-----BEGIN PRIVATE KEY-----",
]


def secrets_of(text):
    kinds, found = list(PATTERNS), []
    for i, (pattern, least) in enumerate(PATTERNS.values()):
        found += [(m.start(), i, m.end()) for m in re.finditer(pattern, text or "", re.A) if len(m.group(1)) >= least]
    return [(kinds[i], start, end) for start, i, end in sorted(found)]


@pytest.fixture(scope="module")
def automaton():
    return Automaton()


def test_spans_equal_those_of_regular_expressions(automaton):
    random.seed(1)
    hits = 0
    for _ in range(20_000):
        text = "".join(random.choices(BITS, k=random.randint(0, 25)))
        assert automaton.spans(text) == secrets_of(text), text
        hits += len(secrets_of(text))
    assert hits > 10_000


def test_states_are_merged_and_moves_premultiplied(automaton):
    width = automaton.end + 1
    assert automaton.n_states < automaton.n_subsets
    assert len(automaton.table) == automaton.n_states * width
    assert all(t < 0 or t % width == 0 for t in automaton.table)


def test_short_matches_use_up_their_bytes(automaton):
    # "secret" is the value of the first assignment, so it begins no other one.
    assert automaton.spans("token=secret: abcdefghijklmnop") == []
    assert automaton.spans("secret: abcdefghijklmnop") == [("assign", 0, 24)]


def test_a_long_run_is_one_span(automaton):
    assert automaton.spans("é" + "0f" * 100_000 + "g") == [("hex", 1, 200_001)]


def test_rules_that_need_a_second_look_are_refused():
    with pytest.raises(ValueError, match="beyond"):
        Automaton((Rule("late", "ab(cd)?"),))
    with pytest.raises(ValueError, match="nothing"):
        Automaton((Rule("none", "a*"),))
    with pytest.raises(ValueError):
        Automaton((Rule("open", "(a"),))


def test_own_rules_with_counts_and_negated_classes():
    own = Automaton((Rule("card", "[0-9]{4}(-[0-9]{4}){3}"), Rule("quoted", r'"[^"]{2,4}"')))
    assert own.spans('1234-5678-9012-3456 "ab" "c" "defg"') == [("card", 0, 19), ("quoted", 20, 24), ("quoted", 29, 35)]


def test_odd_texts(spark):
    rows = documents(spark).withColumn("secrets", F.lit("clash"))
    found = scan_secrets(rows).select("text", "secrets").collect()
    assert len(found) == len(TEXTS)
    for row in found:
        assert [(s["kind"], s["start"], s["end"]) for s in row["secrets"]] == secrets_of(row["text"])
    assert scan_secrets(empty(rows)).count() == 0


def test_op11_by_the_definition(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = op11_secret_scan(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    base = [r.kind for r in BASE]
    for row in rows:
        spans = secrets_of(texts[row["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans if k in base)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert row["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert [row[f"n_{k}"] for k in base] == [sum(s[0] == k for s in spans) for k in base]


# Merkle manifests


def test_addresses_are_a_van_emde_boas_order():
    for levels in range(1, 8):
        nodes = [(d, i) for d in range(levels) for i in range(3**d)]
        places = {node: int(merkle.address(levels, *node)) for node in nodes}
        assert sorted(places.values()) == list(range(merkle.size(levels)))
        upper, lower = levels // 2, levels - levels // 2
        if upper:
            # The upper half comes first; each lower subtree is one run, in the same order.
            assert {p for (d, _), p in places.items() if d < upper} == set(range(merkle.size(upper)))
            for tree in range(3**upper):
                start = merkle.size(upper) + tree * merkle.size(lower)
                inside = {(d, i): p for (d, i), p in places.items() if d >= upper and i // 3 ** (d - upper) == tree}
                assert set(inside.values()) == set(range(start, start + merkle.size(lower)))
                assert all(p - start == merkle.address(lower, d - upper, i % 3 ** (d - upper)) for (d, i), p in inside.items())


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def tree_of(leaves):
    """Root and, for each leaf, its levels of (digests before, digests after)."""
    paths, level, spots = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for path, spot in zip(paths, spots):
            first = spot // 3 * 3
            path.append((level[first:spot], level[spot + 1 : first + 3]))
        level = [sha(*level[i : i + 3]) for i in range(0, len(level), 3)]
        spots = [s // 3 for s in spots]
    return level[0], paths


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def manifest_of(rows):
    """The contract of op12 for (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row, sha(*map(field, row))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[name] = tree_of([leaf for _, leaf in groups[name]])
    root, tops = tree_of([trees[n][0] for n in names])
    out = []
    for name, top in zip(names, tops):
        subroot, paths = trees[name]
        for (row, leaf), path in zip(groups[name], paths):
            path = path + top
            now = list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                now[4] = row[4].replace("\n", "")
            at = sha(*map(field, now))
            for before, after in path:
                at = sha(*before, at, *after)
            proof = sha(*(s for before, after in path for s in before + after))
            out.append((row[0], leaf, subroot, root, proof, at, at == root))
    return sorted(out, key=repr)


def planted(spark, folder, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    if extra:
        df = df.withColumns({n: F.lit(n) for n in ("key", "digest", "position", "n", "block", "before", "leaf", "root")})
    df.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_op12_by_the_definition(spark, tmp_path):
    random.seed(2)
    rows = [(i, "hot", "en", i, f"line {i}\nand {i % 7}\n") for i in range(800)]  # more than two rounds of blocks
    rows += [(i, random.choice(["a", "é", "B", "", None, "s", "hos"]), None, None, random.choice([None, "", "\n", "x"])) for i in range(60)]
    rows += [(5, "hot", "en", 5, "same id"), (5, "hot", "en", 5, "same id"), (None, "hot", "en", 0, "no id\n"), (None, None, None, None, None)]
    rows += [(1000 + i, f"alone {i}", "de", 1, "one\nleaf") for i in range(260)]  # subroots in two blocks
    got = op12_merkle(spark, planted(spark, tmp_path, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == manifest_of(rows)
    assert {r["verified"] for r in got} == {True, False}


def test_op12_on_the_table_and_on_none(spark, tmp_path):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select(*columns).collect()]
    assert sorted((tuple(r) for r in op12_merkle(spark, FOLDER).collect()), key=repr) == manifest_of(rows)
    assert op12_merkle(spark, planted(spark, tmp_path / "none", [])).collect() == []
    one = [(1, None, None, None, "a\nb")]
    assert [tuple(r) for r in op12_merkle(spark, planted(spark, tmp_path / "one", one)).collect()] == manifest_of(one)


def test_manifest_keeps_its_columns_apart(spark):
    rows = spark.createDataFrame([(2, "a"), (1, "a"), (3, None)], "digest long, key string")
    manifest = merkle.build_manifest(rows, "key", ["digest"], F.sha2(F.col("digest").cast("string"), 256))
    proved = {r["digest"]: r for r in manifest.prove().collect()}
    assert {k: r["key"] for k, r in proved.items()} == {1: "a", 2: "a", 3: None}
    assert manifest.root() == sha(sha("3"), sha(sha("1"), sha("2")))
    assert proved[2]["before"] == [sha("1"), sha("3")] and proved[2]["after"] == ["", ""]


# Vector codes


def codes_of(rows, parts=16, entries=64, rounds=2):
    """The contract of op13 for (vec_id, vector, label), with every distance evaluated."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ints = np.array([[math.floor(256 * x) for x in r[1]] for r in kept], dtype=object)
    ints = ints.reshape(len(kept), parts, -1)
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, ints[i].ravel().tolist()))
    books = [[list(ints[i, p]) for i in order[:entries]] for p in range(parts)]

    def assign():
        out = []
        for p in range(parts):
            apart = [[sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]] for x in ints[:, p]]
            out.append([min((d, e) for e, d in enumerate(row)) for row in apart])
        return out

    for _ in range(rounds):
        for p, found in enumerate(assign()):
            for e in range(len(books[p])):
                own = [ints[i, p] for i, (_, at) in enumerate(found) if at == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    last = assign()
    error = [sum(last[p][i][0] for p in range(parts)) for i in range(len(kept))]
    sums = {}
    for r, e in zip(kept, error):
        sums[r[2]] = sums.get(r[2], 0) + e
    digest = sha(",".join(str(c) for book in books for e in book for c in e))
    return sorted(
        (
            (r[0], "".join(f"{last[p][i][1]:02x}" for p in range(parts)), error[i], sums[r[2]], digest)
            for i, r in enumerate(kept)
        ),
        key=repr,
    )


def vectors(spark, folder, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df.withColumns({n: F.lit(n) for n in ("code", "error", "pq_ints", "part")}).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def float32(values):
    return [float(np.float32(v)) for v in values]


def test_op13_by_the_definition(spark, tmp_path):
    random.seed(4)
    rows = [(i, float32(random.gauss(0, 0.2) for _ in range(32)), i % 3 or None) for i in range(140)]
    rows += [(200 + i, rows[3][1], 7) for i in range(60)]  # copies
    rows += [(3, rows[8][1], 1), (None, rows[9][1], None)]  # a tie, and no id
    rows += [(900, None, 1), (901, [None] * 32, 1), (902, [float("nan")] * 32, 1), (903, [float("inf")] + [0.0] * 31, 2)]
    rows += [(904, [-0.001, 1000.0] * 16, 5)]
    got = op13_vector_codes(spark, vectors(spark, tmp_path, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == codes_of(rows)


def test_op13_with_few_vectors_and_none(spark, tmp_path):
    rows = [(i, float32([i / 7, -i] * 8), None) for i in range(5)]
    got = op13_vector_codes(spark, vectors(spark, tmp_path / "few", rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == codes_of(rows)
    assert op13_vector_codes(spark, vectors(spark, tmp_path / "bad", [(1, None, 1), (2, [None], 1)])).collect() == []
    assert op13_vector_codes(spark, vectors(spark, tmp_path / "none", [])).collect() == []


def test_pivots_prune_and_never_change_the_nearest():
    rng = np.random.default_rng(5)
    entries = rng.integers(-60, 60, (64, 4))
    x = np.concatenate([rng.integers(-60, 60, (3000, 4)), entries, entries])  # with distance 0
    entries[40] = entries[7]  # ties between entries
    pivots = vector_codes.choose_pivots(entries[None], 4)[0]
    near = vector_codes._distances(x, pivots).astype(np.float32)
    label, best, evaluated = vector_codes.nearest(x, near, entries, pivots)
    every = ((x[:, None] - entries[None]) ** 2).sum(2)
    assert (best == every.min(1)).all() and (label == every.argmin(1)).all()
    assert evaluated < len(x) * 64 / 4


def test_vectors_of_other_lengths_are_filled_and_large_ones_cut(spark):
    rows = [(1, [0.5] * 5, 0), (2, [1e30] * 20, 0), (3, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    codes, books = vector_codes.compress(df)
    assert books.entries.shape == (16, 3, 2)
    assert {r["vec_id"]: r["error"] for r in codes.collect()} == {1: 0, 2: 0, 3: 0}
    decoded = {r["vec_id"]: r["decoded"] for r in vector_codes.decode(codes, books).collect()}
    assert decoded[1][:6] == pytest.approx([0.5] * 5 + [0.0], abs=1 / 256)


def test_group_errors_count_nulls_together(spark):
    df = spark.createDataFrame([(1, "a", 2), (2, None, 3), (3, None, 4)], "vec_id long, label string, error long")
    rows = vector_codes.with_group_error(df.withColumn("code", F.lit("")), "label", "summed").collect()
    assert {r["vec_id"]: r["summed"] for r in rows} == {1: 2, 2: 7, 3: 7}
