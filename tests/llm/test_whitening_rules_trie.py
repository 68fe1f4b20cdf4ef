"""Whitening, quality rules and the conversation trie against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from marketlens.llm import prefixtrie, rules, whitening  # noqa: E402

# -- 11 whitening ------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, x):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0)
                                  for i, v in enumerate(x)], VECTORS)


@pytest.mark.parametrize("width, wanted, block", [(64, 32, 16), (120, 12, 4), (40, 40, 8), (3, 32, 16)])
def test_jacobi_davidson_is_the_dense_spectrum(width, wanted, block):
    rng = np.random.default_rng(width)
    a = rng.standard_normal((500, width)) * np.linspace(3, 1, width)
    v = a.T @ a / 500
    found = whitening.eigen(lambda u: v @ u, width, wanted, block=block)
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1][:wanted], basis[:, ::-1][:, :wanted]
    assert np.allclose(found.values, values, rtol=1e-13)
    assert (found.residuals <= 1e-13 * values[0]).all()
    assert np.allclose(np.abs(np.sum(found.vectors * basis, axis=0)), 1, atol=1e-10)


def test_jacobi_davidson_equal_and_zero_eigenvalues():
    v = np.diag([5.0] * 4 + [2.0] * 3 + [0.0] * 23)
    found = whitening.eigen(lambda u: v @ u, 30, 10, block=2)
    assert np.allclose(found.values, [5] * 4 + [2] * 3 + [0] * 3, atol=1e-12)


def test_minres_solves_each_column():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((12, 12))
    a = a + a.T
    b = rng.standard_normal((12, 3))
    assert np.allclose(a @ whitening.minres(lambda u: a @ u, b, 12), b, atol=1e-8)


def check_whitening(rows, kept, k):
    """Rows of the digest against dense linear algebra with whole numbers."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    n, width = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(width)]
    exact = {i: sum((n * r[d] - sums[d]) ** 2 for d in range(width)) for (i, _), r in zip(kept, x)}
    y = np.array([[(n * r[d] - sums[d]) / n for d in range(width)] for r in x])
    v = y.T @ y / n
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    assert len(rows) == n * k
    by = defaultdict(dict)
    for r in rows:
        assert r.n == n and r.deviation == exact[r.vec_id] and r.identity_error <= 1e-10
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-9)
        by[r.component][r.vec_id] = r.whitened
    for c in range(1, k + 1):
        want = y @ basis[:, c - 1] / math.sqrt(values[c - 1])
        got = np.array([by[c][i] for i, _ in kept])
        sign = 1 if np.dot(want, got) > 0 else -1
        assert np.allclose(got * sign, want, atol=1e-7)


def test_whitening_against_dense_algebra(spark):
    rng = np.random.default_rng(1)
    x = [list(map(float, v)) for v in rng.standard_normal((300, 40)) * np.linspace(2, 0.3, 40)]
    x += [x[5]] * 150  # one vector holds a third of the rows
    bad = [None, [], [None] + [0.0] * 39, [float("nan")] * 40, [float("inf")] + [0.0] * 39, [1.0] * 7]
    df = vectors(spark, x + bad).withColumn("id", F.lit("clash")).withColumn("v", F.lit(1)).repartition(5)
    rows = whitening.whitening_digest(df).collect()
    check_whitening(rows, list(enumerate(x)), 32)


def test_whitening_of_few_dimensions_and_flat_ones(spark):
    rng = np.random.default_rng(2)
    x = [[float(a), float(b), 0.5] for a, b in rng.standard_normal((50, 2))]
    rows = whitening.whitening_digest(vectors(spark, x)).collect()
    check_whitening(rows, list(enumerate(x)), 2)  # the flat dimension gives no component


@pytest.mark.parametrize("x", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 9])
def test_whitening_without_variance(spark, x):
    out = whitening.whitening_digest(vectors(spark, x))
    assert out.collect() == [] and out.columns[:3] == ["vec_id", "component", "n"]


def test_whitening_of_huge_entries_is_exact(spark):
    x = [[1e12, 3.0], [-1e12, 5.0], [2.5e11, -4.0], [7.0, 1e9]]
    df = spark.createDataFrame([(i if i else None, v) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    w = whitening.fit(df)
    got = {r.id: int(r.deviation) for r in whitening.whiten(w).collect()}
    whole = [[math.floor(64 * c) + 1_000_000 for c in v] for v in x]
    sums = [sum(c) for c in zip(*whole)]
    assert got == {i if i else None: sum((4 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(whole)}
    assert {r.vec_id for r in whitening.whitening_digest(df).where("deviation IS NULL").collect()} == {
        i for i, d in got.items() if d >= 2 ** 63}


# -- 12 quality rules --------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
WHITE = re.compile(r"[^\x20\x09-\x0D]+")


def rules_brute(text):
    words = WHITE.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WHITE.search(line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i:i + 8])].append(i)
    repeated = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)}
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated), failed)


RULE_TEXTS = [None, "", " \t\n", "\n\n", "one", "a b c d e f g h " * 2, "a b c d e f g h", "same\nsame\n same\nsame", "x\x1cy z w é€😀 |#",
              "w " * 19 + "w", " ".join(f"w{i}" for i in range(20)), "é # $ % & * | < >\n" * 3, "tail\n", "word " * 50_000,
              " ".join(f"u{i}" for i in range(30_000)), "日本語 テキスト\n日本語 テキスト\r\n日本語"]


def random_texts(rng, n):
    return ["".join(rng.choice(["a", "b", "ab", " ", " ", "\n", "#", "é"]) for _ in range(rng.randint(0, 400))) for _ in range(n)]


def test_base_counts_against_brute_force(spark):
    texts = RULE_TEXTS + random_texts(random.Random(4), 60)
    d = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(None, "no id", "en", "s", 0)] * 2, DOCS)
    d = d.withColumn("id", F.lit("clash")).withColumn("kept", F.lit(3)).withColumn("key", F.lit(1)).withColumn("_mark", F.lit(1))
    labels = spark.createDataFrame([(3, 1, 0), (8, 0, 0), (8, 1, 0), (None, 0, 0), (12, None, 0)], LABELS)
    rows = rules.rules_digest(d, labels).collect()
    assert len(rows) == len(texts) + 2 and sum(r.doc_id is None for r in rows) == 2
    for r in rows:
        if r.doc_id is not None:
            got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
            assert got == rules_brute(texts[r.doc_id]), texts[r.doc_id][:80] if texts[r.doc_id] else None
            assert not (r.base_failed and r.kept)


def test_rules_without_labels_or_rows(spark):
    d = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30)), "en", "s", 0), (2, "few", "en", "s", 0)], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert {r.doc_id: r.kept for r in rules.rules_digest(d, none).collect()} == {1: True, 2: False}
    assert rules.rules_digest(spark.createDataFrame([], DOCS), none).collect() == []


def random_field(rng):
    return rules.Field(rng.standard_normal(len(rules.FEATURES)), rng.standard_normal((2, 2)), rng.standard_normal(2))


def path_score(field, features, labels):
    score = field.first[labels[0]] + sum(f @ field.weights for f, y in zip(features, labels) if y)
    return score + sum(field.moves[a, b] for a, b in zip(labels, labels[1:]))


def test_viterbi_and_sums_over_all_label_sequences():
    rng = np.random.default_rng(5)
    lengths = [1, 7, 3, 5, 7, 2]
    text = np.repeat(np.arange(len(lengths)) * 2, lengths)  # texts without lines lie between
    features = rng.integers(0, 2, (len(text), len(rules.FEATURES))).astype(float)
    field = random_field(rng)
    got = rules.decode(field, features, text)
    norm, content, moves, first = rules.expected(field, features, text)
    want_norm, at = 0.0, 0
    for n in lengths:
        f = features[at:at + n]
        paths = list(itertools.product((0, 1), repeat=n))
        scores = np.array([path_score(field, f, p) for p in paths])
        assert tuple(got[at:at + n]) == paths[int(scores.argmax())]
        z = np.log(np.exp(scores).sum())
        share = np.exp(scores - z) @ np.array(paths)
        assert np.allclose(share, content[at:at + n])
        want_norm, at = want_norm + z, at + n
    assert norm == pytest.approx(want_norm)


def test_gradient_of_the_field():
    rng = np.random.default_rng(6)
    text = np.repeat(np.arange(4), [3, 1, 5, 2])
    features = rng.integers(0, 2, (11, len(rules.FEATURES))).astype(float)
    labels = rng.integers(0, 2, 11)
    flat = random_field(rng).flat()
    _, grad = rules.likelihood(flat, features, text, labels)
    for i in range(len(flat)):
        step = np.zeros(len(flat))
        step[i] = 1e-5
        up, down = (rules.likelihood(flat + s * step, features, text, labels)[0] for s in (1, -1))
        assert grad[i] == pytest.approx((up - down) / 2e-5, abs=1e-5)


def prose(rng, n):
    return " ".join("".join(rng.choices(("ka", "lo", "mi", "ner", "tas"), k=rng.randint(1, 4))) for _ in range(n)) + "."


def test_field_tells_boilerplate_from_content(spark):
    rng = random.Random(7)
    nav = lambda: " | ".join(prose(rng, 1)[:-1] for _ in range(25))
    texts, marks = [], []
    for i in range(160):
        good = i % 4 != 0
        lines = [prose(rng, 12) for _ in range(6)] if good else [prose(rng, 8)] + [nav() for _ in range(4)]
        texts.append("\n".join(lines))
        marks.append(int(good))
    d = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    # half of the labels are seen; one junk document is repeated many times
    d = d.unionByName(d.where("doc_id = 0").crossJoin(spark.range(300)).drop("id"))
    labels = spark.createDataFrame([(i, m, 0) for i, m in enumerate(marks) if i < 80], LABELS)
    field = rules.train(d, labels)
    kept = {r.id: r.kept for r in rules.judge(d, field).collect()}
    assert all(kept[i] == bool(marks[i]) for i in range(160))
    mark = lambda *lines: [m for _, m in rules.label_lines("\n".join(lines), field)]
    assert mark(prose(rng, 12), "", prose(rng, 12), prose(rng, 12)) == [True, None, True, True]
    assert mark(nav(), nav(), "") == [False, False, None]


# -- 13 conversation trie ------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def trie_brute(rows):
    by = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in by.items()}
    seqs = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    out = {}
    for node, m in members.items():
        below = [x for x in members if x[:len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = sum(not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * len(WHITE.findall(x[-1][1])) for x in below if x)
        ends = ",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out[(min(m), len(node))] = (parent, len(m), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def random_turns(rng, convs, longest=7):
    rows = []
    for c in convs:
        for t in range(rng.randint(1, longest)):
            text = rng.choice(["hi", "hello there", None, "", "a  b\tc", "x y"])
            rows.append((c, None if rng.random() < 0.1 else t, rng.choice(["user", "bot", None]), text))
    return rows


def got_trie(df, **kw):
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
            for r in prefixtrie.trie(df, **kw).collect()}


@pytest.mark.parametrize("kw", [{}, {"block": 3, "last": 5, "chunk": 4}])
def test_trie_against_brute_force(spark, kw):
    rng = random.Random(8)
    rows = random_turns(rng, [c for c in range(-25, 130) if c % 7 != 3] + [10 ** 12 + k for k in range(25)])
    rows += [(None, 0, "user", "nobody")] * 3 + rows[:5] * 2  # repeated rows are turns
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    df = df.withColumn("conv", F.lit("clash")).withColumn("words", F.lit(1)).withColumn("depth", F.lit(2)).withColumn("id", F.lit(3))
    assert got_trie(df, **kw) == trie_brute(rows)


def test_trie_of_hot_conversations(spark):
    """Many copies of one conversation, one very long conversation, one very common first turn."""
    rng = random.Random(9)
    copies = [(c, t, "user", f"turn {t}") for c in range(1000, 1120) for t in range(5)]
    long = [(40, t, "bot", f"step {t % 7}") for t in range(700)]
    first = [(c, t, "user", "hello" if t == 0 else f"{c} says {t}") for c in range(3000, 3080) for t in range(rng.randint(1, 3))]
    rows = copies + long + first
    df = spark.createDataFrame(rows, TURNS)
    assert got_trie(df, block=16, last=64, chunk=32) == trie_brute(rows)


def test_scan_is_spread_over_tasks(spark):
    """A conversation of a third of all rows is numbered by several tasks."""
    rows = [(7, t, "u", str(t)) for t in range(600)] + [(100 + c, t, "u", str(t)) for c in range(400) for t in range(3)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        scanned = prefixtrie.turns(spark.createDataFrame(rows, TURNS))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sorted(r.i for r in scanned.where("conv = 7").collect()) == list(range(600))
    files = scanned.where("conv = 7").select(F.col("_metadata.file_path")).distinct().count()
    assert files > 1


def test_turnless_and_empty(spark):
    assert prefixtrie.trie(spark.createDataFrame([], TURNS)).collect() == []
    # conversations with h >= their turns and without a base conversation
    bare = [c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 >= 1][:6]
    rows = [(c, 0, "user", "x") for c in bare]
    assert got_trie(spark.createDataFrame(rows, TURNS)) == trie_brute(rows)
    assert len(trie_brute(rows)) == 1


def test_modular_arithmetic():
    rng = np.random.default_rng(10)
    p = int(prefixtrie.PRIME)
    a, b = (rng.integers(0, p, 500, dtype=np.uint64) for _ in range(2))
    assert [int(v) for v in prefixtrie.times(a, b)] == [int(x) * int(y) % p for x, y in zip(a, b)]
    assert [int(v) for v in prefixtrie.minus(a, b)] == [(int(x) - int(y)) % p for x, y in zip(a, b)]
    e = rng.integers(0, 10 ** 9, 50)
    assert [int(v) for v in prefixtrie.power(prefixtrie.BASES[0], e)] == [pow(int(prefixtrie.BASES[0]), int(x), p) for x in e]
    begins = np.array([0, 1, 100, 350])
    got, total = prefixtrie.running(a, begins), 0
    for i, x in enumerate(a):
        total = int(x) if i in begins else (total + int(x)) % p
        assert int(got[i]) == total


def test_trie_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    want = con.execute(prefixtrie.ORACLE_SQL)
    columns = [c[0] for c in want.description]
    got = prefixtrie.trie_digest(spark.read.parquet(f"{sf}/conversations.parquet")).select(*columns).collect()
    order = lambda rows: sorted((tuple(r) for r in rows), key=lambda r: r[:2])
    assert order(got) == order(want.fetchall())
