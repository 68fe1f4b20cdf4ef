"""Toxicity: every labelled row that is not held out is learnt from, in parts of any size."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from marketlens.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def _frames(spark, n=600):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    texts, marks = [], []
    for i in range(n):
        words = [word() for _ in range(30)] + ([f"vile{i}"] * 2 if i % 4 == 0 else [])
        words += rng.sample(["idiot", "scum", "moron"], 2) if i % 4 == 0 else []
        texts.append((i, " ".join(words), "en" if i % 3 else "de"))
        marks.append((i, 1, int(i % 4 == 0)))
    return spark.createDataFrame(texts, "doc_id long, text string, lang string"), spark.createDataFrame(marks, LABELS), marks


def test_every_labelled_row_is_counted_and_trained_on(spark, monkeypatch):
    docs, labels, marks = _frames(spark)
    taken = {}
    monkeypatch.setattr(toxicity, "start", lambda w, t, share, made=toxicity.start: taken.update(w=w, share=share) or made(w, t, share))
    model = toxicity.fit(docs, labels, part_rows=50, epochs=2)
    learnt = [m for m in marks if zlib.crc32(str(m[0]).encode()) % 5]
    calibration = {r.doc_id for r in docs.selectExpr("doc_id", f"xxhash64(doc_id, 3) % {toxicity.CALIBRATION_FOLD} = 0 AS c").where("c").collect()}
    trained = [m for m in learnt if m[0] not in calibration]
    idiot = toxicity.word_hashes(np.frombuffer(b"idiot", np.uint8), np.array([0, 5]))[0]
    text = {r.doc_id: r.text.split() for r in docs.collect()}
    uses = sum("idiot" in text[m[0]] for m in trained)
    assert all(taken["w"][r[0]] >= uses > 0 for r in toxicity.rows_of(idiot)) and taken["w"].max() < len(trained)
    assert taken["share"] == pytest.approx(sum(m[2] for m in trained) / len(trained))
    assert model.prior == pytest.approx(sum(m[2] for m in learnt) / len(learnt))


@pytest.mark.parametrize("part_rows", [60, 10_000])
def test_parts_of_any_size_give_a_good_model(spark, part_rows):
    docs, labels, marks = _frames(spark)
    model = toxicity.fit(docs, labels, part_rows=part_rows)
    got = [(r.score >= 0.5, r.flagged, marks[r.id][2]) for r in toxicity.score(docs, model).collect()
           if zlib.crc32(str(r.id).encode()) % 5 == 0]
    assert sum(p == (y == 1) for p, _, y in got) >= 0.95 * len(got)
    assert sum(f == (y == 1) for _, f, y in got) >= 0.95 * len(got)


def test_thresholds_are_those_of_all_scores(spark):
    rng = random.Random(3)
    rows = [(g, max(0.0, min(1.0, rng.gauss(0.6 if t else 0.3, 0.2))), t) for g in "ab" for t in [0] * 300 + [1] * 60]
    got = {r.g: r for r in toxicity.best_thresholds(spark.createDataFrame(rows, "g string, score double, toxic int"), "g").collect()}
    for g in "ab":
        p, y = (np.array(v) for v in zip(*[(s, t) for k, s, t in rows if k == g]))
        f1 = lambda cut: 2 * y[p >= cut].sum() / ((p >= cut).sum() + y.sum())
        assert got[g].hits == 60 and f1(got[g].threshold) == pytest.approx(max(map(f1, p)), abs=0.005)
