"""Language identification with blended-spectrum string kernels.

The kernel of two texts is the number of byte n-grams (n = 1 to ``MAX_GRAM``,
letters in lower case, everything else ASCII as a blank) present in both, over
the geometric mean of their numbers of n-grams. n-grams are hashed into ``SLOTS``
presence slots. A Nyström map over ``LANDMARKS`` landmark texts turns the kernel
into features; one-versus-rest kernel ridge regression is solved on them.
Scoring is two matrix products for a batch of texts: presence x landmarks, and
kernel values x weights.

Learning uses a bounded sample: about ``TRAIN_ROWS`` labelled rows, an equal
share for each language, none of them held out. Its size is a parameter; the
model has a fixed size (LANDMARKS x SLOTS bits), so sending it to every task is
safe. All texts are scored whole.

Defined cases: null text or text without a letter is ``und`` with score 0; a
null language is never learnt from; without any labelled row everything is
``und``; repeated rows and extra columns change nothing; a row without an id
counts as held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import BLOCK_BYTES, LOWER, bounded_sample, buffers, held_out, ship_code

SLOTS = 8192
MAX_GRAM = 4
LANDMARKS = 256
TRAIN_ROWS = 2000
RIDGE = 1e-3
#: Texts in one matrix product.
BATCH_TEXTS = 1024

# ASCII letters in lower case, bytes of other scripts as they are, the rest a blank.
FOLD = np.array([b if b >= 128 else LOWER[b] if chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Boolean matrix texts x SLOTS: the hashed n-grams each text has."""
    n, gap = len(offsets) - 1, MAX_GRAM - 1
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    # blanks before each text keep its n-grams apart from its neighbours'
    padded = np.full(len(data) + gap * (n + 1), 32, np.uint32)
    padded[np.arange(len(data)) + gap * (owner + 1)] = FOLD[data]
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets) + gap) * SLOTS
    out = np.zeros(n * SLOTS, bool)
    code = np.zeros(len(row), np.uint32)
    for k in range(1, MAX_GRAM + 1):
        code = (code << np.uint32(8)) | padded[k - 1:k - 1 + len(row)]
        slot = ((code + np.uint32(k)) * np.uint32(2654435761)) >> np.uint32(32 - 13)
        out[row + slot] = True
    return out.reshape(n, SLOTS)


def blocks_of(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    for a, b, data, off in buffers(col, BLOCK_BYTES, BATCH_TEXTS):
        yield a, b, presence(data, off)


@dataclass
class Model:
    """Landmarks (packed bits), their n-gram counts, and one weight column for each language."""

    langs: list[str]
    bits: np.ndarray
    counts: np.ndarray
    weights: np.ndarray

    def landmarks(self) -> np.ndarray:
        return np.unpackbits(self.bits, axis=1).astype(np.float32)

    def margins(self, present: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
        shared = present.astype(np.float32) @ landmarks.T
        scale = np.sqrt(np.maximum(present.sum(1, dtype=np.float32), 1)[:, None] * self.counts[None, :])
        return (shared / scale) @ self.weights


def train(bits: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nyström kernel ridge regression from packed presence rows."""
    langs = sorted(set(labels))
    y = np.array([langs.index(v) for v in labels])
    # landmarks: in turn from each language
    turn = np.zeros(len(y), np.int64)
    for k in range(len(langs)):
        turn[y == k] = np.arange((y == k).sum())
    chosen = np.lexsort((y, turn))[:landmarks]
    z = np.unpackbits(bits[chosen], axis=1).astype(np.float32)
    counts = np.maximum(z.sum(1), 1)
    values, vectors = np.linalg.eigh((z @ z.T) / np.sqrt(np.outer(counts, counts)))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    gram = np.zeros((root.shape[1],) * 2)
    right = np.zeros((root.shape[1], len(langs)))
    for i in range(0, len(y), BATCH_TEXTS):
        x = np.unpackbits(bits[i:i + BATCH_TEXTS], axis=1).astype(np.float32)
        k = (x @ z.T) / np.sqrt(np.maximum(x.sum(1), 1)[:, None] * counts[None, :])
        phi = k @ root
        gram += phi.T @ phi
        right += phi.T @ np.where(y[i:i + BATCH_TEXTS, None] == np.arange(len(langs)), 1.0, -1.0)
    solved = np.linalg.solve(gram + ridge * len(y) * np.eye(len(gram)), right)
    return Model(langs, bits[chosen], counts.astype(np.float32), (root @ solved).astype(np.float32))


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, present in blocks_of(batch.column(1)):
            packed = np.packbits(present, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array([r.tobytes() for r in packed], pa.binary())], ["lang", "bits"])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        rows: int = TRAIN_ROWS) -> Model | None:
    """Model from a bounded sample of the rows that are not held out; None without labels."""
    ship_code(docs.sparkSession)
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known = known.where(~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = bounded_sample(known.select("doc_id", "lang"), "lang", rows).select("doc_id").distinct()
    taken = known.join(F.broadcast(ids), "doc_id", "left_semi").select("lang", "text").mapInArrow(
        _bits, "lang string, bits binary").collect()
    if not taken:
        return None
    taken.sort(key=lambda r: (r.lang, bytes(r.bits)))
    return train(np.stack([np.frombuffer(bytes(r.bits), np.uint8) for r in taken]), [r.lang for r in taken])


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        landmarks = model.landmarks()
        names = np.array(model.langs, object)
        for batch in batches:
            lettered = np.asarray(batch.column(2).fill_null(False)).astype(bool)
            best, score = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            for a, b, present in blocks_of(batch.column(1)):
                m = model.margins(present, landmarks)
                top = m.argmax(1)
                value = np.clip((m[np.arange(len(top)), top] + 1) / 2, 0, 1)
                has = lettered[a:b]
                best[a:b] = np.where(has, names[top], "und")
                score[a:b] = np.where(has, value, 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string()), pa.array(score)],
                                             ["id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        F.col(text_col).rlike(r"\p{L}").alias("lettered"))
    if model is None:
        return plain.select("id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    ship_code(docs.sparkSession)
    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(_score(model), f"id {kind}, lang_pred string, score double")


def langid_digest(docs: DataFrame) -> DataFrame:
    """The contract's result."""
    return predict(docs, fit(docs)).select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score")
