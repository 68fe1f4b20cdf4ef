"""Quality rules: base counts of a text, then line labels by a conditional random field.

Base counts and the two base rules (too few words, too many words in repeated
8-word windows) are arithmetic. The verdict on the other documents is that of a
linear-chain conditional random field over the lines that hold a word: Viterbi
decoding marks each line as content or boilerplate, and a document stays when at
least ``MIN_SHARE`` of its words are in content lines.

The field has one weight for each line feature (``FEATURES``), four transition
weights and two for the first line; it is trained here by maximum conditional
likelihood with forward-backward sums. Labels of lines come from labelled documents:
the lines of a good document are content, those of a junk document boilerplate; in
further rounds a junk document's lines that the field itself finds to be content
with ``SURE`` become content, because junk is often mixed with ordinary lines.

Scale: a scan without a shuffle; the field is learnt from a bounded sample
(``TRAIN_DOCS`` documents of each label, at most ``TRAIN_LINES`` lines of each, which
reach the driver as one bit set a line) and its few numbers travel in the closure. Sample
rows are drawn by the hash of (id, text), identical rows once, so that neither a
much-repeated id nor copies fill it.

Defined cases: a null or empty text has no words and fails the base rules; a text
is handled whole at any length; equal texts have equal results; rows without an id
are judged like others; repeated rows are rows of their own; without labels of both
kinds every line is content; labels that contradict each other count as junk; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import SPACE_BYTES, U64, buffers, keep, mix, prefix_sums, runs, ship_code, span_hashes

MIN_WORDS = 20
MAX_REPEAT_PCT = 30
WINDOW = 8
MIN_SHARE = 0.5
TRAIN_DOCS = 2000
TRAIN_LINES = 64
SURE = 0.9
ROUNDS = 3
STEPS = 150
#: Weight of the squared weights in the training sum.
RIDGE = 1.0

#: Bytes counted as symbols.
SYMBOLS = b"#*$%&|<>"
# Names of the line features, in bit order.
FEATURES = ["always", "symbols a word >= 0.1", "symbols a word >= 0.5", "symbols a word >= 1.5",
            "capitals of letters >= 0.3", "capitals of letters >= 0.8", "exclamation marks a word >= 0.1",
            "exclamation marks a word >= 0.5", "digits of characters >= 0.1", "digits of characters >= 0.3",
            "word length < 3", "word length > 10", "word length > 20", "words < 3", "words < 8", "words >= 20",
            "equal to an earlier line", "words in repeated windows > 0", "words in repeated windows > 0.5",
            "ends as a sentence", "has ://", "bars a word >= 0.1"]


def _table(members: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(members)] = True
    return t


IS_SYMBOL = _table(SYMBOLS)
IS_UPPER = _table(bytes(range(65, 91)))
IS_LETTER = _table(bytes([*range(65, 91), *range(97, 123)]))
IS_DIGIT = _table(b"0123456789")
IS_END = _table(b".!?;:")


@dataclass
class Measured:
    """Counts of the texts of a block, and of their lines that hold a word."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    line_text: np.ndarray     # text of each line
    line_words: np.ndarray    # words of each line
    features: np.ndarray      # lines x features, 0 or 1


def _sums(flags: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each span [at, ends)."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[at]


def lines_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end of every line; a text has one line more than line feeds."""
    feeds = np.flatnonzero(data == 10)
    n = 1 + np.diff(np.searchsorted(feeds, off))
    first = np.cumsum(n) - n
    starts, ends = np.empty(int(n.sum()), np.int64), np.empty(int(n.sum()), np.int64)
    is_first = np.zeros(len(starts), bool)
    is_first[first] = True
    is_last = np.zeros(len(starts), bool)
    is_last[first + n - 1] = True
    starts[is_first], starts[~is_first] = off[:-1], feeds + 1
    ends[is_last], ends[~is_last] = off[1:], feeds
    return np.repeat(np.arange(len(n)), n), starts, ends


def repeated_words(hashes: np.ndarray, text: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Whether each word is in a window of words that its text holds twice or more."""
    n = len(hashes) - window + 1
    covered = np.zeros(len(hashes), bool)
    if n <= 0:
        return covered
    key = text[:n].astype(U64)
    for k in range(window):
        key = mix(key ^ hashes[k:n + k])
    whole = np.flatnonzero(text[:n] == text[window - 1:])
    order = whole[np.argsort(key[whole], kind="stable")]
    same = (key[order][1:] == key[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, order[twice], 1)
    np.add.at(edge, order[twice] + window, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(data: np.ndarray, off: np.ndarray) -> Measured:
    """All counts of a block of texts (bytes and offsets)."""
    inside = ~SPACE_BYTES[data]
    starts, ends = runs(inside, off)
    point = (data & 0xC0) != 0x80
    first_word = np.searchsorted(starts, off)
    word_text = np.repeat(np.arange(len(off) - 1), np.diff(first_word))
    sums = prefix_sums(data)
    hashes = span_hashes(sums, starts, ends) if len(starts) else np.zeros(0, U64)
    covered = repeated_words(hashes, word_text)
    at, to = off[:-1], off[1:]

    text, ls, le = lines_of(data, off)
    wa, we = np.searchsorted(starts, ls), np.searchsorted(starts, le)
    some = we > wa
    text, ls, le, wa, we = (x[some] for x in (text, ls, le, wa, we))
    words = we - wa
    line_hash = span_hashes(sums, ls, le) if len(ls) else np.zeros(0, U64)
    order = np.lexsort((np.arange(len(ls)), line_hash, text))
    dup = np.zeros(len(ls), bool)
    dup[order[1:]] = ((text[order][1:] == text[order][:-1]) & (line_hash[order][1:] == line_hash[order][:-1])
                      & ((le - ls)[order][1:] == (le - ls)[order][:-1]))

    per = lambda flags: _sums(flags, ls, le)
    chars = np.maximum(per(inside & point), 1)
    w = np.maximum(words, 1)
    symbols, marks, bars = per(IS_SYMBOL[data]) / w, per(data == 33) / w, per(data == 124) / w
    capitals = per(IS_UPPER[data]) / np.maximum(per(IS_LETTER[data]), 1)
    digits = per(IS_DIGIT[data]) / chars
    length = chars / w
    again = _sums(covered, wa, we) / w
    link = np.zeros(len(data), bool)
    link[:-2] = (data[:-2] == 58) & (data[1:-1] == 47) & (data[2:] == 47)
    closing = IS_END[data[ends[we - 1] - 1]] if len(ls) else np.zeros(0, bool)
    features = np.stack([np.ones(len(ls), bool), symbols >= 0.1, symbols >= 0.5, symbols >= 1.5, capitals >= 0.3,
                         capitals >= 0.8, marks >= 0.1, marks >= 0.5, digits >= 0.1, digits >= 0.3, length < 3,
                         length > 10, length > 20, words < 3, words < 8, words >= 20, dup, again > 0, again > 0.5,
                         closing, per(link) > 0, bars >= 0.1], axis=1)
    return Measured(np.diff(first_word), _sums(inside & point, at, to), _sums(IS_SYMBOL[data], at, to),
                    np.bincount(text[dup], minlength=len(off) - 1), _sums(covered, first_word[:-1], first_word[1:]),
                    text, words, features)


# -- the field --------------------------------------------------------------------------
# Label 0 is boilerplate, label 1 content.

@dataclass
class Field:
    weights: np.ndarray       # of the features, for content against boilerplate
    moves: np.ndarray         # 2 x 2: from label, to label
    first: np.ndarray         # 2: of the first line's label

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights, self.moves.ravel(), self.first])

    @staticmethod
    def of(flat: np.ndarray) -> "Field":
        return Field(flat[:-6], flat[-6:-2].reshape(2, 2), flat[-2:])


#: Without labels: every line is content.
NO_FIELD = Field(np.array([1.0] + [0.0] * (len(FEATURES) - 1)), np.zeros((2, 2)), np.zeros(2))


def _by_length(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line and length of each sequence, longest first, and how many are longer than t."""
    _, start, length = np.unique(text, return_index=True, return_counts=True)
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    longest = int(length[0]) if len(length) else 0
    return start, length, np.searchsorted(-length, -np.arange(longest), "left")


def decode(field: Field, features: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Viterbi: the likeliest labels of the lines of each text (ties: content).

    ``text`` numbers the lines' texts in order; all texts go forward together.
    """
    n = len(text)
    labels = np.zeros(n, np.int8)
    if not n:
        return labels
    score = features @ field.weights
    start, length, active = _by_length(text)
    back = np.zeros((n, 2), np.int8)
    best = np.stack([np.full(len(start), field.first[0]), field.first[1] + score[start]], axis=1)
    for t in range(1, len(active)):
        a = active[t]
        at = start[:a] + t
        come = best[:a, :, None] + field.moves[None]
        back[at] = come[:, 1] >= come[:, 0]
        best[:a] = np.maximum(come[:, 0], come[:, 1])
        best[:a, 1] += score[at]
    now = (best[:, 1] >= best[:, 0]).astype(np.int8)
    for t in range(len(active) - 1, -1, -1):
        a = active[t]
        at = start[:a] + t
        labels[at] = now[:a]
        now[:a] = back[at, now[:a]]
    return labels


def expected(field: Field, features: np.ndarray, text: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Log normalisers, marginals of content, expected moves and first labels (forward-backward)."""
    n = len(text)
    score = np.stack([np.zeros(n), features @ field.weights], axis=1)
    start, length, active = _by_length(text)
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    alpha[start] = field.first + score[start]
    for t in range(1, len(active)):
        at = start[:active[t]] + t
        alpha[at] = np.logaddexp(alpha[at - 1, 0, None] + field.moves[0], alpha[at - 1, 1, None] + field.moves[1]) + score[at]
    for t in range(len(active) - 1, 0, -1):
        at = start[:active[t]] + t
        out = beta[at] + score[at]
        beta[at - 1] = np.logaddexp(field.moves[:, 0] + out[:, 0, None], field.moves[:, 1] + out[:, 1, None])
    norm = np.logaddexp(alpha[start + length - 1, 0], alpha[start + length - 1, 1])
    z = np.zeros(n)
    for t in range(len(active)):
        z[start[:active[t]] + t] = norm[:active[t]]
    content = np.exp(alpha[:, 1] + beta[:, 1] - z)
    follows = np.ones(n, bool)
    follows[start] = False
    at = np.flatnonzero(follows)
    pair = np.exp(alpha[at - 1][:, :, None] + field.moves + (beta[at] + score[at])[:, None, :] - z[at, None, None])
    return float(norm.sum()), content, pair.sum(0), np.array([np.sum(1 - content[start]), np.sum(content[start])])


def likelihood(flat: np.ndarray, features: np.ndarray, text: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray]:
    """Penalised conditional log-likelihood of the labels, and its gradient."""
    field = Field.of(flat)
    norm, content, moves, first = expected(field, features, text)
    begins = np.r_[True, text[1:] != text[:-1]]
    at = np.flatnonzero(~begins)
    seen_moves = np.zeros((2, 2))
    np.add.at(seen_moves, (labels[at - 1], labels[at]), 1)
    seen_first = np.bincount(labels[begins], minlength=2).astype(float)
    value = float((features @ field.weights) @ labels + (seen_moves * field.moves).sum() + seen_first @ field.first - norm)
    grad = np.concatenate([features.T @ (labels - content), (seen_moves - moves).ravel(), seen_first - first])
    return value - RIDGE / 2 * float(flat @ flat), grad - RIDGE * flat


def fit(features: np.ndarray, text: np.ndarray, junk: np.ndarray) -> Field:
    """Train on lines in order of their texts; ``junk`` marks the lines of junk documents.

    Rounds of ascent with a step for each weight that grows while its gradient keeps
    its sign and shrinks where it turns; between rounds the sure content lines of
    junk documents are relabelled.
    """
    labels = (~junk).astype(np.int64)
    if not len(text) or labels.min() == labels.max():
        return NO_FIELD
    features = features.astype(float)
    flat = np.zeros(features.shape[1] + 6)
    for _ in range(ROUNDS):
        step, last = np.full(len(flat), 0.05), np.zeros(len(flat))
        for _ in range(STEPS):
            _, grad = likelihood(flat, features, text, labels)
            turn = np.sign(grad) * np.sign(last)
            step = np.clip(np.where(turn > 0, step * 1.2, np.where(turn < 0, step * 0.5, step)), 1e-6, 0.5)
            last = np.where(turn < 0, 0.0, grad)
            flat = flat + np.sign(last) * step
        content = expected(Field.of(flat), features, text)[1]
        again = np.where(junk & (content < SURE), 0, 1)
        if (again == labels).all() or again.min() == again.max():
            break
        labels = again
    return Field.of(flat)


# -- on tables -----------------------------------------------------------------------------

def _line_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, label, text) into (key, label, bit sets of the features of the first lines)."""
    power = 1 << np.arange(len(FEATURES), dtype=np.int64)
    for batch in batches:
        sets = []
        for _, _, data, off in buffers(batch.column(2)):
            m = measure(data, off)
            bits = m.features @ power
            cut = np.searchsorted(m.line_text, np.arange(len(off)))
            sets += [bits[a:min(b, a + TRAIN_LINES)] for a, b in zip(cut[:-1], cut[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.list_(pa.int64()))],
                                         ["key", "label", "lines"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Field:
    """The field learnt from a bounded sample of labelled documents."""
    ship_code(docs.sparkSession)
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(
        F.col(id_col).alias("_marked")).agg(F.min(F.col(label_col)).cast("int").alias("_mark"))
    draw = F.xxhash64(F.lit("rules"), "_marked")
    ids = [marks.where(F.col("_mark") == v).orderBy(draw, "_marked").limit(TRAIN_DOCS) for v in (0, 1)]
    chosen = keep(ids[0].union(ids[1]), "rule_labels")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        chosen, F.col("_id") == F.col("_marked"))
    sets = keep(rows.select(F.xxhash64("_id", "_text").alias("key"), "_mark", "_text")
                .mapInArrow(_line_sets, "key long, label int, lines array<long>")
                .groupBy("key").agg(F.min(F.struct("label", "lines")).alias("s")).select("key", "s.label", "s.lines"),
                "rule_lines")
    seqs, junk = [], []
    for v in (0, 1):
        for r in sets.where(F.col("label") == v).orderBy("key").limit(TRAIN_DOCS).collect():
            if r["lines"]:
                seqs.append(np.array(r["lines"], np.int64))
                junk.append(v == 0)
    if not seqs:
        return NO_FIELD
    bits = np.concatenate(seqs)
    features = (bits[:, None] >> np.arange(len(FEATURES))) & 1
    sizes = [len(s) for s in seqs]
    return fit(features, np.repeat(np.arange(len(seqs)), sizes), np.repeat(np.array(junk), sizes))


def label_lines(text: str | None, field: Field) -> list[tuple[str, bool | None]]:
    """The lines of one text, each with whether it is content (None: it holds no word)."""
    lines = (text or "").split("\n")
    data = np.frombuffer((text or "").encode(), np.uint8)
    m = measure(data, np.array([0, len(data)]))
    marks = iter(decode(field, m.features, m.line_text))
    worded = [bool(x.strip("\x20\x09\x0a\x0b\x0c\x0d")) for x in lines]
    return [(x, bool(next(marks)) if w else None) for x, w in zip(lines, worded)]


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, content share and verdict of every row: ``id``, ``COUNTS``, ``content_share``
    (null without words), ``base_failed``, ``kept``."""
    ship_code(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in buffers(batch.column(1)):
                m = measure(data, off)
                marks = decode(field, m.features, m.line_text)
                good = np.bincount(m.line_text, weights=m.line_words * marks, minlength=b - a)
                share = good / np.maximum(m.n_words, 1)
                failed = (m.n_words < MIN_WORDS) | (100 * m.n_repeat_words > MAX_REPEAT_PCT * m.n_words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *[pa.array(getattr(m, c), pa.int64()) for c in COUNTS],
                     pa.array(share, pa.float64(), mask=m.n_words == 0), pa.array(failed),
                     pa.array(~failed & (share >= MIN_SHARE))],
                    ["id", *COUNTS, "content_share", "base_failed", "kept"])

    kind = plain.schema["id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return plain.mapInArrow(verdicts, f"id {kind}, {counts}, content_share double, base_failed boolean, kept boolean")


def rules_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's result, one row per document."""
    return judge(docs, train(docs, labels)).withColumnRenamed("id", "doc_id")
