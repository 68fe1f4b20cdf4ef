"""Toxicity scores from a convolutional text classifier written in numpy.

A word is hashed to two rows of an embedding table (their sum is its vector, so
two words are confused only if both hashes meet). Filters of several widths run
over the word vectors of a text, a rectifier and the maximum over all positions
follow, and one logistic unit gives the score. Training uses every labelled row that
is not held out. It is mini-batch gradient descent with Adagrad, spread by iterative
parameter mixing: the rows are dealt to parts of about ``PART_ROWS`` by the hash of their
id; in each round every part goes on from the same model, and the parts' models and
Adagrad sums are averaged (an embedding row over the parts that changed it). The
two labels weigh the same in training, and the prior is put back afterwards. Embedding
rows used by fewer than ``MIN_TEXTS`` training texts are zero, so an unknown word is
neutral. The first embedding dimension starts at the log-odds of the row's words, counted
over all training rows.

A fold of the labelled rows is not trained on; on the whole fold a threshold is chosen for
each language (best F1; pooled where a language has too few toxic rows), from the counts
of its scores in ``BINS`` equal bins. Language, source, labels and ids are never inputs of
a score. The model has a fixed size (2**TABLE_BITS x DIM floats), so every task may hold
it; it, its sums and one row per language are all that reaches the driver. Texts are scored
whole, in blocks of whole texts.

Defined cases: null and empty texts have no word and get the score of the bias;
without labelled rows of both kinds every score is the share of toxic labels;
repeated rows and extra columns change nothing; a row without an id is held out;
a language without a threshold of its own uses the pooled one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import U64, buffers, held_out, keep, ship_code, word_hashes

TABLE_BITS = 17
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 16
#: Labelled rows of a part; a part of longer texts is cut at so many bytes of word hashes.
PART_ROWS = 4000
PART_BYTES = 24_000_000
EPOCHS = 8
BATCH = 64
RATE = 0.1
#: Rows used by fewer training texts stay zero.
MIN_TEXTS = 2
#: Texts that a row's log-odds are shrunk by.
PRIOR_TEXTS = 10
CALIBRATION_FOLD = 5
MIN_TOXIC = 20
#: Bins of the scores from 0 to 1 for the thresholds.
BINS = 10_000
BLOCK = 2_000_000
#: Bits (8 MB at most) of the filter that keeps texts without a label from being moved.
FILTER_BITS = 26


@dataclass
class Net:
    table: np.ndarray           # rows x DIM
    filters: list[np.ndarray]   # for each width: width x DIM x FILTERS
    biases: list[np.ndarray]
    out: np.ndarray
    shift: np.ndarray           # one number: the output bias

    def dense(self) -> list[np.ndarray]:
        """All parameters but the table."""
        return [self.out, self.shift, *self.filters, *self.biases]


@dataclass
class Sums:
    """Adagrad's sums of squares: of the dense parameters, and one for each table row."""
    dense: list[np.ndarray]
    table: np.ndarray


def fresh_sums(net: Net) -> Sums:
    return Sums([np.full(p.shape, 1e-4, np.float32) for p in net.dense()], np.full(len(net.table), 1e-3, np.float32))


def rows_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = U64((1 << TABLE_BITS) - 1)
    return (hashes & size).astype(np.int64), ((hashes >> U64(32)) & size).astype(np.int64)


def laid_out(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the words with blanks after each text; where each text begins."""
    n = len(first) - 1
    starts = first[:-1] + np.arange(n) * max(WIDTHS)
    words = np.diff(first)
    at = np.arange(first[-1]) + np.repeat(np.arange(n) * max(WIDTHS), words)
    return at, starts


def vectors(net: Net, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, starts = laid_out(hashes, first)
    a, b = rows_of(hashes)
    x = np.zeros((first[-1] + (len(first) - 1) * max(WIDTHS) + max(WIDTHS), DIM), np.float32)
    x[at] = net.table[a] + net.table[b]
    return x, starts


def convolved(net: Net, x: np.ndarray, k: int) -> np.ndarray:
    """Filter responses of width WIDTHS[k] at all positions but the closing blanks."""
    n = len(x) - max(WIDTHS)
    out = x[:n] @ net.filters[k][0]
    for j in range(1, WIDTHS[k]):
        out += x[j:j + n] @ net.filters[k][j]
    return out


def logits(net: Net, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One logit for each text of a block. The blanks make sure that each has a position."""
    if len(first) < 2:
        return np.zeros(0)
    x, starts = vectors(net, hashes, first)
    pooled = [np.maximum(np.maximum.reduceat(convolved(net, x, k), starts, axis=0) + net.biases[k], 0)
              for k in range(len(WIDTHS))]
    return np.concatenate(pooled, axis=1).astype(np.float64) @ net.out + net.shift[0]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def start(with_row: np.ndarray, toxic_row: np.ndarray, share: float, seed: int = 11) -> Net:
    """The untrained model: for each table row the texts and toxic texts that use it, and the share of toxic texts."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.05, (1 << TABLE_BITS, DIM)).astype(np.float32)
    odds = np.log((toxic_row + PRIOR_TEXTS * share) / (with_row - toxic_row + PRIOR_TEXTS * (1 - share)) * (1 - share) / share)
    table[:, 0] = np.clip(odds, -3, 3) / 3
    table[with_row < MIN_TEXTS] = 0
    filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0, ::2] = np.abs(f[:, 0, ::2]) + 0.5
    return Net(table, filters, [np.full(FILTERS, 0.05, np.float32) for _ in WIDTHS],
               rng.normal(0, 0.1, FILTERS * len(WIDTHS)), np.zeros(1))


def train_round(net: Net, sums: Sums, texts: list[np.ndarray], y: np.ndarray, weights: np.ndarray, epoch: int, seed: int = 11) -> None:
    """One pass over word hashes of texts and 0/1 labels; changes ``net`` and ``sums``."""
    used = np.abs(net.table).sum(1) > 0
    seen = {id(p): q for p, q in zip(net.dense(), sums.dense)}
    table_seen = sums.table

    def step(p: np.ndarray, g: np.ndarray, rate: float) -> None:
        seen[id(p)] += (g * g).astype(np.float32)
        p -= rate * g / np.sqrt(seen[id(p)])

    rate = RATE / (1 + epoch)
    order = np.random.default_rng([seed, epoch]).permutation(len(y))
    for i in range(0, len(order), BATCH):
        pick = order[i:i + BATCH]
        words = np.concatenate([texts[j] for j in pick])
        first = np.concatenate([[0], np.cumsum([len(texts[j]) for j in pick])])
        x, starts = vectors(net, words, first)
        owner = np.repeat(np.arange(len(pick)), np.diff(np.append(starts, len(x) - max(WIDTHS))))
        tops, values = [], []
        for k in range(len(WIDTHS)):
            c = convolved(net, x, k)
            at, which = np.nonzero(c == np.maximum.reduceat(c, starts, axis=0)[owner])
            top = np.zeros((len(pick), FILTERS), np.int64)
            top[owner[at[::-1]], which[::-1]] = at[::-1]  # the first of equal maxima
            tops.append(top)
            values.append(c[top, np.arange(FILTERS)] + net.biases[k])
        hidden = np.maximum(np.concatenate(values, axis=1), 0)
        wrong = (sigmoid(hidden @ net.out + net.shift[0]) - y[pick]) * weights[pick] / len(pick)
        back = (wrong[:, None] * net.out[None, :]).astype(np.float32) * (hidden > 0)
        step(net.out, hidden.T @ wrong + 1e-5 * net.out, rate)
        step(net.shift, np.array([wrong.sum()]), rate)
        at, _ = laid_out(words, first)
        word_at = np.full(len(x), -1, np.int64)
        word_at[at] = np.arange(len(words))
        where, push = [], []
        for k, width in enumerate(WIDTHS):
            g = back[:, k * FILTERS:(k + 1) * FILTERS]
            grad = np.zeros_like(net.filters[k])
            for j in range(width):
                grad[j] = np.einsum("bfd,bf->df", x[tops[k] + j], g)
                where.append(word_at[tops[k] + j].ravel())
                push.append((g[:, :, None] * net.filters[k][j].T[None]).reshape(-1, DIM))
            step(net.filters[k], grad, rate)
            step(net.biases[k], g.sum(0), rate)
        where, push = np.concatenate(where), np.concatenate(push)
        keep = where >= 0
        a, b = rows_of(words[where[keep]])
        rows, slot = np.unique(np.concatenate([a, b]), return_inverse=True)
        grad = np.zeros((len(rows), DIM), np.float32)
        np.add.at(grad, slot, np.concatenate([push[keep]] * 2))
        grad[~used[rows]] = 0
        table_seen[rows] += (grad * grad).mean(1)
        net.table[rows] -= rate * grad / np.sqrt(table_seen[rows])[:, None]


# -- on Spark --------------------------------------------------------------------------

def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, off in buffers(batch.column(4), BLOCK):
            h, _, _, first = word_hashes(data, off)
            words = [h[first[i]:first[i + 1]].tobytes() for i in range(b - a)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(a, b - a) for c in range(4)), pa.array(words, pa.binary())],
                ["part", "lang", "toxic", "calibrate", "words"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(texts as word hashes, labels) of each part in these (part, toxic, words) rows, in an order that depends on the rows only."""
    held, part, size = [], None, 0

    def made():
        held.sort()
        return [np.frombuffer(w, U64) for w, _ in held], np.array([t for _, t in held], np.float64)

    for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
        for p, toxic, words in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (p != part or size > PART_BYTES):
                yield made()
                held, size = [], 0
            part, size = p, size + len(words)
            held.append((words, toxic))
    if held:
        yield made()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, texts, toxic texts) of the table rows that the texts of a task use."""
    with_row, toxic_row = np.zeros(1 << TABLE_BITS, np.int64), np.zeros(1 << TABLE_BITS, np.int64)
    for texts, y in _parts(batches):
        for words, label in zip(texts, y):
            rows = np.unique(np.concatenate(rows_of(words)))
            with_row[rows] += 1
            toxic_row[rows] += int(label)
    rows = np.flatnonzero(with_row)
    yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(with_row[rows]), pa.array(toxic_row[rows])], ["row", "texts", "toxic"])


def _flat(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([a.ravel() for a in arrays]).astype(np.float64)


def _unflat(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    ends = np.cumsum([a.size for a in like])
    return [flat[e - a.size:e].reshape(a.shape).astype(a.dtype) for a, e in zip(like, ends)]


# The changes of a round: table rows from 0; the dense parameters and their sums are rows of the same width below 0.
_VALUES = [f"v{i}" for i in range(DIM + 1)]
_CHANGES = "row long, " + ", ".join(f"{v} double" for v in _VALUES)


def _dense_rows(net: Net, sums: Sums) -> np.ndarray:
    flat = _flat([*net.dense(), *sums.dense])
    return np.pad(flat, (0, -len(flat) % len(_VALUES))).reshape(-1, len(_VALUES))


def _trained(net: Net, sums: Sums, share: float, epoch: int):
    """For each part of a task what a pass over it adds to the model and the sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, y in _parts(batches):
            mine = Net(net.table.copy(), [f.copy() for f in net.filters], [b.copy() for b in net.biases], net.out.copy(), net.shift.copy())
            own = Sums([d.copy() for d in sums.dense], sums.table.copy())
            train_round(mine, own, texts, y, np.where(y > 0, 0.5 / share, 0.5 / (1 - share)), epoch)
            rows = np.flatnonzero(own.table != sums.table)
            table = np.concatenate([mine.table[rows] - net.table[rows], (own.table[rows] - sums.table[rows])[:, None]], axis=1).astype(np.float64)
            dense = _dense_rows(mine, own) - _dense_rows(net, sums)
            values = np.concatenate([table, dense])
            at = np.concatenate([rows, -1 - np.arange(len(dense))])
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(values[:, i]) for i in range(len(_VALUES)))], ["row", *_VALUES])
    return run


def _mixed(net: Net, sums: Sums, changes: pa.Table) -> tuple[Net, Sums]:
    """The model and the sums with the mean changes added."""
    at = changes.column("row").to_numpy()
    values = np.stack([changes.column(v).to_numpy() for v in _VALUES], axis=1)
    rows = at >= 0
    table, table_sums = net.table.copy(), sums.table.copy()
    table[at[rows]] += values[rows, :DIM].astype(np.float32)
    table_sums[at[rows]] += values[rows, DIM].astype(np.float32)
    dense = _dense_rows(net, sums)
    dense[-1 - at[~rows]] += values[~rows]
    parts = _unflat(dense.ravel(), [*net.dense(), *sums.dense])
    n, k = len(net.dense()), len(WIDTHS)
    out, shift, *others = parts[:n]
    return Net(table, others[:k], others[k:], out, shift), Sums(parts[n:], table_sums)


def _scored_marks(net: Net):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            words = [np.frombuffer(w, U64) for w in batch.column(2).to_pylist()]
            p = [float(sigmoid(logits(net, w, np.array([0, len(w)])))[0]) for w in words]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p, pa.float64())], ["lang", "toxic", "score"])
    return run


def _perhaps_in(df: DataFrame, ids: DataFrame, col: str) -> DataFrame:
    """``df`` without nearly all rows whose ``col`` is not in ``ids``: a filter of 2**FILTER_BITS bits at any size, set
    by the hashes of the ids. An exact join has to follow; it moves few rows in vain."""
    slot = F.pmod(F.xxhash64(col, F.lit(13)), F.lit(1 << FILTER_BITS)) + 1
    bits = ids.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits"))
    marked = df.withColumn("_slot", slot).withColumn("_bucket", F.bitmap_bucket_number("_slot")).join(F.broadcast(bits), "_bucket")
    byte = "CAST(conv(hex(substring(_bits, CAST(bitmap_bit_position(_slot) DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    return marked.where(f"getbit({byte}, CAST(bitmap_bit_position(_slot) % 8 AS INT)) = 1").select(*df.columns)


def best_thresholds(scored: DataFrame, group: str) -> DataFrame:
    """(group, threshold, hits): the cut of each group's (score, toxic) rows with the best F1, in the middle between two
    scores. Cuts lie between bins of the scores, so a group's window has ``BINS`` + 1 rows at most."""
    bins = scored.groupBy(group, F.floor(F.col("score") * BINS).alias("bin")).agg(
        F.count("*").alias("n"), F.sum("toxic").alias("hit"), F.min("score").alias("low"), F.max("score").alias("high"))
    falling = Window.partitionBy(group).orderBy(F.col("bin").desc())
    so_far = falling.rowsBetween(Window.unboundedPreceding, 0)
    cuts = bins.select(
        group, "bin", ((F.col("low") + F.coalesce(F.lead("high").over(falling), F.lit(0.0))) / 2).alias("cut"),
        F.sum("hit").over(Window.partitionBy(group)).alias("hits"), F.sum("hit").over(so_far).alias("caught"),
        F.sum("n").over(so_far).alias("taken"))
    f1 = 2 * F.col("caught") / (F.col("taken") + F.col("hits"))
    return cuts.groupBy(group).agg(F.max_by("cut", F.struct(f1, "bin")).alias("threshold"), F.max("hits").alias("hits"))


@dataclass
class Classifier:
    net: Net | None
    prior: float
    thresholds: dict[str, float]   # by language
    pooled: float


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", part_rows: int = PART_ROWS, epochs: int = EPOCHS) -> Classifier:
    """Train on all labelled rows that are not held out."""
    ship_code(docs.sparkSession)
    marks = labels.where("toxic IS NOT NULL").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marks = keep(marks.where(~held_out("label_id")), "toxicity_marks")
    share, n = marks.agg(F.avg("toxic"), F.count("*")).first()
    parts = max(1, -(-n // part_rows))
    texts = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    calibrate = F.xxhash64(F.col("label_id"), F.lit(3)) % CALIBRATION_FOLD == 0
    # both sides are dealt to the parts: one part is one partition here, and one file
    dealt = _perhaps_in(texts, marks, "label_id").repartition(parts, "label_id").join(marks.repartition(parts, "label_id"), "label_id")
    rows = keep(dealt.select(F.spark_partition_id().alias("part"), "lang", "toxic", calibrate.alias("calibrate"), "text").mapInArrow(
        _hashed, "part int, lang string, toxic int, calibrate boolean, words binary"), "toxicity")
    taught = rows.where("NOT calibrate").select("part", "toxic", "words")
    kinds = {r.calibrate: (r.n, r.hits) for r in rows.groupBy("calibrate").agg(F.count("*").alias("n"), F.sum("toxic").alias("hits")).collect()}
    size, toxic = kinds.get(False, (0, 0))
    if not 0 < toxic < size:
        return Classifier(None, float(share or 0.0), {}, 0.5)
    drawn = toxic / size
    counts = taught.coalesce(parts).mapInArrow(_counted, "row long, texts long, toxic long").groupBy("row").agg(
        F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic")).toArrow()
    with_row, toxic_row = np.zeros(1 << TABLE_BITS), np.zeros(1 << TABLE_BITS)
    with_row[counts.column("row").to_numpy()] = counts.column("texts").to_numpy()
    toxic_row[counts.column("row").to_numpy()] = counts.column("toxic").to_numpy()
    net = start(with_row, toxic_row, drawn)
    sums = fresh_sums(net)
    for epoch in range(epochs):
        # a task sends its changes once: no more tasks than parts of full size
        changes = taught.coalesce(parts).mapInArrow(_trained(net, sums, drawn, epoch), _CHANGES).groupBy("row").agg(*[F.avg(v).alias(v) for v in _VALUES])
        net, sums = _mixed(net, sums, changes.toArrow())
    # both labels weigh the same in training; in the data they do not
    net.shift = net.shift + np.log(share / (1 - share))
    judged = rows.where("calibrate") if kinds.get(True, (0, 0))[1] >= MIN_TOXIC else rows
    scored = keep(judged.select("lang", "toxic", "words").mapInArrow(_scored_marks(net), "lang string, toxic int, score double"), "toxicity_scores")
    pooled = best_thresholds(scored.withColumn("all", F.lit(True)), "all").first().threshold
    own = best_thresholds(scored.withColumn("lang", F.coalesce("lang", F.lit(""))), "lang").where(F.col("hits") >= MIN_TOXIC)
    return Classifier(net, float(share), {r.lang: r.threshold for r in own.orderBy("lang").collect()}, pooled)


def _score(net: Net):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for a, b, data, off in buffers(batch.column(2), BLOCK):
                h, _, _, first = word_hashes(data, off)
                out[a:b] = sigmoid(logits(net, h, first))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], ["id", "lang", "score"])
    return run


def score(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, score, threshold, flagged): the threshold is that of the row's language."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    if model.net is None:
        scored = plain.select("id", "lang", F.lit(model.prior).alias("score"))
    else:
        ship_code(docs.sparkSession)
        kind = plain.schema["id"].dataType.simpleString()
        scored = plain.mapInArrow(_score(model.net), f"id {kind}, lang string, score double")
    cut = F.lit(model.pooled)
    for lang, value in model.thresholds.items():
        cut = F.when(F.coalesce("lang", F.lit("")) == lang, value).otherwise(cut)
    return scored.select("id", "score", cut.alias("threshold"), (F.col("score") >= cut).alias("flagged"))


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's result, with the language's threshold beside it."""
    return score(docs, fit(docs, labels)).select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", "flagged")
