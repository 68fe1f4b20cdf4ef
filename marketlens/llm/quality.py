"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model is a byte 5-gram model (four begin marks before a text, one end mark
after it), trained on the trusted documents: those labelled quality 1, but for a
calibration fold. A document's perplexity per byte is compared with a threshold of
its language: the upper fence ``Q3 + FENCE * (Q3 - Q1)`` of the log-perplexities of
the language's calibration documents. Short texts are noisy; a log-perplexity is
averaged with ``PRIOR_BYTES`` bytes of the median before it is compared.

How the counts meet the documents, without moving a text more than once:

* documents are dealt into blocks by the hash of their id, as compressed chunks;
  labels are dealt the same way, so a block knows its trusted documents;
* a block sends each of its distinct 5-grams, with its count in trusted text, to
  the n-gram's shard. Shards merge them: the corpus counts, of all trusted text;
* continuation counts, discounts, context sums and probabilities of orders 1 to 5
  are grouped sums and joins on n-gram keys over the n-grams that occur at all;
* a shard answers each block with the log-probabilities of the n-grams it asked
  for (joined by shard), and the block adds them up for its documents.

What is gathered grows with the distinct n-grams of the corpus; nothing of it
reaches the driver but the four counts of counts of each order.

Defined cases: null text is empty (only the end mark is scored); without trusted
text every byte is equally likely and everything is kept; a language with fewer
than ``MIN_CALIBRATION`` calibration documents (a null language is one of its own)
uses the fence of all languages; without calibration documents everything is kept;
repeated ids are rows of their own; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.blocks import block_of, dealt, opened, text_bytes
from marketlens.llm.common import U64, keep, mix

ORDER = 5
BEGIN, END = 0xFF, 0xFE  # bytes that no UTF-8 text has
SYMBOLS = 257
#: Text of a block, and of the part of it that is turned into arrays at once.
BLOCK = 6_000_000
PART = 2_000_000
SHARD_BYTES = 32_000_000
FOLDS = 5
FENCE = 5.0
PRIOR_BYTES = 200
MIN_CALIBRATION = 20
#: Largest code table; wider alphabets are ranked by sorting.
MAX_TABLE = 1 << 26


# -- n-grams of a block --------------------------------------------------------------

def _ranked(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each code among the distinct ones, and those in order."""
    if size > MAX_TABLE:
        distinct, rank = np.unique(codes, return_inverse=True)
        return rank, distinct
    seen = np.zeros(size, bool)
    seen[codes] = True
    distinct = np.flatnonzero(seen)
    table = np.zeros(size, np.int32)
    table[distinct] = np.arange(len(distinct), dtype=np.int32)
    return table[codes], distinct


def padded(texts: list[bytes]) -> np.ndarray:
    lead, tail = bytes([BEGIN]) * (ORDER - 1), bytes([END])
    return np.frombuffer(b"".join(x for t in texts for x in (lead, t, tail)), np.uint8)


def grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 5-grams in order, and for each scored byte the place of its 5-gram."""
    n = len(data) - ORDER + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    one, alphabet = _ranked(data, 256)
    k = len(alphabet)
    two, pairs = _ranked(one[:-1].astype(np.int64) * k + one[1:], k * k)
    four, quads = _ranked(two[:-2].astype(np.int64) * len(pairs) + two[2:], len(pairs) ** 2)
    scored = np.flatnonzero(data[ORDER - 1:] != BEGIN)
    five, all_ = _ranked(four[:n][scored].astype(np.int64) * k + one[ORDER - 1:][scored], len(quads) * k)
    pair_value = (alphabet[pairs // k] << 8) | alphabet[pairs % k]
    quad_value = (pair_value[quads // len(pairs)] << 16) | pair_value[quads % len(pairs)]
    value = (quad_value[all_ // k].astype(U64) << U64(8)) | alphabet[all_ % k].astype(U64)
    return value, five


def shard_of(values: np.ndarray, shards: int) -> np.ndarray:
    return (mix(values.copy()) % U64(shards)).astype(np.int64)


# -- blocks ---------------------------------------------------------------------------

def _parts(texts: list[bytes]) -> Iterator[list[int]]:
    """Numbers of the texts that are handled at once."""
    part, size = [], 0
    for i, t in enumerate(texts):
        if part and size + len(t) > PART:
            yield part
            part, size = [], 0
        part.append(i)
        size += len(t)
    if part:
        yield part


def _fold(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode()) % FOLDS


def block_counts(ids: list, texts: list[bytes], trusted: set) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 5-grams of the texts and their counts in trusted text outside the calibration fold."""
    found, counts = [], []
    for part in _parts(texts):
        value, place = grams(padded([texts[i] for i in part]))
        use = np.repeat([ids[i] in trusted and _fold(ids[i]) != 0 for i in part], [len(texts[i]) + 1 for i in part])
        found.append(value)
        counts.append(np.bincount(place[use], minlength=len(value)))
    if not found:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    distinct, at = np.unique(np.concatenate(found), return_inverse=True)
    return distinct, np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.int64)


def _ask(shards: int):
    def run(chunks: pa.Table, labels: pa.Table) -> pa.Table:
        rows = []
        if chunks.num_rows:
            ids, _, texts = opened(chunks)
            value, count = block_counts(ids, texts, set(labels.column("label_id").to_pylist()))
            own = shard_of(value, shards)
            block = chunks.column("block")[0].as_py()
            for s in np.unique(own):
                pick = own == s
                rows.append((int(s), block, value[pick].astype("<u8").tobytes(), count[pick].astype("<i4").tobytes()))
        return pa.table({"shard": pa.array([r[0] for r in rows], pa.int64()), "block": pa.array([r[1] for r in rows], pa.int64()),
                         "grams": pa.array([r[2] for r in rows], pa.binary()), "counts": pa.array([r[3] for r in rows], pa.binary())})
    return run


def _merge(asks: pa.Table) -> pa.Table:
    value = np.concatenate([np.frombuffer(b, "<u8") for b in asks.column("grams").to_pylist()])
    count = np.concatenate([np.frombuffer(b, "<i4") for b in asks.column("counts").to_pylist()])
    distinct, at = np.unique(value, return_inverse=True)
    shard = np.full(len(distinct), asks.column("shard")[0].as_py(), np.int64)
    return pa.table({"shard": shard, "gram": distinct.astype(np.int64),
                     "n": np.bincount(at, count, len(distinct)).astype(np.int64)})


def _answer(asks: pa.Table, known: pa.Table) -> pa.Table:
    if not asks.num_rows:
        return pa.table({"block": pa.array([], pa.int64()), "shard": pa.array([], pa.int64()), "logs": pa.array([], pa.binary())})
    value, logp = np.asarray(known.column("gram")).astype(U64), np.asarray(known.column("logp")).astype("<f4")
    order = np.argsort(value)
    value, logp = value[order], logp[order]
    logs = [logp[np.searchsorted(value, np.frombuffer(b, "<u8"))].tobytes() for b in asks.column("grams").to_pylist()]
    return pa.table({"block": asks.column("block"), "shard": asks.column("shard"), "logs": pa.array(logs, pa.binary())})


def _total(shards: int):
    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        ids, langs, texts = opened(chunks)
        told = {r["shard"]: np.frombuffer(r["logs"], "<f4") for r in answers.to_pylist()}
        # the block's n-grams once more, as it asked for them
        mine = np.unique(np.concatenate([grams(padded([texts[i] for i in part]))[0] for part in _parts(texts)]))
        own = shard_of(mine, shards)
        logp = np.zeros(len(mine), np.float64)
        for s, logs in told.items():
            logp[own == s] = logs
        nll = np.zeros(len(texts))
        for part in _parts(texts):
            value, place = grams(padded([texts[i] for i in part]))
            each = logp[np.searchsorted(mine, value)][place]
            size = np.array([len(texts[i]) + 1 for i in part])
            nll[part] = -np.add.reduceat(each, np.cumsum(size) - size)
        return pa.table({"id": pa.array(ids, chunks.schema.field("ids").type.value_type), "lang": pa.array(langs, pa.string()),
                         "nll": nll, "n": pa.array([len(t) + 1 for t in texts], pa.int64())})
    return run


# -- the model ---------------------------------------------------------------------------

def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts; a half where they are undefined."""
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5)
    return tuple(min(max(v, 0.05), k - 0.05) for k, v in enumerate(d, 1))


def probabilities(counted: DataFrame) -> DataFrame:
    """(gram, p) for each asked 5-gram of ``counted`` (gram, n: count in trusted text)."""
    mask = {k: (1 << (8 * k)) - 1 for k in range(1, ORDER + 1)}
    adjusted = {ORDER: counted.where("n > 0").select("gram", "n")}
    asked = {ORDER: counted.select("gram")}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit(mask[k]))
        # how many different bytes come before
        adjusted[k] = keep(adjusted[k + 1].groupBy(suffix.alias("gram")).agg(F.count("*").alias("n")), "kn")
        asked[k] = keep(asked[k + 1].select(suffix.alias("gram")).distinct(), "kn")
    lower = asked[1].select("gram", F.lit(1.0 / SYMBOLS).alias("p"))
    for k in range(1, ORDER + 1):
        cc = adjusted[k].agg(*[F.sum((F.col("n") == i).cast("long")).alias(f"n{i}") for i in range(1, 5)]).first()
        d1, d2, d3 = discounts(*(cc[f"n{i}"] or 0 for i in range(1, 5)))
        cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        context = F.shiftright("gram", 8)
        sums = adjusted[k].groupBy(context.alias("context")).agg(F.sum("n").alias("total"), F.sum(cut).alias("saved"))
        lower_key = F.col("gram").bitwiseAND(F.lit(mask[k - 1])) if k > 1 else F.col("gram")
        below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("backed"))
        own = adjusted[k].select(F.col("gram").alias("seen"), (F.col("n") - cut).alias("kept"))
        rows = asked[k].select("gram", context.alias("context"), lower_key.alias("suffix"))
        lower = keep(rows.join(own, F.col("gram") == F.col("seen"), "left").join(sums, "context", "left")
                     .join(below, "suffix").select("gram", F.when(F.col("total").isNull(), F.col("backed")).otherwise(
                         (F.coalesce("kept", F.lit(0.0)) + F.col("saved") * F.col("backed")) / F.col("total")).alias("p")), "kn")
    return lower


def perplexities(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """(id, lang, nll, n): negative log-likelihood and scored bytes of each row."""
    total = text_bytes(docs, text_col)
    blocks, shards = max(1, -(-total // BLOCK)), max(4, -(-total // SHARD_BYTES))
    chunks = dealt(docs, blocks, id_col, text_col, lang_col)
    kind = docs.schema[id_col].dataType.simpleString()
    trusted = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast(kind).alias("label_id"))
    trusted = trusted.distinct().select(block_of("label_id", blocks), "label_id")
    asks = chunks.groupBy("block").cogroup(trusted.groupBy("block")).applyInArrow(
        _ask(shards), "shard long, block long, grams binary, counts binary")
    counted = keep(asks.groupBy("shard").applyInArrow(_merge, "shard long, gram long, n long"), "kn")
    p = probabilities(counted.select("gram", "n"))
    logs = counted.select("shard", "gram").join(p, "gram").select("shard", "gram", F.log("p").cast("float").alias("logp"))
    answers = asks.groupBy("shard").cogroup(logs.groupBy("shard")).applyInArrow(_answer, "block long, shard long, logs binary")
    return chunks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _total(shards), f"id {kind}, lang string, nll double, n long")


def text_digest(text_col: str = "text"):
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          fence: float = FENCE, with_digest: bool = False) -> DataFrame:
    """(id, lang, perplexity, threshold, keep) for each row; the threshold is a perplexity too.

    Rows of one id, language and text (null is empty) have one verdict;
    ``with_digest`` adds text_sha256, which tells them from others.
    """
    if with_digest:  # it travels with the language
        marked = docs.withColumn("_lang", F.concat(text_digest(text_col), F.coalesce(
            F.concat(F.lit("="), F.col(lang_col).cast("string")), F.lit(""))))
        scored = perplexities(marked, labels, id_col, text_col, "_lang").select(
            "id", F.when(F.length("lang") > 64, F.expr("substring(lang, 66)")).alias("lang"), "nll", "n",
            F.substring("lang", 1, 64).alias("text_sha256"))
    else:
        scored = perplexities(docs, labels, id_col, text_col, lang_col)
    scored, digest = keep(scored, "perplexity"), ["text_sha256"] if with_digest else []
    # calibration documents are trusted and were not trained on
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0
    calm = labels.where(F.col("quality") == 1).where(fold).select(F.col("doc_id").alias("label_id")).distinct()
    rate = F.col("nll") / F.col("n")
    basis = keep(scored.join(calm, F.col("id") == F.col("label_id"), "left_semi").select("lang", "n", rate.alias("rate")), "perplexity")
    quarter = lambda c: F.percentile_approx(c, [0.25, 0.5, 0.75], 10_000)
    middle = basis.agg(F.percentile_approx("rate", 0.5, 10_000)).first()[0]
    if middle is None:
        return scored.select("id", "lang", F.exp(rate).alias("perplexity"), F.lit(None).cast("double").alias("threshold"),
                             F.lit(True).alias("keep"), *digest)
    steady = lambda mid: (F.col("rate") * F.col("n") + mid * PRIOR_BYTES) / (F.col("n") + PRIOR_BYTES)
    limit = lambda q: F.col(q)[2] + fence * (F.col(q)[2] - F.col(q)[0])
    all_limit = basis.agg(quarter(steady(F.lit(middle))).alias("q")).select(limit("q")).first()[0]
    mids = basis.groupBy(F.col("lang").alias("own")).agg(F.percentile_approx("rate", 0.5, 10_000).alias("mid"), F.count("*").alias("texts"))
    mids = mids.where(F.col("texts") >= MIN_CALIBRATION)
    own = basis.join(mids, F.col("lang").eqNullSafe(F.col("own"))).groupBy("own", "mid").agg(
        quarter(steady(F.col("mid"))).alias("q")).select("own", "mid", limit("q").alias("cut"))
    out = scored.withColumn("rate", rate).join(own, F.col("lang").eqNullSafe(F.col("own")), "left")
    mid, cut = F.coalesce("mid", F.lit(middle)), F.coalesce("cut", F.lit(all_limit))
    return out.select("id", "lang", F.exp("rate").alias("perplexity"), F.exp(cut).alias("threshold"),
                      (steady(mid) <= cut).alias("keep"), *digest)


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, labels).withColumnRenamed("id", "doc_id")
