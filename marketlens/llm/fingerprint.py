"""Document fingerprints: improbable-feature digests.

A feature is a window of ``WINDOW`` bytes. Its entropy is that of its letters (byte
modulo 32); entropies that are rare in the corpus rank first (one histogram over
all windows of all texts). Where a feature has the lowest rank, leftmost first, in
at least ``POPULAR`` of the sliding spans of ``SPAN`` windows that hold it, it is
selected. Selected features, each once, go in order into a chain of Bloom filters
of ``BITS`` bits, ``PER_FILTER`` features to a filter, ``HASHES`` bits for each.
Texts below ``SHORT`` code points, which have few windows to choose from, also have
a second chain with all their windows of ``SMALL_WINDOW`` bytes.

Two fingerprints are compared by the chains of small windows if both have one, else
by those of selected windows, which every text has: always features of one kind.
They are compared filter by filter: the common bits, less those that chance gives,
over the most that could be common. The likeness is the mean over the shorter
chain's filters of the best match in the other chain.

``chain`` compares every document with its own edited text and with the next
document. It sorts the (compressed) texts by id once, as range partitions; a task reads its
rows in order with one row of look-ahead, and the rows at the partition ends meet
in a second small step (one head and one tail text for each partition).

Defined cases: null text is empty; an empty text has no filter; two texts without
a filter are alike (1), one without and one with are not (0); a text shorter than a
window is one feature of that kind (so a text below ``WINDOW`` bytes has nothing in
common with one of ``SHORT`` code points or more); rows with equal ids follow each other in an order of their texts; a single
row is its own next document; an empty table gives no rows; extra columns are
ignored; a null id sorts after all others.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import U64, buffers, keep, mix, prefix_sums, ship_code, span_hashes

WINDOW = 64
SPAN = 64
POPULAR = 16
BITS = 2048
HASHES = 5
PER_FILTER = 128
BINS = 1024
#: Texts of fewer code points have few windows to choose from: all their
#: windows of SMALL_WINDOW bytes are features too.
SHORT = 384
SMALL_WINDOW = 8
#: First byte of a filter: which features are in it.
SELECTED, SMALL = 0, 1
BLOCK = 2_000_000

# count * log2(count) of a class in a window, scaled to fill 16 bits
_LOAD = np.round([c * np.log2(c) * 160 if c else 0 for c in range(WINDOW + 1)]).astype(np.uint16)


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """Bin of the letter entropy of each window: 0 is the highest entropy."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint16)
    letters = data & 31
    load = np.zeros(n, np.uint16)
    step = np.empty(n, np.uint16)
    for v in np.flatnonzero(np.bincount(letters, minlength=32)):
        count, width = (letters == v).view(np.uint8), 1
        while width < WINDOW:  # WINDOW is a power of two
            count = count[:-width] + count[width:]
            width *= 2
        load += np.take(_LOAD, count, out=step, mode="clip")
    return load >> 6


def valid_starts(offsets: np.ndarray, n: int) -> np.ndarray:
    """Windows that lie in one text."""
    ok = np.zeros(n, bool)
    step = np.zeros(n + 1, np.int32)
    a, b = offsets[:-1], offsets[1:] - WINDOW + 1
    has = b > a
    np.add.at(step, a[has], 1)
    np.add.at(step, b[has], -1)
    ok[:] = np.cumsum(step[:n]) > 0
    return ok


def histogram(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    bins = entropy_bins(data)
    return np.bincount(bins[valid_starts(offsets, len(bins))], minlength=BINS)


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy bin, rare ones first."""
    rank = np.empty(BINS, np.int64)
    rank[np.lexsort((np.arange(BINS), counts))] = np.arange(BINS)
    return rank


def selected(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Starts of the selected windows, ascending."""
    bins = entropy_bins(data)
    n = len(bins)
    if not n:
        return np.zeros(0, np.int64)
    far = np.int64(1) << 62
    key = np.full(n + 2 * (SPAN - 1), far)
    key[SPAN - 1:SPAN - 1 + n] = np.where(valid_starts(offsets, n), (rank[bins] << 40) | np.arange(n), far)
    # texts are WINDOW - 1 windows apart, so a span holds windows of one text only
    width = 1
    while width < SPAN:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    often = np.diff(np.append(edge, len(key))) >= POPULAR
    value = key[edge[often]]
    return np.sort(value[value < far] & ((np.int64(1) << 40) - 1))


def digests(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """Filters (rows of their kind and BITS / 8 bytes) of each text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    sums = prefix_sums(data)
    start = selected(data, offsets, rank)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    short = np.diff(lead[offsets]) < SHORT
    size = np.diff(offsets)
    tiny = offsets[:-1][(size > 0) & (size < WINDOW)]
    start = np.concatenate([start, tiny])
    owner = np.searchsorted(offsets, start, "right") - 1
    # short texts: all their small windows, or the text itself
    per = np.where(short & (size > 0), np.maximum(size - SMALL_WINDOW + 1, 1), 0)
    small = np.repeat(offsets[:-1] - (np.cumsum(per) - per), per) + np.arange(per.sum())
    begin = np.concatenate([start, small])
    end = np.concatenate([np.minimum(start + WINDOW, offsets[owner + 1]), np.minimum(small + SMALL_WINDOW, np.repeat(offsets[1:], per))])
    chain_of = np.concatenate([2 * owner + SELECTED, 2 * np.repeat(np.arange(len(texts)), per) + SMALL])
    order = np.lexsort((begin, chain_of))
    chain_of = chain_of[order]
    feature = span_hashes(sums, begin[order], end[order])
    # each feature of a chain once, where it is first
    _, once = np.unique(mix(chain_of.astype(U64) + U64(1)) ^ feature, return_index=True)
    once.sort()
    feature, chain_of = feature[once], chain_of[once]
    first = np.searchsorted(chain_of, np.arange(2 * len(texts) + 1))
    place = np.arange(len(chain_of)) - first[chain_of]
    filters = -(-np.diff(first) // PER_FILTER)
    row = (np.cumsum(filters) - filters)[chain_of] + place // PER_FILTER
    bits = np.zeros((int(filters.sum()), BITS), np.uint8)
    for k in range(HASHES):
        bits[row, ((feature >> U64(11 * k)) & U64(BITS - 1)).astype(np.int64)] = 1
    kind = np.repeat(np.arange(2 * len(texts)) & 1, filters).astype(np.uint8)
    packed = np.concatenate([kind[:, None], np.packbits(bits, axis=1)], axis=1)
    at = np.concatenate([[0], np.cumsum(filters)])[::2]
    return [packed[at[i]:at[i + 1]] for i in range(len(texts))]


def written(filters: np.ndarray) -> str:
    return base64.b64encode(filters.tobytes()).decode()


def read(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 1 + BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1; long chains are compared in blocks."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    kind = min(a[:, 0].max(), b[:, 0].max())
    a, b = a[a[:, 0] == kind, 1:], b[b[:, 0] == kind, 1:]
    if len(a) > len(b):
        a, b = b, a
    total = 0.0
    for i in range(0, len(a), 256):
        x = np.unpackbits(a[i:i + 256], axis=1).astype(np.float32)
        nx = x.sum(1)[:, None]
        best = np.zeros(len(x))
        for j in range(0, len(b), 256):
            y = np.unpackbits(b[j:j + 256], axis=1).astype(np.float32)
            ny = y.sum(1)[None, :]
            chance, most = nx * ny / BITS, np.minimum(nx, ny)
            best = np.maximum(best, (np.clip((x @ y.T - chance) / (most - chance), 0, 1)).max(1))
        total += best.sum()
    return float(total / len(a))


def _point(text: bytes, k: int) -> int:
    """Byte at which code point k begins (or the end)."""
    if text.isascii():
        return min(k, len(text))
    lead = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return int(lead[k]) if k < len(lead) else len(text)


def points(text: bytes) -> int:
    return len(text) if text.isascii() else int(((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).sum())


def edit(text: bytes, following: bytes) -> tuple[int, bytes]:
    """Code points, and the text with its second half replaced by the following text's start."""
    n = points(text)
    return n, text[:_point(text, n - n // 2)] + following[:_point(following, n // 2)]


def compared(texts: list[bytes], rank: np.ndarray) -> list[tuple]:
    """(n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of all texts but the last."""
    edits = [edit(a, b) for a, b in zip(texts, texts[1:])]
    own = digests(texts, rank)
    changed = digests([e for _, e in edits], rank)
    return [(n, hashlib.sha256(e).hexdigest(), written(own[i]), written(changed[i]),
             likeness(own[i], changed[i]), likeness(own[i], own[i + 1])) for i, (n, e) in enumerate(edits)]


RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_RESULT_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_RESULT_NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BINS, np.int64)
    for batch in batches:
        for _, _, data, off in buffers(batch.column(0), BLOCK):
            total += histogram(data, off)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bin", "n"])


def corpus_rarity(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Ranks from the histogram over all windows of all texts (at most BINS rows are collected)."""
    ship_code(docs.sparkSession)
    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(_count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BINS, np.int64)
    for r in rows:
        counts[r.bin] = r.n
    return rarity(counts)


def _rows(kind: pa.DataType, part: int, role: int, ids: list, results: list[tuple], text: list) -> pa.RecordBatch:
    n = len(ids)
    cols = [pa.array([r[k] for r in results] if results else [None] * n, t) for k, t in enumerate(_RESULT_TYPES)]
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * n, pa.int32()), pa.array([role] * n, pa.int32()), pa.array(ids, kind), *cols, pa.array(text, pa.binary())],
        ["part", "role", "id", *_RESULT_NAMES, "text"])


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, for the sort by id."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for a, b, data, off in buffers(batch.column(1), BLOCK):
            raw = data.tobytes()
            packed = [packer.compress(raw[off[i]:off[i + 1]]) for i in range(b - a)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(packed, pa.binary())], ["id", "packed"])


def _stream(rank: np.ndarray):
    """Role 0: a finished row; 1: the partition's first row; 2: its last, which waits for the next partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids, texts, size, first = [], [], 0, True
        kind = None
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            kind = batch.column(0).type
            for i, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t = opener.decompress(packed)
                if first:
                    yield _rows(kind, part, 1, [i], [], [t])
                    first = False
                ids.append(i)
                texts.append(t)
                size += len(t) + 100
                if size > BLOCK and len(ids) > 1:
                    yield _rows(kind, part, 0, ids[:-1], compared(texts, rank), [None] * (len(ids) - 1))
                    ids, texts, size = ids[-1:], texts[-1:], 0
        if len(ids) > 1:
            yield _rows(kind, part, 0, ids[:-1], compared(texts, rank), [None] * (len(ids) - 1))
        if ids:
            yield _rows(kind, part, 2, ids[-1:], [], texts[-1:])
    return run


def _ends(rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [compared([a, b], rank)[0] for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([f[k] for f in found], t) for k, t in enumerate(_RESULT_TYPES))], ["id", *_RESULT_NAMES])
    return run


def chain(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row."""
    rank = corpus_rarity(docs, text_col)
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    down = F.col("id").desc_nulls_last()
    squeezed = plain.mapInArrow(_squeezed, f"id {kind}, packed binary")
    ordered = squeezed.repartitionByRange(down).sortWithinPartitions(down, "packed")
    rows = keep(ordered.mapInArrow(_stream(rank), f"part int, role int, id {kind}, {RESULT}, text binary"), "fingerprints")
    heads = rows.where("role = 1").select("part", F.col("text").alias("following"))
    # the partition that comes after each one: part numbers only
    after = rows.where("role = 1").select("part").withColumn("next", F.lead("part").over(Window.orderBy("part")))
    after = after.select("part", F.coalesce("next", F.min("part").over(Window.partitionBy())).alias("next"))
    tails = rows.where("role = 2").select("part", "id", "text").join(after, "part").join(
        heads.withColumnRenamed("part", "next"), "next").select("id", "text", "following")
    last = tails.mapInArrow(_ends(rank), f"id {kind}, {RESULT}")
    return rows.where("role = 0").select("id", *_RESULT_NAMES).unionByName(last)


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    """The contract's result."""
    return chain(docs).withColumnRenamed("id", "doc_id")
