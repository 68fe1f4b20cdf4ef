"""Best-fit packing of tokenised documents by the sum-of-squares rule.

Tokens: the text's ids of a byte-level BPE vocabulary, then one end id. A
document longer than a sequence is cut into full pieces; only its first piece may
be shorter. Full pieces are sequences of their own. All others are placed one
after the other: of the open sequences that have room (one for each residual gap)
and a new one, the choice that makes the sum over gaps of (open sequences with
that gap) squared smallest.

Scale: the texts are tokenised where they are read; only (piece, length) rows go
on. Each group of about ``GROUP_ITEMS`` pieces is packed by itself, longest pieces
first. The sequences with room left are then the items of the next round, in groups
of the same size, as long as a round saves sequences; those at most half full are
packed until one is left. No task gets more than a group and nothing is collected.

Tokenising: a block's text is cut into the vocabulary's pre-tokens with array
operations over code-point classes; each distinct pre-token is encoded once for a
block. Added tokens of the vocabulary that stand in a text are one id each, as the
library has it. ``tests/llm`` compares the ids with the ``tokenizers`` library.

Defined cases: null or empty text is the end id alone; repeated rows are packed
as often as they occur; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import U64, buffers, keep, mix, powers, ship_code

END_ID = 0
LENGTH = 2048
GROUP_ITEMS = 50_000
#: A round of merging that saves fewer than one open sequence in this many is the last one.
GAIN = 200
BLOCK = 2_000_000
#: Distinct pre-tokens whose ids a worker remembers.
CACHE_WORDS = 300_000

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3


# -- tokens -----------------------------------------------------------------------

@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of each code point for the pre-token pattern."""
    out = np.full(0x110000, OTHER, np.uint8)
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, text):
            a, b = ord(m[0][0]), ord(m[0][-1])
            out[a:b + 1] = kind
    return out


@lru_cache(maxsize=1)
def byte_marks() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: bytes with a printed form
    of their own stand for themselves, the others for the code points from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def vocabulary_of(path: str) -> tuple[dict[bytes, int], dict[bytes, int]]:
    """(ranks, added tokens) of the tokenizer file at ``path``: bytes -> id. In this vocabulary
    the ids are also the order of the merges."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
    marks = byte_marks()
    ranks = {bytes(marks[c] for c in token): i for token, i in spec["model"]["vocab"].items() if i not in added.values()}
    return ranks, added


@lru_cache(maxsize=1)
def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary at ``path``; the pattern is a fixed value of the vocabulary."""
    ranks, _ = vocabulary_of(path)
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pre_tokens(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin, in code points of texts laid end to end."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)  # first code point of a text
    first[offsets] = True
    first = first[:n]
    last = np.append(first[1:], True)
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    blank = points == 32
    space = kind == SPACE
    # white space before something else: its last code point stands alone, or with what follows if it is a blank
    before = np.zeros(n, bool)
    before[:-1] = space[:-1] & ~space[1:] & ~last[:-1]
    start[before] = True
    joins = np.flatnonzero(before & blank) + 1
    start[joins] = False
    # an apostrophe that begins a pre-token takes a contraction's letters
    marks = np.flatnonzero((points == 39) & start & ~last)
    for shape in ("re", "ve", "ll", "s", "t", "m", "d"):
        ok = marks
        for k, letter in enumerate(shape, 1):
            ok = ok[ok + k < n]
            ok = ok[(points[ok + k] == ord(letter)) & ~first[ok + k]]
            # a boundary between the letters: they are no run then
            if k > 1:
                ok = ok[~start[ok + k]]
        start[ok + 1] = False
        after = ok + len(shape) + 1
        after = after[after < n]
        start[after] = True
    return np.flatnonzero(start)


class Tokens:
    """Token ids of blocks of texts, with a bounded memory of pre-tokens."""

    def __init__(self, path: str):
        self.encode = encoder(path)._core_bpe.encode_single_piece
        # no pre-token equals an added token: those mix letters and other signs
        self.added = {t: np.array([i], np.uint32) for t, i in vocabulary_of(path)[1].items()}
        self.known: dict[bytes, np.ndarray] = dict(self.added)

    def ids(self, piece: bytes) -> np.ndarray:
        got = self.known.get(piece)
        if got is None:
            got = np.array(self.encode(piece), np.uint32)
            if len(self.known) >= CACHE_WORDS:
                self.known = dict(self.added)
            self.known[piece] = got
        return got

    def added_spans(self, text: bytes, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Where added tokens stand in the texts of a block, from left to right."""
        if not any(t in text for t in self.added):
            return []
        one_of = re.compile(b"|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)))
        cuts = offsets.tolist()
        return [m.span() for a, b in zip(cuts, cuts[1:]) for m in one_of.finditer(text, a, b)]

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, end to end, and where each text's begin."""
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        lead = (data & 0xC0) != 0x80  # first byte of a code point
        text = data.tobytes()
        points = np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)
        place = np.append(np.flatnonzero(lead), len(data))
        # added tokens are cut out first; what stands between them is pre-tokenised like texts of its own
        spans = self.added_spans(text, offsets)
        cuts = np.unique(np.append(offsets, np.array(spans, np.int64).ravel())) if spans else offsets
        starts = pre_tokens(points, np.searchsorted(place, cuts))
        a = place[starts]
        if spans:
            begin, end = np.array(spans, np.int64).T
            span = np.searchsorted(begin, a, side="right") - 1
            a = a[(span < 0) | (a == begin[span]) | (a >= end[span])]
        b = np.append(a[1:], len(data))
        p, q = powers(len(data))
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * p[:len(data)], out=sums[1:])
        raw = (sums[b] - sums[a]) * q[a]
        key = mix(raw) + (b - a).astype(U64)
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        # equal keys are compared byte by byte: first eight bytes, last eight bytes, length
        pieces = [self.ids(text[i:j]) for i, j in zip(a[first].tolist(), b[first].tolist())]
        if not _same_spans(data, a, b, first[inverse]):
            pieces, inverse = [self.ids(text[i:j]) for i, j in zip(a.tolist(), b.tolist())], np.arange(len(a))
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        where = np.cumsum(counts) - counts
        flat = np.concatenate(pieces)
        each = counts[inverse]
        begin = np.cumsum(each) - each
        ids = flat[np.repeat(where[inverse] - begin, each) + np.arange(each.sum())]
        token_at = np.append(begin, len(ids))
        return ids, token_at[np.searchsorted(a, offsets)]


def _same_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, like: np.ndarray) -> bool:
    """Whether each span equals the span it was matched with, byte for byte."""
    size = b - a
    other = a[like]
    if not (size == size[like]).all():
        return False
    k = 0
    live = np.flatnonzero(like != np.arange(len(a)))
    while len(live):
        if not (data[a[live] + k] == data[other[live] + k]).all():
            return False
        k += 1
        live = live[size[live] > k]
    return True


def _pieces(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path)
        for batch in batches:
            for a, b, data, off in buffers(batch.column(1), BLOCK):
                ids, at = tokens.block(data, off)
                row, piece, start, size, crc = [], [], [], [], []
                for i in range(b - a):
                    own = np.append(ids[at[i]:at[i + 1]], np.uint32(END_ID)).astype("<u4")
                    head = len(own) % length or min(length, len(own))
                    cuts = [0, *range(head, len(own) + 1, length)]
                    for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
                        row.append(a + i)
                        piece.append(k)
                        start.append(s)
                        size.append(e - s)
                        crc.append(zlib.crc32(own[s:e].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                    ["id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, piece, start, length, ids_crc32): the pieces of every document."""
    ship_code(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(_pieces(path, length), f"id {kind}, piece int, start long, length long, ids_crc32 long")


# -- packing ----------------------------------------------------------------------------

def sum_of_squares(sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each item, items taken longest first."""
    order = np.argsort(-sizes, kind="stable")
    count = np.zeros(length + 1, np.int64)      # open bins by gap
    free: list[list[int]] = [[] for _ in range(length + 1)]
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    n = 0
    for i in order.tolist():
        s = int(sizes[i])
        # moving a bin from gap g to g - s changes the sum by 2 (count[g - s] - count[g] + 1);
        # a bin that becomes full only leaves; a new bin adds 2 count[length - s] + 1
        change = 2 * (count[:length + 1 - s] - count[s:]) + 2
        change[0] = 1 - 2 * count[s]
        change[count[s:] == 0] = 1 << 60
        k = int(change.argmin())
        if change[k] < (1 << 60):
            gap = k + s
            b = free[gap].pop()
            count[gap] -= 1
        else:
            gap, b = length, n
            n += 1
        bins[i], offsets[i] = b, length - gap
        if gap > s:
            count[gap - s] += 1
            free[gap - s].append(b)
    return bins, offsets


def _pack_group(length: int):
    def run(key: tuple, items: pa.Table) -> pa.Table:
        item = items.column("item").combine_chunks()
        sizes = np.asarray(items.column("size").combine_chunks()).astype(np.int64)
        order = np.argsort(np.asarray(item), kind="stable")
        bins, offsets = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        bins[order], offsets[order] = sum_of_squares(sizes[order], length)
        fill = np.bincount(bins, sizes).astype(np.int64)
        names = np.asarray(item)[order]
        first = np.full(len(fill), np.iinfo(np.int64).max)
        np.minimum.at(first, bins[order], names)
        return pa.table({"item": item, "into": pa.array(first[bins]), "offset": pa.array(offsets),
                         "fill": pa.array(fill[bins])})
    return run


def place(items: DataFrame, length: int = LENGTH, group_items: int = GROUP_ITEMS) -> DataFrame:
    """(item, sequence, offset) for rows (item, size) with 0 < size <= length; items are distinct numbers.

    A sequence is named by an item in it. Rounds: the sequences with room for another one (the
    smallest that is open still fits) are packed again, in groups of ``group_items`` on average,
    until a round saves less than one sequence of ``GAIN``. Then only those at most
    half full, any two of which fit together, are packed until one is left. No round has larger groups.
    """
    placed = keep(items.select("item", F.col("item").alias("sequence"), F.lit(0).cast("long").alias("offset"),
                               F.col("size").cast("long").alias("fill")), "packed")
    before = groups = most = None
    turn = 0
    while True:
        heads = placed.where((F.col("offset") == 0) & (F.col("fill") < length)).select(
            F.col("sequence").alias("item"), F.col("fill").alias("size")).distinct()
        if most is not None:
            heads = heads.where(F.col("size") <= most)
        n, smallest = heads.agg(F.count(F.lit(1)), F.min("size")).first()
        if n < 2:
            break
        # what has no room for the smallest fits nowhere either: its partner would have to be smaller
        heads = heads.where(F.col("size") <= length - smallest)
        open_ = n
        n = heads.count()
        if n < 2:
            break
        if most is None and before is not None and (groups == 1 or before - open_ < before / GAIN):
            most = length // 2
            continue
        before = open_
        groups = -(-n // max(2, group_items))
        turn += 1
        packed = keep(heads.withColumn("_group", F.pmod(F.xxhash64("item", F.lit(turn)), F.lit(groups)))
                      .repartition(groups, "_group")
                      .groupBy("_group").applyInArrow(_pack_group(length), "item long, into long, offset long, fill long"),
                      "packed")
        moved = packed.select(F.col("item").alias("sequence"), "into", F.col("offset").alias("by"), F.col("fill").alias("now"))
        placed = keep(placed.join(moved, "sequence", "left").select(
            "item", F.coalesce("into", "sequence").alias("sequence"),
            (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset"),
            F.coalesce("now", "fill").alias("fill")), "packed")
    return placed.select("item", "sequence", "offset")


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """The pieces of every document with sequence and offset."""
    cut = keep(pieces(docs, path, id_col, text_col, length).withColumn("item", F.monotonically_increasing_id()), "pieces")
    short = cut.where(F.col("length") < length).select("item", F.col("length").alias("size"))
    at = place(short, length).withColumnRenamed("item", "placed")
    return cut.join(at, F.col("item") == F.col("placed"), "left").select(
        "id", "piece", "start", "length", "ids_crc32",
        F.coalesce("sequence", "item").alias("sequence_id"), F.coalesce("offset", F.lit(0)).alias("offset"))


def vocabulary() -> str:
    """Path of the byte-level vocabulary among the public tokenizers."""
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def packing_digest(docs: DataFrame) -> DataFrame:
    """The contract's result."""
    return pack(docs, vocabulary()).withColumnRenamed("id", "doc_id")
