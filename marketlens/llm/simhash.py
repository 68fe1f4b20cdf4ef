"""SimHash near-duplicates by a binary-trie self-join.

``fingerprints`` gives each text a 64-bit SimHash over word shingles. ``links``
finds all pairs of distinct fingerprints within ``max_bits`` differing bits:

* the bits are cut into ``max_bits`` + 1 parts; a linked pair agrees on one part
  at least, so one trie per part, with that part turned to the top, is entered at
  the nodes below equal parts, with no differing bit so far;
* a node pair is a row group (part, prefix pair). One that holds more than
  ``node_rows`` fingerprints is taken ``STEP_BITS`` levels down at once: each
  fingerprint goes to the child pairs whose summed differing bits stay within the
  budget, and pairs with an empty side vanish. This repeats until every node pair
  is small, so no group of copies or common part sits in one task;
* the small node pairs are walked in their tasks, level by level and all pairs of
  a batch at once: children are paired, differing bits added up, and a pair is
  pruned when its sum exceeds the budget.

``near_duplicates`` adds the connected component of each document.

Scale: texts are read once and never shuffled. Equal fingerprints are one trie
entry. A fingerprint has at most C(64,1) + C(64,2) others within two bits, so the
links stay proportional to the distinct fingerprints.

Defined cases: null text counts as empty; a text without a word has fingerprint
zero; repeated document ids are rows of their own with the same component rules;
an empty table gives no rows; a null id has the smallest id of its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import SPACE_BYTES, U64, buffers, keep, ship_code
from marketlens.llm.components import components

STEP_BITS = 8
#: Fingerprints that one node pair may hand to a task.
NODE_ROWS = 256
#: Node pairs walked at once in a task.
FRONTIER = 500_000
BIT_BLOCK = 65_536


# -- fingerprints ---------------------------------------------------------------

def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, most significant bit first."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BIT_BLOCK):
        part = hashes[i:i + BIT_BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return total


def simhash(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of one text: A-Z lower-cased, words split at ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(
        starts[:n].tolist(), ends[shingle - 1:].tolist())), U64, n)
    bits = _bit_counts(hashes) * 2 > n
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, U64)
            for a, _, data, off in buffers(batch.column(1)):
                raw = data.tobytes()
                for i in range(len(off) - 1):
                    out[a + i] = simhash(raw[off[i]:off[i + 1]], shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], ["id", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): the fingerprint as a signed 64-bit number."""
    ship_code(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(_fingerprint_batches(shingle), f"id {kind}, fp long")


# -- the self-join -----------------------------------------------------------------

def _split(lo: np.ndarray, hi: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Where the children with a 1 begin, in nodes [lo, hi) of the sorted array."""
    return hi - (ones[hi] - ones[lo])


def trie_pairs(x: np.ndarray, first: np.ndarray, roots: list[np.ndarray], max_bits: int
               ) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of entries at most ``max_bits`` apart.

    x: fingerprints, sorted within each root node; roots: arrays lo1, hi1, lo2,
    hi2, err of node pairs (equal ranges: a node with itself). first: a bit
    number for each root; the levels above it are equal or counted in err.
    """
    found_i, found_j = [], []
    todo = [(int(d), tuple(r[first == d] for r in roots)) for d in np.unique(first)]
    ones_at: dict[int, np.ndarray] = {}
    while todo:
        depth, pairs = todo.pop()
        if len(pairs[0]) > FRONTIER:
            half = len(pairs[0]) // 2
            todo += [(depth, tuple(p[:half] for p in pairs)), (depth, tuple(p[half:] for p in pairs))]
            continue
        lo1, hi1, lo2, hi2, err = pairs
        same = lo1 == lo2
        leaf = (hi1 - lo1 == 1) & (hi2 - lo2 == 1)
        done = leaf & ~same
        if done.any():  # two leaves: the rest of the path is one comparison
            i, j = lo1[done], lo2[done]
            ok = np.bitwise_count(x[i] ^ x[j]) <= max_bits
            found_i.append(i[ok])
            found_j.append(j[ok])
        live = ~leaf
        if depth >= 64 or not live.any():
            if depth >= 64 and live.any():
                raise AssertionError("equal entries in a trie of distinct fingerprints")
            continue
        lo1, hi1, lo2, hi2, err, same = (v[live] for v in (lo1, hi1, lo2, hi2, err, same))
        if depth not in ones_at:
            bit = (x >> U64(63 - depth)) & U64(1)
            ones_at[depth] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        ones = ones_at[depth]
        m1, m2 = _split(lo1, hi1, ones), _split(lo2, hi2, ones)
        children = [(lo1, m1, lo2, m2, err, slice(None)), (m1, hi1, m2, hi2, err, slice(None)),
                    (lo1, m1, m2, hi2, err + 1, slice(None)), (m1, hi1, lo2, m2, err + 1, ~same)]
        grown = [tuple(v[pick] for v in child) for *child, pick in children]
        nxt = [np.concatenate([g[k] for g in grown]) for k in range(5)]
        fine = (nxt[1] > nxt[0]) & (nxt[3] > nxt[2]) & (nxt[4] <= max_bits)
        todo.append((depth + 1, tuple(v[fine] for v in nxt)))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_i]), np.concatenate([none, *found_j])


def _turn(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Rotate left by ``by`` bits."""
    by = by.astype(U64)
    return (x << by) | (x >> ((U64(64) - by) & U64(63)))


def _walk(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            cols = dict(zip(batch.schema.names, batch.columns))
            depth, err, turn, part = (np.asarray(cols[c]).astype(np.int64) for c in ("depth", "err", "turn", "part"))
            sides = []
            for name in ("left", "right"):
                col = cols[name]
                lens = np.diff(np.asarray(col.offsets))
                sides.append((np.asarray(col.flatten()).view(U64), lens))
            (xl, nl), (xr, nr) = sides
            node = np.concatenate([np.repeat(np.arange(rows) * 2, nl), np.repeat(np.arange(rows) * 2 + 1, nr)])
            x = np.concatenate([xl, xr])
            order = np.lexsort((x, node))
            x, node = x[order], node[order]
            edge = np.searchsorted(node, np.arange(2 * rows + 1))
            diagonal = nr == 0
            lo1, hi1 = edge[0:2 * rows:2], edge[1:2 * rows:2]
            lo2 = np.where(diagonal, lo1, edge[1:2 * rows:2])
            hi2 = np.where(diagonal, hi1, edge[2::2])
            i, j = trie_pairs(x, depth, [lo1, hi1, lo2, hi2, err], max_bits)
            row = node[i] // 2
            back = (64 - turn[row]) % 64
            a, b = _turn(x[i], back), _turn(x[j], back)
            # a pair that agrees on several parts is told by the first of them
            told = _first_part(a ^ b, max_bits + 1) == part[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[told].view(np.int64)), pa.array(b[told].view(np.int64))], ["a", "b"])
    return run


def part_starts(parts: int) -> list[int]:
    """Bit numbers (0: most significant) at which the parts begin, and 64."""
    return [64 * p // parts for p in range(parts + 1)]


def _first_part(diff: np.ndarray, parts: int) -> np.ndarray:
    at = part_starts(parts)
    out = np.full(len(diff), parts, np.int64)
    for p in reversed(range(parts)):
        mask = U64(((1 << (at[p + 1] - at[p])) - 1) << (64 - at[p + 1]))
        out[(diff & mask) == 0] = p
    return out


def links(fps: DataFrame, max_bits: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """(a, b): all pairs of distinct fingerprints (column fp, no repeats) within ``max_bits``."""
    spark = fps.sparkSession
    ship_code(spark)
    parts = max_bits + 1
    at = part_starts(parts)
    rotate = "shiftleft(fp, {s}) | shiftrightunsigned(fp, {r})"
    # a row: an entry x in a node pair; side 0: a node with itself, 1 and 2: the two nodes of a pair
    entries = None
    for p in range(parts):
        x = "fp" if p == 0 else rotate.format(s=at[p], r=64 - at[p])
        width = at[p + 1] - at[p]
        one = fps.selectExpr(f"{p} AS part", f"{at[p]} AS turn", f"{width} AS depth", "0 AS err", f"{x} AS x").selectExpr(
            "part", "turn", "depth", "err", f"shiftrightunsigned(x, {64 - width}) AS u",
            f"shiftrightunsigned(x, {64 - width}) AS v", "0 AS side", "x")
        entries = one if entries is None else entries.unionByName(one)
    key = ["part", "turn", "depth", "err", "u", "v"]
    pieces = []
    while True:
        sizes = entries.groupBy(*key).agg(F.count("*").alias("n"), F.max("side").alias("top"), F.min("side").alias("low"))
        sizes = sizes.where("n > 1 AND (top = 0 OR top > low)")  # a lone entry or an empty side pairs with nothing
        rows = keep(entries.join(sizes.select(*key, "n"), key), "trie")
        # at the last level a node is one fingerprint
        large = (F.col("n") > node_rows) & (F.col("depth") < 64)
        small = rows.where(~large).groupBy(*key).agg(
            F.collect_list(F.when(F.col("side") < 2, F.col("x"))).alias("left"),
            F.collect_list(F.when(F.col("side") == 2, F.col("x"))).alias("right"))
        pieces.append(small.select("part", "turn", "depth", "err", "left", "right")
                      .mapInArrow(_walk(max_bits), "a long, b long"))
        big = rows.where(large)
        if big.isEmpty():
            break
        entries = _descend(big, max_bits)
    out = pieces[0]
    for piece in pieces[1:]:
        out = out.unionByName(piece)
    return out


def _descend(big: DataFrame, max_bits: int) -> DataFrame:
    """Node pairs ``STEP_BITS`` levels down, for the entries of large node pairs."""
    masks = sorted((m for m in range(1 << STEP_BITS) if bin(m).count("1") <= max_bits), key=lambda m: (bin(m).count("1"), m))
    flips = F.array(*[F.lit(m) for m in masks])
    # the last step has fewer bits left
    step = F.least(F.lit(STEP_BITS), 64 - F.col("depth"))
    d = big.select("*", step.alias("step")).select(
        "part", "turn", "depth", "err", "u", "v", "side", "x", "step",
        F.expr("CAST(shiftrightunsigned(shiftleft(x, depth), 64 - step) AS INT) AS own"), F.explode(flips).alias("flip"))
    d = d.where("flip < shiftleft(1, step) AND err + bit_count(flip) <= " + str(max_bits))
    other = F.col("own").bitwiseXOR(F.col("flip"))
    is_left = F.when(F.col("side") == 0, F.col("own") <= other).otherwise(F.col("side") == 1)
    down = lambda c, bits: F.expr(f"shiftleft({c}, step)").bitwiseOR(bits.cast("long"))
    return d.select(
        "part", "turn", (F.col("depth") + F.col("step")).alias("depth"),
        (F.col("err") + F.expr("bit_count(flip)")).alias("err"),
        down("u", F.when(is_left, F.col("own")).otherwise(other)).alias("u"),
        down("v", F.when(is_left, other).otherwise(F.col("own"))).alias("v"),
        F.when((F.col("side") == 0) & (F.col("flip") == 0), 0).when(is_left, 1).otherwise(2).alias("side"), "x")


# -- documents -----------------------------------------------------------------------

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(id, fp, component): one row per row of ``docs``; component: the smallest id reachable."""
    fp = keep(fingerprints(docs, id_col, text_col, shingle), "simhash")
    first = fp.groupBy("fp").agg(F.min("id").alias("first_id"))
    roots = components(links(first.select("fp"), max_bits)).select(F.col("node").alias("fp"), "root")
    labelled = keep(first.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "simhash")
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component"))
    by_fp = labelled.join(smallest, "root").select(F.col("fp").alias("label_fp"), "component")
    return fp.join(by_fp, F.col("fp") == F.col("label_fp"), "left").select("id", "fp", "component")


def simhash_digest(docs: DataFrame) -> DataFrame:
    """The contract's result."""
    return near_duplicates(docs).select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"))
