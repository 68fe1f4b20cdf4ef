"""Suffix-array de-duplication: maximal repeats from the interval tree of an
enhanced suffix array.

Bytes of a document that lie in a string of ``MIN_BYTES`` bytes which also begins in
a document with a smaller id are removed.

The kernel (``RepeatFinder``) sorts the suffixes of many text segments, computes the
common prefixes of neighbours, and scans them with a stack: each interval of the
common-prefix tree with ``MIN_BYTES`` or more is a set of suffixes with all
occurrences of one string. Its left extension is diverse if two occurrences have
different bytes before them (or a segment begins there); then it is a maximal
repeat group, and every window of ``MIN_BYTES`` bytes in it gets the smallest
document id of the group. Intervals that are not left-diverse are covered by the
group one byte to the left.

No task can hold all suffixes, so they are dealt out such that equal windows of
``MIN_BYTES`` bytes always meet, and text that occurs once is never sent:

* each window has an anchor, the smallest hash of its ``GRAM``-byte strings; equal
  windows have equal anchors, and a run of neighbouring windows shares one;
* documents are dealt into blocks of a few MB. A block sends each of its anchors
  (4 bytes) to the anchor's shard; the shard returns those that occur in two
  documents or more, and marks as hot those with very many different surroundings;
* a block sends the segments (runs) of the anchors that came back, each different
  segment once, with the smallest id of its documents, to the anchor's shard. The
  windows of a hot anchor go one by one, to shards by their content, so no shard
  gets an unbounded group; equal ones are sent once for a block;
* the shard's kernel tells each block which windows of its segments begin in a
  smaller document, and the block removes what they cover.

Text is shuffled once, as compressed chunks.

Defined cases: null text is empty; a text shorter than ``MIN_BYTES`` is kept whole;
rows with equal ids do not count as smaller to each other; a row without an id is
larger than all others and equal to its like; an empty table gives no rows; extra
columns are ignored. Ids are whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.blocks import dealt, opened, text_bytes
from marketlens.llm.common import U64, gram_hashes, mix, prefix_sums, span_hashes

MIN_BYTES = 50
GRAM = 24
BLOCK = 5_000_000
SHARD_BYTES = 8_000_000
#: Windows in a segment.
MAX_RUN = 64
#: Different segments of one anchor that a shard may get.
HOT = 2_000
NO_ID = np.iinfo(np.int64).max


# masks of the first 0 to 8 bytes of a word
_LEADING = np.array([((1 << 8 * n) - 1) << (64 - 8 * n) for n in range(9)], U64)


# -- the enhanced suffix array ---------------------------------------------------------

class RepeatFinder:
    """Suffixes of segments, down to the last ``min_bytes`` of each segment."""

    def __init__(self, segments: list[bytes], ids: np.ndarray, min_bytes: int = MIN_BYTES):
        self.min_bytes = min_bytes
        sizes = np.array([len(s) for s in segments], np.int64)
        self.text = np.frombuffer(b"".join(segments) + bytes(16), np.uint8)
        begin = np.cumsum(sizes) - sizes
        self.windows = np.maximum(sizes - min_bytes + 1, 0)
        self.base = np.cumsum(self.windows) - self.windows
        self.segment = np.repeat(np.arange(len(sizes)), self.windows)
        offset = np.arange(len(self.segment)) - self.base[self.segment]
        self.start = begin[self.segment] + offset
        self.size = sizes[self.segment] - offset
        self.inner = offset > 0
        self.id = np.asarray(ids, np.int64)[self.segment]
        # eight bytes from every position, most significant first
        self.words = np.lib.stride_tricks.as_strided(self.text, (len(self.text) - 7, 8), (1, 1))

    def word(self, which: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8k to 8k + 7 of suffixes, zero after their end."""
        at = np.minimum(self.start[which] + 8 * k, len(self.text) - 8)
        value = np.ascontiguousarray(self.words[at]).view(">u8").ravel().astype(U64)
        have = np.clip(self.size[which] - 8 * k, 0, 8)
        return value & _LEADING[have]

    def sort(self) -> None:
        """Suffix order and the common prefix of each suffix with the one before it."""
        n = len(self.start)
        order = np.arange(n)
        lcp = np.zeros(n, np.int64)
        if n:
            first = self.word(order, 0)
            order = np.argsort(first, kind="stable")
            key = first[order]
            tied = np.zeros(n, bool)          # equal to the one before so far
            tied[1:] = key[1:] == key[:-1]
            lcp[1:] = self._common(key[:-1], key[1:])
            k = 1
            while tied.any():
                # groups of suffixes that are equal so far
                member = tied.copy()
                member[:-1] |= tied[1:]
                rows = np.flatnonzero(member)
                group = np.cumsum(~tied[rows])
                which = order[rows]
                value = self.word(which, k)
                ended = self.size[which] <= 8 * k  # sorts first and cannot be told further
                again = np.lexsort((value, ~ended, group))
                order[rows] = which[again]
                value, ended = value[again], ended[again]  # groups stay where they are
                same = np.zeros(len(rows), bool)
                same[1:] = group[1:] == group[:-1]
                pair = np.flatnonzero(same)
                lcp[rows[pair]] = 8 * k + self._common(value[pair - 1], value[pair])
                live = np.zeros(len(rows), bool)
                live[pair] = (value[pair] == value[pair - 1]) & ~ended[pair] & ~ended[pair - 1]
                tied[:] = False
                tied[rows] = live
                k += 1
            short = np.minimum(self.size[order[1:]], self.size[order[:-1]])
            lcp[1:] = np.minimum(lcp[1:], short)
        self.order, self.lcp = order, lcp

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal leading bytes of two words."""
        diff = a ^ b
        out = np.zeros(len(diff), np.int64)
        for byte in range(1, 9):
            out += (diff >> U64(64 - 8 * byte)) == 0
        return out

    def intervals(self) -> np.ndarray:
        """Rows (lo, hi, common prefix) of the tree's intervals with min_bytes or more."""
        deep = np.where(self.lcp >= self.min_bytes, self.lcp, 0)
        inside = np.flatnonzero(deep)
        found: list[tuple[int, int, int]] = []
        stack: list[tuple[int, int]] = []
        last = -2
        for i, depth in zip(inside.tolist(), deep[inside].tolist()):
            if i != last + 1:  # the chain is broken: all open intervals end
                for d, lo in reversed(stack):
                    found.append((lo, last + 1, d))
                stack = []
            lo = i - 1
            while stack and stack[-1][0] > depth:
                d, lo = stack.pop()
                found.append((lo, i, d))
            if not stack or stack[-1][0] < depth:
                stack.append((depth, lo))
            last = i
        for d, lo in reversed(stack):
            found.append((lo, last + 1, d))
        return np.array(found, np.int64).reshape(-1, 3)

    def maximal(self) -> tuple[np.ndarray, np.ndarray]:
        """Left-diverse intervals and the smallest id of each."""
        self.sort()
        tree = self.intervals()
        if not len(tree):
            return tree, np.zeros(0, np.int64)
        lo, hi, _ = tree.T
        before = self.text[np.maximum(self.start[self.order] - 1, 0)].astype(np.int64)
        edge = ~self.inner[self.order]
        change = np.zeros(len(self.order), np.int64)
        change[1:] = (before[1:] != before[:-1]) | edge[1:] | edge[:-1]
        change = np.cumsum(change)
        diverse = change[hi - 1] > change[lo]
        tree = tree[diverse]
        ids = np.append(self.id[self.order], NO_ID)
        bounds = tree[:, :2].ravel()
        smallest = np.minimum.reduceat(ids, bounds)[::2] if len(bounds) else np.zeros(0, np.int64)
        return tree, smallest

    def smallest_ids(self) -> np.ndarray:
        """For each window (segment by segment) the smallest id in which it begins."""
        out = self.id.copy()
        tree, smallest = self.maximal()
        step = 1 << 16
        size = tree[:, 1] - tree[:, 0] if len(tree) else np.zeros(0, np.int64)
        cut = np.searchsorted(np.cumsum(size), np.arange(0, size.sum() + step, step)) if len(size) else []
        for a, b in zip(cut, [*cut[1:], len(tree)]) if len(size) else ():
            part = slice(int(a), int(b))
            if a == b:
                continue
            count = size[part]
            member = np.repeat(tree[part, 0] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            suffix = self.order[member]
            width = np.repeat(tree[part, 2], count) - self.min_bytes + 1
            value = np.repeat(smallest[part], count)
            at = np.repeat(suffix - (np.cumsum(width) - width), width) + np.arange(width.sum())
            np.minimum.at(out, at, np.repeat(value, width))
        return out


def maximal_repeats(texts: list[bytes], min_bytes: int = MIN_BYTES) -> list[tuple[int, list[tuple[int, int]]]]:
    """Maximal repeat groups of some texts: (length, all occurrences as (text, start))."""
    finder = RepeatFinder(texts, np.arange(len(texts)), min_bytes)
    tree, _ = finder.maximal()
    out = []
    for lo, hi, size in tree.tolist():
        member = finder.order[lo:hi]
        own = finder.segment[member]
        out.append((size, sorted(zip(own.tolist(), (member - finder.base[own]).tolist()))))
    return out


# -- a block of documents ------------------------------------------------------------------

class Block:
    """Whole texts of a block, in the order of their ids, with their runs of windows."""

    def __init__(self, chunks: pa.Table):
        self.ids, _, texts = opened(chunks)
        self.id = np.array([NO_ID if i is None else i for i in self.ids], np.int64)
        self.raw = b"".join(texts)
        self.data = np.frombuffer(self.raw, np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.sums = prefix_sums(self.data)
        least = gram_hashes(self.sums, GRAM)
        width, need = 1, MIN_BYTES - GRAM + 1
        while width < need:
            step = min(width, need - width)
            least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
            width += step
        n = len(least)
        inside = np.zeros(n + 1, np.int64)
        a, b = self.offsets[:-1], self.offsets[1:] - MIN_BYTES + 1
        has = b > a
        np.add.at(inside, a[has], 1)
        np.add.at(inside, b[has], -1)
        good = np.cumsum(inside[:n]) > 0
        new = good.copy()
        if n:
            new[1:] &= ~good[:-1] | (least[1:] != least[:-1])
        start = np.flatnonzero(new)
        stop = np.flatnonzero(good & ~np.append(good[1:], False)) + 1  # ends of the texts' windows
        size = np.minimum(np.append(start[1:], n), stop[np.searchsorted(stop, start, "right")] if len(start) else n) - start
        # long runs (periodic text) are cut up
        parts = -(-size // MAX_RUN)
        offset = (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * MAX_RUN
        self.start = np.repeat(start, parts) + offset
        self.count = np.minimum(np.repeat(size, parts) - offset, MAX_RUN)
        self.key = least[self.start] if n else np.zeros(0, U64)
        self.owner = np.searchsorted(self.offsets, self.start, "right") - 1

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors, whether two ids have them, and their different segments (at most 255 told)."""
        if not len(self.key):
            return np.zeros(0, U64), np.zeros(0, bool), np.zeros(0, np.uint8)
        content = mix(span_hashes(self.sums, self.start, self.start + self.count + MIN_BYTES - 1) ^ self.key)
        order = np.lexsort((content, self.key))
        key, content, own = self.key[order], content[order], self.id[self.owner[order]]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        other = np.concatenate([[False], (key[1:] == key[:-1]) & (content[1:] != content[:-1])])
        several = np.maximum.reduceat(own, head) > np.minimum.reduceat(own, head)
        return key[head], several, np.minimum(1 + np.add.reduceat(other.astype(np.int64), head), 255).astype(np.uint8)

    def spans(self, level: np.ndarray) -> Spans:
        """Segments of the runs with level 1 (shared) and single windows of those with level 2 (hot)."""
        one = np.flatnonzero(level == 1)
        hot = np.flatnonzero(level == 2)
        wide = self.count[hot]
        each = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
        start = np.concatenate([self.start[one], np.repeat(self.start[hot], wide) + each])
        count = np.concatenate([self.count[one], np.ones(len(each), np.int64)])
        owner = np.concatenate([self.owner[one], np.repeat(self.owner[hot], wide)])
        return Spans(self, start, count, owner, np.concatenate([self.key[one], np.zeros(len(each), U64)]), len(one))


class Spans:
    """Spans of a block, equal ones as one segment."""

    def __init__(self, block: Block, start: np.ndarray, count: np.ndarray, owner: np.ndarray, key: np.ndarray, runs: int):
        self.block, self.start, self.count = block, start, count
        self.end = start + count + MIN_BYTES - 1
        hashes = span_hashes(block.sums, start, self.end) if len(start) else np.zeros(0, U64)
        kind = np.arange(len(start)) >= runs  # windows of hot anchors
        number: dict[tuple, int] = {}
        raw = block.raw
        # segments are told apart by their bytes
        self.segment = np.fromiter((number.setdefault((k, raw[a:b]), len(number)) for k, a, b in zip(
            kind.tolist(), start.tolist(), self.end.tolist())), np.int64, len(start))
        _, self.first = np.unique(self.segment, return_index=True)
        self.smallest = np.full(len(number), NO_ID)
        self.id = block.id[owner]
        np.minimum.at(self.smallest, self.segment, self.id)
        self.texts = [t for _, t in number]
        self.deal = np.where(kind, hashes, key)[self.first]


def _told(rows: list[dict], keys: np.ndarray, shards: int) -> np.ndarray:
    """Level of each run's anchor: 0 alone, 1 shared, 2 hot."""
    level = np.zeros(len(keys), np.int64)
    own = (keys % U64(shards)).astype(np.int64)
    short = (keys >> U64(32)).astype(np.uint32)
    by_shard = np.argsort(own, kind="stable")
    edge = np.searchsorted(own[by_shard], np.arange(shards + 1))
    for r in rows:
        told = np.frombuffer(r["a"], "<u4")
        mine = by_shard[edge[r["shard"]]:edge[r["shard"] + 1]]
        at = np.minimum(np.searchsorted(told, short[mine]), len(told) - 1)
        level[mine] = np.where(told[at] == short[mine], np.frombuffer(r["b"], np.uint8)[at], 0)
    return level


# A message between blocks and shards: up to three binary columns.
MESSAGE = "shard long, block long, kind int, a binary, b binary, c binary"
_NAMES = ["shard", "block", "kind", "a", "b", "c"]
ANCHORS, SHARED, SEGMENTS, REMOVED = range(4)


def _message(rows: list[tuple]) -> pa.Table:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(zip(_NAMES, types))})


def _ask(shards: int):
    def run(chunks: pa.Table) -> pa.Table:
        block = chunks.column("block")[0].as_py()
        key, several, segments = Block(chunks).anchors()
        own = (key % U64(shards)).astype(np.int64)
        short = (key >> U64(32)).astype("<u4")
        order = np.lexsort((short, own))
        edge = np.searchsorted(own[order], np.arange(shards + 1))
        rows = []
        for s in range(shards):
            pick = order[edge[s]:edge[s + 1]]
            if len(pick):
                rows.append((s, block, ANCHORS, short[pick].tobytes(), np.packbits(several[pick]).tobytes(), segments[pick].tobytes()))
        return _message(rows)
    return run


def _share(hot: int):
    """Tell each block which of its anchors two documents have."""
    def run(asked: pa.Table) -> pa.Table:
        return _shared(asked, hot)
    return run


def _shared(asked: pa.Table, hot: int) -> pa.Table:
    rows = asked.to_pylist()
    keys = [np.frombuffer(r["a"], "<u4") for r in rows]
    flat = np.concatenate(keys)
    several = np.concatenate([np.unpackbits(np.frombuffer(r["b"], np.uint8))[:len(k)] for r, k in zip(rows, keys)])
    segments = np.concatenate([np.frombuffer(r["c"], np.uint8) for r in rows]).astype(np.int64)
    distinct, at = np.unique(flat, return_inverse=True)
    texts = np.bincount(at, 1 + several, len(distinct))
    level = np.where(texts < 2, 0, np.where(np.bincount(at, segments, len(distinct)) > hot, 2, 1)).astype(np.uint8)
    out, place = [], 0
    for r, k in zip(rows, keys):
        mine = level[at[place:place + len(k)]]
        place += len(k)
        if (mine > 0).any():
            out.append((r["shard"], r["block"], SHARED, k[mine > 0].astype("<u4").tobytes(), mine[mine > 0].tobytes(), None))
    return _message(out)


def _send(shards: int):
    """A block's segments to their shards; what it was told goes along to its last step."""
    def run(chunks: pa.Table, told: pa.Table) -> pa.Table:
        rows = told.to_pylist()
        if not rows or not chunks.num_rows:
            return _message([])
        block = rows[0]["block"]
        held = Block(chunks)
        spans = held.spans(_told(rows, held.key, shards))
        out = [(-1 - block, block, SHARED, r["a"], r["b"], np.array([r["shard"]], "<i8").tobytes()) for r in rows]
        own = (mix(spans.deal.copy()) % U64(shards)).astype(np.int64)
        order = np.argsort(own, kind="stable")
        edge = np.searchsorted(own[order], np.arange(shards + 1))
        for s in range(shards):
            pick = order[edge[s]:edge[s + 1]]
            if len(pick):
                size = np.array([len(spans.texts[k]) for k in pick], "<u2")
                numbers = np.concatenate([pick.astype("<i8"), spans.smallest[pick].astype("<i8")])
                out.append((s, block, SEGMENTS, b"".join(spans.texts[k] for k in pick), size.tobytes(), numbers.tobytes()))
        return _message(out)
    return run


def _find(messages: pa.Table) -> pa.Table:
    """Tell each block which windows of its segments begin in a smaller document."""
    rows = messages.to_pylist()
    out = [(r["shard"], r["block"], SHARED, r["a"], r["b"], r["c"]) for r in rows if r["kind"] == SHARED]
    rows = [r for r in rows if r["kind"] == SEGMENTS]
    if not rows:
        return _message(out)
    number: dict[bytes, int] = {}
    which, smallest = [], []
    for r in rows:
        size = np.frombuffer(r["b"], "<u2").astype(np.int64)
        end = np.cumsum(size)
        text = r["a"]
        which.append(np.fromiter((number.setdefault(text[e - s:e], len(number)) for s, e in zip(size.tolist(), end.tolist())),
                                 np.int64, len(size)))
        smallest.append(np.frombuffer(r["c"], "<i8")[len(size):])
    least = np.full(len(number), NO_ID)
    np.minimum.at(least, np.concatenate(which), np.concatenate(smallest))
    finder = RepeatFinder(list(number), least)
    first_id = finder.smallest_ids()
    for r, mine, own in zip(rows, which, smallest):
        count = finder.windows[mine]
        at = np.repeat(finder.base[mine] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        gone = first_id[at] < np.repeat(own, count)
        if gone.any():
            # runs of windows, not across segments
            segment = np.repeat(np.arange(len(mine)), count)
            offset = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            begin = gone & ~np.concatenate([[False], gone[:-1] & (segment[1:] == segment[:-1])])
            end = gone & ~np.concatenate([gone[1:] & (segment[1:] == segment[:-1]), [False]])
            a, b = np.flatnonzero(begin), np.flatnonzero(end)
            names = np.frombuffer(r["c"], "<i8")[:len(mine)][segment[a]]
            out.append((r["shard"], r["block"], REMOVED, names.astype("<i8").tobytes(), offset[a].astype("<u2").tobytes(),
                        (offset[b] + 1).astype("<u2").tobytes()))
    return _message(out)


def _remove(shards: int):
    def run(chunks: pa.Table, told: pa.Table) -> pa.Table:
        kind = chunks.schema.field("ids").type.value_type
        if not chunks.num_rows:
            return pa.table({"id": pa.array([], kind), "n_bytes": pa.array([], pa.int64()), "starts": pa.array([], pa.list_(pa.int64())),
                             "ends": pa.array([], pa.list_(pa.int64())), "kept": pa.array([], pa.binary())})
        held = Block(chunks)
        rows = told.to_pylist()
        shared = [{"shard": int(np.frombuffer(r["c"], "<i8")[0]), "a": r["a"], "b": r["b"]} for r in rows if r["kind"] == SHARED]
        spans = held.spans(_told(shared, held.key, shards))
        begin, end = [], []
        # a segment that a smaller document of the block holds as well goes whole
        whole = spans.id > spans.smallest[spans.segment]
        begin.append(spans.start[whole])
        end.append(spans.end[whole])
        member = np.argsort(spans.segment, kind="stable")
        edge = np.searchsorted(spans.segment[member], np.arange(len(spans.texts) + 1))
        for r in rows:
            if r["kind"] == REMOVED:
                names, a, b = np.frombuffer(r["a"], "<i8"), np.frombuffer(r["b"], "<u2"), np.frombuffer(r["c"], "<u2")
                count = edge[names + 1] - edge[names]
                span = member[np.repeat(edge[names] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
                begin.append(spans.start[span] + np.repeat(a, count).astype(np.int64))
                end.append(spans.start[span] + np.repeat(b, count).astype(np.int64) + MIN_BYTES - 1)
        step = np.zeros(len(held.data) + 1, np.int64)
        np.add.at(step, np.concatenate(begin), 1)
        np.add.at(step, np.concatenate(end), -1)
        gone = np.cumsum(step[:-1]) > 0
        first = np.zeros(len(gone) + 1, bool)
        first[held.offsets] = True
        a = np.flatnonzero(gone & (np.concatenate([[True], ~gone[:-1]]) | first[:-1])) if len(gone) else np.zeros(0, np.int64)
        b = np.flatnonzero(gone & (np.concatenate([~gone[1:], [True]]) | first[1:])) + 1 if len(gone) else a
        at = np.searchsorted(a, held.offsets)
        starts, ends, kept = [], [], []
        for i, o in enumerate(held.offsets[:-1].tolist()):
            starts.append((a[at[i]:at[i + 1]] - o).tolist())
            ends.append((b[at[i]:at[i + 1]] - o).tolist())
            mine = slice(o, int(held.offsets[i + 1]))
            kept.append(held.raw[mine] if not starts[-1] else held.data[mine][~gone[mine]].tobytes())
        return pa.table({"id": pa.array(held.ids, kind), "n_bytes": pa.array(np.diff(held.offsets)),
                         "starts": pa.array(starts, pa.list_(pa.int64())), "ends": pa.array(ends, pa.list_(pa.int64())),
                         "kept": pa.array(kept, pa.binary())})
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK,
                   shard_bytes: int = SHARD_BYTES, hot: int = HOT) -> DataFrame:
    """(id, n_bytes, starts, ends, kept): the byte spans each row loses, and the bytes that stay."""
    total = text_bytes(docs, text_col)
    blocks, shards = max(1, -(-total // block_bytes)), max(4, -(-total // shard_bytes))
    chunks = dealt(docs, blocks, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    by_block = chunks.groupBy("block")
    shared = by_block.applyInArrow(_ask(shards), MESSAGE).groupBy("shard").applyInArrow(_share(hot), MESSAGE)
    sent = chunks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_send(shards), MESSAGE)
    found = sent.groupBy("shard").applyInArrow(_find, MESSAGE)
    return chunks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        _remove(shards), f"id {kind}, n_bytes long, starts array<long>, ends array<long>, kept binary")


def repeats_digest(docs: DataFrame) -> DataFrame:
    """The contract's result."""
    lost = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return remove_repeats(docs).select(
        F.col("id").alias("doc_id"), "n_bytes", lost.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


# All windows as hexadecimal strings.
ORACLE_SQL = """
WITH b AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (
  SELECT doc_id, p, substring(h, 2 * p + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 49, 0))) AS p FROM b)),
f AS (SELECT s, min(doc_id) AS first_doc FROM w GROUP BY s),
gone AS (SELECT w.doc_id, w.p FROM w JOIN f ON w.s = f.s WHERE f.first_doc < w.doc_id),
bytes AS (
  SELECT doc_id, p, substring(h, 2 * p + 1, 2) AS x FROM (SELECT doc_id, h, unnest(range(0, n)) AS p FROM b)),
marked AS (
  SELECT y.doc_id, y.p, y.x, coalesce(y.p - max(g.p) OVER (PARTITION BY y.doc_id ORDER BY y.p) < 50, false) AS lost
  FROM bytes y LEFT JOIN gone g ON y.doc_id = g.doc_id AND y.p = g.p),
runs AS (
  SELECT *, lost AND NOT coalesce(lag(lost) OVER (PARTITION BY doc_id ORDER BY p), false) AS begins FROM marked),
summed AS (
  SELECT doc_id, CAST(sum(lost::INT) AS BIGINT) AS n_removed, CAST(sum(begins::INT) AS BIGINT) AS n_spans,
         sha256(unhex(coalesce(string_agg(x, '' ORDER BY p) FILTER (WHERE NOT lost), ''))) AS kept_sha256
  FROM runs GROUP BY doc_id)
SELECT b.doc_id, b.n AS n_bytes, coalesce(s.n_removed, 0) AS n_removed, coalesce(s.n_spans, 0) AS n_spans,
       coalesce(s.kept_sha256, sha256(''::BLOB)) AS kept_sha256
FROM b LEFT JOIN summed s ON b.doc_id = s.doc_id
"""
