"""Benchmark decontamination: rare word-pair seeds, an equi-join, then Smith-Waterman alignment.

A leak is a passage whose best local alignment with a test item, word by word, scores at
least ``MIN_SCORE`` (0.5) of the item's alignment with itself.

1. Items are cut into pairs of neighbouring words. One scan of the documents counts, for
   each pair, the documents that hold it, as neighbours or with one word between them.
2. Seeds are the item's rarest pairs. How many of the commonest may be left out follows
   from the score: an alignment with s pairs of neighbouring matches and u steps over a
   changed or missing word scores 2s + u + 2 at most and spans s + 2u + 1 words of the item;
   so any alignment that scores enough holds a least number of pairs (``least_pairs``, about
   a third of the item's words), and with all but ``least_pairs - SEEDS`` of them as seeds it holds
   at least ``SEEDS`` seeds. No leak of 0.5 or more is missed, however common its pairs are.
3. A second scan gives (text hash, pair, places) of the documents' seeds. An equi-join on the
   pair brings documents and items together; pairs of a text and an item with fewer
   than ``SEEDS`` places are no candidates.
4. The candidates' texts are joined by text hash with the words of their items. Around seeds
   lie passages of three to four times the item's words; one is left out only if the
   words that it has in common with the item (``MATCH`` each, ``MISMATCH`` for all between)
   cannot reach the score. The others are aligned (Smith-Waterman, linear gaps).

The scores are those of aligning whole documents (with ``min_score`` under 0.5 leaks without a
seed are missed). Documents are scanned twice at any size of the benchmark; only candidates'
texts are shuffled. Items stay in tables. What every task holds of them is a bit filter of
their pairs, of 2**``FILTER_BITS`` bits at most; beyond that size it lets more pairs through to the
join and changes no result. A hot pair is folded to one row for each text before the
join, whose sides are written tables, so adaptive execution can split it.

Words are lower-cased runs of letters and digits; in scripts that are written without
blanks (``UNSPACED``) each code point is a word.

Defined cases: null and empty texts have no leak; an item without a word never leaks;
one with fewer than ``MIN_WORDS`` words leaks where it stands whole, word for word
(score 1), unless ``short_items`` is off; an item without an id is reported under that null
id; an id may have any type; items of equal words are reported under each of their ids,
a repeated row of one id once; repeated documents in each of their rows; very long texts and
items are taken whole; of equally good passages the first counts; an empty table on either
side gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import LOWER, U64, WORD_BYTES, buffers, keep, mix, prefix_sums, runs, ship_code, span_hashes

MIN_WORDS = 6
MIN_SCORE = 0.5
#: Seeds that a leak holds at least (fewer where its item is too short for that).
SEEDS = 2
#: At most 2**28 bits (32 MB) of the items' pairs are sent to tasks.
FILTER_BITS = 28
MATCH, MISMATCH, GAP = 2, -1, -1
#: Seeds handled at once, and words of the passages laid out at once.
SEED_BATCH = 200_000
CELLS = 1 << 19
#: An item's words as a set of bits: other words can only add passages to align.
MARK_BITS = 9
TABLE_BITS = 20
BLOCK = 2_000_000
#: Code points of scripts without blanks between words: Thai, Lao, Tibetan, Burmese,
#: Khmer, and those of Chinese and Japanese.
UNSPACED = np.array([(0x0E00, 0x1000), (0x1000, 0x10A0), (0x1780, 0x1800), (0x3005, 0x3008), (0x3040, 0x3100),
                     (0x31F0, 0x3200), (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00), (0xFF66, 0xFFA0),
                     (0x20000, 0x40000)])


def text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block: hashes, starts, ends and first word of each text."""
    low = LOWER[data]
    starts, ends = runs(WORD_BYTES[low], offsets)
    lead = np.flatnonzero(data >= 0xE0)
    if len(lead):
        size = np.where(data[lead] >= 0xF0, 4, 3)
        point = (data[lead] & np.where(size == 4, 7, 15)).astype(np.int64)
        for k in range(1, 4):
            more = data[np.minimum(lead + k, len(data) - 1)] & 63
            point = np.where(k < size, point << 6 | more, point)
        side = np.searchsorted(UNSPACED.ravel(), point, "right")
        one = side % 2 == 1
        cuts = np.concatenate([lead[one], (lead + size)[one]])
        starts, ends = (np.unique(np.concatenate([old, new])) for old, new in (
            (starts, cuts[np.isin(cuts, ends, invert=True)]), (ends, cuts[np.isin(cuts, starts, invert=True)])))
    hashes = span_hashes(prefix_sums(low), starts, ends) if len(starts) else np.zeros(0, U64)
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def run_keys(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of n words and its place; none crosses a text."""
    many = len(words) - n + 1
    if many <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    h = words[:many].copy()
    for k in range(1, n):
        h = mix(h) + words[k:k + many]
    left = np.repeat(first[1:], np.diff(first))[:many] - np.arange(many)
    at = np.flatnonzero(left >= n)
    return mix(h)[at], at


def pair_keys(words: np.ndarray, first: np.ndarray, step: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with the one ``step`` after it, and the first's place; none crosses a text."""
    n = len(words) - step
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    left = np.repeat(first[1:], np.diff(first))[:n] - np.arange(n)
    at = np.flatnonzero(left > step)
    return mix(mix(words[at]) + words[at + step]), at


def least_pairs(words: int, min_score: float) -> int:
    """Pairs of neighbouring matches in any alignment of an item with so many words that scores enough."""
    for s in range(words):
        if 2 * s + (words - 1 - s) // 2 * -MISMATCH + MATCH >= min_score * MATCH * words:
            return s
    return words - 1


@dataclass
class Items:
    """Items of a block of texts: word hashes end to end, and the sorted table of their seeds."""

    ids: list
    words: np.ndarray
    first: np.ndarray
    keys: np.ndarray      # distinct seeds, sorted
    begin: np.ndarray     # for each of keys, its first occurrence (one entry more)
    item_of: np.ndarray   # for each occurrence in the order of keys, the item
    word_of: np.ndarray   # and its place in the item
    marks: np.ndarray     # for an item a row of MATCH for its words, MISMATCH for others
    short: list[tuple[int, np.ndarray, list[np.ndarray]]]  # for items of n words under MIN_WORDS: n, keys, items of each

    @staticmethod
    def of(ids: list, word_lists: list[np.ndarray], seeds: list[np.ndarray]) -> Items:
        """Items by their word hashes and the keys of the pairs that are seeds."""
        words = np.concatenate([*word_lists, np.zeros(0, U64)])
        first = np.concatenate([[0], np.cumsum([len(w) for w in word_lists])]).astype(np.int64)
        pairs, at = pair_keys(words, first)
        item = np.searchsorted(first, at, "right") - 1
        seed = np.zeros(len(pairs), bool)
        ends = np.searchsorted(item, np.arange(len(ids) + 1))
        for k, own in enumerate(seeds):
            if first[k + 1] - first[k] >= MIN_WORDS:
                seed[ends[k]:ends[k + 1]] = np.isin(pairs[ends[k]:ends[k + 1]], own)
        order = np.flatnonzero(seed)[np.argsort(pairs[seed], kind="stable")]
        keys, begin = np.unique(pairs[order], return_index=True)
        marks = np.full((len(ids), 1 << MARK_BITS), MISMATCH, np.int8)
        marks[np.repeat(np.arange(len(ids)), np.diff(first)), marks_of(words)] = MATCH
        short = []
        for n in range(1, MIN_WORDS):
            own = np.flatnonzero(np.diff(first) == n)
            if len(own):
                whole, where = run_keys(words, first, n)
                whole = whole[np.searchsorted(where, first[own])]
                found = np.unique(whole)
                short.append((n, found, [own[whole == k] for k in found]))
        return Items(ids, words, first, keys, np.append(begin, len(order)), item[order], (at - first[item])[order], marks, short)


def marks_of(words: np.ndarray) -> np.ndarray:
    return (words >> U64(64 - MARK_BITS)).astype(np.intp)


class Finder:
    """Looks word pairs up in a sorted table, behind a bit table."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(1 << TABLE_BITS, bool)
        self.bits[(keys >> U64(64 - TABLE_BITS)).astype(np.int64)] = True

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known pairs among ``grams``, and in the table."""
        maybe = np.flatnonzero(self.bits[(grams >> U64(64 - TABLE_BITS)).astype(np.int64)])
        if not len(maybe):
            return maybe, maybe
        k = np.minimum(np.searchsorted(self.keys, grams[maybe]), len(self.keys) - 1)
        ok = self.keys[k] == grams[maybe]
        return maybe[ok], k[ok]


def align(items: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment of each row of ``items`` with the same row of ``passages``.

    Both are padded with zeros, which match nothing. Returns the scores and the
    first column in which such an alignment ends.
    """
    n, width = passages.shape
    above = np.zeros((n, width + 1), np.int32)
    best, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    steps = np.arange(width + 1, dtype=np.int32) * -GAP
    for i in range(items.shape[1]):
        word = items[:, i:i + 1]
        same = (passages == word) & (word != 0)
        here = np.zeros_like(above)
        here[:, 1:] = np.maximum(above[:, :-1] + np.where(same, np.int32(MATCH), np.int32(MISMATCH)), above[:, 1:] + GAP)
        np.maximum(here, 0, out=here)
        # a gap in the item: the best cell to the left, less its distance
        here = np.maximum.accumulate(here + steps, axis=1) - steps
        top = here.argmax(1)
        value = here[np.arange(n), top]
        better = (value > best) | ((value == best) & (top - 1 < end))
        best, end = np.where(better, value, best), np.where(better, top - 1, end)
        above = here
    return best, end


def _laid_out(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words [begin, end) in rows of equal width, and which of them are in the span."""
    at = begin[:, None] + np.arange(int((end - begin).max()))
    inside = at < end[:, None]
    return np.minimum(at, len(words) - 1), inside


def _reach(words_marks: np.ndarray, begin: np.ndarray, end: np.ndarray, item: np.ndarray, items: Items) -> np.ndarray:
    """The most that an alignment of each passage [begin, end) with its item can score."""
    width = int((end - begin).max())
    kind = np.int16 if MATCH * width < 1 << 15 else np.int64
    at = begin[:, None] + np.arange(width)
    own = np.take(words_marks, at, mode="clip")
    own += (item << MARK_BITS)[:, None]
    value = np.take(items.marks.ravel(), own)
    value[at >= end[:, None]] = MISMATCH
    total = np.zeros((len(begin), width + 1), kind)
    np.cumsum(value, axis=1, dtype=kind, out=total[:, 1:])
    return (total - np.minimum.accumulate(total, axis=1)).max(1)


def _batches(width: np.ndarray) -> Iterator[np.ndarray]:
    """Places in the order of width, so many at once that CELLS holds them (or one)."""
    order = np.argsort(width, kind="stable")
    k = 0
    while k < len(order):
        n = max(1, CELLS // int(width[order[k]]))
        while n > 1 and int(width[order[min(k + n, len(order)) - 1]]) * n > CELLS:
            n = (n + 1) // 2
        yield order[k:k + n]
        k += n


def leaks_of(words: np.ndarray, first: np.ndarray, items: Items, finder: Finder, min_score: float, asked: np.ndarray
             ) -> list[tuple[int, int, float, int, int, int]]:
    """(text, item, score, first word, end word, seeds) of the leaks in a block of texts.

    ``asked`` has the candidates as text * items + item, ascending.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for step in (1, 2):
        pairs, at = pair_keys(words, first, step)
        hit, key = finder.find(pairs)
        found.append((at[hit], key))
    place, key = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(place, kind="stable")
    place, key = place[order], key[order]
    many = items.begin[key + 1] - items.begin[key]
    so_far = np.concatenate([[0], np.cumsum(many)])
    marks = marks_of(words)
    best: dict[tuple[int, int], tuple] = {}
    a = 0
    while a < len(place):
        b = max(a + 1, int(np.searchsorted(so_far, so_far[a] + SEED_BATCH, "right")) - 1)
        _leaks_at(place[a:b], key[a:b], words, marks, first, items, min_score, asked, best)
        a = b
    out = []
    for (doc, item), (score, lo, hi) in best.items():
        a, b = np.searchsorted(place, [lo, hi])
        seeds = {int(p) for p, k in zip(place[a:b], key[a:b]) if (items.item_of[items.begin[k]:items.begin[k + 1]] == item).any()}
        out.append((doc, item, score, lo, hi, len(seeds)))
    return out


def short_leaks_of(words: np.ndarray, first: np.ndarray, items: Items, finders: list[Finder], asked: np.ndarray
                   ) -> list[tuple[int, int, float, int, int, int]]:
    """Like ``leaks_of`` for the items of fewer than MIN_WORDS words, each where it first stands whole."""
    out = []
    for (n, _, owners), finder in zip(items.short, finders):
        pairs, at = run_keys(words, first, n)
        hit, key = finder.find(pairs)
        doc = np.searchsorted(first, at[hit], "right") - 1
        _, once = np.unique(doc * len(owners) + key, return_index=True)
        out += [(int(doc[i]), int(item), 1.0, int(at[hit[i]]), int(at[hit[i]]) + n, n - 1)
                for i in once.tolist() for item in owners[key[i]] if _among(doc[i] * len(items.ids) + item, asked)]
    return out


def _among(values, sorted_values: np.ndarray):
    """Which values are among the sorted ones."""
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def _leaks_at(place: np.ndarray, key: np.ndarray, words: np.ndarray, marks: np.ndarray, first: np.ndarray, items: Items,
              min_score: float, asked: np.ndarray, best: dict[tuple[int, int], tuple]) -> None:
    """Puts (score, first word, end word) of the leaks at some seeds into ``best`` by (text, item)."""
    per = items.begin[key + 1] - items.begin[key]
    occ = np.repeat(items.begin[key] - (np.cumsum(per) - per), per) + np.arange(per.sum())
    place = np.repeat(place, per)
    doc = np.searchsorted(first, place, "right") - 1
    item, start = items.item_of[occ], place - items.word_of[occ]
    wanted = _among(doc * len(items.ids) + item, asked)
    if not wanted.any():
        return
    doc, item, start = doc[wanted], item[wanted], start[wanted]
    size = np.diff(items.first)[item]
    # seeds of an item whose passages begin in the same stretch, as long as the item, share one alignment
    tile = (start - first[doc]) // size
    order = np.lexsort((start, tile, item, doc))
    doc, item, start, size, tile = doc[order], item[order], start[order], size[order], tile[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (tile[1:] != tile[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(doc)) - 1
    doc, item, size = doc[head], item[head], size[head]
    begin = np.maximum(first[doc], start[head] - size)
    end = np.minimum(first[doc + 1], start[tail] + 2 * size)
    need = min_score * MATCH * size
    likely = np.zeros(len(head), bool)
    for part in _batches(end - begin):
        likely[part] = _reach(marks, begin[part], end[part], item[part], items) >= need[part]
    doc, item, size, begin, end, need = (v[likely] for v in (doc, item, size, begin, end, need))

    def rows(source, lo, hi, back=False):
        at, inside = _laid_out(source, lo, hi)
        if back:
            at = np.maximum(hi[:, None] - 1 - np.arange(at.shape[1]), 0)
        return np.where(inside, source[at], U64(0))

    for part in _batches(end - begin):
        lo, hi, own = begin[part], end[part], items.first[item[part]]
        score, last = align(rows(items.words, own, own + size[part]), rows(words, lo, hi))
        good = np.flatnonzero(score >= need[part])
        if not len(good):
            continue
        # back from its end, which no other alignment as good lies before
        part, lo, own, score, stop = part[good], lo[good], own[good], score[good], lo[good] + last[good] + 1
        _, back = align(rows(items.words, own, own + size[part], True), rows(words, lo, stop, True))
        for c, value, w0, w1 in zip(part, score, stop - 1 - back, stop):
            name, row = (int(doc[c]), int(item[c])), (float(value / (MATCH * size[c])), int(w0), int(w1))
            if name not in best or (-row[0], row[1]) < (-best[name][0], best[name][1]):
                best[name] = row


# -- on Spark --------------------------------------------------------------------------

def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64), pa.int64())


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (item_id, text) into (item_id, item, n, words); item is a hash of the words."""
    for batch in batches:
        for a, b, data, off in buffers(batch.column(1), BLOCK):
            words, _, _, first = text_words(data, off)
            n = np.diff(first)
            some = np.flatnonzero(n)
            if not len(some):
                continue
            turn = (np.arange(len(words)) - np.repeat(first[:-1], n)).astype(U64)
            item = mix(np.add.reduceat(mix(words + mix(turn)), first[some]) + n[some].astype(U64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a).take(pa.array(some)), _signed(item), pa.array(n[some], pa.int32()),
                 pa.array([words[first[k]:first[k + 1]].tobytes() for k in some], pa.binary())], ["item_id", "item", "n", "words"])


def _item_pairs(min_score: float):
    """Rows (item, words) into the item's pairs: (key, item, place, spare, need); a short item has one key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = np.frombuffer(raw, U64)
                n = len(words)
                keys, _ = run_keys(words, np.array([0, n]), 2 if n >= MIN_WORDS else n)
                least = max(1, least_pairs(n, min_score)) if n >= MIN_WORDS else 1
                need = min(SEEDS, least)
                same = lambda v, t: pa.array(np.full(len(keys), v), t)
                yield pa.RecordBatch.from_arrays(
                    [_signed(keys), same(item, pa.int64()), pa.array(np.arange(len(keys)), pa.int32()),
                     same(least - need, pa.int32()), same(need, pa.int32()), same(n, pa.int32())],
                    ["key", "item", "place", "spare", "need", "n"])
    return run


class Filter:
    """The leading bits of a set of keys; other keys may pass, none of the set is lost."""

    def __init__(self, keys: DataFrame):
        many = keys.count()
        self.bits = min(FILTER_BITS, max(16, int(many * 16).bit_length()))
        lead = F.shiftrightunsigned("key", 64 - self.bits) + 1  # bitmaps count from 1
        rows = keys.select(lead.alias("lead")).groupBy(F.bitmap_bucket_number("lead").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("lead")).alias("bits")).collect()
        packed = np.zeros(max(1, (1 << self.bits) // 32768) * 4096, np.uint8)
        for r in rows:
            packed[(r.bucket - 1) * 4096:r.bucket * 4096] = np.frombuffer(bytes(r.bits), np.uint8)
        self.packed = packed

    def passing(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> U64(64 - self.bits)
        return np.flatnonzero(self.packed[(at >> U64(3)).astype(np.intp)] >> (at & U64(7)).astype(np.uint8) & 1)


def _passing(words: np.ndarray, first: np.ndarray, known: Filter, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Texts and keys of the pairs, and of the runs of some lengths, that pass."""
    texts, found = [], []
    for keys, at in [*(pair_keys(words, first, step) for step in (1, 2)), *(run_keys(words, first, n) for n in lengths)]:
        ok = known.passing(keys)
        texts.append(np.searchsorted(first, at[ok], "right") - 1)
        found.append(keys[ok])
    return np.concatenate(texts), np.concatenate(found)


def _folded(texts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, key), and how often each is there."""
    order = np.lexsort((texts, keys))
    texts, keys = texts[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1])
    head = np.flatnonzero(new)
    return texts[head], keys[head], np.diff(np.append(head, len(keys)))


def _doc_counts(known: Filter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, off in buffers(batch.column(0), BLOCK):
                words, _, _, first = text_words(data, off)
                _, keys, _ = _folded(*_passing(words, first, known, []))
                keys, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([_signed(keys), pa.array(n, pa.int64())], ["key", "docs"])
    return run


def _hits(known: Filter, lengths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, data, off in buffers(batch.column(1), BLOCK):
                words, _, _, first = text_words(data, off)
                text, keys, n = _folded(*_passing(words, first, known, lengths))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(a + text)), _signed(keys), pa.array(n, pa.int64())], ["text_hash", "key", "n"])
    return run


def _aligned(min_score: float):
    """Rows (id, text, items: [(item, words, keys)]) into (id, item, score, span_start, span_end, seeds)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, item, score, lo, hi, n = [], [], [], [], [], []
            for a, b, data, off in buffers(batch.column(1), BLOCK):
                number: dict[int, int] = {}
                ids, word_lists, seeds, asked = [], [], [], []
                for doc, own in enumerate(batch.column(2).slice(a, b - a).to_pylist()):
                    for it in own:
                        if it["item"] not in number:
                            number[it["item"]] = len(ids)
                            ids.append(it["item"])
                            word_lists.append(np.frombuffer(it["words"], U64))
                            seeds.append(np.array(it["keys"], np.int64).view(U64))
                        asked.append((doc, number[it["item"]]))
                items = Items.of(ids, word_lists, seeds)
                wanted = np.unique(np.array([d * len(ids) + k for d, k in asked], np.int64))
                words, starts, ends, first = text_words(data, off)
                rows = leaks_of(words, first, items, Finder(items.keys), min_score, wanted) if len(items.keys) else []
                rows += short_leaks_of(words, first, items, [Finder(keys) for _, keys, _ in items.short], wanted)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                for doc, it, sc, w0, w1, many in rows:
                    base = chars[off[doc]]
                    row.append(a + doc)
                    item.append(items.ids[it])
                    score.append(sc)
                    lo.append(int(chars[starts[w0]] - base))
                    hi.append(int(chars[ends[max(w0, w1 - 1)]] - base))
                    n.append(many)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(item, pa.int64()), pa.array(score, pa.float64()),
                 pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(n, pa.int32())],
                ["id", "item", "score", "span_start", "span_end", "seeds"])
    return run


def rare_seeds(texts: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(key, item, need) of each item's seeds, for ``items`` (item, n, words) and ``texts`` (text)."""
    pairs = keep(items.select("item", "words").mapInArrow(
        _item_pairs(min_score), "key long, item long, place int, spare int, need int, n int"), "item_pairs")
    long = pairs.where(F.col("n") >= MIN_WORDS)
    docs = texts.mapInArrow(_doc_counts(Filter(long)), "key long, docs long").groupBy("key").agg(F.sum("docs").alias("docs"))
    ranked = long.join(docs, "key", "left").withColumn("common", F.row_number().over(
        Window.partitionBy("item").orderBy(F.col("docs").desc_nulls_last(), "place")))
    rare = ranked.where("common > spare AND docs IS NOT NULL")  # a pair of no document joins nothing
    return rare.select("key", "item", "need").unionByName(pairs.where(F.col("n") < MIN_WORDS).select("key", "item", "need")).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_score: float = MIN_SCORE, short_items: bool = True) -> DataFrame:
    """(id, item_id, score, span_start, span_end, seeds): each item's best leak in each document.

    The span is in code points of the text; seeds are the words of it at which a seed of the
    item begins (for a short item, its words less one).
    """
    ship_code(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    kind, item_kind = plain.schema["id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    tests = benchmark.select("item_id", "text").where("text IS NOT NULL").mapInArrow(
        _item_words, f"item_id {item_kind}, item long, n int, words binary")
    tests = keep(tests if short_items else tests.where(F.col("n") >= MIN_WORDS), "items")
    names, items = tests.select("item", "item_id").distinct(), tests.dropDuplicates(["item"]).select("item", "n", "words")
    seeds = keep(rare_seeds(plain.select("text"), items, min_score), "seeds")
    lengths = sorted(r.n for r in items.where((F.col("n") < MIN_WORDS) & (F.col("n") != 2)).select("n").distinct().collect())
    hits = plain.select(F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        _hits(Filter(seeds), lengths), "text_hash long, key long, n long")
    hits = keep(hits.groupBy("text_hash", "key").agg(F.max("n").alias("n")), "hits")
    pairs = hits.join(seeds, "key").groupBy("text_hash", "item").agg(F.sum("n").alias("n"), F.max("need").alias("need"))
    pairs = pairs.where("n >= need").select("text_hash", "item")
    own = items.join(seeds.groupBy("item").agg(F.collect_list("key").alias("keys")), "item")
    asked = pairs.join(own, "item").groupBy("text_hash").agg(F.collect_list(F.struct("item", "words", "keys")).alias("items"))
    asked = keep(asked, "candidates")
    found = plain.withColumn("text_hash", F.xxhash64("text")).join(asked, "text_hash").select("id", "text", "items").mapInArrow(
        _aligned(min_score), f"id {kind}, item long, score double, span_start long, span_end long, seeds int")
    return found.join(names, "item").select("id", "item_id", "score", "span_start", "span_end", "seeds")


def leak_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark).withColumnRenamed("id", "doc_id")
