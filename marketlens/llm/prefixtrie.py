"""Conversation prefix trie: subtree figures from an Euler tour.

``rebuilt`` gives every conversation its turns (below), a trie node is a distinct
sequence of first turns, and ``trie`` returns its nodes with members, children,
leaves and savings. A sequence is known by a polynomial hash modulo 2**61 - 1 in two
lanes, so a node's key comes from sums over a conversation's turns and never from
following the trie level by level; depth costs no rounds.

The tour. Nodes are sorted by (parent, own smallest member) and numbered in that
order, so that siblings are neighbours. Each node has an enter and an exit arc; an
arc's successor follows from the first and last child of each family. ``list_rank``
numbers the arcs:

* arcs are dealt into blocks of ``BLOCK`` consecutive nodes; in a block, chains are
  contracted by pointer doubling, and one element a chain is left;
* longer lists go on with random mates: an element whose coin is 1 is spliced out by
  a predecessor whose coin is 0, about a quarter of the list in each round, until
  ``LAST`` elements or fewer are left, which are ranked at once;
* the rounds are undone in reverse order: rank = rank of the splicing element + offset.

At the arcs' positions, leaves and savings stand at the enter arcs. Prefix sums (by
chunks of ``CHUNK`` positions, then over chunks, level by level) give a subtree's
total: the sum at its exit arc less the sum before its enter arc.

Scale. Turn numbers and hashes of a conversation are a scan over a range-partitioned
sort, so a conversation of any length is spread over tasks; one row for each task
(``carries``) reaches the driver. Hot nodes are folded on the map side. Children of
one parent are spread by the sort. Joins have one row per key on one side, both
sides written or shuffled plainly, so that adaptive execution can split a hot key. Members that end
at a node are joined in groups of at most ``CHUNK`` consecutive ids, and the strings of a node
are hashed in a stream. Intermediate tables are written to the shared folder.

The rebuilt conversation c: the first h turns of conversation c - c % 20 (``%`` with
the sign of c), then c's own turns after its first h; h = crc32(decimal c) % 4.

Defined cases: turns are in the order of (turn, role, text), nulls first; a null role
or text is empty; repeated rows are turns of their own; rows without a conv_id belong
to no conversation; an absent base gives no turns; a conversation without turns is a
member of the root only; an empty table has no nodes; texts of any length are whole;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import U64, keep, ship_code

FAMILY = 20
HEADS = 4           # h is 0 to 3
BLOCK = 1024        # nodes of a block of the tour
LAST = 100_000      # list elements ranked at once
CHUNK = 4096        # positions, or consecutive ids, that are summed or joined together
WORD = "[^\\x20\\x09-\\x0D]+"

# The Mersenne prime of the hashes and their bases.
PRIME = U64((1 << 61) - 1)
BASES = (U64(0x0123456789ABCDE1), U64(0x1A2B3C4D5E6F7081))


# -- arithmetic modulo 2**61 - 1 -----------------------------------------------------------

def fold(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> U64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product modulo the prime of numbers below it."""
    ah, al, bh, bl = a >> U64(31), a & U64(0x7FFFFFFF), b >> U64(31), b & U64(0x7FFFFFFF)
    mid = al * bh + ah * bl
    return fold(fold(ah * bh * U64(2) + (mid >> U64(30))) + fold(((mid & U64(0x3FFFFFFF)) << U64(31)) + al * bl))


def minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return fold(a + PRIME - b)


def power(base, exponents: np.ndarray) -> np.ndarray:
    out = np.ones(len(exponents), U64)
    left, square = exponents.astype(np.int64), np.array([base], U64)
    while (left > 0).any():
        out = np.where(left & 1, times(out, square), out)
        square, left = times(square, square), left >> 1
    return out


def running(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Running sums modulo the prime, anew at each position in ``begins`` (0 is one)."""
    high, low = np.cumsum(values >> U64(31)), np.cumsum(values & U64(0x7FFFFFFF))
    segment = np.repeat(begins, np.diff(np.r_[begins, len(values)]))
    high, low = high - (high[segment] - (values[segment] >> U64(31))), low - (low[segment] - (values[segment] & U64(0x7FFFFFFF)))
    return fold(times(fold(high), U64(1 << 31)) + fold(low))


# -- turns, numbered and hashed ---------------------------------------------------------------

def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv, words, t0, t1) into (part, at, conv, i, words, t0, t1, p0, p1): a turn's
    number in its conversation and the hash up to it, as far as this task has seen."""
    part, at = TaskContext.get().partitionId(), 0
    conv, seen, sums = None, 0, [0, 0]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        c = batch.column(0).to_numpy()
        begins = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        i = np.arange(n) - np.repeat(begins, np.diff(np.r_[begins, n]))
        goes_on = np.zeros(n, bool)
        if conv is not None and c[0] == conv:
            goes_on[:begins[1] if len(begins) > 1 else n] = True
        i = i + goes_on * seen
        tokens = [fold(batch.column(k).to_numpy().view(U64)) for k in (2, 3)]
        hashes = []
        for lane, (t, base) in enumerate(zip(tokens, BASES)):
            p = running(times(t, power(base, i)), begins)
            hashes.append(np.where(goes_on, fold(p + U64(sums[lane])), p))
        conv, seen, sums = c[-1], int(i[-1]) + 1, [int(p[-1]) for p in hashes]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(at, at + n), pa.int64()), batch.column(0),
             pa.array(i, pa.int64()), batch.column(1), *[pa.array(x.astype(np.int64)) for x in (*tokens, *hashes)]],
            ["part", "at", "conv", "i", "words", "t0", "t1", "p0", "p1"])
        at += n


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv, i, words, t0, t1, p0, p1) of every turn: its number from 0, words of its text,
    hashes of the turn and of the conversation up to it."""
    ship_code(conversations.sparkSession)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    plain = conversations.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                                 text(role_col).alias("role"), text(text_col).alias("text")).where("conv IS NOT NULL")
    scanned = keep(
        plain.repartitionByRange("conv", F.col("turn").asc_nulls_first(), "role", "text")
        .sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
        .select("conv", F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
                *[F.xxhash64(F.lit(k), "role", "text").alias(f"t{k}") for k in (0, 1)])
        .mapInArrow(_scan, "part int, at long, conv long, i long, words long, t0 long, t1 long, p0 long, p1 long"), "turns")
    held = carries(scanned)
    if not held:
        return scanned.drop("part", "at")

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, conv, i = (batch.column(c).to_numpy() for c in ("part", "conv", "i"))
            more = np.zeros(len(i), np.int64)
            before = [np.zeros(len(i), U64), np.zeros(len(i), U64)]
            for p in np.unique(part):
                if int(p) in held:
                    c, n, sums = held[int(p)]
                    on = (part == p) & (conv == c)
                    more[on] = n
                    for lane in (0, 1):
                        before[lane][on] = sums[lane]
            found = []
            for lane, base in enumerate(BASES):
                p = batch.column(f"p{lane}").to_numpy().astype(U64)
                found.append(pa.array(fold(times(p, power(base, more)) + before[lane]).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array(i + more), *[batch.column(c) for c in ("words", "t0", "t1")], *found],
                ["conv", "i", "words", "t0", "t1", "p0", "p1"])

    return keep(scanned.mapInArrow(carry, "conv long, i long, words long, t0 long, t1 long, p0 long, p1 long"), "turns_carried")


def carries(scanned: DataFrame) -> dict[int, tuple[int, int, tuple[int, int]]]:
    """For each task that begins inside a conversation: that conversation, the turns of it that
    earlier tasks had, and their hash. One row a task is looked at."""
    ends = scanned.groupBy("part").agg(F.min(F.struct("at", "conv")).alias("a"),
                                       F.max(F.struct("at", "conv", "i", "p0", "p1")).alias("z")).orderBy("part").collect()
    held, last = {}, None
    for r in ends:
        first, end = r["a"]["conv"], r["z"]
        n, sums = end["i"] + 1, (end["p0"], end["p1"])
        if last and last[0] == first:
            held[r["part"]] = last
            if end["conv"] == first:  # the whole task is inside this conversation
                sums = tuple(int((s + pow(int(b), last[1], int(PRIME)) * p) % int(PRIME))
                             for s, p, b in zip(last[2], sums, BASES))
                n += last[1]
        last = (end["conv"], n, sums)
    return held


def rebuilt(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv, depth, f0, f1, g0, g1, words): a rebuilt conversation's prefix of ``depth`` turns, the prefix
    before it, and the words of its last turn; and (conv, depth, f0, f1): where each conversation ends."""
    at = lambda c, k: F.coalesce(F.max(F.when(F.col("i") == k, F.col(c))), F.lit(0).cast("long"))
    heads = keep(scanned.groupBy("conv").agg(
        (F.max("i") + 1).alias("n"), *[F.array(*[at(c, k) for k in range(HEADS - 1)]).alias(c) for c in ("p0", "p1", "words")]),
        "heads")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    base = heads.select(F.col("conv").alias("base"), F.col("n").alias("base_n"),
                        *[F.col(c).alias(f"base_{c}") for c in ("p0", "p1", "words")])
    upto = lambda c, k: F.when(k > 0, F.get(c, (k - 1).cast("int"))).otherwise(F.lit(0).cast("long"))
    own = heads.withColumn("h", h.cast("long")).withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
    plan = keep(own.join(base, "base", "left")
                .withColumn("lead", F.least("h", F.coalesce("base_n", F.lit(0).cast("long"))))
                .select("conv", "h", "lead", (F.col("lead") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
                        *[F.coalesce(upto(f"base_p{k}", F.col("lead")), F.lit(0).cast("long")).alias(f"lead{k}") for k in (0, 1)],
                        *[upto(f"p{k}", F.col("h")).alias(f"own{k}") for k in (0, 1)],
                        "base_p0", "base_p1", "base_words"), "rebuilt")
    first = plan.select("conv", "length", F.explode(F.expr(f"""filter(transform(sequence(1, {HEADS - 1}), j -> struct(
        CAST(j AS long) AS depth, base_p0[j - 1] AS f0, base_p1[j - 1] AS f1,
        CASE WHEN j > 1 THEN base_p0[j - 2] ELSE 0L END AS g0, CASE WHEN j > 1 THEN base_p1[j - 2] ELSE 0L END AS g1,
        base_words[j - 1] AS words)), x -> x.depth <= lead)""")).alias("x")).select("conv", "length", "x.*")
    tail = scanned.join(plan.select("conv", "h", "lead", "length", "lead0", "lead1", "own0", "own1"), "conv").where("i >= h")

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = lambda c: batch.column(c).to_numpy()
            i, up = col("i"), col("h") - col("lead")
            f, g = [], []
            for k, base in enumerate(BASES):
                back = power(pow(int(base), -1, int(PRIME)), up)
                t, p, lead, before = (col(f"{c}{k}").view(U64) for c in ("t", "p", "lead", "own"))
                here = fold(times(minus(p, before), back) + lead)
                f.append(here)
                g.append(minus(here, times(t, power(base, i - up))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("length"), pa.array(i - up + 1),
                 *[pa.array(x.astype(np.int64)) for x in (*f, *g)], batch.column("words")],
                ["conv", "length", "depth", "f0", "f1", "g0", "g1", "words"])

    rows = keep(tail.mapInArrow(moved, "conv long, length long, depth long, f0 long, f1 long, g0 long, g1 long, words long")
                .unionByName(first), "prefixes")
    zero = F.lit(0).cast("long")
    ends = rows.where("depth = length").select("conv", "depth", "f0", "f1").unionByName(
        plan.where("length = 0").select("conv", zero.alias("depth"), zero.alias("f0"), zero.alias("f1")))
    return rows.drop("length"), ends


# -- the members that end at a node ---------------------------------------------------------------

def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, f0, f1, ids) into one digest of the joined ids for each node."""
    key, state = None, None
    done: list[tuple] = []
    for batch in batches:
        for *k, ids in zip(*[batch.column(c).to_pylist() for c in range(4)]):
            if k != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _digests(done)
        done = []
    if key is not None:
        yield _digests([(*key, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      ["depth", "f0", "f1", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, f0, f1, ends_sha256): the hash of the ids that end at a node, ascending."""
    groups = ends.groupBy("depth", "f0", "f1", F.floor(F.col("conv") / CHUNK).alias("group")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    return (groups.repartition("depth", "f0", "f1").sortWithinPartitions("depth", "f0", "f1", "group")
            .select("depth", "f0", "f1", "ids").mapInArrow(_streamed, "depth long, f0 long, f1 long, ends_sha256 string"))


# -- nodes, numbered ------------------------------------------------------------------------------

def nodes(rows: DataFrame, root: int) -> DataFrame:
    """(depth, f0, f1, conv, parent, n_convs, words) of every node but the root."""
    found = keep(rows.groupBy("depth", "f0", "f1").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.max("g0").alias("g0"), F.max("g1").alias("g1")), "nodes")
    above = found.select((F.col("depth") + 1).alias("depth"), F.col("f0").alias("g0"), F.col("f1").alias("g1"),
                         F.col("conv").alias("parent"))
    deep = found.where("depth > 1").join(above, ["depth", "g0", "g1"])
    top = found.where("depth = 1").withColumn("parent", F.lit(root).cast("long"))
    return keep(deep.unionByName(top).drop("g0", "g1"), "linked_nodes")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(at, at + n), pa.int64()), *batch.columns],
            ["part", "at", *batch.schema.names])
        at += n


def numbered(linked: DataFrame) -> DataFrame:
    """``linked`` with ``id``: 1, 2, … in the order of (parent, depth, conv); the root is 0."""
    order = ["parent", "depth", "conv"]
    sorted_ = keep(linked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _numbered, "part int, at long, depth long, f0 long, f1 long, conv long, n_convs long, words long, parent long"), "sorted_nodes")
    sizes = sorted_.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # one row a task
    first, total = {}, 1
    for r in sizes:
        first[r["part"]] = total
        total += r["n"]
    starts = linked.sparkSession.createDataFrame(list(first.items()), "part int, start long")
    return sorted_.join(F.broadcast(starts), "part").withColumn("id", F.col("start") + F.col("at")).drop("part", "at", "start")


# -- the Euler tour -----------------------------------------------------------------------------------
# Arcs: 2 * id enters a node, 2 * id + 1 leaves it.

def tour(numbered_nodes: DataFrame, families: DataFrame) -> DataFrame:
    """(arc, next) of every arc; the last one, which leaves the root, has no next."""
    own = numbered_nodes.select("id", "conv", "depth").unionByName(
        families.where("depth = 0").select(F.lit(0).cast("long").alias("id"), "conv", "depth"))
    joined = own.join(families, ["conv", "depth"], "left")
    enter = joined.select((2 * F.col("id")).alias("arc"),
                          F.coalesce(2 * F.col("first"), 2 * F.col("id") + 1).alias("next"), F.col("id").alias("of"))
    # a node's exit leads to its next neighbour; the last child's leads to the parent's exit
    inner = joined.where("first IS NOT NULL").select("id", "first", "last")
    climbs = inner.select((2 * F.col("last") + 1).alias("arc"), (2 * F.col("id") + 1).alias("next"), F.col("last").alias("of"))
    steps = numbered_nodes.select("id").join(inner.select(F.col("last").alias("id")), "id", "left_anti").select(
        (2 * F.col("id") + 1).alias("arc"), (2 * F.col("id") + 2).alias("next"), F.col("id").alias("of"))
    end = own.where("id = 0").select((2 * F.col("id") + 1).alias("arc"), F.lit(None).cast("long").alias("next"), F.col("id").alias("of"))
    return enter.union(climbs).union(steps).union(end)


def _chains(rows: pa.Table) -> pa.Table:
    """Contract the chains inside a block: each arc's chain head and offset, each chain's way out."""
    order = np.argsort(rows["arc"].to_numpy())
    arc = rows["arc"].to_numpy()[order]
    out = rows["next"].fill_null(-1).to_numpy()[order]
    n = len(arc)
    place = np.searchsorted(arc, out)
    inside = (place < n) & (arc[np.minimum(place, n - 1)] == out)
    back = np.arange(n)                       # predecessor in the block, or itself
    back[place[inside]] = np.flatnonzero(inside)
    jump = (back != np.arange(n)).astype(np.int64)
    for _ in range(max(1, n.bit_length())):   # pointer doubling
        jump = jump + jump[back]
        back = back[back]
    return pa.table({"arc": arc, "head": arc[back], "at": jump,
                     "next": pa.array(out, mask=inside | (out < 0)), "tail": ~inside})


def list_rank(arcs: DataFrame, first: int = 0, block: int = BLOCK, last: int = LAST) -> DataFrame:
    """(arc, pos): the position of every arc of the list that begins with ``first``.

    ``arcs`` has the columns arc, next (null at the end) and of (a dense number; arcs of
    ``block`` consecutive numbers are contracted together).
    """
    chains = keep(arcs.select("arc", "next", F.floor(F.col("of") / block).alias("block")).groupBy("block").applyInArrow(
        _chains, "arc long, head long, at long, next long, tail boolean"), "chains")
    live = keep(chains.where("tail").select(F.col("head").alias("arc"), "next", (F.col("at") + 1).alias("weight")), "list")
    spliced: list[DataFrame] = []
    count = live.count()
    while count > last:
        seed = len(spliced)
        coin = lambda c: F.pmod(F.xxhash64(F.lit(seed), c), F.lit(2))  # noqa: B023, E731
        marked = live.withColumn("calls", (coin("arc") == 0) & F.col("next").isNotNull() & (coin("next") == 1))
        calls = marked.where("calls").select(F.col("arc").alias("caller"), F.col("weight").alias("caller_weight"), F.col("next").alias("arc"))
        met = marked.where(coin("arc") == 1).drop("calls").join(calls, "arc", "left")
        others = marked.where((coin("arc") == 0) & ~F.col("calls")).select(
            "arc", "next", "weight", F.lit(None).cast("long").alias("caller"), F.lit(None).cast("long").alias("caller_weight"))
        state = keep(met.select("arc", "next", "weight", "caller", "caller_weight").union(others), "mates")
        spliced.append(state.where("caller IS NOT NULL").select("arc", "caller", "caller_weight"))
        live = state.select(F.coalesce("caller", "arc").alias("arc"), "next",
                            (F.col("weight") + F.coalesce("caller_weight", F.lit(0).cast("long"))).alias("weight"))
        count = live.count()
    # LAST elements at most: walked here
    rows = {r["arc"]: (r["next"], r["weight"]) for r in live.collect()}
    at, pos, found = first, 0, []
    while at is not None:
        found.append((at, pos))
        at, pos = rows[at][0], pos + rows[at][1]
    ranks = arcs.sparkSession.createDataFrame(found, "arc long, pos long")
    for gone in reversed(spliced):
        back = gone.join(ranks.withColumnRenamed("arc", "caller"), "caller").select(
            "arc", (F.col("pos") + F.col("caller_weight")).alias("pos"))
        ranks = keep(ranks.union(back), "ranks")
    heads = ranks.withColumnRenamed("arc", "head")
    return chains.select("arc", "head", "at").join(heads, "head").select("arc", (F.col("pos") + F.col("at")).alias("pos"))


def running_totals(rows: DataFrame, values: list[str], chunk: int = CHUNK) -> DataFrame:
    """``rows`` (dense ``pos`` from 0) with each value replaced by its sum up to and with that position."""
    chunked = rows.withColumn("_chunk", F.floor(F.col("pos") / chunk))
    so_far = Window.partitionBy("_chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = chunked.select(*[F.sum(c).over(so_far).alias(c) if c in values else F.col(c) for c in chunked.columns])
    sums = keep(chunked.groupBy(F.col("_chunk").alias("pos")).agg(*[F.sum(c).alias(c) for c in values]), "chunk_sums")
    if sums.count() <= 1:
        return inside.drop("_chunk")
    whole = running_totals(sums, values, chunk)
    before = whole.select((F.col("pos") + 1).alias("_chunk"), *[F.col(c).alias(f"_{c}") for c in values])
    zero = F.lit(0).cast("long")
    return inside.join(before, "_chunk", "left").select(
        *[(F.col(c) + F.coalesce(f"_{c}", zero)).alias(c) if c in values else F.col(c) for c in rows.columns])


NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")


def trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
         text_col: str = "text", block: int = BLOCK, last: int = LAST, chunk: int = CHUNK) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations; columns as in ``NODE``."""
    spark = conversations.sparkSession
    rows, ends = rebuilt(turns(conversations, conv_col, turn_col, role_col, text_col))
    all_ = ends.agg(F.count("*").alias("n"), F.min("conv").alias("conv")).first()
    if not all_["n"]:
        return spark.createDataFrame([], NODE)
    root = all_["conv"]
    here = keep(numbered(nodes(rows, root)), "numbered_nodes")
    families = here.groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n_children"))
    families = keep(families, "families")
    if not here.limit(1).count():  # only turnless conversations: the root stands alone
        families = spark.createDataFrame([(root, 0, None, None, 0)],
                                         "conv long, depth long, first long, last long, n_children long")
    places = keep(list_rank(tour(here, families), 0, block, last), "places")
    zero = F.lit(0).cast("long")
    top = spark.createDataFrame([(0, 0, 0, root, all_["n"], 0, None, 0)],
                                "depth long, f0 long, f1 long, conv long, n_convs long, words long, parent long, id long")
    known = here.unionByName(top).join(families.select("conv", "depth", "n_children"), ["conv", "depth"], "left")
    known = keep(known.withColumn("n_children", F.coalesce("n_children", zero)), "known_nodes")
    at_arcs = places.withColumn("id", F.floor(F.col("arc") / 2)).join(
        known.select("id", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                     ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "id")
    enters = F.col("arc") % 2 == 0
    valued = at_arcs.select("id", "pos", enters.alias("enters"), *[F.when(enters, F.col(c)).otherwise(zero).alias(c)
                                                                 for c in ("leaves", "saved")],
                            *[F.when(enters, F.col(c)).otherwise(zero).alias(f"own_{c}") for c in ("leaves", "saved")])
    sums = running_totals(valued, ["leaves", "saved"], chunk)
    # up to the exit, less what stands before the enter arc
    total = lambda c: F.sum(F.when(F.col("enters"), F.col(f"own_{c}") - F.col(c)).otherwise(F.col(c)))
    per_node = sums.groupBy("id").agg(total("leaves").alias("n_leaves"), total("saved").alias("saved_tokens"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (known.join(per_node, "id").join(end_digests(ends), ["depth", "f0", "f1"], "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                    "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))


def trie_digest(conversations: DataFrame) -> DataFrame:
    """The contract's result, one row per node."""
    return trie(conversations)


_CRC_STEP = "CASE WHEN {c} % 2 = 1 THEN xor({c} // 2, 3988292384) ELSE {c} // 2 END"


def _crc32_sql(column: str) -> str:
    """CRC-32 of the decimal digits of a column, eight shifts a character (DuckDB has no such function)."""
    body = "xor(s, CAST(ascii(ch) AS BIGINT))"
    steps = ["list_reduce(list_prepend({0}, range(8)), lambda c, k: {1})".format(body, _CRC_STEP.format(c="c"))]
    chars = f"list_transform(string_split(CAST({column} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {chars}), lambda s, ch: "
            + steps[0].replace("CAST(ascii(ch) AS BIGINT)", "ch") + "), 4294967295)")


ORACLE_SQL = f"""
WITH own AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hs AS (SELECT *, {_crc32_sql('conv_id')} % 4 AS h FROM own),
seqs AS (
  SELECT c.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, c.h), list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
  FROM hs c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
prefixes AS (
  SELECT conv_id, len(turns) AS length, unnest(range(0, len(turns) + 1)) AS depth, turns FROM seqs),
keyed AS (
  SELECT conv_id, length, depth, list_slice(turns, 1, depth) AS seq,
         CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(turns[depth].t, '[^ \\t-\\r]+')) END AS words FROM prefixes),
node AS (
  SELECT depth, seq, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = depth), '')) AS ends_sha256
  FROM keyed GROUP BY depth, seq),
child AS (
  SELECT depth - 1 AS depth, list_slice(seq, 1, depth - 1) AS seq, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1, 2),
full_node AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children, p.conv_id AS parent_conv_id
  FROM node n LEFT JOIN child c ON c.depth = n.depth AND c.seq = n.seq
  LEFT JOIN node p ON p.depth = n.depth - 1 AND p.seq = list_slice(n.seq, 1, n.depth - 1)),
above AS (SELECT *, unnest(range(0, depth + 1)) AS up FROM full_node),
subtree AS (
  SELECT up AS depth, list_slice(seq, 1, up) AS seq, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
         CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens FROM above GROUP BY 1, 2)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM full_node n JOIN subtree s ON s.depth = n.depth AND s.seq = n.seq
"""
