"""Line de-duplication with DataFrame functions only.

A line's key is the line without surrounding white space, in ASCII lower case.
Lines are exploded as (document, position, 128-bit key hash); a key that occurs
in at least ``min_docs`` documents is repeated; every line with a repeated key is
dropped except in the smallest document id that holds it; the other lines are
put together again by position.

Scale: only 16-byte hashes are shuffled by key, folded on the map side first, so
a hot line is one row per map task. The repeated keys are written to the shared
folder. Finding the dropped lines is an inner join
that adaptive execution can split at a hot key. The texts are shuffled once, by
document. Only documents that lose a line are cut up again.

Defined cases: a null or empty text is one empty line; a document id that occurs
more than once counts as one document, and each of its rows keeps or loses the
same keys; a row without an id keeps its lines; a text whose lines all go becomes
empty; an empty table gives no rows; a very long text is cut up like any other; ties
do not occur, as the smallest id is one value. Input columns other than the id and the
text pass through: the names used here inside are chosen so that no column has them, and
an input column with the name of a count is replaced by it (``counts=None`` adds none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import keep, unused

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c):
    """A-Z in lower case; ``lower`` is the same, and faster, for ASCII text."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, pos from 1, key) of the lines whose key has at least ``min_chars`` code points."""
    lines = docs.select(F.col(id_col).alias("id"), F.posexplode(
        F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("at", "line"))
    keyed = lines.where(F.char_length("line") >= min_chars).select(
        "id", (F.col("at") + 1).alias("pos"), F.trim(F.col("line"), F.lit(WHITE)).alias("bare"))
    return keyed.where(F.char_length("bare") >= min_chars).select(
        "id", "pos", F.coalesce(F.unhex(F.md5(ascii_lower(F.col("bare")).cast("binary"))),
                                F.lit(b"")).alias("key"))  # never null: no second md5 in a null filter


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """(id, positions): the 1-based positions that each document loses, ascending."""
    if min_docs < 2:
        raise ValueError("a repeated line is in two documents at least")
    keys = line_keys(docs, id_col, text_col, min_chars)
    if min_docs == 2:
        repeated = (keys.groupBy("key").agg(F.min("id").alias("keeper"), F.max("id").alias("last"))
                    .where("keeper < last").select("key", "keeper"))
    else:
        repeated = (keys.select("key", "id").distinct().groupBy("key")
                    .agg(F.min("id").alias("keeper"), F.count("*").alias("n"))
                    .where(F.col("n") >= min_docs).select("key", "keeper"))
    # written first: the join then has two shuffles of its own and a hot key can be split
    repeated = keep(repeated, "repeated_lines")
    gone = keys.join(repeated, "key").where("id > keeper").select("id", "pos")
    return gone.groupBy("id").agg(F.sort_array(F.collect_set("pos")).alias("positions"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2, min_chars: int = 10,
                counts: tuple[str, str] | None = ("_n_lines", "_n_dropped")) -> DataFrame:
    """``docs`` with the text de-duplicated, and the numbers of its lines and of those dropped under the names ``counts``."""
    own, gone, lines = unused(docs, "_line_id", "_line_gone", "_line_all")
    lost = dropped_lines(docs, id_col, text_col, min_docs, min_chars).select(
        F.col("id").alias(own), F.col("positions").alias(gone))
    joined = docs.join(lost, F.col(id_col) == F.col(own), "left")
    cut = joined.withColumn(lines, F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1))
    # the kept lines are the slices between dropped positions
    kept = F.expr(f"""array_join(flatten(transform(sequence(0, size({gone})), i -> slice({lines},
        CASE WHEN i = 0 THEN 1 ELSE {gone}[i - 1] + 1 END,
        CASE WHEN i = size({gone}) THEN size({lines}) + 1 ELSE {gone}[i] END
          - CASE WHEN i = 0 THEN 1 ELSE {gone}[i - 1] + 1 END))), '\n')""")
    text = F.when(F.col(gone).isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(kept)
    added = [] if counts is None else [F.size(lines).cast("long").alias(counts[0]),
                                       F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(counts[1])]
    replaced = {c.lower() for c in counts or ()}
    columns = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c.lower() not in replaced]
    return cut.select(*columns, *added)


def line_digest(docs: DataFrame) -> DataFrame:
    """The contract's result, one row per document."""
    d = dedup_lines(docs.select("doc_id", "text"))
    return d.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                    F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos
  FROM documents),
bare AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
rep AS (
  SELECT k, min(doc_id) AS keeper FROM bare WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT b.doc_id, b.pos, b.line, (r.k IS NOT NULL AND b.doc_id > r.keeper) AS gone
  FROM bare b LEFT JOIN rep r ON b.k = r.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
