"""Shared pieces of the training-data operators.

* ``table`` reads one given table by its own schema;
* ``keep`` writes a DataFrame to the shared folder (``spark.checkpoint.dir``)
  and reads it back: it cuts lineage and survives lost executors;
* ``ship_code`` makes this package importable for Python workers;
* the numpy helpers turn a column of texts into byte buffers and hash
  n-grams and words of a whole buffer at once.
"""

from __future__ import annotations

import io
import os
import sys
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import scratch_path

U64 = np.uint64
#: Bytes of text that a kernel handles at once (a longer text is one block).
BLOCK_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared store and read it back."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores after it until ``df`` has no such column in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send the package to the executors once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for p in sorted((root / "marketlens").rglob("*.py")):
            z.write(p, p.relative_to(root))
    path = os.path.join(tempfile.mkdtemp(prefix="marketlens-code-"), "marketlens_code.zip")
    Path(path).write_bytes(buf.getvalue())
    spark.sparkContext.addPyFile(path)
    if path in sys.path:  # the driver has the package itself
        sys.path.remove(path)
    _SHIPPED.add(app)


def held_out(doc_id: str = "doc_id", folds: int = 5):
    """True for rows that are never learnt from: crc32(doc_id as text) mod folds = 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(True))


def bounded_sample(df: DataFrame, group: str, rows: int, by: str = "doc_id") -> DataFrame:
    """About ``rows`` rows at most, an equal share for each value of ``group``.

    A row is taken by the hash of ``by``, so the sample does not depend on the
    partitioning; a group smaller than its share is taken whole. Pass ids without
    texts and join the sample with the texts: it is small enough to broadcast.
    """
    sizes = df.groupBy(group).agg(F.count("*").alias("_n"))
    groups = sizes.agg(F.count("*")).scalar()
    share = sizes.select(F.col(group).alias("_group"), "_n", groups.alias("_groups")).select(
        "_group", (F.lit(float(rows)) / F.col("_groups") / F.col("_n")).alias("_rate"))
    draw = (F.xxhash64(F.col(by), F.lit(7)).bitwiseAND(F.lit((1 << 30) - 1))) / float(1 << 30)
    return df.join(share, df[group].eqNullSafe(F.col("_group"))).where(draw < F.col("_rate")).drop("_group", "_rate")


# -- texts as byte buffers -------------------------------------------------------

def buffers(col: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES, max_rows: int = 1 << 30
            ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of consecutive texts: (first row, end row, bytes, offsets).

    ``offsets`` has one entry more than the block has rows; null texts are
    empty. A block holds at most ``limit`` bytes or one text, and ``max_rows`` rows.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off_buf, data_buf = col.buffers()
    if not len(col):
        return
    off = np.frombuffer(off_buf, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(col):
        b = int(np.searchsorted(off, off[a] + limit, "right")) - 1
        b = min(max(b, a + 1), a + max_rows, len(col))
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


# -- hashes ------------------------------------------------------------------------
# Odd multipliers of the polynomial hash and of the final mixing.
MULTIPLIER = U64(0x9E3779B97F4A7C15)
MIX_1 = U64(0xFF51AFD7ED558CCD)
MIX_2 = U64(0xC4CEB9FE1A85EC53)

_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MULTIPLIER**i and its inverse power modulo 2**64, for i up to n."""
    if "p" not in _POWERS or len(_POWERS["p"]) <= n:
        size = max(n + 1, BLOCK_BYTES + 65_536)
        p = np.full(size, MULTIPLIER, U64)
        q = np.full(size, U64(pow(int(MULTIPLIER), -1, 1 << 64)), U64)
        p[0] = q[0] = U64(1)
        _POWERS["p"], _POWERS["q"] = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _POWERS["p"], _POWERS["q"]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(33))
    h *= MIX_1
    h ^= h >> U64(29)
    h *= MIX_2
    h ^= h >> U64(32)
    return h


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with S[i] = sum of (byte + 1) * MULTIPLIER**j over the first i bytes."""
    p, _ = powers(len(data))
    s = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * p[:len(data)], out=s[1:])
    return s


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [starts, ends): equal spans, equal hashes."""
    _, q = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * q[starts])


def gram_hashes(sums: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-byte windows."""
    n = len(sums) - k
    if n <= 0:
        return np.zeros(0, U64)
    _, q = powers(len(sums))
    return mix((sums[k:] - sums[:n]) * q[:n])


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut where a text begins."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = mask.copy()
    first[1:] &= ~mask[:-1] | edge[1:n]
    last = mask.copy()
    last[:-1] &= ~mask[1:] | edge[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


# Bytes that make up a word: ASCII letters and digits, and all of any other script.
WORD_BYTES = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
# A-Z to a-z, all other bytes unchanged.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
# The white space of the contracts: \x20 and \x09-\x0D.
SPACE_BYTES = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def word_hashes(data: np.ndarray, offsets: np.ndarray, mask_of: np.ndarray = WORD_BYTES
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words of a block: hashes, starts, ends and first word of each text."""
    low = LOWER[data]
    starts, ends = runs(mask_of[low], offsets)
    hashes = span_hashes(prefix_sums(low), starts, ends) if len(starts) else np.zeros(0, U64)
    return hashes, starts, ends, np.searchsorted(starts, offsets)
