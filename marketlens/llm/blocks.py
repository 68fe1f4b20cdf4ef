"""Documents dealt into blocks: rows of compressed text that travel once.

``dealt`` gives chunks (block, ids, extras, sizes, texts): a task's documents of
one block in one row. Grouped by block they are a few MB of whole documents, so a
kernel sees many texts at once; ``opened`` takes a group apart in a fixed order.
The same chunks used several times in one query are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import buffers, ship_code

#: Text that a task gathers before it writes chunks.
CHUNK = 16_000_000


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts, and one for each row."""
    return docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 1)).first()[0] or 0


def block_of(id_col: str, blocks: int):
    return F.pmod(F.xxhash64(id_col), F.lit(blocks)).alias("block")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, id, extra, text) into one compressed row for each block, a few MB at a time."""
    held: dict[int, list] = {}
    size = 0
    packer = zstandard.ZstdCompressor(level=3)

    def flush() -> Iterator[pa.RecordBatch]:
        for block, rows in held.items():
            texts = [t for _, _, t in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([[r[0] for r in rows]], pa.list_(kind)),
                 pa.array([[r[1] for r in rows]], pa.list_(pa.string())),
                 pa.array([np.array([len(t) for t in texts], "<i8").tobytes()], pa.binary()),
                 pa.array([packer.compress(b"".join(texts))], pa.binary())],
                ["block", "ids", "extras", "sizes", "texts"])
        held.clear()

    for batch in batches:
        kind = batch.column(1).type
        block, ids, extras = (batch.column(c).to_pylist() for c in range(3))
        for a, _, data, off in buffers(batch.column(3), CHUNK):
            raw = data.tobytes()
            for i in range(len(off) - 1):
                text = raw[off[i]:off[i + 1]]
                held.setdefault(block[a + i], []).append((ids[a + i], extras[a + i], text))
                size += len(text) + 100
            if size >= CHUNK:
                yield from flush()
                size = 0
    yield from flush()


def opened(chunks: pa.Table) -> tuple[list, list, list[bytes]]:
    """Ids, extra values and texts of a block in a fixed order: by id (null last) and text."""
    reader = zstandard.ZstdDecompressor()
    rows = []
    for r in chunks.to_pylist():
        sizes = np.frombuffer(r["sizes"], "<i8")
        raw = reader.decompress(r["texts"], max_output_size=max(1, int(sizes.sum())))
        ends = np.cumsum(sizes)
        rows += [(i, v, raw[e - s:e]) for i, v, s, e in zip(r["ids"], r["extras"], sizes, ends)]
    rows.sort(key=lambda r: (r[0] is None, 0 if r[0] is None else r[0], r[2], r[1] or ""))
    return [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]


def dealt(docs: DataFrame, blocks: int, id_col: str, text_col: str, extra_col: str | None = None) -> DataFrame:
    ship_code(docs.sparkSession)
    extra = F.col(extra_col).cast("string") if extra_col else F.lit(None).cast("string")
    plain = docs.select(F.col(id_col).alias("id"), extra.alias("extra"), F.col(text_col).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    return plain.select(block_of("id", blocks), "id", "extra", "text").mapInArrow(
        _chunks, f"block long, ids array<{kind}>, extras array<string>, sizes binary, texts binary")
