"""Blocks of documents that ask a large table about their distinct entries.

A block is a bounded run of text, coded against a dictionary of its own.  Only its distinct entries are joined with the large
table, one row per block and entry; the answers and the block's body then meet again.  So neither the vocabulary nor its
counts have to fit anywhere, a frequent entry is one row per block, and no group grows with an input partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a block; a longer document is cut into several.
BLOCK_BYTES = 4 << 20


def numbered() -> Iterator[int]:
    """Block numbers of this task; those of different tasks differ."""
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 32
    n = 0
    while True:
        yield base + n
        n += 1


def document_runs(lengths: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """(from, to) of documents that have up to ``size`` bytes together; a longer document is a run of its own."""
    ends = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
        yield at, to
        at = to


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; ``expanded`` reads it."""
    import zstandard

    head = np.array([len(arrays), *[len(a) for a in arrays]], np.int64)
    names = "".join(f"{a.dtype.str:<4}" for a in arrays).encode()
    return zstandard.ZstdCompressor(level=3).compress(head.tobytes() + names + b"".join(a.tobytes() for a in arrays))


def expanded(raw: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(raw)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, 8).tolist()
    at = 8 + 8 * n
    kinds = [np.dtype(raw[at + 4 * i : at + 4 * i + 4].decode().strip()) for i in range(n)]
    at += 4 * n
    out = []
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(raw, kind, size, at))
        at += size * kind.itemsize
    return out


def met_again(bodies: DataFrame, answers: DataFrame) -> DataFrame:
    """Rows of ``answers`` (block, local, ...) and of ``bodies`` (block, body), those of a block together, its body last."""
    rows = answers.unionByName(bodies.select("block", "body"), allowMissingColumns=True)
    return rows.repartition("block").sortWithinPartitions("block", F.col("local").asc_nulls_last())


def block_answers(batches, columns: list[str]) -> Iterator[tuple[int, list[np.ndarray], bytes]]:
    """For each block of ``met_again``: its number, the answers' columns and the body.  Blocks may span batches."""
    import pyarrow as pa

    held = []
    for batch in batches:
        ends = np.flatnonzero(np.asarray(batch.column("body").is_valid()))
        at = 0
        for end in ends.tolist():
            held.append(batch.slice(at, end - at).select(columns))
            table = pa.Table.from_batches(held)
            yield batch.column("block")[end].as_py(), [table[c].to_numpy() for c in columns], batch.column("body")[end].as_py()
            held, at = [], end + 1
        if at < batch.num_rows:
            held.append(batch.slice(at).select(columns))
