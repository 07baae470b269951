"""What several corpus operators share: reading rows by name, intermediate tables, byte-level word hashing."""

from __future__ import annotations

import sys
import types

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import save_table  # noqa: F401  (used by the operators)

#: The white space of the word definition ``[^\x20\x09-\x0D]+``.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers of it have inverses
#: Texts are worked on in blocks of about this many bytes, so that arrays stay in the processor's cache.
BLOCK = 1 << 19


def rows_of(df: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` and ``text`` (NULL: empty), whatever else the table has."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), text, *more)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def worker_state(name: str) -> dict:
    """A dict that lives as long as this worker process (functions sent by value get new globals for every task)."""
    module = sys.modules.setdefault("_tidemark_worker_state", types.ModuleType("_tidemark_worker_state"))
    return module.__dict__.setdefault(name, {})


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a 64-bit permutation with good avalanche."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX_A
        x = (x ^ (x >> np.uint64(27))) * MIX_B
        return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def byte_codes() -> np.ndarray:
    """One random odd 64-bit code for each byte value."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * BASE) | np.uint64(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n, kept for the life of the worker."""
    state = worker_state("powers")
    if state.get("n", 0) < n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            state["up"] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, BASE)]))
            state["down"] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, inverse)]))
        state["n"] = n
    return state["up"][:n], state["down"][:n]


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs ``data[start:end]``; equal bytes (after ``table``) give equal hashes."""
    up, down = powers(max(BLOCK * 2, len(data) + 1))
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[: len(data)], out=total[1:])
        return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * MIX_B)


def blocks(lengths: np.ndarray):
    """(from, to) of documents whose bytes fill one block; a longer document is a block of its own."""
    at, size = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if size and size + n > BLOCK:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(lengths):
        yield at, len(lengths)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string or binary column, and its offsets (length + 1)."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    places = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, kind)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), places.astype(np.int64)


def space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SPACES)] = True
    return table


def word_bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes of a class, never across documents: start, end, and how many runs each document has.

    ``offsets`` are those of the documents, from 0 to ``len(data)``; ``inside`` says of each byte value if it is of the class.
    """
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets) - 1, np.int64)
    is_word = inside[data]
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    cut = offsets[(offsets > 0) & (offsets < n)]
    first[cut] = is_word[cut]
    last = is_word.copy()
    last[:-1] &= ~is_word[1:]
    last[cut - 1] = is_word[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    per_doc = np.diff(np.searchsorted(start, offsets))
    return start, end, per_doc


def block_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray | None = None):
    """For each block of documents: (first, last document, hashes of its words, words of each document).

    ``table`` gives the codes of bytes (for instance equal codes for both cases); words are ``[^\\x20\\x09-\\x0D]+``.
    """
    table = byte_codes() if table is None else table
    inside = ~space_table()
    for i, j in blocks(np.diff(offsets)):
        part = data[offsets[i] : offsets[j]]
        start, end, per_doc = word_bounds(part, offsets[i : j + 1] - offsets[i], inside)
        yield i, j, run_hashes(part, start, end, table), per_doc


def windows(hashes: np.ndarray, per_doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words within a document: hash, document, place; shorter documents give none."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for k in range(width):
            out = out * BASE + hashes[k : k + n]
    first = np.cumsum(per_doc) - per_doc
    whole = doc[:n] == doc[width - 1 :]
    place = np.arange(n) - first[doc[:n]]
    return mixed(out[whole]), doc[:n][whole], place[whole]


def packed_texts(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of compressed blocks: the long columns ``keys`` of some documents and their texts, zstd-compressed together.

    A shuffle of these moves a third to a half of what the texts themselves take.  ``unpacked`` reads a block.  ``chunk`` is
    the number of the partition they come from.
    """

    def run(batches):
        import pyarrow as pa
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            chunk = batch.column("chunk")
            for i, j in blocks(np.diff(offsets)):
                head = [np.array([j - i], np.int64), offsets[i : j + 1] - offsets[i]]
                for key in keys:
                    column = batch.column(key).slice(i, j - i)
                    head += [np.asarray(column.is_null().to_numpy(zero_copy_only=False), np.int64),
                             column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)]
                raw = b"".join(x.tobytes() for x in head) + data[offsets[i] : offsets[j]].tobytes()
                yield pa.record_batch([chunk.slice(i, 1), pa.array([squeeze.compress(raw)], pa.binary())], names=["chunk", "block"])

    return rows.mapInArrow(run, "chunk int, block binary")


def unpacked(block: bytes, n_keys: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """Keys, which of them are NULL, the texts' bytes and their offsets."""
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(block)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    numbers = np.frombuffer(raw, np.int64, n + 1 + 2 * n * n_keys, 8)
    offsets, rest = numbers[: n + 1], numbers[n + 1 :].reshape(2 * n_keys, n)
    data = np.frombuffer(raw, np.uint8, int(offsets[-1]), 8 + numbers.nbytes)
    return list(rest[1::2]), [x.astype(bool) for x in rest[0::2]], data, offsets
