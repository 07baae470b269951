"""Token ids by a public tokenizer's file, flat token files, and packing into fixed windows.

The tokenizers here drop white space and never join letters across it, so a text is encoded word by word; the default one also
never joins letters, digits and signs, so its words of ASCII and Latin-1 letters are cut into runs of these.  A block of texts is coded against its
distinct words, each worker keeps the ids of words it has met (bounded, see ``KNOWN_WORDS``) and asks the library only for new
ones.  A text's ids are the same as the library gives for the whole text (tested).
"""

from __future__ import annotations

import json
import re
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.blocks import document_runs
from tidemark.llm.common import rows_of, save_table, text_buffers, worker_state
from tidemark.session import shared_folder

END = 1
WINDOW = 2048
#: Words whose ids a worker process keeps (about 200 bytes each): the latest ones, and as many that were met before them.
KNOWN_WORDS = 200_000
#: Bytes of text that are coded together; a longer document is a block of its own.
CODED_BYTES = 4 << 20
SHARD_BYTES = 32 << 20
#: Documents whose places make one record of a shard's index.
INDEXED = 1 << 16

#: What a byte of a text is: white space between words, (part of) a letter, a digit, a sign, or one that leaves its word uncut (the
#: first byte of any letter outside ASCII and U+00C0 to U+00FF, a control character, the apostrophe of 's and 't, the bar of special tokens).
SPACE, LETTER, DIGIT, SIGN, UNCUT = range(5)
#: The pre-tokenizer and normalizer whose words can be cut so.
CUTTABLE = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", ["NFC", "Replace", "Lowercase"])

#: A word that was cut, in small letters.
CUT = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[!-&(-/:-@[-`{}~]+|[0-9]")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_kinds(cuttable: bool) -> np.ndarray:
    kinds = np.full(256, UNCUT, np.uint8)
    kinds[[10, 32]] = SPACE
    if cuttable:
        kinds[33:127] = SIGN
        kinds[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3]] = LETTER
        kinds[48:58] = DIGIT
        kinds[[39, 124]] = UNCUT
    return kinds


def byte_spelling() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 as it is, others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def cuts_words(tokenizer) -> bool:
    """Whether this tokenizer works on runs of letters, single digits and runs of signs, whatever their case."""
    spec = json.loads(tokenizer.to_str())
    steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    special = all("|" in t["content"] for t in spec["added_tokens"])
    first = steps[0]
    return (special and (first.get("pattern", {}).get("Regex"), normal) == CUTTABLE and first["behavior"] == "Removed" and first["invert"]
            and [s["type"] for s in steps] == ["Split", "ByteLevel"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"])


class WordEncoder:
    """``column(texts)``: the ids of each text and the end id, as little-endian unsigned 16-bit bytes (32-bit for vocabularies
    over 65,536 ids)."""

    SEPARATOR = "\x01"
    #: Stands for the end id; no word holds it.
    CLOSE = b"\n"

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.end = np.array([END], self.kind).tobytes()
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.mark = self._encode(self.SEPARATOR)
        self.cuttable = cuts_words(self.tokenizer)
        self.kinds = byte_kinds(self.cuttable)
        if self.cuttable:
            self.lower = np.arange(256, dtype=np.uint8)
            self.lower[65:91] += 32
            self.spelling = byte_spelling()
            self.raw = [i.to_bytes(self.kind.itemsize, "little") for i in range(self.tokenizer.get_vocab_size())]

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learned(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The library's ids of some words; a cut one is a single piece, so it goes to the library's merges as it is."""
        if not self.cuttable:
            return self._together(words)
        found, rest, merge, raw = {}, [], self.tokenizer.model.tokenize, self.raw
        for w in words:
            if CUT.fullmatch(w):
                found[w] = b"".join([raw[token.id] for token in merge(w.decode("latin-1").translate(self.spelling))])
            else:
                rest.append(w)
        return found | self._together(rest)

    def _together(self, words: list[bytes]) -> dict[bytes, bytes]:
        found = {}
        plain = [w for w in words if b"\x01" not in w] if len(self.mark) == 1 else []
        separator = f" {self.SEPARATOR} ".encode()
        for i in range(0, len(plain), 20_000):
            some = plain[i : i + 20_000]
            text = separator.join(some).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.kind)
            cuts = np.flatnonzero(ids == self.mark[0])
            if len(cuts) != len(some) - 1:  # a word made the mark itself
                continue
            raw, size = ids.tobytes(), self.kind.itemsize
            starts = [0, *((cuts + 1) * size).tolist()]
            ends = [*(cuts * size).tolist(), len(raw)]
            found.update((w, raw[a:b]) for w, a, b in zip(some, starts, ends, strict=True))
        for w in words:
            if w not in found:
                found[w] = np.array(self._encode(w.decode()), dtype=self.kind).tobytes()
        return found

    def answers(self, words: list[bytes]) -> list[bytes]:
        """The ids of some distinct words; those asked for last stay known."""
        out = list(map(self.known.get, words))
        missing = [i for i, ids in enumerate(out) if ids is None]
        if missing:
            for i in missing:
                out[i] = self.older.get(words[i])
            found = self._learned([words[i] for i in missing if out[i] is None])
            for at in range(0, len(missing), KNOWN_WORDS):
                some = missing[at : at + KNOWN_WORDS]
                if len(self.known) + len(some) > KNOWN_WORDS:
                    self.older, self.known = self.known, {}
                for i in some:
                    if out[i] is None:
                        out[i] = found[words[i]]
                    self.known[words[i]] = out[i]
        return out

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """All words of some texts in a row, ``CLOSE`` after each text's: their bytes and where each begins."""
        n = len(data)
        kind = self.kinds[data]
        inside = kind != SPACE
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begins = inside & edge[:n]
        begins[1:] |= inside[1:] & ~inside[:-1]
        text = data
        if self.cuttable:
            text = self.lower[data]
            accents = np.flatnonzero(data == 0xC3) + 1
            second = data[accents]
            kind[accents[(second == 0x97) | (second == 0xB7)]] = UNCUT  # the signs of multiplication and division
            text[accents[second < 0x9F]] += 32
            self._keep_uncut(data, text, kind, begins, inside & (edge[1:] | ~np.append(inside[1:], False)))
            begins[1:] |= (kind[1:] != kind[:-1]) & inside[1:]
            begins |= kind == DIGIT
        before = np.zeros(n + 1, np.int32 if n < 1 << 31 else np.int64)
        np.cumsum(inside, out=before[1:])
        ends = before[offsets[1:]]
        return np.insert(text[inside], ends, self.CLOSE[0]), np.flatnonzero(np.insert(begins[inside], ends, True))

    @staticmethod
    def _keep_uncut(data: np.ndarray, text: np.ndarray, kind: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        """Words with an ``UNCUT`` byte are of this kind throughout and as they were written."""
        uncut = np.flatnonzero(kind == UNCUT)
        if not len(uncut):
            return
        touched = np.searchsorted(np.flatnonzero(begins), uncut, side="right") - 1
        touched = touched[np.append(True, touched[1:] != touched[:-1])]
        step = np.zeros(len(data) + 1, np.int8)
        step[np.flatnonzero(begins)[touched]] = 1
        step[np.flatnonzero(ends)[touched] + 1] -= 1
        whole = np.flatnonzero(np.cumsum(step[:-1], dtype=np.int8))
        kind[whole] = UNCUT
        text[whole] = data[whole]

    def column(self, texts):
        """An Arrow column of texts (no NULLs) as one of ids, a text's ended by the end id."""
        import pyarrow as pa

        data, offsets = text_buffers(texts)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        text, starts = self.words(data, offsets)
        places = pa.array(np.append(starts, len(text)), pa.int64())
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, places.buffers()[1], pa.py_buffer(text)])
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        close = distinct.index(self.CLOSE)
        distinct[close] = b""  # (the empty word has no ids in any vocabulary: it is not asked for)
        ids = self.answers([w for w in distinct if w])
        ids.insert(close, self.end)
        taken = pa.array(ids, pa.large_binary()).take(coded.indices)
        bounds = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1]
        last = np.flatnonzero(coded.indices.to_numpy() == close) + 1
        ends = pa.array(np.append(0, bounds[last]), pa.int64())
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, ends.buffers()[1], taken.buffers()[2]])


def encoder(path: str) -> WordEncoder:
    state = worker_state("encoders")
    if path not in state:
        state[path] = WordEncoder(path)
    return state[path]


def _encoded(path: str):
    """Arrow batches (doc_id, text) to (doc_id column, column of ids with the end id), some MB of text at a time."""

    def pieces(batches):
        enc = encoder(path)
        for batch in batches:
            sizes = np.diff(text_buffers(batch.column("text"))[1])
            for i, j in document_runs(sizes, CODED_BYTES):
                yield enc, batch.column("doc_id").slice(i, j - i), enc.column(batch.column("text").slice(i, j - i))

    return pieces


def _bounds(ids) -> np.ndarray:
    """Where each value of a column of ids begins and ends in its bytes."""
    return text_buffers(ids)[1]


# --- flat files -------------------------------------------------------------------------------------------------------
#
# A shard holds, one after another: the ids of its documents (unsigned, little-endian, each document ended by the end id),
# then (doc_id, first token) of each document as two signed 64-bit integers, then token count, document count and id width
# as three 64-bit integers.  Places of tokens count from the shard's first one; shards follow each other in ascending
# doc_id order.  Files go through Spark's text writer, so they can be in any store that Spark writes: every record below
# ends with a zero byte (end id, place, width), which the writer puts there as its line separator.


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None) -> None:
    """Writes all documents as shards in ascending ``doc_id`` (NULL first; equal ids by text).

    One range shuffle of the texts.  Shards hold about 32 MB of text, or follow ``spark.sql.shuffle.partitions`` if that
    gives smaller ones.  Empty tables write no shard.
    """
    path = tokenizer or tokenizer_path()
    pieces = _encoded(path)
    rows = rows_of(docs)
    spark = docs.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES), 1)

    def records(batches):
        import pyarrow as pa

        out = pa.schema([("record", pa.binary())])
        tokens, index, width = 0, [], 2
        for enc, doc_ids, ids in pieces(batches):
            width = enc.kind.itemsize
            bounds = _bounds(ids)
            yield pa.record_batch([pa.array([ids.buffers()[2][int(bounds[0]) : int(bounds[-1]) - 1].to_pybytes()], pa.binary())], schema=out)
            keys = doc_ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            index.append(np.stack([keys, tokens + (bounds[:-1] - bounds[0]) // width], axis=1).astype("<i8"))
            tokens += int(bounds[-1] - bounds[0]) // width
        if index:
            table = np.concatenate(index)
            for i in range(0, len(table), INDEXED):
                yield pa.record_batch([pa.array([table[i : i + INDEXED].tobytes()[:-1]], pa.binary())], schema=out)
            tail = np.array([tokens, len(table), width], dtype="<i8").tobytes()[:-1]
            yield pa.record_batch([pa.array([tail], pa.binary())], schema=out)

    # (nothing below shuffles or sorts again: a task's records are written in the order it gives them)
    ordered = rows.repartitionByRange(int(shards), "doc_id").sortWithinPartitions("doc_id", "text")
    written = ordered.mapInArrow(records, "record binary")
    written.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\0").text(folder)


def read_shard(raw) -> tuple[np.ndarray, np.ndarray]:
    """ids and (doc_id, first token) of one shard's bytes (``bytes`` or a memory map)."""
    tokens, docs, width = np.frombuffer(raw[-24:], "<i8").tolist()
    ids = np.frombuffer(raw, np.dtype(f"<u{width}"), tokens)
    return ids, np.frombuffer(raw, "<i8", 2 * docs, tokens * width).reshape(-1, 2)


def map_shard(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The same from a file on a mounted file system, memory-mapped: pages are read when they are touched."""
    return read_shard(np.memmap(path, np.uint8, "r"))


def _shards(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    number = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long")
    return files.filter("length > 0").select(number.alias("shard"), "content")


def shard_bases(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, base): the tokens in all shards before it.  One row per file, so one window over them is small."""

    def totals(batches):
        import pyarrow as pa

        for batch in batches:
            n = [int(np.frombuffer(raw.as_py()[-24:], "<i8")[0]) for raw in batch.column("tail")]
            yield pa.record_batch([batch.column("shard"), pa.array(n, pa.int64())], names=["shard", "n"])

    tails = _shards(spark, folder).select("shard", F.expr("substring(content, -24, 24)").alias("tail"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return tails.mapInArrow(totals, "shard long, n long").select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32 (of 32-bit ids)."""

    def digests(batches):
        import pyarrow as pa

        for batch in batches:
            for base, content in zip(batch.column("base").to_pylist(), batch.column("content"), strict=True):
                ids, index = read_shard(content.as_buffer())
                ends = np.append(index[1:, 1], len(ids))
                wide = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(index[:, 1], ends, strict=True)]
                keys = pa.array(index[:, 0], pa.int64(), mask=index[:, 0] == -(1 << 63))
                yield pa.record_batch([keys, pa.array(index[:, 1] + base), pa.array(ends - index[:, 1]), pa.array(wide, pa.int64())],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # The broadcast side has one row of 16 bytes per shard of 32 MB, so it stays small at any size of corpus.
    joined = _shards(spark, folder).join(F.broadcast(shard_bases(spark, folder)), "shard")
    return joined.select("base", "content").mapInArrow(
        digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes ``docs`` to a new folder in the shared scratch space and reads the files back."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, folder, tokenizer)
    return token_digests(spark, folder)


# --- packing ----------------------------------------------------------------------------------------------------------


def _with_totals(path: str):
    """Encodes a partition; each row says which partition it is in and how many tokens stand before it there."""
    pieces = _encoded(path)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for enc, doc_ids, ids in pieces(batches):
            width, n = enc.kind.itemsize, len(ids)
            counts = np.diff(_bounds(ids)) // width
            before = at + np.cumsum(counts) - counts
            at += int(counts.sum())
            yield pa.record_batch([
                doc_ids, pa.array(np.full(n, part, np.int64)), pa.array(before), pa.array(counts),
                pa.array(np.full(n, width, np.int32)), ids.cast(pa.binary())],
                names=["doc_id", "part", "before", "n", "width", "ids"])

    return run


def packed(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None) -> DataFrame:
    """Concatenate and cut: every document, with its end id, laid out in one row of tokens, cut every ``window`` tokens.

    Pass one encodes (kept as a Parquet table) and counts tokens per partition; a prefix sum over these totals, one row per
    partition, gives each partition its global offset.  Pass two cuts: a document that crosses a window's end gives one
    boundary record on either side.  Only the very last sequence can be short.  The order of documents is that of the
    input's partitions.  An empty text has its end id only; an empty table gives no rows; repeated rows are packed each.
    """
    path = tokenizer or tokenizer_path()
    saved = save_table(rows_of(docs).mapInArrow(
        _with_totals(path), "doc_id long, part long, before long, n long, width int, ids binary"), "packing")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = saved.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "at", "n", "width")), batch.column("ids"), strict=True)
            keys, out = [], []
            for doc_id, at, n, width, raw in rows:
                ids = np.frombuffer(raw.as_buffer(), np.dtype(f"<u{width}")).astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, window)
                    length = min(n - start, window - offset)
                    keys.append(doc_id)
                    out.append((start, length, zlib.crc32(ids[start : start + length].tobytes()), n, sequence, offset))
                    start += length
            columns = np.array(out, np.int64).reshape(-1, 6)
            yield pa.record_batch(
                [pa.array(keys, pa.int64()), *(pa.array(columns[:, k].copy()) for k in range(6))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    # One row per partition of the input, 16 bytes each: small at any size of corpus.
    placed = saved.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("at"), "n", "width", "ids")
    return placed.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                  "sequence_id long, offset long")
