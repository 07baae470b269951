"""Cross-tokenizer alignment: where the tokens of two vocabularies end together, and which ids meet there.

Most places are one token of A against the one token of B with the same bytes.  An array from A's ids to B's ids of the same
bytes is made once from the vocabularies; such groups are counted in a vector over A's vocabulary.  Only links of other
groups are counted as pairs by a shuffle, one row per block of documents and distinct pair.
"""

from __future__ import annotations

import itertools
import json
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import block_answers, document_runs, expanded, met_again, numbered, squeezed
from tidemark.llm.common import rows_of, save_table, text_buffers, worker_state
from tidemark.llm.tokens import tokenizer_path

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Units a worker keeps and their characters; beyond either it starts anew.
KNOWN, KNOWN_CHARS = 300_000, 16 << 20
#: Characters given to the tokenizers at once; their results take far more memory.
PART = 1 << 17


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers, the bytes of their tokens and the identity map (-1: no token of B has the bytes).

    Of several tokens of B with the same bytes the map names one that is no byte piece, the least id of these.
    """

    def __init__(self, first: str, second: str):
        import os

        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        alphabet = _byte_alphabet()
        with open(first, encoding="utf-8") as f:
            described = json.load(f)
        vocabulary = described["model"]["vocab"] | {t["content"]: t["id"] for t in described.get("added_tokens", [])}
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token)
        self.bytes_b = []
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        for piece in pieces:
            byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        by_bytes: dict[bytes, int] = {}
        for i in sorted(range(len(pieces)), key=lambda i: (self.b.is_byte(i), i)):
            by_bytes.setdefault(self.bytes_b[i], i)
        self.same = np.array([by_bytes.get(x, -1) for x in self.bytes_a], np.int64)
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.signed = [f"{i}{end}".encode() for i in range(max(len(self.bytes_a), len(pieces))) for end in ",|;"]
        # a space after another character starts a token in both, so texts can be cut there
        self.cuttable = not any("▁" in piece.lstrip("▁") for piece in pieces)

    def alone(self, unit: str) -> bool:
        """Is a cut right before and after this string, at single spaces, a place that no token crosses?"""
        return self.cuttable and bool(unit) and not any(c.isspace() or c in "▁\u180e\u200b\ufeff" for c in (unit[0], unit[-1]))

    def units(self, text: str) -> list[str]:
        """The text cut at single spaces; strings that may not stand alone stay together with their neighbours."""
        out, open_ = [], True
        for part in text.split(" ") if text else []:
            alone = self.alone(part)
            if out and (open_ or not alone):
                out[-1] += " " + part
            else:
                out.append(part)
            open_ = not alone
        return out

    def encoded(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of each text in A and in B; two empty lists where the bytes differ or there is no text."""
        out, at = [], 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= PART):
                size += len(texts[to])
                to += 1
            some = texts[at:to]
            first = [e.ids for e in self.a.encode_batch_fast([" " + t for t in some], add_special_tokens=False)]
            second = self.b.encode(some, num_threads=1)
            want = [b" " + t.encode() for t in some]
            if all(some) and self._spelled(first, want, self.bytes_a, self.length_a) and self._spelled(second, want, self.bytes_b, self.length_b):
                out += zip(first, second, strict=True)
            else:
                for t, x, a, b in zip(some, want, first, second, strict=True):
                    whole = t and b"".join([self.bytes_a[i] for i in a]) == x and b"".join([self.bytes_b[i] for i in b]) == x
                    out.append((a, b) if whole else ([], []))
            at = to
        return out

    @staticmethod
    def _spelled(ids: list[list[int]], want: list[bytes], by_id: list[bytes], length: np.ndarray) -> bool:
        """Do all of these ids spell the bytes wanted of them?"""
        flat, n = _flat(ids)
        ends = np.concatenate([[0], np.cumsum(length[flat])])[np.cumsum(n)]
        whole = (ends == np.cumsum([len(x) for x in want])).all()
        return bool(whole) and b"".join([by_id[i] for i in flat.tolist()]) == b"".join(want)

    def grouped(self, ids: list[tuple[list[int], list[int]]]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """For texts of which A's and B's ids spell the same bytes: the links (last ids of each group, A's above 32 bits) of
        all, how many each has, and the groups of each as text, every one ended by ``;``."""
        (a, n_a), (b, n_b) = (_flat([x[k] for x in ids]) for k in (0, 1))
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        at = np.searchsorted(end_b, end_a)
        last_a = np.flatnonzero(end_b[at] == end_a) if len(a) else np.zeros(0, np.int64)
        last_b = at[last_a]
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        sign_a[last_a], sign_b[last_b] = 1, 2  # a comma follows, but "|" A's last and ";" B's last of a group
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + np.repeat(np.cumsum(size_b) - size_b, size_a)] = a * 3 + sign_a
        code[np.arange(len(b)) + np.repeat(np.cumsum(size_a), size_b)] = b * 3 + sign_b
        ends = np.searchsorted(last_a, np.cumsum(n_a))
        places = np.concatenate([[0], np.cumsum(size_a + size_b)])[ends].tolist()
        signed = [self.signed[c] for c in code.tolist()]
        texts = [b"".join(signed[i:j]) for i, j in zip([0, *places], places, strict=False)]
        return a[last_a] << 32 | b[last_b], np.diff(ends, prepend=0), texts


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(x) for x in ids], np.int64)
    return np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(n.sum())), n


class Units:
    """What is known of the units met so far: how many ids they have in A and in B, their links, their groups as text."""

    def __init__(self, both: Aligner):
        self.both = both
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}  # strings between single spaces; -1: may not stand alone
        self.joined: dict[str, int] = {}  # units of several such strings
        self.n_a, self.n_b, self.links, self.text, self.chars = [], [], [], [], 0

    def learn(self, units: list[str], into: dict[str, int]) -> None:
        """New units; one that is not spelled by the tokens of both has no links."""
        ids = self.both.encoded(units)
        links, n, texts = self.both.grouped(ids)
        into.update(zip(units, range(len(self.n_a), len(self.n_a) + len(units)), strict=True))
        self.n_a += [len(a) for a, _ in ids]
        self.n_b += [len(b) for _, b in ids]
        self.links += np.split(links, np.cumsum(n)[:-1]) if units else []
        self.text += texts
        self.chars += sum(map(len, units))

    def of(self, texts: list[str]) -> list[list[int]]:
        """The units of each text by number; none for a text that the tokens of both do not spell."""
        split = [t.split(" ") if t else [] for t in texts]
        new = {u for units in split for u in units if u not in self.number}
        alone = [u for u in new if self.both.alone(u)]
        self.number.update((u, -1) for u in new.difference(alone))
        self.learn(sorted(alone), self.number)
        out = []
        for text, units in zip(texts, split, strict=True):
            found = [self.number[u] for u in units]
            if -1 in found:
                units = self.both.units(text)
                joined = dict.fromkeys(u for u in units if self.number.get(u, -1) < 0)
                self.learn([u for u in joined if u not in self.joined], self.joined)
                found = [self.joined[u] if u in joined else self.number[u] for u in units]
            if not all([self.text[u] for u in found]):  # a unit is not spelled: is the text as a whole?
                self.learn([text] if text not in self.joined else [], self.joined)
                found = [self.joined[text]] if self.text[self.joined[text]] else []
            out.append(found)
        return out


def known_units(first: str, second: str) -> Units:
    state = worker_state("aligners")
    if (first, second) not in state:
        state[first, second] = Units(Aligner(first, second))
    return state[first, second]


def _aligned(first: str, second: str):
    def run(batches):
        """Per block: distinct pairs of irregular links (block, local, a, b, n), then its body; the vector of identical
        tokens of the whole task as rows of block -1."""
        import hashlib

        import pyarrow as pa

        known = known_units(first, second)
        same = known.both.same
        number = numbered()
        seen = np.zeros(len(same), np.int64)
        schema = pa.schema([("block", pa.int64()), ("local", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()),
                            ("body", pa.binary())])

        def pairs(block, local, a, b, n):
            columns = [np.full(len(a), block), local, a.astype(np.int32), b.astype(np.int32), n.astype(np.int64)]
            return pa.record_batch([*map(pa.array, columns), pa.nulls(len(a), pa.binary())], schema=schema)

        for batch in batches:
            _, offsets = text_buffers(batch.column("text"))
            for i, j in document_runs(np.diff(offsets)):
                if len(known.number) + len(known.joined) > KNOWN or known.chars > KNOWN_CHARS:
                    known.clear()
                docs = known.of(batch.column("text").slice(i, j - i).to_pylist())
                text = known.text
                digests = b"".join([hashlib.sha256(b"".join([text[u] for u in d])[:-1]).digest() if d else bytes(32) for d in docs])
                ends = np.cumsum([len(d) for d in docs])
                unit, place, times = np.unique(np.fromiter((u for d in docs for u in d), np.int64, int(ends[-1])),
                                               return_inverse=True, return_counts=True)
                links = [known.links[u] for u in unit.tolist()]
                sizes = np.array([len(x) for x in links], np.int64)
                link = np.concatenate([np.zeros(0, np.int64), *links])
                weight = np.repeat(times, sizes)
                link_a, link_b = link >> 32, link & 0xFFFFFFFF
                regular = same[link_a] == link_b
                np.add.at(seen, link_a[regular], weight[regular])
                key, local = np.unique(link[~regular], return_inverse=True)
                n = np.zeros(len(key), np.int64)
                np.add.at(n, local, weight[~regular])
                code = link_a.astype(np.int32)  # identical tokens by A's id, other pairs by their place in the block
                code[~regular] = -1 - local.astype(np.int32)
                block = next(number)
                if len(key):
                    yield pairs(block, np.arange(len(key), dtype=np.int32), key >> 32, key & 0xFFFFFFFF, n)
                doc = batch.column("doc_id").slice(i, j - i)
                counts = [np.array([c[u] for u in unit.tolist()], np.int64) for c in (known.n_a, known.n_b)]
                body = squeezed(doc.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                                doc.is_null().to_numpy(zero_copy_only=False).astype(np.int8), ends.astype(np.int64), place.astype(np.int32),
                                *counts, sizes, code, np.frombuffer(digests, np.uint8))
                yield pa.record_batch([[block], [None], [None], [None], [None], [body]], schema=schema)
        met = np.flatnonzero(seen)
        if len(met):
            yield pairs(-1, np.zeros(len(met), np.int32), met, same[met], seen[met])

    return run


def _counted(batches, count: np.ndarray, best: np.ndarray):
    """Per document the digest columns, from the body of its block and the counts of its pairs."""
    import pyarrow as pa

    for _, (local, n, is_best), body in block_answers(batches, ["local", "n", "best"]):
        doc, null, ends, place, n_a, n_b, sizes, code, digests = expanded(body)
        counts, bests = np.zeros(len(local), np.int64), np.zeros(len(local), bool)
        counts[local], bests[local] = n, is_best
        own = code < 0
        value, top = np.empty(len(code), np.int64), np.empty(len(code), bool)
        value[~own], top[~own] = count[code[~own]], best[code[~own]]
        value[own], top[own] = counts[-1 - code[own]], bests[-1 - code[own]]
        ended = np.cumsum(sizes)
        of_unit = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[ended], prepend=0)  # noqa: B023, E731
        of_doc = lambda x: pa.array(np.diff(np.concatenate([[0], np.cumsum(x[place])])[ends], prepend=0))  # noqa: B023, E731
        hexes = [x.tobytes().hex() if k else "" for x, k in zip(digests.reshape(-1, 32), np.diff(ends, prepend=0), strict=True)]
        yield pa.record_batch([pa.array(doc, mask=null.astype(bool)), of_doc(n_a), of_doc(n_b), of_doc(sizes), of_doc(sizes),
                               of_doc(of_unit(top)), of_doc(of_unit(value)), pa.array(hexes)],
                              names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def aligned_tables(docs: DataFrame, first: str | None = None, second: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The blocks of ``docs`` and the pair table (a, b, n, regular, best): ids linked n times in all documents.

    ``regular`` pairs have the same bytes and come from the vectors; ``best`` pairs have their B id's highest count.
    """
    first, second = first or tokenizer_path(FIRST), second or tokenizer_path(SECOND)
    blocks = save_table(rows_of(docs).mapInArrow(_aligned(first, second), "block long, local int, a int, b int, n long, body binary"),
                        "aligned-blocks")
    pairs = blocks.filter("body IS NULL").groupBy("a", "b", (F.col("block") < 0).alias("regular")).agg(F.sum("n").alias("n"))
    pairs = save_table(pairs, "aligned-pairs")
    highest = pairs.groupBy("b").agg(F.max("n").alias("highest"))  # at most one row per id of B's vocabulary
    return blocks, pairs.join(F.broadcast(highest), "b").select("a", "b", "n", "regular", (F.col("n") == F.col("highest")).alias("best"))


def alignment_report(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A group ends where a token of A and one of B end at the same byte; no token is empty, so it has one link, its last pair.
    Texts that are NULL, empty or not spelled by the tokens of both have zeros and an empty digest.  Repeated rows count each.
    Texts may be of any length: they are encoded by units that give the same tokens.  An empty table gives no rows.
    """
    blocks, pairs = aligned_tables(docs, first, second)
    # one row per id of A's vocabulary at most
    vector = pairs.filter("regular").select("a", "n", "best").toPandas()
    size = 1 + int(vector["a"].max()) if len(vector) else 1
    count, best = np.zeros(size, np.int64), np.zeros(size, bool)
    count[vector["a"]], best[vector["a"]] = vector["n"], vector["best"]
    wanted = blocks.filter("body IS NULL AND block >= 0").select("block", "local", "a", "b")
    answers = wanted.join(pairs.filter("NOT regular").select("a", "b", "n", "best"), ["a", "b"]).select("block", "local", "n", "best")
    return met_again(blocks.filter("body IS NOT NULL"), answers).mapInArrow(
        lambda batches: _counted(batches, count, best),
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
