"""Phrases against brute force; filters against plain counters."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import blocks, phrases, quotient
from tidemark.llm.common import text_buffers


def brute(rows, least=10, covered=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        n[lang] += 0
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = []
        for p, a in counts.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(100 * c >= covered * a and p in (q[:2], q[1:]) for q, c in counts.items() if len(q) == 3 and c >= least):
                continue
            score, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((score, a, " ".join(p), counts[p[:k]], counts[p[k:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, lo, r, n[lang], s) for i, (s, a, p, lo, r) in enumerate(found[:top])]
    return sorted(out)


def some_rows(seed, n=150):
    rnd = random.Random(seed)
    vocabulary = ["new", "York", "The", "a", "é", "漢字", "x-1", "of", "state\x00", "ÄB", "tail", " ", "end"]
    rows = []
    for _ in range(n):
        parts = [rnd.choice(["new york state\x00", "the a of", rnd.choice(vocabulary), "rare%d" % rnd.randrange(10**6)]) for _ in range(rnd.randrange(0, 25))]
        rows.append(("".join(p + rnd.choice([" ", " ", "  ", "\t", ". ", "\n", "\x0b"]) for p in parts), rnd.choice(["en", "fr", None, "und", ""])))
    return [*rows, (None, "en"), ("", None), (" .,", "xx"), ("same line here " * 40, "de"), ("same line here " * 40, "de")]


def test_phrases_against_brute_force(spark):
    rows = some_rows(1)
    df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string")
    df = df.select("*", *[F.lit("z").alias(c) for c in ("word", "block", "n", "f", "id", "x", "phrase", "body", "bucket")]).repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(df).collect())
    assert got == brute(rows) and len(got) > 20
    few = sorted(tuple(r) for r in phrases.collocations(df, top=3).collect())
    assert few == brute(rows, top=3)
    assert phrases.collocations(df.limit(0)).collect() == []


def test_score_beyond_64_bits(spark):
    big = 9 * 10**14
    df = spark.createDataFrame([(big, big, big), (big, big + 7, big + 12345678), (10, 10**14, 10**14)], "a long, l long, r long")
    got = [r[0] for r in df.select(phrases._score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [1_000_000 * r.a * r.a // (r.l * r.r) for r in df.collect()]


@pytest.mark.parametrize("size", [7, 20, 64, 1000])
def test_long_texts_are_cut_without_loss(size):
    import pyarrow as pa

    rnd = random.Random(size)
    texts = ["".join(rnd.choice(["ab ", "c", " ", ". ", "dddddddddddddddddddddd "]) for _ in range(n)) for n in (0, 3, 200, 1, 90, 0, 400)]
    data, offsets = text_buffers(pa.array(texts))
    _, inside, _ = phrases._classes()
    words, pairs = Counter(), Counter()
    for i, j, a, b, skipped in phrases.segments(data, offsets, inside, size):
        for d in range(i, j):
            part = data[max(a, offsets[d]) : min(b, offsets[d + 1])].tobytes().decode()
            w = re.findall(r"[^ \t.]+", part)
            words.update(w[skipped:])
            pairs.update(x for k, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if k + 2 >= skipped)
    every = [re.findall(r"[^ \t.]+", t) for t in texts]
    assert words == Counter(w for t in every for w in t)
    assert pairs == Counter(x for t in every for x in zip(t, t[1:], t[2:], strict=False))


@pytest.mark.parametrize("id_bits,prefix", [(1, 0), (2, 3), (9, 0), (17, 5), (21, 7), (22, 4), (33, 2), (42, 6)])
def test_filters_keep_every_count(id_bits, prefix):
    rng = np.random.default_rng(id_bits)
    half = quotient.half_bits(id_bits)
    prefix = min(prefix, half)
    top = min(1 << id_bits, 1 << 40)
    total, filters = Counter(), defaultdict(list)
    for _ in range(3):
        ids = rng.integers(0, max(2, top), (3, 3000)).astype(np.uint64) % np.uint64(top)
        ids[:, :400] = ids[:, :1]  # one hot n-gram, beyond a byte's counter
        total.update(map(tuple, ids.T.tolist()))
        left, right = quotient.permuted(*quotient.packed(*ids, id_bits), half)
        back = quotient.unpacked_ids(*quotient.restored(left, right, half), id_bits)
        assert all((a == b).all() for a, b in zip(back, ids, strict=True))
        left, right, count = quotient.folded(left, right, None, half)
        part = left >> np.uint64(half - prefix)
        for p in np.unique(part).tolist():
            at = part == p
            raw = quotient.written(left[at], right[at], count[at], half, prefix)
            again = quotient.read(raw, p, half, prefix)
            assert all((a == b).all() for a, b in zip(again, (left[at], right[at], count[at]), strict=True))
            filters[p].append(again)
    merged = Counter()
    for parts in filters.values():
        left, right, count = quotient.folded(*(np.concatenate(c) for c in zip(*parts, strict=True)), half)
        ids = quotient.unpacked_ids(*quotient.restored(left, right, half), id_bits)
        merged.update(dict(zip(zip(*(x.tolist() for x in ids), strict=True), count.tolist(), strict=True)))
    assert merged == total


def test_small_filters_and_ranges_give_the_same(monkeypatch):
    """Many small filters, merged often, count as one large one."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    codes = [rng.integers(1, 30, 5000).astype(np.int32) * np.where(rng.random(5000) < 0.1, -1, 1).astype(np.int32) for _ in range(4)]
    schema = pa.schema([("block", pa.int64()), ("local", pa.int32()), ("id", pa.int64()), ("body", pa.binary())])
    batches = []
    for b, code in enumerate(codes):
        batches.append(pa.record_batch([[b] * 29, list(range(1, 30)), [i * 3 if i % 5 else 0 for i in range(1, 30)], [None] * 29], schema=schema))
        batches.append(pa.record_batch([[b], [None], [None], [blocks.squeezed(np.zeros(1, np.int64), code)]], schema=schema))

    def counts(held, prefix):
        rows = pa.Table.from_batches(phrases._filters(iter(batches), 7, prefix, held)).sort_by("range").to_batches(max_chunksize=3)
        found = pa.Table.from_batches(phrases._merged(iter(rows), 7, prefix, 2, held)).to_pylist()
        return sorted(tuple(r.values()) for r in found)

    assert counts(10, 4) == counts(1 << 22, 0) and len(counts(10, 4)) > 100
