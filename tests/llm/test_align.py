"""Alignment against a plain version that goes over every pair of token occurrences."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import align
from tidemark.llm.tokens import tokenizer_path

TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "the  quick   brown\n\n\tfox", "naïve café 漢字 😀 ß", "", None, " ", "▁odd", "a▁b",
    "<|endoftext|> and <unk> </s> <0x41> are text", "x" * 3000, "12345678901234567890", "\x00\x01 control", "don't won't 'tis",
    "the the the the fox", "the the the the fox", " leading and trailing ", "a" * 5 + " " * 50 + "b", "é café", "﻿bom   nbsp",
]


@pytest.fixture(scope="module")
def both():
    return align.Aligner(tokenizer_path(align.FIRST), tokenizer_path(align.SECOND))


def brute(both, texts):
    docs, counts = [], Counter()
    for t in texts:
        a = both.a.encode(" " + t, add_special_tokens=False).ids if t else []
        b = both.b.encode(t) if t else []
        want = b" " + (t or "").encode()
        if b"".join(both.bytes_a[i] for i in a) != want or b"".join(both.bytes_b[i] for i in b) != want:
            a, b = [], []
        links, groups, i, j, x, y, end_a, end_b = [], [], 0, 0, [], [], 0, 0
        while i < len(a) or j < len(b):
            if end_a <= end_b and i < len(a):
                end_a += len(both.bytes_a[a[i]])
                x.append(a[i])
                i += 1
            else:
                end_b += len(both.bytes_b[b[j]])
                y.append(b[j])
                j += 1
            if end_a == end_b:
                links.append((x[-1], y[-1]))
                groups.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
                x, y = [], []
        docs.append((len(a), len(b), links, groups))
        counts.update(links)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for n_a, n_b, links, groups in docs]


def test_alignment_against_brute_force(spark, both):
    rows = list(enumerate(TEXTS))
    df = spark.createDataFrame([(None if i == 3 else i, t) for i, t in rows], "doc_id long, text string")
    df = df.select("*", *[F.lit(1).alias(c) for c in ("a", "b", "n", "block", "local", "body", "best", "regular")]).repartition(3)
    got = {r[0]: tuple(r[1:]) for r in align.alignment_report(df).collect()}
    want = brute(both, TEXTS)
    assert got == {None if i == 3 else i: w for i, w in enumerate(want)}
    assert want[0][0] > 5 and want[2][2] > 3 and want[6] == (0, 0, 0, 0, 0, 0, "")
    assert align.alignment_report(df.limit(0)).collect() == []


def test_only_irregular_pairs_are_shuffled(spark, both):
    df = spark.createDataFrame([(1, "the quick brown fox " * 30), (2, "naïve 1234567")], "doc_id long, text string")
    blocks, pairs = align.aligned_tables(df)
    by_bytes = {(r.a, r.b): r for r in pairs.collect()}
    assert all(r.regular == (both.same[a] == b) for (a, b), r in by_bytes.items())
    assert all(both.bytes_a[a] == both.bytes_b[b] for (a, b), r in by_bytes.items() if r.regular)
    assert {r.regular for r in by_bytes.values()} == {True, False}


def test_units_give_the_same_tokens(both):
    texts = [t for t in TEXTS if t] + [" ".join(t for t in TEXTS if t) + " It's 42 o'clock , isn't it ? \u3000 x\u00a0 y _ z 1 2 " * 3, "  a", "b  ", " \n c \n"]
    texts += ["".join(random.Random(i).choices("ab1 ,.'\n\t é漢▁\u00a0\u3000\u2009s😀", k=60)) for i in range(400)]
    assert both.cuttable
    for text in texts:
        units = both.units(text)
        assert " ".join(units) == text
        assert [i for u in units for i in both.a.encode(" " + u, add_special_tokens=False).ids] == both.a.encode(" " + text, add_special_tokens=False).ids
        assert [i for u in units for i in both.b.encode(u)] == both.b.encode(text)


def test_units_start_anew(both, monkeypatch):
    known = align.Units(both)
    first = known.of(["one two three", "one  two", ""])
    assert [len(x) for x in first] == [3, 1, 0]
    alone = {u: known.of([u])[0] for u in ("\n", "x\n", "x\n y", "\n x")}  # as whole texts, then as parts of others
    assert all(len(x) == 1 for x in alone.values())
    assert [len(x) for x in known.of(["a \n b c", "x\n y z"])] == [2, 2]
    known.clear()
    assert known.of(["one two three"]) == [[known.number[w] for w in ("one", "two", "three")]]
