"""The n-gram join against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def some_rows(seed, groups=12):
    """Copies, copies with a few or many words changed, chains, short and odd texts."""
    rnd = random.Random(seed)
    word = lambda: f"w{int(rnd.paretovariate(0.7)) % 4000}"
    texts = []
    for g in range(groups):
        base = [word() for _ in range(rnd.choice([3, 8, 40, 120, 400]))]
        for _ in range(rnd.randrange(1, 25)):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5, 12])):
                copy[rnd.randrange(len(copy))] = word()
            if rnd.random() < 0.3:
                copy += [word() for _ in range(rnd.randrange(6))]
            if rnd.random() < 0.3:
                base = copy  # a chain: its ends are less alike than its links
            texts.append(" ".join(copy))
    texts += [None, "", " \t\n", "One", "one", "one two", "ONE\ntwo", "one two three", "É é x", "é é x", "a a a a a", "a a a"] * 2
    texts += ["long " * 3000 + "tail", "long " * 2000 + "tail"]
    rnd.shuffle(texts)
    return [(None if i % 41 == 7 else i // 2 if i % 29 == 0 else i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,limits", [(1, {}), (2, {"CELL": 500, "COMPARED": 64, "BROADCAST_IDS": 0, "RANGE": 64})])
def test_components_against_all_pairs(spark, monkeypatch, tmp_path, seed, limits):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    rows = some_rows(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.select("*", *[F.lit("q").alias(c) for c in ("rid", "id", "key", "n", "set", "bucket", "label", "root", "place", "block", "u")])
    df.repartition(3).write.parquet(f"{tmp_path}/docs")
    df = spark.read.parquet(f"{tmp_path}/docs")
    got = sorted((tuple(r) for r in jaccard.component_report(df).collect()), key=str)
    assert got == brute(rows)
    assert len({r[2] for r in got}) < len(got) - 30
    if not limits:
        assert jaccard.component_report(df.limit(0)).collect() == []


def test_bounds():
    for n in range(1, 120):
        for m in range(1, n + 1):
            need = next(i for i in range(n + m + 1) if 100 * i >= 90 * (n + m - i))
            assert jaccard.needed(n, m) == need
            if need <= m:  # sets that may be linked: the two prefixes meet
                assert jaccard.prefix_size(n) >= n - need + 1 and jaccard.prefix_size(m) >= m - need + 1


def test_suffix_filter_drops_no_link():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 200))
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        keep = rng.random(len(x)) > rng.choice([0, 0.03, 0.06, 0.2])
        y = np.unique(np.concatenate([x[keep], rng.integers(0, 1 << 63, int(rng.integers(0, 8)), dtype=np.uint64)]))
        if len(y):
            same = len(np.intersect1d(x, y))
            assert jaccard.linked(x, y) == (100 * same >= 90 * (len(x) + len(y) - same))
