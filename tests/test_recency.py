"""Dedup against the last N keys, next to a cache that is walked row by row."""

import random
from collections import OrderedDict

import numpy as np
import pytest

from tidemark.operators import recency


def cached(rows, last):
    cache, out = OrderedDict(), []
    for o, k in rows:
        if k in cache:
            cache.move_to_end(k)
        else:
            out.append((o, k))
            cache[k] = 1
            if len(cache) > last:
                cache.popitem(last=False)
    return out


def test_below_counts_smaller_points():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 200):
        x, y, w = rng.integers(0, 20, n), rng.integers(0, 20, n), rng.integers(1, 5, n)
        want = [int(w[(x < a) & (y < b)].sum()) for a, b in zip(x, y, strict=True)]
        assert recency.below(x, y, w).tolist() == want


@pytest.mark.parametrize("strip,together", [(1_000_000, 1_000), (7, 3), (40, 2)])
def test_dominated_points(spark, monkeypatch, strip, together):
    rnd = random.Random(strip)
    pts = list(zip(rnd.sample(range(300), 150), rnd.sample(range(300), 150), strict=True))
    df = spark.createDataFrame([(x, y, 1) for x, y in pts], "x long, y long, w long")
    got = {(r.x, r.y): r.below for r in recency.dominated(df, 300, strip, together).collect()}
    assert got == {(x, y): sum(a < x and b < y for a, b in pts) for x, y in pts}


@pytest.mark.parametrize("last", [1, 2, 5, 20, 1000])
def test_dedup_last_is_a_cache_of_the_last_keys(spark, monkeypatch, last):
    monkeypatch.setattr(recency, "STRIPS_TOGETHER", 4)
    rnd = random.Random(last)
    keys = [rnd.choice(["hot", None, *(f"k{int(rnd.paretovariate(0.6)) % 60}" for _ in range(2))]) for _ in range(250)]
    rows = [(i * 3 - 100, k) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "o long, k string").repartition(3)
    got = sorted((tuple(r) for r in recency.dedup_last(df, ["k"], "o", last, width=50, strip=30).collect()))
    assert got == cached(rows, last)
    assert recency.dedup_last(df.limit(0), ["k"], "o", last).collect() == []
