"""Covered ranges, resumed loads and publishing plans next to plain loops."""

import random

import pytest

from tidemark.operators import paging


def made(seed, n=25):
    rnd = random.Random(seed)
    return [(a, a + rnd.randrange(0, 12)) for a in (rnd.randrange(-50, 250) for _ in range(n))] + [(7, 3), (None, 9), (4, None)]


@pytest.mark.parametrize("width", [None, 5, 40])
def test_ranges_gaps_and_what_is_left(spark, rows, width):
    for seed in range(2):
        ranges = made(seed)
        points = {c for a, b in ranges if a is not None and b is not None for c in range(a, b + 1)}
        df = spark.createDataFrame(ranges, "low long, high long").repartition(3)
        islands = rows(paging.covered_ranges(df, width=width))
        assert {c for a, b in islands for c in range(a, b + 1)} == points
        assert all(b + 1 < c for (_, b), (c, _) in zip(islands, islands[1:], strict=False))
        assert rows(paging.range_gaps(df, width=width)) == [(b + 1, c - 1) for (_, b), (c, _) in zip(islands, islands[1:], strict=False)]
        loads = spark.createDataFrame([(c, str(c)) for c in [*range(-60, 280), None]], "cursor long, high string")
        left = paging.not_covered(loads, df.withColumnRenamed("high", "until"), "cursor", "low", "until", width)
        assert rows(left.select("cursor")) == [(None,), *((c,) for c in range(-60, 280) if c not in points)]


def test_nothing_covered(spark, rows):
    none = spark.createDataFrame([], "low long, high long")
    loads = spark.createDataFrame([(1,), (2,)], "c long")
    assert rows(paging.covered_ranges(none)) == rows(paging.range_gaps(none)) == []
    assert rows(paging.not_covered(loads, none, "c")) == [(1,), (2,)]


@pytest.mark.parametrize("max_rows,max_bytes,width", [(5, 100, None), (3, 1000, 7), (100, 30, 11), (1, 30, 50)])
def test_publish_batches_keep_both_limits(spark, max_rows, max_bytes, width):
    rnd = random.Random(max_rows)
    data = [(i * 2, rnd.choice([None, 0, 1, 5, 17, 30])) for i in range(200)]
    df = spark.createDataFrame(data, "o long, size int").repartition(3)
    got = sorted((r.o, r.size or 0, r.batch) for r in paging.publish_batches(df, "o", "size", max_rows, max_bytes, width).collect())
    assert [(o, s) for o, s, _ in got] == [(o, s or 0) for o, s in data]
    batches = [b for _, _, b in got]
    assert batches == sorted(batches)
    for b in set(batches):
        sizes = [s for _, s, x in got if x == b]
        assert len(sizes) <= max_rows and sum(sizes) <= max_bytes
    assert len(set(batches)) <= -(-200 // max_rows) + -(-sum(s for _, s, _ in got) // max(1, max_bytes - 29)) + 1
    with pytest.raises(ValueError):
        paging.publish_batches(df, "o", "size", 5, 29)
