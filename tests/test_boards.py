"""Leaderboards kept by ranges equal a full ranking after every batch."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ranking import apply_scores
from tidemark.streaming.boards import Board

SCHEMA = "o BIGINT, g STRING, m BIGINT, s BIGINT"


def expected(history):
    """The definition, row by row in plain Python."""
    scores = {}
    for _, g, m, s in sorted(history):
        if s:
            scores[g, m] = s
        else:
            scores.pop((g, m), None)
    out = []
    for group in {g for g, _ in scores}:
        best = sorted(((s, m) for (g, m), s in scores.items() if g == group), reverse=True)
        out += [(group, m, s, i) for i, (s, m) in enumerate(best, 1)]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or "", r[1]))


def kept(board, spark, only=None):
    df = board.ranks(spark, only)
    return [] if df is None else sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1]))


@pytest.mark.parametrize("capacity", [7, 10_000])
def test_board_over_batches(spark, tmp_path, capacity):
    rng = random.Random(capacity)
    board, history = Board(str(tmp_path), "g", "m", "s", capacity, buckets=3), []
    # One group holds most members; scores tie often; removals by zero and NULL; members of small groups come and go.
    for batch in range(4):
        new = [(batch * 100 + i, rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.randrange(25),
                rng.choice([None, 0, *range(1, 9)]) if batch < 3 else 0) for i in range(60)]
        history += new
        board.apply(spark.createDataFrame(new, SCHEMA), "o", batch)
        assert kept(board, spark) == expected(history)
    sizes = [r["n"] for r in board.ranges(spark)]
    assert sum(sizes) == len(expected(history))
    assert all(r["low"] is not None for r in board.ranges(spark))


def test_a_batch_rewrites_only_the_ranges_it_touches(spark, tmp_path):
    board = Board(str(tmp_path), "g", "m", "s", 20, buckets=2)
    rows = spark.range(200).select(F.col("id").alias("o"), F.lit("hot").alias("g"), F.col("id").alias("m"), (F.col("id") + 1).alias("s"))
    board.apply(rows, "o", 0)
    before = board.ranges(spark)
    assert len(before) > 8 and max(r["n"] for r in before) < 60
    board.apply(spark.createDataFrame([(900, "hot", 3, 5)], SCHEMA), "o", 1)  # a neighbour's place: ties go to the later member
    after = board.ranges(spark)
    assert sum(r["version"] == 1 for r in after) <= 2 and sum(r["n"] for r in after) == 200
    asked = spark.createDataFrame([("hot", 3), ("hot", 199), ("none", 1)], "g STRING, m BIGINT")
    assert kept(board, spark, asked) == [("hot", 3, 5, 197), ("hot", 199, 200, 1)]


def test_replay_and_emptied_board(spark, tmp_path):
    board = Board(str(tmp_path), "g", "m", "s", 4, buckets=2)
    first = spark.createDataFrame([(i, "x", i, i + 1) for i in range(30)], SCHEMA)
    board.apply(first, "o", 0)
    second = spark.createDataFrame([(50, "x", 2, 99), (51, "y", 1, 1)], SCHEMA)
    board.apply(second, "o", 1)
    once = kept(board, spark)
    board.apply(second, "o", 1)
    assert kept(board, spark) == once and once[2] == ("x", 2, 99, 1)
    board.apply(spark.createDataFrame([], SCHEMA), "o", 2)
    assert kept(board, spark) == once
    gone = apply_scores(None, spark.createDataFrame([(99, r[0], r[1], 1) for r in once], SCHEMA), "g", "m", "s", "o")
    board.apply(gone.withColumns({"s": F.lit(0).cast("bigint"), "o": F.lit(1)}), "o", 3)
    assert kept(board, spark) == []
    board.apply(spark.createDataFrame([(100, "x", 1, 7)], SCHEMA), "o", 4)
    assert kept(board, spark) == [("x", 1, 7, 1)]


def test_small_ranges_share_files(spark, tmp_path):
    """Hundreds of ranges are a few files, and a batch that touches some of them leaves the others where they are."""
    board = Board(str(tmp_path), "g", "m", "s", 20, buckets=2)
    rows = spark.range(4000).select(F.col("id").alias("o"), F.lit("hot").alias("g"), F.col("id").alias("m"), (F.col("id") + 1).alias("s"))
    board.apply(rows, "o", 0)
    assert len(board.ranges(spark)) >= 200 and len(list((tmp_path / "ranges").rglob("*.parquet"))) <= 4
    board.apply(spark.createDataFrame([(9000 + i, "hot", 100 * i, 0) for i in range(5)], SCHEMA), "o", 1)
    assert sum(r["version"] == 0 for r in board.ranges(spark)) >= 190
    want = expected([(i, "hot", i, i + 1) for i in range(4000)] + [(9000 + i, "hot", 100 * i, 0) for i in range(5)])
    assert kept(board, spark) == want
