"""Running values: the cut form equals a row-by-row fold, whatever the keys, NULLs, chunk widths."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.aggregates import changelog, collect_pages, dedup, first_per_key, latest_by, latest_rows, monotone
from tidemark.operators.joins import lookup_join
from tidemark.operators.ranking import leaderboard, next_number, rank_all
from tidemark.operators.running import Running, running

# Chunk widths: the default (one chunk here), tiny pieces, every place its own chunk, some places together.
CUTS = [None, 3, 1, 10]


def sample(seed, size=300):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    offsets = rng.sample(range(-50, size * 2), size)
    return [(o, rng.choice(keys), rng.choice([None, *range(20)])) for o in offsets]


def fold(data, start, step):
    state, out = {}, []
    for row in sorted(data):
        state[row[1]], result = step(state.get(row[1], start), row)
        if result is not None:
            out.append(result)
    return sorted(out, key=str)


@pytest.mark.parametrize("width", CUTS)
@pytest.mark.parametrize("seed", [1, 2])
def test_monotone_equals_fold(spark, seed, width):
    data = sample(seed)

    def accept(newest, row):
        _, key, time = row
        if key is None:
            return newest, row
        if newest is None or (time is not None and time >= newest):
            return (newest if time is None else time), row
        return newest, None

    df = spark.createDataFrame(data, "o BIGINT, k STRING, t INT").repartition(3)
    got = sorted((tuple(r) for r in monotone(df, "k", "t", "o", width).collect()), key=str)
    assert got == fold(data, None, accept)


def test_monotone_golden(spark):
    def run(times):
        df = spark.createDataFrame([(i, "k", t) for i, t in enumerate(times)], "o BIGINT, k STRING, t INT")
        return [r.t for r in monotone(df, "k", "t", "o").orderBy("o").collect()]
    assert run([3, 2, 3, None, 5, 4]) == [3, 3, 5]
    assert run([None, None, 2, None]) == [None, None, 2]
    assert run([]) == []


@pytest.mark.parametrize("width", CUTS)
def test_all_folds(spark, width):
    data = [r for r in sample(7) if r[1] is not None]

    def step(state, row):
        n, total, top, last = state
        value = row[2]
        if value is not None:
            n, total = n + 1, (total or 0) + value
            top, last = (value if top is None else max(top, value)), value
        state = (n, total, top, last)
        return state, (row[0], row[1], *state)

    df = spark.createDataFrame(data, "o BIGINT, k STRING, v INT").repartition(3)
    values = {"n": ("count", "v"), "s": ("sum", "v"), "m": ("max", "v"), "l": ("last", "v")}
    got = changelog(df, ["k"], values, "o", width).select("o", "k", "n", "s", "m", "l").collect()
    assert sorted((tuple(r) for r in got), key=str) == fold(data, (0, None, None, None), step)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("width", CUTS)
def test_as_of_equals_fold(spark, how, width):
    data = sample(11)
    rng = random.Random(5)
    sides = [(o, k, v, rng.random() < 0.3) for o, k, v in data]

    def step(state, row):
        offset, key, value, is_update = row
        seen, held = state
        if is_update:
            return (True, held if value is None else value), None
        if key is None:
            return state, ((offset, key, None) if how == "left" else None)
        return state, ((offset, key, held) if seen or how == "left" else None)

    events = spark.createDataFrame([(o, k) for o, k, _, u in sides if not u], "o BIGINT, k STRING")
    updates = spark.createDataFrame([(k, o, v) for o, k, v, u in sides if u], "key STRING, at BIGINT, v INT")
    got = lookup_join(events, updates, ("k", "key"), ("o", "at"), ["v"], how=how, width=width)
    assert sorted((tuple(r) for r in got.collect()), key=str) == fold(sides, (False, None), step)


def test_update_at_the_same_place_counts(spark):
    events = spark.createDataFrame([(5, "k")], "o BIGINT, k STRING")
    updates = spark.createDataFrame([("k", 5, 1)], "key STRING, at BIGINT, v INT")
    assert lookup_join(events, updates, ("k", "key"), ("o", "at"), ["v"]).collect()[0].v == 1


def test_latest_lookup_uses_final_table(spark, rows):
    events = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "o BIGINT, k STRING")
    updates = spark.createDataFrame([("a", 9, 7), ("a", 10, None)], "key STRING, at BIGINT, v INT")
    got = lookup_join(events, updates, ("k", "key"), ("o", "at"), ["v"], mode="latest", how="left")
    assert rows(got) == [(1, "a", 7), (2, "b", None), (3, None, None)]


def test_time_order_is_cut_by_hour(spark):
    data = [(f"2024-01-01 {h:02d}:{m:02d}:00", "k", h * 60 + m) for h in range(4) for m in (0, 30)]
    df = spark.createDataFrame(data, "ts STRING, k STRING, v INT").select(F.to_timestamp("ts").alias("ts"), "k", "v")
    for frame in (df, df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))):
        got = running(frame, ["k"], ["ts"], [Running("n", "count", F.lit(1))])
        assert [r.n for r in got.orderBy("ts").collect()] == list(range(1, 9))


@pytest.mark.parametrize("width", CUTS)
def test_null_orders_come_first_and_null_keys_are_one_group(spark, width):
    data = [(o, k, t) for k in ("k", None) for t, o in enumerate([None, 4, 5, 9, 10, 30])]
    df = spark.createDataFrame(data, "o BIGINT, k STRING, t INT")
    folds = [Running("n", "count", F.lit(1)), Running("s", "sum", F.col("t")), Running("m", "max", F.col("t")),
             Running("l", "last", F.when(F.col("t") < 3, F.col("t")))]
    got = running(df, ["k"], ["o"], folds, width=width).collect()
    assert sorted((r.t, r.n, r.s, r.m, r.l) for r in got if r.k is None) == [
        (t, t + 1, t * (t + 1) // 2, t, min(t, 2)) for t in range(6)]
    assert len(got) == 12 and sorted(r[2:] for r in got if r.k) == sorted(r[2:] for r in got if not r.k)


def test_rows_are_shuffled_once_and_nothing_is_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).selectExpr("id AS o", "id % 3 AS k", "repeat('x', 10) AS wide")
        plan = running(df, ["k"], ["o"], [Running("n", "count", F.lit(1))])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 4 and "Broadcast" not in plan  # rows, totals, totals by key, back


@pytest.mark.parametrize("width", CUTS)
def test_dedup_horizon(spark, width):
    data = [(o, k, o) for o, k, _ in sample(3) if k]

    def step(last, row):
        return row[0], (row if last is None or row[0] - last > 4 else None)

    df = spark.createDataFrame(data, "o BIGINT, k STRING, t BIGINT")
    got = dedup(df, ["k"], "o", "t", 4, width).collect()
    assert sorted((tuple(r) for r in got), key=str) == fold(data, None, step)


@pytest.mark.parametrize("width", CUTS)
def test_pages_hold_every_row_once(spark, width):
    data = [r for r in sample(9) if r[1] is not None]
    df = spark.createDataFrame(data, "o BIGINT, k STRING, v INT")
    pages = collect_pages(df, "k", "o", ["v"], 7, width).collect()
    assert all(len(p["items"]) <= 7 for p in pages)
    for key in {r[1] for r in data}:
        mine = sorted((p.page, [i.o for i in p["items"]]) for p in pages if p.k == key)
        assert [o for _, items in mine for o in items] == sorted(r[0] for r in data if r[1] == key)
        assert [p for p, _ in mine] == list(range(len(mine)))


@pytest.mark.parametrize("width", CUTS)
def test_next_number(spark, rows, width):
    requests = spark.createDataFrame([(i, "g" if i % 2 else "h") for i in range(8)], "o BIGINT, g STRING")
    supply = spark.createDataFrame([("g", 246)], "g STRING, supply BIGINT")
    got = next_number(requests, supply, "g", "o", width=width).select("o", "g", "edition", "marker")
    assert rows(got) == [(0, "h", 1, 0), (1, "g", 247, 0), (2, "h", 2, 0), (3, "g", 248, 1), (4, "h", 3, 0),
                         (5, "g", 249, 1), (6, "h", 4, 0), (7, "g", 250, 1)]


def test_full_ranking_equals_top_k(spark, rows):
    rng = random.Random(4)
    data = [("big" if i % 3 else "small", f"m{i:03d}", rng.randrange(12)) for i in range(200)]
    df = spark.createDataFrame(data, "g STRING, m STRING, s INT").repartition(5)
    everyone = leaderboard(df, "g", "m", "s")
    assert rows(everyone) == rows(rank_all(df, "g", "m", "s", partitions=9))
    assert rows(everyone) == rows(leaderboard(df, "g", "m", "s", 200).withColumn("rank", F.col("rank").cast("bigint")))
    for name in ("big", "small"):
        want = sorted(((s, m) for g, m, s in data if g == name), reverse=True)
        got = everyone.where(F.col("g") == name).orderBy("rank").collect()
        assert [(r.s, r.m) for r in got] == want


def test_latest_by_skips_nulls_per_column(spark, rows):
    df = spark.createDataFrame([("k", 1, "a", None), ("k", 2, None, 5), (None, 3, "x", 9)],
                               "k STRING, o BIGINT, a STRING, b INT")
    assert rows(latest_by(df, ["k"], ["a", "b"], "o")) == [("k", "a", 5)]
    assert rows(latest_by(df, [], ["a", "b"], "o")) == [("x", 9)]
    assert rows(latest_rows(df.where("k is not null"), ["k"], "o")) == [("k", 2, None, 5)]
    assert rows(first_per_key(df.where("k is not null"), ["k"], "o")) == [("k", 1, "a", None)]
