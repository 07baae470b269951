"""Streams equal their batch form over several micro-batches, survive restarts and replays."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.aggregates import changelog, dedup, first_per_key, latest_by, monotone
from tidemark.operators.joins import interval_join, lookup_join
from tidemark.plans import datasets as ds
from tidemark.plans import dictionaries as fixed
from tidemark.streaming import batches, complete, sinks, stateful


class Feed:
    """A folder written file by file, read as a stream one file per micro-batch."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.files = spark, str(folder), schema, 0

    def add(self, data):
        self.spark.createDataFrame(data, self.schema).coalesce(1).write.mode("append").parquet(self.folder)
        self.files += 1

    @property
    def batch(self):
        return self.spark.read.parquet(self.folder)

    @property
    def stream(self):
        reader = self.spark.readStream.schema(self.batch.schema).option("maxFilesPerTrigger", 1)
        return reader.parquet(self.folder)


def drain(df, tmp_path, name="out"):
    sinks.drain(sinks.write_stream(df, str(tmp_path / name), str(tmp_path / f"{name}-progress")))
    return sinks.read_log(df.sparkSession, str(tmp_path / name))


@pytest.fixture
def feed(spark, tmp_path):
    rng = random.Random(2)
    made = Feed(spark, tmp_path / "in", "o BIGINT, k STRING, t BIGINT, v DECIMAL(20,3)")
    from decimal import Decimal
    for part in range(3):
        made.add([(part * 40 + i, rng.choice("aab"), rng.choice([None, *range(30)]), Decimal(2**53 + i) / 1000)
                  for i in rng.sample(range(40), 40)])
    return made


def test_monotone_stream(feed, tmp_path, rows):
    got = drain(stateful.monotone_stream(feed.stream, "k", "t", "o"), tmp_path)
    assert rows(got) == rows(monotone(feed.batch, "k", "t", "o"))


def test_count_stream(feed, tmp_path, rows):
    got = drain(stateful.count_stream(feed.stream, "k", "o", "n"), tmp_path)
    assert rows(got) == rows(changelog(feed.batch, ["k"], {"n": ("count", "o")}, "o"))


# Every key cut into chunks of 7 offsets, the state in three buckets.
CUT = {"width": 7, "buckets": 3}


def test_monotone_and_changelog_logs(feed, spark, tmp_path, rows):
    values = {"n": ("count", "t"), "s": ("sum", "t"), "m": ("max", "v"), "l": ("last", "t")}

    def run():
        sinks.drain(batches.monotone_log(feed.stream, str(tmp_path / "m"), str(tmp_path / "mp"), "k", "t", "o", **CUT))
        sinks.drain(batches.changelog_log(feed.stream, str(tmp_path / "c"), str(tmp_path / "cp"), ["k"], values, "o", **CUT))
        return rows(batches.read_rows(spark, str(tmp_path / "m"))), rows(batches.read_rows(spark, str(tmp_path / "c")))

    def want():
        return rows(monotone(feed.batch, "k", "t", "o")), rows(changelog(feed.batch, ["k"], values, "o"))

    assert run() == want()
    feed.add([(700, "a", 3, None), (701, "a", 99, None), (702, None, 1, None), (703, "new", None, None)])
    assert run() == want()
    feed.add([(800, "b", 50, None), (801, "a", 50, None)])
    assert run() == want()


def test_replayed_log_batch_changes_nothing(feed, spark, tmp_path, rows):
    def run():
        sinks.drain(batches.monotone_log(feed.stream, str(tmp_path / "m"), str(tmp_path / "mp"), "k", "t", "o"))
        return rows(batches.read_rows(spark, str(tmp_path / "m")))

    first = run()
    forget_last_commit(tmp_path / "mp")
    assert run() == first == rows(monotone(feed.batch, "k", "t", "o"))


def forget_last_commit(progress):
    """As if the driver was lost right after the last batch was written."""
    last = max(int(p.name) for p in (progress / "commits").iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (progress / "commits" / name).unlink()


def test_first_seen_and_dedup(feed, spark, tmp_path, rows):
    keys = rows(first_per_key(feed.batch, ["k"], "o").select("k"))
    assert rows(drain(stateful.first_seen(feed.stream.select("k"), ["k"]), tmp_path)) == keys
    timed = feed.stream.select("k", F.timestamp_seconds("o").alias("ts"))
    assert rows(drain(stateful.dedup_within(timed, ["k"], "ts", "1 day").select("k"), tmp_path, "dedup")) == keys


def test_latest_table_restart_and_compaction(feed, spark, tmp_path, rows):
    path, progress = str(tmp_path / "table"), str(tmp_path / "progress")

    def run():
        table = stateful.latest_table(feed.stream, ["k"], ["t", "v"], "o")
        sinks.drain(sinks.upsert(table, path, ["k"], progress))
        return rows(sinks.current(spark, path, ["k"]).select("k", "t", "v"))

    assert run() == rows(latest_by(feed.batch, ["k"], ["t", "v"], "o"))
    feed.add([(500, "new", 1, None), (501, "a", 99, None)])
    assert run() == rows(latest_by(feed.batch, ["k"], ["t", "v"], "o"))
    sinks.compact(spark, path, ["k"], str(tmp_path / "compact"))
    assert rows(sinks.current(spark, str(tmp_path / "compact"), ["k"]).select("k", "t", "v")) == run()


def test_replayed_batch_leaves_its_rows_once(feed, spark, tmp_path, rows):
    path, progress = str(tmp_path / "table"), tmp_path / "progress"

    def run():
        sinks.drain(sinks.upsert(feed.stream, path, ["k"], str(progress), order="o", mode="append"))
        return rows(sinks.current(spark, path, ["k"]))

    first = run()
    assert len(first) == 2
    forget_last_commit(progress)
    assert run() == first


def test_reading_a_keyed_table_opens_one_version_per_bucket(feed, spark, tmp_path, rows):
    path = str(tmp_path / "table")

    def run():
        sinks.drain(sinks.upsert(feed.stream, path, ["k"], str(tmp_path / "p"), order="o", mode="append", buckets=4))
        return sinks.current(spark, path, ["k"])

    files = len(run().inputFiles())
    for n in range(5):
        feed.add([(500 + n, "a", n, None), (600 + n, None, n, None)])
    table = run()
    assert len(table.inputFiles()) <= files + 1  # the new NULL key may have a bucket of its own
    assert rows(table.select("k", "o")) == [(None, 604), ("a", 504), ("b", rows(feed.batch.where("k = 'b'").groupBy("k").agg(F.max("o")))[0][1])]


def timed(df, seconds, time):
    return df.withColumn(time, F.timestamp_seconds(seconds))


@pytest.mark.parametrize("slot", [1000, 86_400])
def test_interval_join_log_loses_no_late_row(spark, tmp_path, rows, slot):
    left = Feed(spark, tmp_path / "l", "k STRING, ls BIGINT, i INT")
    right = Feed(spark, tmp_path / "r", "b STRING, rs BIGINT, j INT")
    day = 86_400
    left.add([("a", 20 * day, 1), ("b", 30 * day, 2), (None, 5, 7)])
    right.add([("a", 25 * day, 1), ("b", 0, 2), ("a", None, 8)])
    left.add([("a", 25 * day + 7200, 3), ("a", 25 * day - 7201, 4), ("b", 0, 5)])  # the first meets an old row
    right.add([("a", 20 * day - 7200, 3), ("b", 30 * day + 1, 4), ("b", 30 * day + 7201, 5), ("b", 100, 6)])  # 10 days late, untimed

    path, progress = str(tmp_path / "log"), tmp_path / "progress"

    def run():
        sinks.drain(complete.interval_join_log(timed(left.stream, "ls", "lt"), timed(right.stream, "rs", "rt"), path, str(progress),
                                               ("k", "b"), ("lt", "rt"), 7200, slot=slot))
        return rows(batches.read_rows(spark, path).select("i", "j"))

    def want():
        both = interval_join(timed(left.batch, "ls", "lt"), timed(right.batch, "rs", "rt"), ("k", "b"), ("lt", "rt"), 7200)
        return rows(both.select("i", "j"))

    first = run()
    assert first == want() == [(1, 3), (2, 4), (3, 1), (5, 2), (5, 6)]
    forget_last_commit(progress)
    assert run() == first
    left.add([("a", 20 * day, 9), ("b", 30 * day, 10)])
    assert run() == want() == sorted([*first, (9, 3), (10, 4)])


def test_dedup_log_equals_the_batch_form(feed, spark, tmp_path, rows):
    feed.add([(800, None, 90, None), (801, "late", 1, None), (802, None, 91, None), (803, "a", 200, None)])

    def run(horizon):
        path = str(tmp_path / f"log-{horizon}")
        column = None if horizon is None else "t"
        sinks.drain(complete.dedup_log(feed.stream.fillna({"t": 0}), path, path + "-p", ["k"], "o", column, horizon, **CUT))
        return rows(batches.read_rows(spark, path)), rows(dedup(feed.batch.fillna({"t": 0}), ["k"], "o", column, horizon))

    for horizon in (None, 3, 20, 100):
        got, want = run(horizon)
        assert got == want and (801, "late", 1, None) in want


def test_append_log_restart_adds_only_new_rows(feed, tmp_path, rows):
    assert drain(feed.stream, tmp_path).count() == 120
    feed.add([(900, "z", 1, None)])
    assert rows(drain(feed.stream, tmp_path)) == rows(feed.batch)


def test_scores_follow_changes(spark, tmp_path, rows):
    made = Feed(spark, tmp_path / "in", "g STRING, m STRING, s INT, o BIGINT")
    made.add([("g", "x", 5, 1), ("g", "x", 7, 2), ("g", "y", 1, 3)])
    made.add([("g", "y", 0, 4), ("g", "z", None, 5)])
    sinks.drain(sinks.upsert(made.stream, str(tmp_path / "s"), ["g", "m"], str(tmp_path / "p"), order="o", mode="append"))
    assert rows(sinks.scores_now(spark, str(tmp_path / "s"), "g", "m", "s")) == [("g", "x", 7)]


def test_interval_join_stream_with_late_rows(spark, tmp_path, rows):
    left = Feed(spark, tmp_path / "l", "k STRING, ls BIGINT, i INT")
    right = Feed(spark, tmp_path / "r", "b STRING, rs BIGINT, j INT")
    left.add([("a", 0, 1), ("b", 50, 2)])
    left.add([("a", 7200, 3), ("a", 20000, 4)])
    right.add([("a", 7201, 1), ("a", 100, 2)])
    right.add([("a", 14400, 3), ("b", 7250, 4), ("b", 7251, 5)])

    def join(l, r):
        l, r = l.withColumn("ls", F.col("ls") + 1_600_000_000), r.withColumn("rs", F.col("rs") + 1_600_000_000)
        return interval_join(timed(l, "ls", "lt"), timed(r, "rs", "rt"), ("k", "b"), ("lt", "rt"), 7200).select("i", "j")

    got = drain(join(left.stream, right.stream), tmp_path)
    assert rows(got) == rows(join(left.batch, right.batch)) == [(1, 2), (2, 4), (3, 1), (3, 2), (3, 3), (4, 3)]


def test_lookup_stream(spark, tmp_path, rows):
    events = Feed(spark, tmp_path / "e", "o BIGINT, k STRING")
    updates = Feed(spark, tmp_path / "u", "key STRING, at BIGINT, x STRING, y INT")
    events.add([(1, "a"), (3, "a"), (6, "a"), (6, "b")])
    updates.add([("a", 2, "p", 1), ("a", 5, None, 2), (None, 1, "q", 9)])
    events.add([(9, "b"), (12, "a")])
    updates.add([("b", 8, "r", None), ("a", 10, "s", None)])
    for how in ("inner", "left"):
        got = drain(stateful.lookup_stream(events.stream, updates.stream, ("k", "key"), ("o", "at"), ["x", "y"], how),
                    tmp_path, how)
        want = rows(lookup_join(events.batch, updates.batch, ("k", "key"), ("o", "at"), ["x", "y"], how=how))
        assert rows(got) == want
        path = str(tmp_path / f"log-{how}")
        sinks.drain(batches.lookup_log(events.stream, updates.stream, path, path + "-progress", ("k", "key"), ("o", "at"),
                                       ["x", "y"], how, **CUT))
        assert rows(batches.read_rows(spark, path)) == want


def test_typed_dataset_and_table_join_on_a_stream(spark, tmp_path, rows):
    made = Feed(spark, tmp_path / "in", "offset BIGINT, type STRING, slot BIGINT, blockTime BIGINT, blockhash STRING, "
                                        "recentBlockhash STRING, payload STRING")
    change = '{"pubkey":"p","mint":"m","preAmount":"0","postAmount":"150","decimals":2}'
    bond = f'{{"programId":"{fixed.BONDING_PROGRAM}","accounts":{{"targetMint":"m","tokenBonding":"B"}}}}'
    made.add([(1, "initializeTokenBondingV0", 1, 1, None, None, bond)])
    made.add([(2, "TokenAccountBalanceChange", 2, 2, None, None, change)])
    stream = ds.token_account_balance_changes(made.stream)
    assert rows(drain(stream, tmp_path)) == rows(ds.token_account_balance_changes(made.batch))
    table = ds.typed(made.batch, "token_bonding_initializes").select("targetMint", "tokenBonding", "seq")
    joined = lookup_join(stream, table, ("mint", "targetMint"), ("seq", "seq"), ["tokenBonding"], mode="latest")
    assert [r.tokenBonding for r in drain(joined, tmp_path, "joined").collect()] == ["B"]
