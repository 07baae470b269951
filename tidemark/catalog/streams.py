"""Streaming forms over the driver's tables as file streams, most of them in several micro-batches; results must equal
the batch SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.joins import as_of_sql
from tidemark.catalog.registry import query
from tidemark.catalog.rows import DEDUP_HORIZON_SQL, cents
from tidemark.catalog.tables import CHANGELOG_SQL, MONOTONE_SQL
from tidemark.operators.filters import of_type
from tidemark.session import shared_folder
from tidemark.streaming import batches, boards, complete, sinks, stateful


def drained(t, df: DataFrame) -> DataFrame:
    """Run an append stream to its end and read what it wrote."""
    folder = f"{shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"
    sinks.drain(sinks.write_stream(df, f"{folder}/rows", f"{folder}/progress"))
    return sinks.read_log(t.spark, f"{folder}/rows")


def utc(column: str):
    """Zone-less times as TIMESTAMP, which watermarks need."""
    return F.col(column).cast("timestamp")


PARTS = 4


def arriving(t, df: DataFrame, part: Column) -> DataFrame:
    """The rows as a stream of PARTS files, one a micro-batch, in the order of ``part`` (0 to PARTS - 1)."""
    folder = f"{shared_folder(t.spark)}/arriving-{uuid.uuid4().hex}"
    for i in range(PARTS):
        df.where(part == i).coalesce(1).write.mode("append").parquet(folder)
    return t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def in_order(t, df: DataFrame, order: str) -> DataFrame:
    """The rows as a stream that follows ``order``, a quarter of its range a micro-batch."""
    low, high = df.agg(F.min(order), F.max(order)).first()
    step = (high - low) // PARTS + 1 if high is not None else 1
    return arriving(t, df, F.floor((F.col(order) - F.lit(low or 0)) / step))


def resumed(t, df: DataFrame, part: Column, start) -> int:
    """Run ``start(stream)`` to its end over the first half of PARTS files, and again, with the same progress folder, once the
    others have arrived; returns the number of micro-batches that had rows.  A micro-batch takes one file."""
    folder, batches_run = f"{shared_folder(t.spark)}/arriving-{uuid.uuid4().hex}", 0
    for half in (range(PARTS // 2), range(PARTS // 2, PARTS)):
        for i in half:
            df.where(part == i).coalesce(1).write.mode("append").parquet(folder)
        running = start(t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder))
        sinks.drain(running)
        batches_run += sum(progress.numInputRows > 0 for progress in running.recentProgress)
    return batches_run


@query("st_resumed_log", f"SELECT o_orderkey, o_custkey, {PARTS} AS batches FROM orders")
def _(t):
    folder = f"{shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"
    rows = t.orders.select("o_orderkey", "o_custkey")
    n = resumed(t, rows, F.pmod("o_orderkey", F.lit(PARTS)), lambda stream: sinks.write_stream(
        stream, f"{folder}/rows", f"{folder}/progress"))
    return sinks.read_log(t.spark, f"{folder}/rows").withColumn("batches", F.lit(n))


# A keyed table keeps what arrived last, and inside a micro-batch what is last in order; the files follow that order.
@query("st_resumed_table", f"""
    SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, {PARTS} AS batches
    FROM events WHERE user_id IS NOT NULL GROUP BY user_id""")
def _(t):
    folder = f"{shared_folder(t.spark)}/table-{uuid.uuid4().hex}"
    rows = t.events.select("user_id", "event_id", "event_type").where("user_id IS NOT NULL")
    low, high = rows.agg(F.min("event_id"), F.max("event_id")).first()
    width = (high - low) // PARTS + 1 if high is not None else 1
    n = resumed(t, rows, F.floor((F.col("event_id") - F.lit(low or 0)) / width), lambda stream: sinks.upsert(
        stream, f"{folder}/rows", ["user_id"], f"{folder}/progress", order="event_id", mode="append"))
    return sinks.current(t.spark, f"{folder}/rows", ["user_id"]).withColumn("batches", F.lit(n))


# Every seventh row has no time; what has none is stamped with the epoch.
UNTIMED_SQL = """
    WITH e AS (SELECT event_id, user_id, event_type, CASE WHEN event_id % 7 = 0 THEN TIMESTAMP '1970-01-01' ELSE ts END AS ts FROM events)
    SELECT s.event_id AS signup_id, p.event_id AS purchase_id, s.user_id
    FROM e s JOIN e p ON s.user_id = p.user_id AND p.ts BETWEEN s.ts - INTERVAL 2 HOUR AND s.ts + INTERVAL 2 HOUR
    WHERE s.event_type = 'signup' AND p.event_type = 'purchase'"""


@query("st_interval_join", UNTIMED_SQL)
def _(t):
    untimed = F.when(F.col("event_id") % 7 == 0, F.timestamp_seconds(F.lit(0))).otherwise(utc("ts"))
    rows = t.events.select("event_id", "user_id", "event_type", untimed.alias("ts"))
    events = arriving(t, rows, F.pmod(F.xxhash64("event_id"), F.lit(PARTS)))  # in no order of time at all

    def side(name, **columns):
        return of_type(events, name, "event_type").select(*[F.col(source).alias(out) for out, source in columns.items()])

    signups = side("signup", signup_id="event_id", user_id="user_id", signup_ts="ts")
    purchases = side("purchase", purchase_id="event_id", buyer="user_id", purchase_ts="ts")
    return logged(t, lambda path, progress: complete.interval_join_log(
        signups, purchases, path, progress, ("user_id", "buyer"), ("signup_ts", "purchase_ts"), 7200)).select(
            "signup_id", "purchase_id", "user_id")


def logged(t, start) -> DataFrame:
    """Run a log of running values to its end and read it."""
    folder = f"{shared_folder(t.spark)}/log-{uuid.uuid4().hex}"
    sinks.drain(start(folder, f"{folder}/progress"))
    return batches.read_rows(t.spark, folder)


@query("st_monotone", MONOTONE_SQL)
def _(t):
    orders = in_order(t, t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey")
    return logged(t, lambda path, progress: batches.monotone_log(
        orders, path, progress, "o_custkey", "o_orderdate", "o_orderkey")).select("o_orderkey", "o_custkey")


@query("st_changelog", CHANGELOG_SQL)
def _(t):
    rows = of_type(t.orders, "F", "o_orderstatus").select("o_orderkey", "o_custkey", "o_orderpriority")
    rows = in_order(t, rows, "o_orderkey")
    values = {"n": ("count", "o_orderkey"), "top": ("max", "o_orderpriority")}
    return logged(t, lambda path, progress: batches.changelog_log(
        rows, path, progress, ["o_custkey"], values, "o_orderkey")).drop("o_orderpriority")


@query("st_lookup", as_of_sql("view", "signup", "ASOF JOIN"))
def _(t):
    events = in_order(t, t.events.select("event_id", "user_id", "event_type", "props"), "event_id")
    views = of_type(events, "view", "event_type").select("event_id", "user_id")
    signups = of_type(events, "signup", "event_type").select(
        F.col("user_id").alias("owner"), F.col("event_id").alias("at"), F.col("props").alias("seen_props"),
        F.col("event_id").alias("seen_id"))
    return logged(t, lambda path, progress: batches.lookup_log(
        views, signups, path, progress, ("user_id", "owner"), ("event_id", "at"), ["seen_props", "seen_id"]))


@query("st_scores", """
    SELECT o_orderpriority AS board, o_custkey AS member, arg_max(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE
           CAST(round(o_totalprice * 100) AS BIGINT) END, o_orderkey) AS score FROM orders
    GROUP BY ALL HAVING arg_max(o_orderstatus, o_orderkey) <> 'F'""")
def _(t):
    score = F.when(F.col("o_orderstatus") == "F", F.lit(0).cast("bigint")).otherwise(cents("o_totalprice"))
    changes = t.stream("orders").select(F.col("o_orderpriority").alias("board"), F.col("o_custkey").alias("member"),
                                        score.alias("score"), "o_orderkey")
    folder = f"{shared_folder(t.spark)}/scores-{uuid.uuid4().hex}"
    sinks.drain(sinks.upsert(changes, f"{folder}/rows", ["board", "member"], f"{folder}/progress", order="o_orderkey",
                             mode="append"))
    return sinks.scores_now(t.spark, f"{folder}/rows", "board", "member", "score")


@query("st_leaderboard", """
    WITH s AS (SELECT o_orderpriority AS board, o_custkey AS member, arg_max(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE
               CAST(round(o_totalprice * 100) AS BIGINT) END, o_orderkey) AS score FROM orders GROUP BY ALL)
    SELECT board, member, score, row_number() OVER (PARTITION BY board ORDER BY score DESC, member DESC) AS rank
    FROM s WHERE score <> 0""")
def _(t):
    score = F.when(F.col("o_orderstatus") == "F", F.lit(0).cast("bigint")).otherwise(cents("o_totalprice"))
    rows = t.orders.select(F.col("o_orderpriority").alias("board"), F.col("o_custkey").alias("member"), score.alias("score"), "o_orderkey")
    folder = f"{shared_folder(t.spark)}/board-{uuid.uuid4().hex}"
    board = boards.Board(folder, "board", "member", "score", capacity=5_000)
    sinks.drain(boards.keep_board(in_order(t, rows, "o_orderkey"), board, f"{folder}/progress", "o_orderkey"))
    return board.ranks(t.spark)


@query("st_first_seen", "SELECT DISTINCT user_id FROM events WHERE event_type = 'error'")
def _(t):
    errors = of_type(t.stream("events"), "error", "event_type").select("user_id")
    return drained(t, stateful.first_seen(errors, ["user_id"]))


@query("st_dedup", DEDUP_HORIZON_SQL)
def _(t):
    rows = in_order(t, t.events.select("event_id", "user_id"), "event_id")
    return logged(t, lambda path, progress: complete.dedup_log(rows, path, progress, ["user_id"], "event_id", "event_id", 100))


@query("st_latest_table", """
    SELECT user_id, arg_max(props, event_id) FILTER (WHERE event_type = 'signup') AS signup,
           arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def _(t):
    signup = F.when(F.col("event_type") == "signup", F.col("props")).alias("signup")
    rows = t.stream("events").select("event_id", "user_id", signup, "event_type")
    table = stateful.latest_table(rows, ["user_id"], ["signup", "event_type"], "event_id")
    folder = f"{shared_folder(t.spark)}/table-{uuid.uuid4().hex}"
    sinks.drain(sinks.upsert(table, f"{folder}/rows", ["user_id"], f"{folder}/progress"))
    return sinks.current(t.spark, f"{folder}/rows", ["user_id"])
