"""The plans are the ones meant for large inputs."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import QUERIES
from tidemark.operators.aggregates import first_per_key, monotone
from tidemark.operators.joins import interval_join, lookup_join
from tidemark.operators.ranking import leaderboard

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.split("_")[0] in ("src", "flt", "set", "jn", "ag", "wn", "rq")))
def test_no_cartesian_product(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@needs_tables
def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["flt_route_type"](spark, FOLDER))
    assert "EqualTo(event_type,signup)" in text and "props" not in text.split("ReadSchema")[1]
    assert "GreaterThan" in text or "user_id" in text


def test_top_k_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("m"), F.col("id").alias("s"))
    for shaped in (leaderboard(df, "g", "m", "s", 5), first_per_key(df, ["g"], "s")):
        text = plan(shaped)
        assert text.index("Final") < text.index("Exchange") < text.rindex("Partial")


def test_rows_are_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).select("id", (F.col("id") % 3).alias("k"), F.col("id").alias("t"), F.lit("x").alias("wide"))
        text = plan(monotone(df, "k", "t", "id"))
        rows_side = text.split(":- Window")[1].split("+- Sort")[1]
        assert "SortMergeJoin" in text and rows_side.count("Exchange hashpartitioning") <= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_interval_join_matches_on_buckets(spark):
    left = spark.range(10).select((F.col("id") % 2).alias("a"), F.col("id").alias("at"))
    right = spark.range(10).select((F.col("id") % 2).alias("b"), F.col("id").alias("bt"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(interval_join(left.repartition(2), right.repartition(2), ("a", "b"), ("at", "bt"), 2))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(a" in text and "__bucket" in text and "__spread" in text


def test_as_of_join_has_no_range_join(spark):
    events = spark.range(10).select("id", F.lit("k").alias("k"))
    updates = spark.range(10).select(F.lit("k").alias("key"), F.col("id").alias("at"), F.lit(1).alias("v"))
    text = plan(lookup_join(events, updates, ("k", "key"), ("id", "at"), ["v"]))
    assert "Window" in text and "NestedLoop" not in text
