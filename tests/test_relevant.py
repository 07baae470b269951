"""Rows that list a key of a wanted table: the filter before the explode changes no result."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import filters as flt


@pytest.mark.parametrize("filter_keys", [10_000, 0])
def test_relevant_rows(spark, rows, filter_keys):
    df = spark.createDataFrame(
        [(i, [f"k{(i * 7 + j) % 500}" for j in range(i % 4)] + [None] * (i % 3 == 0), i) for i in range(300)] + [(900, None, 0), (901, [None], 0)],
        "i INT, keys ARRAY<STRING>, extra INT")
    wanted = spark.createDataFrame([(f"k{i}",) for i in range(0, 500, 9)] * 2 + [(None,), ("other",)], "w STRING")
    known = {r.w for r in wanted.collect()} - {None}
    got = flt.relevant_rows(df, "i", "keys", wanted, filter_keys)
    assert got.columns == df.columns
    assert rows(got.select("i", "extra")) == [(r.i, r.extra) for r in df.collect() if known & set(r["keys"] or ())]


@pytest.mark.parametrize("filter_keys", [10_000, 0])
def test_nothing_wanted(spark, filter_keys):
    df = spark.createDataFrame([(1, [5])], "i INT, keys ARRAY<BIGINT>")
    assert flt.relevant_rows(df, "i", "keys", spark.createDataFrame([(None,)], "w INT"), filter_keys).count() == 0
    assert flt.relevant_rows(df, "i", "keys", spark.createDataFrame([(5,)], "w INT"), filter_keys).count() == 1


def test_only_candidates_are_exploded(spark, tmp_path):
    spark.range(20_000).select("id", F.array("id", F.col("id") + 20_000).alias("keys")).write.parquet(f"{tmp_path}/t")
    df, wanted = spark.read.parquet(f"{tmp_path}/t"), spark.range(0, 20_000, 200)
    got = flt.relevant_rows(df, "id", "keys", wanted)
    bits, words = flt.key_filter(wanted, 100)
    passed = df.withColumn("b", bits).select(F.explode(F.filter("keys", lambda k: flt.maybe_listed(k, F.col("b"), words))))
    assert 100 <= passed.count() < 400  # of 40,000 keys, 100 of them wanted
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "exists(" in text[text.index("Generate"):]  # tested below the explode
    assert got.count() == 100
