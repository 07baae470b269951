"""Topics in folders, declared schemas, start positions, incremental reads, Kafka options."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.sources import topics as src
from tidemark.streaming.sinks import append_into, to_records, with_event_time


@pytest.fixture
def stored(spark, tmp_path):
    records = [("k1", '{"slot":1,"skipped":true}', 10, 0, 0, "ledger.a"), ("k2", '{"slot":"x"}', 20, 0, 1, "ledger.a"),
               ("3", "oops", 30, 0, 0, "ledger.b"), ("4", None, 40, 0, 0, "other")]
    df = spark.createDataFrame(records, "key STRING, value STRING, s BIGINT, partition INT, offset BIGINT, topic STRING")
    df = df.withColumn("timestamp", F.timestamp_seconds("s")).drop("s")
    df.write.partitionBy("topic").parquet(str(tmp_path / "topics"))
    return str(tmp_path / "topics")


def test_topic_pattern_matches_whole_names_and_prunes(spark, stored):
    got = src.topic_pattern(spark, stored, r"ledger\..*")
    assert sorted(r.key for r in got.collect()) == ["3", "k1", "k2"]
    assert src.topic_pattern(spark, stored, "ledger").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan


def test_start_latest_keeps_later_records(spark, stored):
    now = F.timestamp_seconds(F.lit(20))
    got = src.read_folder(spark, stored, start="latest", now=now)
    assert sorted(r.key for r in got.collect()) == ["3", "4", "k2"]
    with pytest.raises(ValueError):
        src.read_folder(spark, stored, start="middle")


def test_json_topic_nulls_and_key(spark, stored, rows):
    schema, key = src.declared("blocks")
    got = src.json_topic(src.read_folder(spark, stored), schema, key)
    assert got.columns == ["slot", "skipped", "error", "timestamp", "partition", "offset", "topic"]
    assert rows(got.select("slot", "skipped", "error")) == [(None, None, None)] * 3 + [(1, True, None)]
    schema, key = src.declared("slots")
    assert key == "key"
    keyed = src.json_topic(src.read_folder(spark, stored), schema, key)
    assert rows(keyed.select("key", "slot")) == [(None, None), (None, 1), (3, None), (4, None)]


def test_declared_schemas_parse(spark):
    for name in src.SCHEMAS:
        schema, key = src.declared(name)
        assert key is None or key in schema.names


def test_nested_payload_reads_as_text(spark):
    raw = spark.createDataFrame([('{"type":"T","slot":1,"payload":{"a":{"b":1}}}',)], "value STRING")
    event = src.json_topic(raw, src.declared("solana_events")[0]).first()
    assert (event.type, event.slot, event.payload, event.blockhash) == ("T", 1, '{"a":{"b":1}}', None)


def test_decimal_amount_round_trip(spark):
    schema, key = src.declared("latest_bonding_token_account_balances")
    row = spark.createDataFrame([("acct", Decimal("1.5"))], "pubkey STRING, tokenAmount DECIMAL(27,9)")
    back = src.json_topic(to_records(row, "pubkey"), schema, key).first()
    assert (back.pubkey, back.tokenAmount) == ("acct", Decimal("1.500000000"))


def test_incremental(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 7)], "c INT")
    sink, empty = df.where("c <= 4"), df.where("c > 99")
    assert [r.c for r in src.incremental_since(df, sink, "c", start=1).orderBy("c").collect()] == [5, 6]
    assert [r.c for r in src.incremental_since(df, empty, "c", start=3).orderBy("c").collect()] == [4, 5, 6]
    assert src.incremental_since(df, empty, "c").count() == 0


def test_kafka_options():
    got = src.kafka_options("host:1", pattern="a.*", start="latest", per_trigger=1000)
    assert got == {"kafka.bootstrap.servers": "host:1", "startingOffsets": "latest", "subscribePattern": "a.*",
                   "maxOffsetsPerTrigger": "1000"}
    assert src.kafka_options("h", topic="t")["subscribe"] == "t"
    for bad in ({}, {"topic": "t", "pattern": "p"}, {"topic": "t", "start": "soon"}):
        with pytest.raises(ValueError):
            src.kafka_options("h", **bad)


def test_append_and_event_time(spark, rows):
    a = spark.createDataFrame([(1, "x")], "n INT, s STRING")
    b = spark.createDataFrame([("y", None)], "s STRING, n INT")
    stamped = with_event_time(append_into(a, b), "n", "at").select("s", F.unix_seconds("at"))
    assert rows(stamped) == [("x", 1), ("y", 0)]
