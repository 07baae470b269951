"""From ids to events to datasets, on small ledgers; quirks that consumers rely on."""

import json

from pyspark.sql import functions as F
from test_extract import CURVE, PAYER, SYSTEM, balance, ix, record, transactions

from tidemark.operators.filters import route_column
from tidemark.functions.json_text import json_field
from tidemark.plans import datasets as ds
from tidemark.plans import dictionaries as fixed
from tidemark.plans import ledger
from tidemark.sources.topics import topic_pattern
from tidemark.streaming import sinks


def test_ids_to_events(spark):
    good = record([ix([1, 0, 2], "2", 3)], post=[balance(1, "5")], slot=1)
    failed = record([ix([1, 0, 2], "2", 3)], err='{"x":1}', slot=2)
    big = record([ix([1, 0, 2], "2", 3)], slot=3, keys=[PAYER, CURVE, SYSTEM, fixed.TOKEN_PROGRAM, "x" * 600_000])
    store = spark.createDataFrame([("s1", json.dumps(good)), ("s2", json.dumps(failed)), ("s3", json.dumps(big)),
                                   ("unasked", json.dumps(good))], "key STRING, value STRING")
    ids = spark.createDataFrame(
        [("ids.a", "s1", 1), ("ids.b", "s1", 2), ("ids.b", "s2", 3), ("ids.a", "s3", 4), ("ids.a", "unknown", 5),
         ("other", "unasked", 6)], "topic STRING, key STRING, offset BIGINT")
    unique = ledger.unique_ids(ids, r"ids\..*")
    assert sorted(r.key for r in unique.collect()) == ["s1", "s2", "s3", "unknown"]
    txns = ledger.fetch_transactions(unique, store, "key")
    assert sorted(r.slot for r in txns.collect()) == [1, 2]
    events = ledger.event_stream(txns)
    assert sorted((r.type, r.slot) for r in events.collect()) == [("InitializeTokenAccount", 1), ("TokenAccountBalanceChange", 1)]


EVENT = "offset BIGINT, type STRING, slot BIGINT, blockTime BIGINT, blockhash STRING, recentBlockhash STRING, payload STRING"


def events(spark, *rows):
    return spark.createDataFrame([(i, t, i, at, None, "h", json.dumps(p)) for i, (t, at, p) in enumerate(rows)], EVENT)


def bonding(at, mint, bond, storage="store"):
    return ("initializeTokenBondingV0", at, {"programId": fixed.BONDING_PROGRAM, "accounts": {
        "targetMint": mint, "tokenBonding": bond, "baseStorage": storage}})


def change(at, account, mint, amount, decimals=1):
    return ("TokenAccountBalanceChange", at, {"pubkey": account, "mint": mint, "preAmount": "0", "postAmount": amount,
                                              "decimals": decimals})


def test_latest_balances_and_boards(spark, rows):
    log = events(
        spark,
        change(1, "early", "m", "10"),  # before the table row: no match
        bonding(1, "m", "B"),
        change(5, "ann", "m", "20"),
        change(4, "ann", "m", "99"),  # older than what was accepted: dropped
        change(6, "bob", "m", "70"),
        change(6, "cy", "m", "30"),
        change(7, "cy", "m", "0"),  # zero leaves the board
        change(None, "dee", "m", "40"),  # no time yet and nothing accepted: passes
        change(8, "store", "base", "500", 0),
        change(8, "ann", "unbonded", "1"),
    )
    for split in ({}, {"width": 2}):
        got = ds.latest_bonding_token_account_balances(log, **split)
        assert rows(got.select("pubkey", F.col("tokenAmount").cast("double"), "tokenBonding")) == [
            ("ann", 2.0, "B"), ("bob", 7.0, "B"), ("cy", 0.0, "B"), ("cy", 3.0, "B"), ("dee", 4.0, "B")]
    assert [(r.board, r.pubkey, r["rank"]) for r in ds.BOARDS["ACCOUNT"](log, 2).orderBy("rank").collect()] == [
        ("accounts-by-balance-B", "bob", 1), ("accounts-by-balance-B", "dee", 2)]
    top, = ds.BOARDS["TOP_TOKENS"](log, 10).collect()
    assert (top.board, top.tokenBonding, float(top.tokenAmount)) == ("bonding-by-tvl-base", "B", 500.0)
    marks = ds.high_watermark(ds.latest_bonding_token_account_balances(log))
    assert rows(marks) == [("ann", 5), ("bob", 6), ("cy", 7), ("dee", None)]
    late = ds.bonding_token_account_balance_changes(log, mode="latest")
    assert "early" in {r.pubkey for r in late.collect()}


def test_lazy_plan_gives_the_same_balances(spark, rows):
    log = events(spark, bonding(1, "m", "B"), change(5, "ann", "m", "20"), change(4, "ann", "m", "99"))
    lazy = ds.latest_bonding_token_account_balances(log, save=lambda df, name: df)
    assert rows(lazy) == rows(ds.latest_bonding_token_account_balances(log))


def metadata(at, meta, name, kind="CreateMetadata"):
    return (kind, at, {"programId": fixed.METADATA_PROGRAM, "accounts": {"tokenMetadata": meta}, "data": {"data": {"name": name}}})


def test_unclaimed_tokens_join_any_metadata_command_within_two_hours(spark, rows):
    def unclaimed(at, meta):
        return ("initializeUnclaimedSocialTokenV0", at, {"programId": fixed.COLLECTIVE_PROGRAM, "accounts": {
            "name": "n", "initializeArgs": {"tokenMetadata": meta, "collective": "c"}}})
    log = events(spark, unclaimed(10_000, "x"), metadata(2_800, "x", "edge"), metadata(2_799, "x", "too early"),
                 metadata(17_200, "x", "update", "UpdateMetadata"), metadata(10_000, "y", "other"),
                 ("initializeUnclaimedSocialTokenV0", 10_000, {"programId": "elsewhere"}))
    got = ds.collective_create_unclaimed_tokens(log).select("tokenMetadataName", "name", "collective")
    assert rows(got) == [("edge", "n", "c"), ("update", "n", "c")]


def test_users_keep_the_old_reference_and_latest_non_null_value(spark, rows):
    claim = ("claimSocialTokenV0", 1, {"programId": fixed.COLLECTIVE_PROGRAM, "accounts": {
        "owner": "o", "tokenRef": "old", "newTokenRef": "new", "collective": "c"}})
    owned = ("initializeOwnedSocialTokenV0", 2, {"programId": fixed.COLLECTIVE_PROGRAM, "accounts": {
        "owner": "o", "tokenRef": "mine", "initializeArgs": {}}})
    log = events(spark, claim, owned)
    assert rows(ds.collective_users(log).select("tokenRef", "collective")) == [("mine", None), ("old", "c")]
    assert rows(ds.collective_users_table(log).select("owner", "tokenRef", "blockTime", "collective")) == [("o", "mine", 2, "c")]
    assert ds.trophies(log).count() == 2  # one award per update


def test_awards_cutoff_and_exclusions(spark):
    def claim(at, owner):
        return ("claimSocialTokenV0", at, {"programId": fixed.COLLECTIVE_PROGRAM, "accounts": {"owner": owner}})
    cutoff = fixed.AWARD_CUTOFF_MILLIS // 1000
    log = events(spark, claim(cutoff - 1, "in"), claim(cutoff, "out"), claim(1, fixed.AWARD_EXCLUDED[3]), claim(None, "no time"))
    assert {r.key for r in ds.trophies(log).collect()} == {"in", "no time"}


def test_blocks(spark, rows):
    blocks = spark.createDataFrame(
        [(0, 7, True, "x Block not available for slot"), (1, 7, True, "was cleaned up, does not exist on node"),
         (2, 8, True, "other"), (3, 9, False, "Block not available"), (4, 10, None, "Block not available"), (5, 11, True, None),
         (6, 12, True, "Block not available")], "offset BIGINT, slot INT, skipped BOOLEAN, error STRING")
    assert rows(ds.retriable_blocks(blocks)) == [(7, 2, 7), (12, 1, 12)]
    assert rows(ds.raw_retriable_blocks(blocks)) == [(0, 7, 7, 1), (1, 7, 7, 2), (6, 12, 12, 1)]
    assert rows(ds.missed_slots(blocks)) == [(7, 7), (12, 12)]


def test_one_pass_writes_all_routes(spark, tmp_path, rows):
    log = events(spark, metadata(1, "x", "a"), bonding(1, "m", "B"), ("other", 1, {"programId": "p"}))
    log.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "in"))
    topic = route_column(json_field("payload", "programId"), ds.PROGRAMS)
    routed = stream.withColumn("topic", topic).where(F.col("topic").isNotNull())
    sinks.drain(sinks.write_stream(routed, str(tmp_path / "out"), str(tmp_path / "p"), partition_by=["topic"]))
    back = topic_pattern(spark, str(tmp_path / "out"), "spl_token_.*", schema=routed.schema)
    assert rows(back.select("topic", "type")) == [("spl_token_bonding_events", "initializeTokenBondingV0"),
                                                  ("spl_token_metadata_events", "CreateMetadata")]
