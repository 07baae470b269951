"""Declared streams loaded from JSON records, start positions, nested accounts, observed counts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.events import account, little_endian
from tidemark.catalog.registry import query
from tidemark.catalog.rows import cents
from tidemark.functions.binary import base58_bytes, base58_text, hex_to_base58
from tidemark.functions.json_text import json_fields
from tidemark.operators import extract as ex
from tidemark.operators.aggregates import observed
from tidemark.plans import dictionaries as fixed
from tidemark.session import shared_folder
from tidemark.sources.topics import declared, json_topic, topic_pattern


def loaded(rows: DataFrame, stream: str, record_key: Column, broken: Column, **fields: Column) -> DataFrame:
    """A declared stream read from records with these fields; NULL fields are absent, ``broken`` records are no JSON."""
    value = F.when(broken, F.lit("{no json")).otherwise(F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])))
    return json_topic(rows.select(record_key.cast("string").alias("key"), value.alias("value")), *declared(stream))


@query("src_declared_blocks", """
    SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END::INTEGER AS slot,
           CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus = 'F' END AS skipped,
           CASE WHEN o_orderkey % 7 <> 0 AND o_orderstatus = 'F' THEN o_orderpriority END AS error FROM orders""")
def _(t):
    return loaded(
        t.orders, "blocks", F.col("o_orderkey"), F.col("o_orderkey") % 7 == 0, slot=F.col("o_orderkey"),
        skipped=F.col("o_orderstatus") == "F", error=F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")))


SLOTS = """SELECT CAST({key} AS INTEGER) AS "key", CASE WHEN {key} % 5 <> 0 THEN {slot} END::INTEGER AS slot{more} FROM {table}"""


# The key column comes from the record's key, whatever the value says.
@query("src_declared_slots", SLOTS.format(key="event_id", slot="user_id", more="", table="events"))
def _(t):
    return loaded(t.events, "slots", F.col("event_id"), F.col("event_id") % 5 == 0, slot=F.col("user_id"), key=F.lit(-1))


@query("src_declared_missed_slots", SLOTS.format(key="p_partkey", slot="p_size", more="", table="part"))
def _(t):
    return loaded(t.part, "missed_slots", F.col("p_partkey"), F.col("p_partkey") % 5 == 0, slot=F.col("p_size"))


@query("src_declared_raw_retriable_blocks", SLOTS.format(
    key="l_orderkey", slot="l_partkey", table="lineitem",
    more=""", CASE WHEN l_orderkey % 5 <> 0 THEN l_linenumber END::INTEGER AS "count" """))
def _(t):
    return loaded(t.lineitem, "raw_retriable_blocks", F.col("l_orderkey"), F.col("l_orderkey") % 5 == 0,
                  slot=F.col("l_partkey"), count=F.col("l_linenumber"))


@query("src_declared_solana_events", """
    SELECT event_type AS type, event_id AS slot, CASE WHEN user_id % 3 <> 0 THEN user_id END AS "blockTime",
           NULL::VARCHAR AS blockhash, 'h' || user_id AS "recentBlockhash",
           json_extract_string(props, '$.k') AS k FROM events""")
def _(t):
    props = F.from_json("props", "k INT")
    rows = loaded(
        t.events, "solana_events", F.col("event_id"), F.lit(False), type=F.col("event_type"), slot=F.col("event_id"),
        blockTime=F.when(F.col("user_id") % 3 != 0, F.col("user_id")), recentBlockhash=F.concat(F.lit("h"), "user_id"), payload=props)
    return json_fields(rows, "payload", {"k": "k"}).drop("payload")  # a nested object stays JSON text


@query("src_declared_collective_users", """
    SELECT c_name AS owner, 'ref' || c_custkey AS "tokenRef", CASE WHEN c_custkey % 2 = 0 THEN 'back' || c_custkey END
           AS "reverseTokenRef", NULL::VARCHAR AS "tokenBonding", c_nationkey::BIGINT AS "blockTime", c_mktsegment AS collective
    FROM customer""")
def _(t):
    number = F.col("c_custkey")
    return loaded(
        t.customer, "collective_users", number, F.lit(False), owner=F.col("c_name"), tokenRef=F.concat(F.lit("ref"), number),
        reverseTokenRef=F.when(number % 2 == 0, F.concat(F.lit("back"), number)), blockTime=F.col("c_nationkey"),
        collective=F.col("c_mktsegment"))


BALANCE_SQL = """
    SELECT 'k' || {number} AS pubkey, 'T' AS type, {number} AS slot, NULL::VARCHAR AS blockhash, {nation}::BIGINT AS "blockTime",
           {name} AS "recentBlockhash", {nation}::INTEGER AS "instructionIndex", NULL::INTEGER AS "innerIndex", {name} AS mint,
           round(100 * {balance})::BIGINT AS units, 'bond' AS "tokenBonding", 2 AS decimals FROM {table}"""


def balances(rows: DataFrame, stream: str, prefix: str) -> DataFrame:
    """Latest balances as records; the amount is compared in whole hundredths."""
    def column(name: str) -> Column:
        return F.col(f"{prefix}_{name}")

    number = {"c": "custkey", "s": "suppkey"}[prefix]
    read = loaded(
        rows, stream, F.concat(F.lit("k"), column(number)), F.lit(False), type=F.lit("T"), slot=column(number),
        blockTime=column("nationkey"), recentBlockhash=column("name"), instructionIndex=column("nationkey"), mint=column("name"),
        tokenAmount=column("acctbal").cast("decimal(27,9)"), tokenBonding=F.lit("bond"), decimals=F.lit(2))
    return read.withColumn("units", F.round(F.col("tokenAmount") * 100).cast("bigint")).drop("tokenAmount")


@query("src_declared_latest_bonding_balances", BALANCE_SQL.format(
    number="c_custkey", nation="c_nationkey", name="c_name", balance="c_acctbal", table="customer"))
def _(t):
    return balances(t.customer, "latest_bonding_token_account_balances", "c")


@query("src_declared_latest_reserve_balances", BALANCE_SQL.format(
    number="s_suppkey", nation="s_nationkey", name="s_name", balance="s_acctbal", table="supplier"))
def _(t):
    return balances(t.supplier, "latest_reserve_token_account_balances", "s")


@query("src_declared_trophies", """
    SELECT '' || c_custkey AS "key", 'alpha' AS "trophyShortName", c_mktsegment AS "trophyMasterEditionMeta",
           c_name AS destination FROM customer""")
def _(t):
    return loaded(t.customer, "trophies", F.col("c_custkey"), F.lit(False), trophyShortName=F.lit("alpha"),
                  trophyMasterEditionMeta=F.col("c_mktsegment"), destination=F.col("c_name"), other=F.lit(1))


@query("src_declared_raw_users", "SELECT c_name AS owner FROM customer")
def _(t):
    return loaded(t.customer, "raw_users", F.col("c_name"), F.col("c_custkey") % 2 == 0, owner=F.lit("not this"))


@query("src_start_latest", """
    SELECT '' || o_orderkey AS "key", 'orders.' || o_orderstatus AS topic FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_orderdate >= TIMESTAMP '1996-01-01'""")
def _(t):
    path = f"{shared_folder(t.orders.sparkSession)}/records-{uuid.uuid4().hex}"
    records = t.orders.select(
        F.col("o_orderkey").cast("string").alias("key"), F.lit("{}").alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"), F.lit(0).alias("partition"),
        F.col("o_orderkey").alias("offset"), F.concat(F.lit("orders."), "o_orderstatus").alias("topic"))
    records.write.partitionBy("topic").parquet(path)
    now = F.lit("1996-01-01 00:00:00").cast("timestamp")
    return topic_pattern(t.orders.sparkSession, path, r"orders\.[FO]", start="latest", now=now).select("key", "topic")


LOAN_PROGRAM = "LoanProgram11111111111111111111111111111111"
LOAN_INTERFACE = {
    "metadata": {"address": LOAN_PROGRAM},
    "instructions": [{
        "name": "openLoanV0",
        "args": [{"name": "amount", "type": "u64"}, {"name": "note", "type": "string"}, {"name": "late_fee", "type": {"option": "u32"}}],
        "accounts": [{"name": "payer"}, {"name": "parties", "accounts": [
            {"name": "borrower"}, {"name": "deep", "accounts": [{"name": "owner"}]}]}]}],
}


# Nested accounts are named by their paths; the instructions of O orders list no third account, so it is NULL there.
@query("ex_nested_accounts", """
    SELECT o_orderkey AS slot, '' || CAST(round(o_totalprice * 100) AS BIGINT) AS amount, o_orderpriority AS note,
           CASE WHEN o_orderstatus = 'F' THEN '' || o_custkey END AS fee,
           '22' || lpad(format('{:x}', o_orderkey), 62, '0') AS payer, '11' || lpad(format('{:x}', o_custkey), 62, '0') AS borrower,
           CASE WHEN o_orderstatus <> 'O' THEN '33' || lpad(format('{:x}', o_custkey), 62, '0') END AS owner FROM orders""")
def _(t):
    number, customer, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    commands = fixed.idl_commands(LOAN_INTERFACE)
    fee = F.when(status == "F", F.concat(F.lit("01"), little_endian(customer, 4))).otherwise(F.lit("00"))
    data = base58_text(F.unhex(F.concat(
        F.lit(commands[0]["key"]), little_endian(cents("o_totalprice"), 8),
        little_endian(F.octet_length("o_orderpriority").cast("bigint"), 4), F.hex("o_orderpriority"), fee)))
    keys = hex_to_base58(F.array(account("11", customer), account("22", number), account("33", customer)))
    shaped = t.orders.select(number.alias("slot"), status, data.alias("data"), F.concat(keys, F.array(F.lit(LOAN_PROGRAM))).alias("keys"))
    listed = F.when(status == "O", F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(1), F.lit(0), F.lit(2)))
    instruction = F.struct(listed.alias("accounts"), F.col("data"), F.lit(3).alias("programIdIndex"))
    inner = F.array().cast("array<struct<index:int,instructions:array<struct<accounts:array<int>,data:string,programIdIndex:int>>>>")
    txns = shaped.select(
        "slot", F.lit(0).cast("bigint").alias("blockTime"), F.struct(F.lit(None).cast("string").alias("err"), inner.alias("innerInstructions")).alias("meta"),
        F.struct(F.struct(F.col("keys").alias("accountKeys"), F.lit("h").alias("recentBlockhash"),
                          F.array(instruction).alias("instructions")).alias("message")).alias("transaction"))
    fields = json_fields(ex.instruction_events(txns, commands), "payload", {
        "amount": "data.amount", "note": "data.note", "fee": "data.lateFee", "payer": "accounts.payer",
        "borrower": "accounts.parties.borrower", "owner": "accounts.parties.deep.owner"})
    names = ["payer", "borrower", "owner"]
    return fields.select("slot", "amount", "note", "fee", *[F.lower(F.hex(base58_bytes(F.col(n)))).alias(n) for n in names])


@query("ag_observed", """
    SELECT event_type, count(*) AS n, (SELECT count(*) FROM events WHERE event_type <> 'view') AS observed
    FROM events WHERE event_type <> 'view' GROUP BY event_type""")
def _(t):
    rows, counter = observed(t.events.where(F.col("event_type") != "view"), f"rows-{uuid.uuid4().hex}")
    rows.write.format("noop").mode("overwrite").save()  # the action that counts on the side
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("observed", F.lit(counter.get["rows"]).cast("bigint"))
