"""Exploding and extraction over transactions derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.catalog.rows import cents
from tidemark.functions.binary import base58_bytes, base58_text, hex_to_base58
from tidemark.functions.json_text import json_fields
from tidemark.functions.scalars import epoch_seconds
from tidemark.operators import extract as ex
from tidemark.plans import dictionaries as fixed
from tidemark.plans import ledger


def little_endian(value: Column, size: int) -> Column:
    """Hex of a non-negative BIGINT in little-endian bytes."""
    used = min(size, 8)
    parts = [F.lpad(F.hex(F.shiftright(value, 8 * i).bitwiseAND(F.lit(255))), 2, "0") for i in range(used)]
    return F.concat(*parts, F.lit("00" * (size - used)))


def account(prefix: str, number: Column) -> Column:
    """A 32-byte key as hex: a prefix byte, then zeros, then the number."""
    return F.concat(F.lit(prefix), F.lpad(F.hex(number), 62, "0"))


def transactions(t) -> DataFrame:
    """One transaction per order: a name registration, a token account set-up and one balance entry pair.

    Status P orders fail; the customer's account has no balance before in O orders and none after in F orders.
    """
    orders = t.orders
    number, amount = F.col("o_orderkey"), cents("o_totalprice")
    keys = F.array(account("11", F.col("o_custkey")), account("22", number), account("33", F.col("o_custkey")))
    programs = F.array(F.lit(fixed.NAME_PROGRAM), F.lit(fixed.TOKEN_PROGRAM))
    register = base58_text(F.unhex(F.concat(
        F.lit("00"), account("44", number), little_endian(amount, 8), little_endian(number, 4))))

    def instruction(accounts: list[int], data: Column, program: int) -> Column:
        return F.struct(F.array(*[F.lit(a) for a in accounts]).alias("accounts"), data.alias("data"),
                        F.lit(program).alias("programIdIndex"))

    outer = F.array(instruction([2, 0, 1, 0, 2], F.col("register"), 3), instruction([0, 1], F.lit("zzz"), 1))
    inner = F.array(F.struct(F.lit(0).alias("index"), F.array(
        instruction([1, 2, 0, 0], F.lit("2"), 4)).alias("instructions")))

    def balance(present: Column, value: Column) -> Column:
        entry = F.struct(
            F.lit(1).alias("accountIndex"), F.col("o_orderpriority").alias("mint"),
            F.struct(value.alias("amount"), F.lit(2).alias("decimals")).alias("uiTokenAmount"))
        return F.when(present, F.array(entry)).otherwise(F.array().cast(
            "array<struct<accountIndex:int,mint:string,uiTokenAmount:struct<amount:string,decimals:int>>>"))

    status = F.col("o_orderstatus")
    after = F.when(F.col("o_custkey") > F.col("o_orderkey"), F.lit("7")).otherwise(amount.cast("string"))
    shaped = orders.select(
        "*", register.alias("register"), F.concat(hex_to_base58(keys), programs).alias("keys"),
        epoch_seconds(orders, "o_orderdate").alias("seconds"))
    return shaped.select(
        F.col("o_orderkey").alias("slot"), F.col("seconds").alias("blockTime"),
        F.struct(
            F.when(status == "P", F.lit('{"Custom":1}')).alias("err"), inner.alias("innerInstructions"),
            balance(status != "O", F.lit("7")).alias("preTokenBalances"),
            balance(status != "F", after).alias("postTokenBalances")).alias("meta"),
        F.struct(F.struct(F.col("keys").alias("accountKeys"), F.col("o_orderpriority").alias("recentBlockhash"),
                          outer.alias("instructions")).alias("message")).alias("transaction"))


@query("ex_two_level", """
    WITH lines AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
    outers AS (SELECT doc_id, unnest(l) AS item, generate_subscripts(l, 1) - 1 AS i FROM lines),
    inners AS (SELECT doc_id, i AS g, string_split(item, '. ') AS s FROM outers)
    SELECT doc_id, CAST(i AS INTEGER) AS "instructionIndex", CAST(NULL AS INTEGER) AS "innerIndex", item FROM outers
    UNION ALL
    SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER), CAST(g AS INTEGER), unnest(s) FROM inners""")
def _(t):
    lines = F.split("text", "\n")
    groups = F.transform(lines, lambda line, i: F.struct(
        i.alias("index"), F.split(line, r"\. ").alias("instructions")))
    return ex.explode_two_levels(t.documents, lines, groups, ["doc_id"])


@query("ex_named_list", """
    SELECT page_id, p[1] AS scheme, p[3] AS host, p[4] AS section FROM (SELECT page_id, string_split(url, '/') AS p
    FROM pages)""")
def _(t):
    names = F.array(*[F.lit(n) for n in ("scheme", "blank", "host", "section")])
    named = ex.named_list(names, F.split("url", "/"))
    return t.pages.select("page_id", named.alias("m")).select(
        "page_id", *[F.try_element_at("m", F.lit(n)).alias(n) for n in ("scheme", "host", "section")])


@query("ex_build_events", """
    SELECT '' || event_id AS "key", '{"type":"' || event_type || '","slot":' || event_id || ',"recentBlockhash":null,' ||
           '"blockTime":' || user_id || ',"payload":' || props || '}' AS "value", user_id AS seconds FROM events""")
def _(t):
    events = t.events.select(
        F.col("event_type").alias("type"), F.col("event_id").alias("slot"),
        F.lit(None).cast("string").alias("recentBlockhash"), F.col("user_id").alias("blockTime"),
        F.col("props").alias("payload"))
    return ex.event_records(events).select("key", "value", F.unix_seconds("timestamp").alias("seconds"))


@query("ex_instructions", """
    SELECT o_orderkey AS slot, i AS "instructionIndex", g AS "innerIndex", program AS "programId"
    FROM orders, (VALUES (0, NULL, 'namesLPneVptA9Z5rqUDD9tMTWEJwofgaYwp8cawRkX'),
                         (1, NULL, NULL), (0, 0, 'TokenkegQfeZyiNwAJbNbGKPFXCWuBvf9Ss623VQ5DA')) v(i, g, program)""")
def _(t):
    rows = ex.explode_instructions(transactions(t), ["slot"])
    known = F.when(F.col("programId").isin(fixed.NAME_PROGRAM, fixed.TOKEN_PROGRAM), F.col("programId"))
    return rows.select("slot", "instructionIndex", "innerIndex", known.alias("programId"))


@query("ex_decode_args", """
    SELECT o_orderkey AS slot, 0 AS instruction, '' || CAST(round(o_totalprice * 100) AS BIGINT) AS lamports,
           '' || o_orderkey AS space, CAST(44 AS INTEGER) AS size, '44' || lpad(format('{:x}', o_orderkey), 62, '0') AS hashed
    FROM orders""")
def _(t):
    rows = ex.decode_args(ex.explode_instructions(transactions(t), ["slot"]), fixed.opcode_commands())
    names = rows.where(F.col("type") == "CreateNameServiceName")
    fields = json_fields(names, "data", {"instruction": "instruction", "lamports": "lamports", "space": "space",
                                         "hashed": "hashedName"})
    size = F.when(F.length("hashed").between(43, 44), F.lit(44))
    # The key is turned back into bytes, so every byte of it is compared.
    return fields.select("slot", F.col("instruction").cast("int").alias("instruction"), "lamports", "space",
                         size.alias("size"), F.lower(F.hex(base58_bytes(F.col("hashed")))).alias("hashed"))


@query("ex_instruction_events", """
    SELECT type, o_orderkey AS slot, epoch(o_orderdate)::BIGINT AS "blockTime", o_orderpriority AS "recentBlockhash",
           program AS "programId", lamports, i AS "instructionIndex", g AS "innerIndex", same, surplus
    FROM (SELECT *, 'CreateNameServiceName' AS type, 'namesLPneVptA9Z5rqUDD9tMTWEJwofgaYwp8cawRkX' AS program,
                 '' || CAST(round(o_totalprice * 100) AS BIGINT) AS lamports, '0' AS i, NULL AS g, true AS same,
                 false AS surplus FROM orders
          UNION ALL SELECT *, 'InitializeTokenAccount', 'TokenkegQfeZyiNwAJbNbGKPFXCWuBvf9Ss623VQ5DA', NULL, '0', '0',
                 NULL, false FROM orders)
    WHERE o_orderstatus <> 'P'""")
def _(t):
    events = ex.build_events(transactions(t), [lambda txns: ex.instruction_events(txns, fixed.opcode_commands())])
    fields = json_fields(events, "payload", {
        "programId": "programId", "lamports": "data.lamports", "instructionIndex": "instructionIndex",
        "innerIndex": "innerIndex", "payer": "accounts.payer", "owner": "accounts.owner", "parent": "accounts.parent"})
    # payer and owner are both key 0; token accounts have an owner but no payer; nobody gets a sixth account.
    return fields.select("type", "slot", "blockTime", "recentBlockhash", "programId", "lamports", "instructionIndex",
                         "innerIndex", (F.col("payer") == F.col("owner")).alias("same"),
                         F.col("parent").isNotNull().alias("surplus"))


BALANCES = """
    SELECT *, CASE WHEN o_orderstatus <> 'O' THEN '7' END AS pre,
           CASE WHEN o_orderstatus <> 'F' THEN CASE WHEN o_custkey > o_orderkey THEN '7'
                ELSE '' || CAST(round(o_totalprice * 100) AS BIGINT) END END AS post FROM orders"""


@query("ex_balance_changes", f"""
    SELECT o_orderkey AS slot, coalesce(pre, '0') AS "preAmount", post AS "postAmount", o_orderpriority AS mint,
           '2' AS decimals FROM ({BALANCES}) WHERE pre IS DISTINCT FROM post""")
def _(t):
    changes = ex.balance_changes(transactions(t))
    fields = json_fields(changes, "payload", {n: n for n in ("preAmount", "postAmount", "mint", "decimals")})
    return fields.select("slot", "preAmount", "postAmount", "mint", "decimals")


@query("ex_events_by_type", f"""
    SELECT type, count(*) AS n FROM (
        SELECT unnest(['CreateNameServiceName', 'InitializeTokenAccount']) AS type FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT 'TokenAccountBalanceChange' FROM ({BALANCES})
        WHERE pre IS DISTINCT FROM post AND o_orderstatus <> 'P') GROUP BY type""")
def _(t):
    events = ledger.event_stream(transactions(t))
    return events.groupBy("type").agg(F.count("payload").alias("n"))


@query("ex_fetched_events", f"""
    SELECT type, count(*) AS n FROM (
        SELECT unnest(['CreateNameServiceName', 'InitializeTokenAccount']) AS type, o_orderkey FROM orders
        WHERE o_orderstatus <> 'P'
        UNION ALL SELECT 'TokenAccountBalanceChange', o_orderkey FROM ({BALANCES})
        WHERE pre IS DISTINCT FROM post AND o_orderstatus <> 'P')
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'R')) GROUP BY type""")
def _(t):
    ids = t.lineitem.select(
        F.concat(F.lit("ids."), F.lower("l_returnflag")).alias("topic"), F.col("l_orderkey").alias("id"),
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").alias("offset"))
    stored = transactions(t)
    store = stored.select(F.col("slot").alias("id"), F.to_json(F.struct(*stored.columns)).alias("value"))
    unique = ledger.unique_ids(ids, r"ids\.[ar]", "id")
    events = ledger.event_stream(ledger.fetch_transactions(unique, store, "id"))
    return events.groupBy("type").agg(F.count("payload").alias("n"))
