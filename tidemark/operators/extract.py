"""From nested transactions to typed JSON events.

Everything stays inside the row until the final explode, so a transaction never crosses a shuffle; the only
Python is the base58 codec, and it sees only instructions of known programs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.binary import with_decoded
from tidemark.functions.scalars import seconds_to_time
from tidemark.operators.filters import has_body, relevant, succeeded
from tidemark.plans.dictionaries import TOKEN_PROGRAM

_INSTRUCTION = "STRUCT<accounts: ARRAY<INT>, data: STRING, programIdIndex: INT>"
_BALANCE = "STRUCT<accountIndex: INT, mint: STRING, uiTokenAmount: STRUCT<amount: STRING, decimals: INT>>"
TRANSACTION = (
    "slot BIGINT, blockTime BIGINT, "
    f"meta STRUCT<err: STRING, innerInstructions: ARRAY<STRUCT<index: INT, instructions: ARRAY<{_INSTRUCTION}>>>, "
    f"preTokenBalances: ARRAY<{_BALANCE}>, postTokenBalances: ARRAY<{_BALANCE}>>, "
    "transaction STRUCT<message: STRUCT<accountKeys: ARRAY<STRING>, recentBlockhash: STRING, "
    f"instructions: ARRAY<{_INSTRUCTION}>>, signatures: ARRAY<STRING>>"
)
KEYS = "transaction.message.accountKeys"

Extractor = Callable[[DataFrame], DataFrame]


def two_level_rows(outer: Column, groups: Column) -> Column:
    """The rows of :func:`explode_two_levels` as an array."""
    def place(index: Column, inner: Column, item: Column) -> Column:
        return F.struct(index.cast("int").alias("instructionIndex"), inner.cast("int").alias("innerIndex"),
                        item.alias("item"))

    nothing = F.lit(None).cast("int")
    inside = F.flatten(F.transform(
        groups, lambda g: F.transform(g["instructions"], lambda item, i: place(i, g["index"], item))
    ))
    outside = F.transform(outer, lambda item, i: place(i, nothing, item))
    return F.when(inside.isNull(), outside).otherwise(F.concat(inside, outside))


def explode_two_levels(df: DataFrame, outer: Column, groups: Column, keep: Iterable[str | Column]) -> DataFrame:
    """One row per inner and outer item of a record: (instructionIndex, innerIndex, item).

    Inner items come first and carry their place inside the group as ``instructionIndex`` and the outer place
    as ``innerIndex`` (the names are swapped on purpose: consumers expect it); outer items have no ``innerIndex``.
    """
    rows = two_level_rows(outer, groups)
    # Shaped before the explode, so each exploded row carries the kept columns and not the whole record.  The outer
    # form keeps the optimizer from testing the array's size in a filter, which would build the array twice.
    shaped = df.select(*keep, rows.alias("__rows"))
    exploded = shaped.select(*shaped.columns[:-1], F.inline_outer("__rows"))
    return exploded.where(F.col("instructionIndex").isNotNull())


def explode_instructions(txns: DataFrame, keep: Iterable[str | Column] = ()) -> DataFrame:
    """One row per inner and outer instruction with its program id and the transaction's keys."""
    kept = [*keep, F.col(KEYS).alias("keys")]
    rows = explode_two_levels(
        txns, F.col("transaction.message.instructions"), F.col("meta.innerInstructions"), kept
    )
    return rows.withColumn("programId", F.get("keys", F.col("item.programIdIndex")))


def named_list(names: Column, values: Column) -> Column:
    """Names to values by position as a map; surplus values and names without a value are left out."""
    size = F.least(F.size(names), F.size(values))
    return F.map_from_arrays(F.slice(names, F.lit(1), size), F.slice(values, F.lit(1), size))


def json_pieces(paths: list[str]) -> tuple[list[str], str]:
    """The constant texts before each value, and after the last, of a JSON object with these dotted paths."""
    pieces, opened, first = [], [], True
    for path in paths:
        *groups, leaf = path.split(".")
        shared = 0
        while shared < min(len(groups), len(opened)) and groups[shared] == opened[shared]:
            shared += 1
        text = "{" if first else "}" * (len(opened) - shared) + ","
        text += "".join(f'"{g}":' + "{" for g in groups[shared:])
        pieces.append(f'{text}"{leaf}":')
        opened, first = groups, False
    return pieces, ("{}" if first else "}" * (len(opened) + 1))


def command_table(spark: SparkSession, commands: list[dict]) -> DataFrame:
    rows = []
    for c in commands:
        pieces, tail = json_pieces(c["accounts"])
        rows.append((c["programId"], c["type"], pieces, tail, c["strict"]))
    return spark.createDataFrame(
        rows, "programId STRING, type STRING, pieces ARRAY<STRING>, tail STRING, strict BOOLEAN"
    )


def decode_args(instructions: DataFrame, commands: list[dict]) -> DataFrame:
    """Add ``type`` and ``data`` (arguments as JSON text) for known commands; other rows are dropped."""
    known = sorted({c["programId"] for c in commands})
    rows = with_decoded(instructions.where(F.col("programId").isin(known)), "programId", "item.data", commands)
    named = rows.where(F.col("__decoded.type").isNotNull())
    return named.select(*instructions.columns, "__decoded.type", "__decoded.data")


def _named_payload(data: Column) -> tuple[Column, Column]:
    """Payload of an instruction beside its command's row, and whether an account points outside the key list."""
    indexes = F.slice("item.accounts", F.lit(1), F.size("pieces"))
    outside = F.exists(indexes, lambda i: (i >= F.size("keys")) | (i < 0))
    pubkeys = F.transform(indexes, lambda i: F.concat(F.lit('"'), F.get("keys", i), F.lit('"')))
    fields = F.zip_with("pieces", pubkeys, lambda piece, key: F.concat(piece, F.coalesce(key, F.lit("null"))))
    accounts = F.concat(F.array_join(fields, ""), F.col("tail"))
    payload = F.concat(
        F.lit("{"), F.coalesce(F.concat(F.lit('"data":'), data, F.lit(",")), F.lit("")),
        F.lit('"accounts":'), accounts, F.lit(',"programId":"'), F.col("programId"),
        F.lit('","instructionIndex":'), F.col("instructionIndex").cast("string"),
        F.lit(',"innerIndex":'), F.coalesce(F.col("innerIndex").cast("string"), F.lit("null")), F.lit("}"),
    )
    return payload, outside


def instruction_events(txns: DataFrame, commands: list[dict]) -> DataFrame:
    """Typed events of all known commands: accounts named by position, arguments decoded.

    A command whose named accounts point outside the key list yields no event when it is ``strict``; otherwise
    those accounts are null, as are named accounts the instruction does not list.
    """
    wanted = relevant(txns, KEYS, sorted({c["programId"] for c in commands}))
    kept = ["slot", "blockTime", F.col("transaction.message.recentBlockhash").alias("recentBlockhash")]
    decoded = decode_args(explode_instructions(wanted, kept), commands)
    # The command table is built from literals, so its size does not depend on the data.
    rows = decoded.join(F.broadcast(command_table(txns.sparkSession, commands)), ["programId", "type"])
    payload, outside = _named_payload(F.col("data"))
    return rows.where(~(F.col("strict") & outside)).select(
        "type", "slot", "blockTime", "recentBlockhash", payload.alias("payload")
    )


def _listed_balances(name: str) -> Column:
    entries = F.transform(F.col(f"meta.{name}"), lambda b: F.struct(
        F.get(F.col(KEYS), b["accountIndex"]).alias("pubkey"), b["mint"].alias("mint"),
        b["uiTokenAmount"]["amount"].alias("amount"), b["uiTokenAmount"]["decimals"].alias("decimals"),
    ))
    return F.coalesce(entries, F.array().cast(
        "array<struct<pubkey:string,mint:string,amount:string,decimals:int>>"))


def _last_of(side: Column, pubkey: Column) -> Column:
    return F.try_element_at(F.filter(side, lambda e: e["pubkey"] == pubkey), F.lit(-1))


def _balance_payload(pubkey: Column, pre: Column, post: Column) -> Column:
    return F.to_json(F.struct(
        pubkey.alias("pubkey"), F.coalesce(pre["amount"], F.lit("0")).alias("preAmount"),
        F.coalesce(pre["mint"], post["mint"]).alias("mint"), post["amount"].alias("postAmount"),
        F.coalesce(pre["decimals"], post["decimals"]).alias("decimals"),
    ), {"ignoreNullFields": "false"})


def balance_changes(txns: DataFrame) -> DataFrame:
    """One ``TokenAccountBalanceChange`` event per account whose token balance a transaction changed.

    Balances before and after are matched by account inside the row; the last entry per account wins.  An
    account without a balance before starts at 0 and always counts as changed, a closed one ends at null.
    """
    accounts = F.array_distinct(F.concat(
        F.transform("__pre", lambda e: e["pubkey"]), F.transform("__post", lambda e: e["pubkey"])
    ))
    pairs = F.transform(accounts, lambda k: F.struct(
        k.alias("pubkey"), _last_of(F.col("__pre"), k).alias("pre"), _last_of(F.col("__post"), k).alias("post")
    ))
    rows = (
        relevant(txns, KEYS, [TOKEN_PROGRAM])
        .withColumns({"__pre": _listed_balances("preTokenBalances"), "__post": _listed_balances("postTokenBalances")})
        .select("slot", "blockTime", F.col("transaction.message.recentBlockhash").alias("recentBlockhash"),
                pairs.alias("__pairs"))
        .select("slot", "blockTime", "recentBlockhash", F.inline_outer("__pairs"))
        .where(F.col("pubkey").isNotNull() & ~F.col("pre.amount").eqNullSafe(F.col("post.amount")))
    )
    payload = _balance_payload(F.col("pubkey"), F.col("pre"), F.col("post"))
    return rows.select(
        F.lit("TokenAccountBalanceChange").alias("type"), "slot", "blockTime", "recentBlockhash",
        payload.alias("payload"),
    )


#: What an extractor finds in a transaction: finished events (``type``, ``payload``), or instructions still to be decoded.
FOUND = (
    "array<struct<type:string,payload:string,programId:string,instructionIndex:int,innerIndex:int,"
    "item:struct<accounts:array<int>,data:string,programIdIndex:int>>>"
)


def nothing_found() -> Column:
    return F.array().cast(FOUND)


def _with_key(wanted: Iterable[str], found: Column) -> Column:
    """``found`` in transactions that list a wanted key."""
    listed = F.arrays_overlap(F.col(KEYS), F.array(*[F.lit(w) for w in wanted]))
    return F.when(listed, F.coalesce(found.cast(FOUND), nothing_found())).otherwise(nothing_found())


def finished(kind: Column, payload: Column) -> Column:
    """A finished event as an element of :data:`FOUND`."""
    empty = F.lit(None)
    return F.struct(kind.alias("type"), payload.alias("payload"), empty.cast("string").alias("programId"),
                    empty.cast("int").alias("instructionIndex"), empty.cast("int").alias("innerIndex"),
                    empty.cast("struct<accounts:array<int>,data:string,programIdIndex:int>").alias("item"))


def balance_array() -> Column:
    """The events of :func:`balance_changes` of one transaction as an array."""
    pre, post = _listed_balances("preTokenBalances"), _listed_balances("postTokenBalances")

    def changes(sides: Column) -> Column:
        accounts = F.array_distinct(F.transform(F.concat(sides["pre"], sides["post"]), lambda e: e["pubkey"]))
        pairs = F.transform(F.filter(accounts, lambda k: k.isNotNull()), lambda k: F.struct(
            k.alias("pubkey"), _last_of(sides["pre"], k).alias("pre"), _last_of(sides["post"], k).alias("post")))
        changed = F.filter(pairs, lambda p: ~p["pre"]["amount"].eqNullSafe(p["post"]["amount"]))
        return F.transform(changed, lambda p: finished(
            F.lit("TokenAccountBalanceChange"), _balance_payload(p["pubkey"], p["pre"], p["post"])))

    # The outer array of one binds both lists, so that they are built once and not once per account.
    bound = F.array(F.struct(pre.alias("pre"), post.alias("post")))
    return _with_key([TOKEN_PROGRAM], F.get(F.transform(bound, changes), 0))


def instruction_array(programs: Iterable[str]) -> Column:
    """The instructions of these programs in one transaction, inner and outer, as an array."""
    programs = sorted(programs)
    rows = two_level_rows(F.col("transaction.message.instructions"), F.col("meta.innerInstructions"))

    def found(row: Column) -> Column:
        return F.struct(F.lit(None).cast("string").alias("type"), F.lit(None).cast("string").alias("payload"),
                        F.get(F.col(KEYS), row["item"]["programIdIndex"]).alias("programId"),
                        row["instructionIndex"], row["innerIndex"], row["item"])

    return _with_key(programs, F.filter(F.transform(rows, found), lambda r: r["programId"].isin(programs)))


def extract_once(txns: DataFrame, arrays: Iterable[Column], commands: list[dict]) -> DataFrame:
    """Events of many extractors in one pass over complete, successful transactions: columns of the event stream.

    Every extractor is an array of :data:`FOUND` computed inside the row; all arrays are concatenated and exploded once, so the
    transactions are read once however many extractors there are, and of the instructions only those of known programs leave
    the row.  The decoder sees the elements that are instructions of ``commands``; finished events pass it by.
    """
    good = succeeded(has_body(txns, "transaction"))
    head = ["slot", "blockTime", F.col("transaction.message.recentBlockhash").alias("recentBlockhash"), F.col(KEYS).alias("keys")]
    shaped = good.select(*head, F.concat(nothing_found(), *arrays).alias("__found"))
    rows = shaped.select(*shaped.columns[:-1], F.inline_outer("__found")).where("type IS NOT NULL OR programId IS NOT NULL")
    rows = with_decoded(rows, "programId", "item.data", commands)
    table = command_table(txns.sparkSession, commands).withColumnsRenamed({"programId": "__program", "type": "__command"})
    # The command table is built from literals, so its size does not depend on the data.
    known = rows.join(F.broadcast(table), (F.col("programId") == F.col("__program")) & (F.col("__decoded.type") == F.col("__command")), "left")
    payload, outside = _named_payload(F.col("__decoded.data"))
    refused = F.coalesce(F.col("strict") & outside, F.lit(False))
    kept = known.where((F.col("type").isNotNull() | F.col("__command").isNotNull()) & ~refused)
    return kept.select(F.coalesce("type", "__command").alias("type"), "slot", "blockTime", F.lit(None).cast("string").alias("blockhash"),
                       "recentBlockhash", F.when(F.col("type").isNull(), payload).otherwise(F.col("payload")).alias("payload"))


def build_events(txns: DataFrame, extractors: Iterable[Extractor]) -> DataFrame:
    """Events of all extractors over complete, successful transactions: columns of the event stream."""
    good = succeeded(has_body(txns, "transaction"))
    parts = [extract(good) for extract in extractors]
    events = parts[0]
    for part in parts[1:]:
        events = events.unionByName(part)
    return events.select("type", "slot", "blockTime", F.lit(None).cast("string").alias("blockhash"),
                         "recentBlockhash", "payload")


def event_records(events: DataFrame) -> DataFrame:
    """Events as (key, value, timestamp) records: key = slot, value = JSON with the payload nested in it."""
    head = F.to_json(F.struct("type", "slot", "recentBlockhash", "blockTime"), {"ignoreNullFields": "false"})
    value = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"payload":'), F.col("payload"), F.lit("}"))
    return events.select(F.col("slot").cast("string").alias("key"), value.alias("value"),
                         seconds_to_time("blockTime").alias("timestamp"))
