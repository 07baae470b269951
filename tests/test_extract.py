"""Transactions to events, on a small hand-made transaction and golden values."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.binary import decode_all, encode_all, from_base58, hex_to_base58, to_base58
from tidemark.operators import extract as ex
from tidemark.plans import dictionaries as fixed
from tidemark.plans import ledger
from plain_reader import read_value

# Golden pairs: zero-stripped hex keys and their base58 texts.
KEYS = {
    "a4f3dca6b5a781173aa2d300910213f48975d62ec60e04b72826a9fa65c0b075": "C6uY3FCNz76k5kDjaYtHyedgzXW8fsJABXg3R7rfc7fA",
    "df341bdfe02364276f9a420fd60ab5c3ddff771a7e144dea6b6de322ae3d43d0": "G2J17bwMJc6fZ6GimJ4Pj8Grf7bdsxb467ZceqUHGRHR",
    "00": "11111111111111111111111111111111",
}
PAYER, CURVE, SYSTEM = KEYS.values()
CURVE_PROGRAM = "CurveProgram1111111111111111111111111111111"
CURVE_IDL = {
    "metadata": {"address": CURVE_PROGRAM},
    "instructions": [{"name": "createCurveV0", "args": [{"name": "args", "type": {"defined": "Curves"}}], "accounts": [
        {"name": "payer"}, {"name": "made", "accounts": [{"name": "curve"}, {"name": "deep", "accounts": [{"name": "x"}]}]},
        {"name": "late"}]}],
    "types": [{"name": "Curves", "type": {"kind": "enum", "variants": [{"name": "LogCurveV0", "fields": [
        {"name": "g", "type": "u128"}, {"name": "c", "type": "u128"}, {"name": "taylor_iterations", "type": "u16"}]}]}}],
}
CURVE_DATA = "GAGaFqU2H6ppHk3yUAfKFLHHmJoyAGs462YQbedhYdgQgcZcNvTqc6ukffu"


def balance(index, amount, decimals=2, mint="m"):
    return {"accountIndex": index, "mint": mint, "uiTokenAmount": {"amount": amount, "decimals": decimals}}


def ix(accounts, data, program):
    return {"accounts": accounts, "data": data, "programIdIndex": program}


def transactions(spark, *records):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "v STRING")
    return df.select(F.from_json("v", ex.TRANSACTION).alias("t")).select("t.*")


def record(outer, inner=(), pre=(), post=(), err=None, slot=7, keys=None):
    keys = keys or [PAYER, CURVE, SYSTEM, fixed.TOKEN_PROGRAM, fixed.ASSOCIATED_TOKEN_PROGRAM, CURVE_PROGRAM]
    return {"slot": slot, "blockTime": 100, "transaction": {"message": {
        "accountKeys": keys, "recentBlockhash": "h", "instructions": list(outer)}, "signatures": []},
        "meta": {"err": err, "innerInstructions": list(inner), "preTokenBalances": list(pre), "postTokenBalances": list(post)}}


def payloads(df):
    return [(r.type, json.loads(r.payload)) for r in df.collect()]


def test_base58(spark):
    assert [to_base58(bytes.fromhex(h.zfill(64))) for h in KEYS] == list(KEYS.values())
    assert all(from_base58(t) == bytes.fromhex(h.zfill(64)) for h, t in KEYS.items())
    df = spark.createDataFrame([(list(KEYS),), (None,)], "k ARRAY<STRING>")
    assert [r[0] for r in df.select(hex_to_base58(F.col("k"))).collect()] == [list(KEYS.values()), None]


def test_base58_in_bulk_equals_one_by_one():
    rng = random.Random(1)
    raws = [rng.randbytes(n) for n in [0, 1, 2, 4, 5, 31, 32, 33, 64, 255, 256, 257, 400] * 5]
    raws += [b"\0" * 32, b"\0\0" + rng.randbytes(30), b"\xff" * 32, None]
    texts = encode_all(raws)
    assert texts == [None if r is None else to_base58(r) for r in raws]
    assert decode_all(texts) == raws
    assert decode_all(["0", "\u00e9", "1l", "z" * 300 + "0", "z", None]) == [None, None, None, None, b"9", None]


def test_discriminators():
    assert fixed.discriminator("createCurveV0") == "cdcbfac99c8772dd"
    assert fixed.discriminator("initializeUnclaimedSocialTokenV0") == "f792a255afdd48b3"


def test_read_value_types():
    layout = {"struct": [["n", "i8"], ["big", "u64"], ["o", {"option": "u8"}], ["v", {"vec": "u16"}],
                         ["a", {"array": ["bool", 2]}], ["s", "string"], ["b", "bytes"]]}
    raw = bytes([255]) + (2**63).to_bytes(8, "little") + b"\0" + b"\1\0\0\0\5\0" + b"\1\0" + b"\2\0\0\0hi" + b"\1\0\0\0\7"
    value, at = read_value(layout, raw, 0, [])
    assert value == {"n": -1, "big": str(2**63), "o": None, "v": [5], "a": [True, False], "s": "hi", "b": [7]}
    assert at == len(raw)
    with pytest.raises(ValueError):
        read_value("u32", b"\1", 0, [])


def test_instructions_inner_first_with_swapped_index_names(spark):
    outer = [ix([0], "a", 2), ix([1], "b", 3)]
    inner = [{"index": 1, "instructions": [ix([0], "c", 3), ix([0], "d", 9)]}]
    got = ex.explode_instructions(transactions(spark, record(outer, inner)), ["slot"]).collect()
    assert [(r.instructionIndex, r.innerIndex, r.item.data, r.programId) for r in got] == [
        (0, 1, "c", fixed.TOKEN_PROGRAM), (1, 1, "d", None), (0, None, "a", SYSTEM), (1, None, "b", fixed.TOKEN_PROGRAM)]
    none = record(outer)
    none["meta"]["innerInstructions"] = None
    assert ex.explode_instructions(transactions(spark, none), ["slot"]).count() == 2


def test_opcode_commands(spark):
    outer = [
        ix([1, 0, 2, 2], "2", 3),  # opcode 1, fourth account is surplus
        ix([0, 1], "", 4),  # empty data is opcode 0; two accounts missing
        ix([0, 77], "2", 3),  # a named account outside the key list: no event
        ix([0], "zzz0", 3),  # not base58: no event
        ix([0], to_base58(b"\x09"), 3),  # unknown opcode
        ix([0], to_base58(b"\x06"), 3),  # data ends early
        ix([0, 1], to_base58(b"\x06\x02\x01" + from_base58(CURVE)), 3),
    ]
    got = payloads(ex.instruction_events(transactions(spark, record(outer)), fixed.opcode_commands()))
    assert got == [
        ("InitializeTokenAccount", {"data": {"instruction": 1}, "accounts": {"account": CURVE, "mint": PAYER, "owner": SYSTEM},
                                    "programId": fixed.TOKEN_PROGRAM, "instructionIndex": 0, "innerIndex": None}),
        ("InitializeAssociatedTokenAccount",
         {"accounts": {"signer": PAYER, "account": CURVE, "owner": None, "mint": None}, "programId": fixed.ASSOCIATED_TOKEN_PROGRAM,
          "instructionIndex": 1, "innerIndex": None}),
        ("TokenProgramSetAuthority",
         {"data": {"instruction": 6, "authorityType": 2, "newAuthority": CURVE},
          "accounts": {"mintOrAccount": PAYER, "signer1": CURVE}, "programId": fixed.TOKEN_PROGRAM,
          "instructionIndex": 6, "innerIndex": None})]


def test_interface_commands_with_nested_accounts(spark):
    commands = fixed.idl_commands(CURVE_IDL)
    outer = [ix([0, 1, 2], CURVE_DATA, 5), ix([0, 1, 2], CURVE_DATA, 3)]
    (kind, payload), = payloads(ex.instruction_events(transactions(spark, record(outer)), commands))
    assert kind == "createCurveV0"
    assert payload["data"] == {"args": {"logCurveV0": {"g": "100000000000", "c": "1000000000000", "taylorIterations": 15}}}
    assert payload["accounts"] == {"payer": PAYER, "made": {"curve": CURVE, "deep": {"x": SYSTEM}}, "late": None}


def test_metadata_layout_round_trip(spark):
    def text(s):
        return len(s).to_bytes(4, "little") + s.encode()
    creator = b"\1" + (1).to_bytes(4, "little") + from_base58(PAYER) + b"\1\x64"
    raw = b"\x10" + text("Name") + text("SYM") + text("uri") + (250).to_bytes(2, "little") + creator + b"\0\0" + b"\1"
    keys = [PAYER, CURVE, SYSTEM, fixed.METADATA_PROGRAM]
    txns = transactions(spark, record([ix([0, 1, 2, 0, 1], to_base58(raw), 3)], keys=keys))
    (kind, payload), = payloads(ex.instruction_events(txns, fixed.opcode_commands()))
    assert kind == "CreateMetadataV2"
    assert payload["data"]["data"] == {
        "name": "Name", "symbol": "SYM", "uri": "uri", "sellerFeeBasisPoints": 250,
        "creators": [{"address": PAYER, "verified": 1, "share": 100}], "collection": None, "uses": None}


def test_balance_changes(spark):
    pre = [balance(0, "5"), balance(1, "9"), balance(1, "8"), balance(2, "4")]
    post = [balance(0, "5"), balance(1, "7", 6), balance(3, "0")]
    got = payloads(ex.balance_changes(transactions(spark, record([], pre=pre, post=post))))
    assert [(p["pubkey"], p["preAmount"], p["postAmount"], p["decimals"]) for _, p in got] == [
        (CURVE, "8", "7", 2), (SYSTEM, "4", None, 2), (fixed.TOKEN_PROGRAM, "0", "0", 2)]
    nothing = record([], keys=[PAYER])
    nothing["meta"]["preTokenBalances"] = nothing["meta"]["postTokenBalances"] = None
    assert ex.balance_changes(transactions(spark, nothing)).count() == 0


def test_build_events_drops_failed_and_bodyless(spark):
    good, failed, bodyless = record([ix([1, 0, 2], "2", 3)]), record([ix([1, 0, 2], "2", 3)], err='{"x":1}'), record([])
    bodyless["transaction"] = None
    txns = transactions(spark, good, failed, bodyless)
    events = ex.build_events(txns, [ex.balance_changes, lambda t: ex.instruction_events(t, fixed.opcode_commands())])
    (out,) = ex.event_records(events).collect()
    value = json.loads(out.value)
    assert out.key == "7" and out.timestamp.second == 40
    assert (value["type"], value["slot"], value["blockTime"], value["recentBlockhash"]) == ("InitializeTokenAccount", 7, 100, "h")
    assert value["payload"]["accounts"]["account"] == CURVE


def test_json_pieces():
    pieces, tail = ex.json_pieces(["a", "g.b", "g.h.c", "k.d", "e"])
    assert json.loads("".join(p + "1" for p in pieces) + tail) == {"a": 1, "g": {"b": 1, "h": {"c": 1}}, "k": {"d": 1}, "e": 1}
    assert ex.json_pieces([]) == ([], "{}")


def both_forms(txns, idls=()):
    commands = fixed.opcode_commands() + [c for idl in idls for c in fixed.idl_commands(idl)]
    apart = ex.build_events(txns, [ex.balance_changes, lambda t: ex.instruction_events(t, commands)])
    return ledger.event_stream(txns, idls), apart


def test_one_pass_equals_one_extractor_at_a_time(spark, rows):
    rng = random.Random(5)
    amounts = [None, "0", "7", "8"]

    def some(n):
        return [balance(rng.randrange(8), rng.choice(amounts)) for _ in range(rng.randrange(n))]

    def some_ix():
        return ix(rng.choices(range(8), k=rng.randrange(5)), rng.choice(["2", "", CURVE_DATA, "!", None]), rng.randrange(8))

    records = [record([some_ix() for _ in range(rng.randrange(4))],
                      [{"index": rng.randrange(3), "instructions": [some_ix() for _ in range(rng.randrange(3))]}
                       for _ in range(rng.randrange(3))], some(4), some(4), slot=i,
                      keys=rng.choice([None, None, [PAYER, fixed.TOKEN_PROGRAM, PAYER], [PAYER], []])) for i in range(150)]
    for r in records[:40]:
        r["meta"][rng.choice(["innerInstructions", "preTokenBalances", "postTokenBalances"])] = None
    records[0]["transaction"]["message"]["accountKeys"] = records[1]["transaction"]["message"]["instructions"] = None
    records[2]["meta"]["err"], records[3]["transaction"] = "x", None
    once, apart = both_forms(transactions(spark, *records), [CURVE_IDL])
    got = rows(once)
    assert got == rows(apart) and {r[0] for r in got} >= {"TokenAccountBalanceChange", "InitializeTokenAccount", "createCurveV0"}


def test_one_scan_for_all_extractors_and_a_further_one(spark, tmp_path):
    transactions(spark, record([ix([1, 0, 2], "2", 3)], post=[balance(1, "7")]), record([], slot=8)).write.parquet(f"{tmp_path}/t")
    txns = spark.read.parquet(f"{tmp_path}/t")
    slots = F.array(ex.finished(F.lit("Slot"), F.concat(F.lit('{"n":'), F.col("slot").cast("string"), F.lit("}"))))
    events = ledger.event_stream(txns, more=[slots])
    text = events._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Generate") == 1 and "Exchange hashpartitioning" not in text
    assert sorted((r.type, r.slot) for r in events.collect()) == [
        ("InitializeTokenAccount", 7), ("Slot", 7), ("Slot", 8), ("TokenAccountBalanceChange", 7)]
