"""Layout columns against a plain reader: every type, every known command, whole and broken data."""

import json
import random

import pytest
from pyspark.sql import functions as F

from plain_reader import read_value
from tidemark.functions.binary import to_base58, with_decoded
from tidemark.functions.layouts import INT_SIZES, MARK, fixed_size, layout_text
from tidemark.plans import dictionaries as fixed

TEXTS = ["", "plain", 'quo"te \\ back', "line\nend\ttab", "ünï 漢字 🙂", "a/b c"]
ODD = {"struct": [
    ["n", "i8"], ["m", "i16"], ["k", "i32"], ["big", "i64"], ["huge", "u128"], ["low", "i128"], ["flag", "bool"],
    ["pair", {"array": ["u16", 2]}], ["names", {"array": ["string", 2]}], ["blob", "bytes"],
    ["rows", {"vec": {"struct": [["key", "pubkey"], ["part", {"option": "u64"}]]}}],
    ["fixed", {"vec": {"struct": [["key", "pubkey"], ["share", "u8"]]}}],
    ["choice", {"enum": [["None", None], ["One", [["x", "u32"]]], ["Many", [["xs", {"vec": "string"}]]]]}], ["end", "u8"]]}


def written(kind, rng) -> bytes:
    """Random data of a layout type."""
    if isinstance(kind, dict):
        (form, inner), = kind.items()
        if form == "option":
            return rng.choice([b"\0", b"\1" + written(inner, rng)])
        if form == "struct":
            return b"".join(written(field, rng) for _, field in inner)
        if form == "enum":
            which = rng.randrange(len(inner))
            return bytes([which]) + written({"struct": inner[which][1] or []}, rng)
        if form == "array":
            return b"".join(written(inner[0], rng) for _ in range(inner[1]))
        n = rng.choice([0, 1, 2, 5])
        return n.to_bytes(4, "little") + b"".join(written(inner, rng) for _ in range(n))
    if kind == "string":
        text = rng.choice(TEXTS).encode()
        return len(text).to_bytes(4, "little") + text
    if kind == "bytes":
        return written({"vec": "u8"}, rng)
    if kind == "bool":
        return bytes([rng.choice([0, 1, 7])])
    size = 32 if kind == "pubkey" else INT_SIZES[kind]
    return rng.choice([b"\0" * size, b"\xff" * size, b"\0" * (size - 1) + b"\x80", rng.randbytes(size)])


def plain(layout, raw: bytes, skip: int = 0):
    """The value by the plain reader, None where the data does not fit."""
    try:
        value, _ = read_value(layout, raw, skip, [])
    except (ValueError, IndexError):
        return None
    return json.loads(json.dumps(value, default=to_base58))


def broken(raw: bytes, rng) -> list[bytes]:
    """Cut short at random places, with random bytes altered, and with bytes to spare."""
    cut = [raw[:rng.randrange(len(raw) + 1)] for _ in range(3)]
    noise = []
    for _ in range(3):
        other = bytearray(raw)
        if other:
            other[rng.randrange(len(other))] = rng.randrange(256)
        noise.append(bytes(other))
    return cut + noise + [raw + b"more", b""]


@pytest.mark.parametrize("layout", [ODD, {"vec": "string"}, {"option": {"vec": "i128"}}, {"struct": []}, "u128", {"vec": "bool"}])
def test_layout_columns_equal_the_plain_reader(spark, layout):
    rng = random.Random(3)
    raws = [raw for _ in range(30) for whole in [written(layout, rng)] for raw in [whole, *broken(whole, rng)]]
    df = spark.createDataFrame([(i, bytearray(raw)) for i, raw in enumerate(raws)], "i INT, raw BINARY")
    for i, text in df.select("i", F.expr(layout_text(layout, "raw"))).collect():
        value = None
        if text is not None:
            parts = text.split(MARK)
            parts[1::2] = [to_base58(bytes.fromhex(key)) for key in parts[1::2]]
            value = json.loads("".join(parts))
        assert value == plain(layout, raws[i]), (layout, raws[i])


def test_all_known_commands_equal_the_plain_reader(spark):
    rng, commands, rows = random.Random(4), fixed.opcode_commands(), []
    for c in commands:
        for _ in range(12):
            body = written(c["layout"], rng) if c["layout"] else b"\0"
            whole = bytes.fromhex(c["key"]) + body[1:]
            rows += [(c["programId"], raw) for raw in [whole, *broken(whole, rng)]]
    df = spark.createDataFrame([(i, p, to_base58(raw)) for i, (p, raw) in enumerate(rows)], "i INT, program STRING, data STRING")
    got = with_decoded(df, "program", "data", commands).select("i", "__decoded.type", "__decoded.data").collect()
    known = {(c["programId"], c["key"]): c for c in commands}
    decoded = 0
    for i, kind, data in got:
        program, raw = rows[i]
        c = known.get((program, (raw[:1] or b"\0").hex()))
        value = c and c["layout"] and plain(c["layout"], raw)
        want = c["type"] if c and (c["layout"] is None or value is not None) else None
        assert (kind, data and json.loads(data)) == (want, value or None), (rows[i], kind, data)
        decoded += kind is not None
    assert len(got) == len(rows) and decoded > len(commands) * 12


def test_fixed_layouts_are_slices(spark):
    assert fixed_size({"struct": [["a", "u8"], ["b", {"array": ["pubkey", 2]}]]}) == 65 and fixed_size(ODD) is None
    fixed_layout = {"struct": [["opcode", "u8"], ["hashed", "pubkey"], ["space", "u32"]]}
    df = spark.createDataFrame([(bytearray(37),)], "raw BINARY").select(F.expr(layout_text(fixed_layout, "raw")).alias("t"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and df.first().t is not None


def test_a_list_longer_than_its_data_is_refused(spark):
    raws = [b"\xff\xff\xff\xff", b"\xff\xff\xff\x7f" + b"\0" * 9, b"\x02\0\0\0" + b"\0" * 3]
    df = spark.createDataFrame([(bytearray(r),) for r in raws], "raw BINARY")
    for element in ["u8", "string", {"struct": []}, {"option": "u8"}]:
        texts = [r[0] for r in df.select(F.expr(layout_text({"vec": element}, "raw"))).collect()]
        assert texts[:2] == [None, None]


def test_unknown_types_are_refused():
    for layout in ["u7", {"set": "u8"}, {"struct": [["a", "float"]]}]:
        with pytest.raises(ValueError):
            layout_text(layout, "raw")


@pytest.mark.parametrize("wanted", [["type"], ["data"], ["data", "type"]])
def test_any_part_of_the_result_may_be_read_alone(spark, wanted):
    data = to_base58(b"\x10" + written(fixed._DATA_V2, random.Random(1)) + b"\1")
    df = spark.createDataFrame([(fixed.METADATA_PROGRAM, data), (fixed.METADATA_PROGRAM, None)], "program STRING, data STRING")
    got = with_decoded(df, "program", "data", fixed.opcode_commands()).select(*[f"__decoded.{w}" for w in wanted]).collect()
    assert all(v is not None for v in got[0]) and all(v is None for v in got[1])
