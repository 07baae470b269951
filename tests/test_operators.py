"""Hand-computed edge rows: NULLs, ties, empty input, three-valued logic."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as sc
from tidemark.functions.json_text import json_field, json_fields
from tidemark.operators import aggregates as ag
from tidemark.operators import filters as flt
from tidemark.operators import joins as jn
from tidemark.operators import ranking as rk
from tidemark.operators import requests as rq


def test_shift_decimal_golden(spark):
    cases = [("1000000000", 9, "1.000000000"), ("0", 9, "0E-9"), ("5", 0, "5.000000000"),
             ("123456789012", 6, "123456.789012000"), ("1234567890123", 12, "1.234567890"),
             ("18446744073709551615", 0, None), ("123456789012345678901234567890", 9, None), ("123456789012345678901234567", 9, "123456789012345678.901234567"),
             (None, 9, None), ("5", None, None), ("abc", 2, None), ("1234567890126", 12, "1.234567890")]
    df = spark.createDataFrame([(a, d) for a, d, _ in cases], "a STRING, d INT")
    got = [r[0] for r in df.select(sc.shift_decimal("a", "d")).collect()]
    assert got == [None if w is None else Decimal(w) for _, _, w in cases]


JSON = ['{"a":1,"b":"x"}', '{"a":1.50,"b":null}', '{"a":true}', '{"a":{"c":[1, 2 ,{"d":"q\\"z"}]},"b":{}}',
        '{"a":"\\u00e9\\n"}', '{"a":""}', "not json", "", '{"a":1,', None, "[1,2]", '"str"', "5", "null",
        '{"a":18446744073709551615}', '{"b":{"c":null,"d":1},"a":{"c":"v"}}', '{"a":NaN}', '{"b":"text"}',
        '{"b":[{"c":1},{"c":2}]}', '{"b":5,"a":7}', '{"a":"x","b":{"c":"y"},}', '{"a":01}', '{"a":"tab\there"}',
        '{"b":{"c":{"d":[1.0, 1E5]}}}', '{"a":{"c":1},"b":{"c":2,"d":"3"}}']


def test_one_parse_equals_one_path_at_a_time(spark):
    df = spark.createDataFrame([(t,) for t in JSON], "v STRING")
    for paths in (["a", "b.c", "b.d"], ["a", "b"], ["b", "b.c"], ["b[0].c", "a.c"]):
        fields = {f"f{i}": p for i, p in enumerate(paths)}
        once = json_fields(df, "v", fields).collect()
        each = df.select("v", *[json_field("v", p).alias(n) for n, p in fields.items()]).collect()
        assert once == each


def test_tolerant_cast_and_defaults(spark):
    df = spark.createDataFrame([("7", 0, ""), ("x", None, None), (None, 3, "t")], "s STRING, n INT, t STRING")
    got = df.select(sc.tolerant("s", "int"), sc.or_default("n", 9), sc.or_default("t", "-"), sc.seconds_to_millis("n"),
                    sc.seconds_to_time("n")).collect()
    epoch = datetime(1970, 1, 1)
    assert [tuple(r) for r in got] == [(7, 9, "-", 0, epoch), (None, 9, "-", 0, epoch),
                                       (None, 3, "t", 3000, epoch.replace(second=3))]


def test_text_helpers(spark):
    df = spark.createDataFrame([(" opt out ", "é\u0000")], "a STRING, b STRING")
    got = df.select(sc.shout("a"), sc.strip_nul("b"), sc.utf8_size("b"), sc.fill_template("{x}+{x}", x="b"),
                    sc.record_json("a", F.lit(None).cast("int").alias("n"))).first()
    assert tuple(got) == ("OPT OUT", "é", 3, "é\0+é\0", '{"a":" opt out ","n":null}')


def test_floor_div(spark):
    df = spark.createDataFrame([(n,) for n in (-249, -248, -1, 0, 247, 248)], "n BIGINT")
    assert [r[0] for r in df.select(sc.floor_div(F.col("n"), 248)).collect()] == [-2, -1, -1, 0, 0, 1]


def test_epoch_seconds_before_1970_and_zones(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ '1969-12-31 23:59:58.5' a, TIMESTAMP_NTZ '2024-03-10 02:30:00' b, 5 c")
        got = df.select(*[sc.epoch_seconds(df, c) for c in "abc"]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got) == (-2, 1710037800, 5)
    with pytest.raises(TypeError):
        sc.epoch_seconds(spark.sql("SELECT 'x' a"), "a")


def test_like_any_and_not_self_keep_three_valued_logic(spark, rows):
    df = spark.createDataFrame([("ab",), ("cd",), (None,)], "s STRING")
    assert rows(flt.like_any(df, "s", ["%a%", "%d"])) == [("ab",), ("cd",)]
    assert rows(flt.like_any(df, "s", [])) == []
    assert rows(flt.not_self(df, "s", "ab")) == [(None,), ("cd",)]


@pytest.mark.parametrize("excluded,want", [([], [None, 1, 2]), ([1], [2]), ([1, None], [])])
def test_not_in_list_and_table_agree(spark, excluded, want):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n INT")
    table = spark.createDataFrame([(e,) for e in excluded], "e INT")
    assert [r.n for r in flt.not_in(df, "n", table).orderBy("n").collect()] == want
    assert [r.n for r in flt.not_in(df, "n", excluded).orderBy("n").collect()] == want


def test_body_size_and_optional_filters(spark, rows):
    df = spark.createDataFrame([("é" * 2, 1), ("abc", 2), (None, 3)], "s STRING, n INT")
    assert rows(flt.max_bytes(df, "s", 3)) == [("abc", 2)]
    assert rows(flt.has_body(df, "s").select("n")) == [(1,), (2,)]
    assert flt.maybe_eq(df, "n").count() == 3 and flt.maybe_eq(df, "n", 2).count() == 1
    assert rows(flt.succeeded(df, "s").select("n")) == [(3,)]


def test_routes(spark, rows):
    df = spark.createDataFrame([('{"p":"1"}',), ('{"p":"2"}',), ("{}",)], "v STRING")
    routes = flt.route_by(df, json_field("v", "p"), {"one": "1", "two": "2"})
    assert {n: r.count() for n, r in routes.items()} == {"one": 1, "two": 1}
    got = df.select(flt.route_column(json_field("v", "p"), {"one": "1", "two": "2"}))
    assert rows(got) == [(None,), ("one",), ("two",)]


def test_relevant(spark, rows):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, []), (4, None)], "i INT, k ARRAY<STRING>")
    assert rows(flt.relevant(df, "k", ["b", "z"]).select("i")) == [(1,)]


@pytest.mark.parametrize("kind", ["bigint", "timestamp", "timestamp_ntz"])
def test_interval_join_bounds(spark, rows, kind):
    def side(data, key, time, ident):
        df = spark.createDataFrame(data, f"{key} STRING, s BIGINT, {ident} INT")
        value = F.col("s") if kind == "bigint" else F.timestamp_seconds("s").cast(kind)
        return df.select(key, value.alias(time), ident)

    times = [0, 1, 99, 100, 101, 199, 200, 201, 350, -100, -101]
    left = side([("k", t, i) for i, t in enumerate(times)] + [(None, 0, 90), ("k", None, 91)], "a", "at", "i")
    right = side([("k", t, i) for i, t in enumerate(times)] + [("other", 0, 92), (None, 0, 93)], "b", "bt", "j")
    want = sorted((i, j) for i, x in enumerate(times) for j, y in enumerate(times) if abs(x - y) <= 100)
    for width in (None, 7, 1000):
        assert rows(jn.interval_join(left, right, ("a", "b"), ("at", "bt"), 100, width=width).select("i", "j")) == want


def test_zip_changes_and_upsert_stats(spark, rows):
    pre = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "5", 1), ("c", None, 1)], "k STRING, v STRING, o INT")
    post = spark.createDataFrame([("a", "2", 1), ("b", "6", 1), ("d", "0", 1)], "k STRING, v STRING, o INT")
    assert rows(jn.zip_changes(pre, post, ["k"], "v", order="o")) == [("b", "5", "6"), ("d", None, "0")]
    one = ag.latest_rows(pre, ["k"], "o")
    assert rows(ag.upsert_stats(one, post, ["k"], "v")) == [(4, 2)]


def test_hydrate_keeps_missing_and_drops_oversize(spark, rows):
    keys = spark.createDataFrame([(1,), (2,), (3,)], "k INT")
    records = spark.createDataFrame([(1, "ok"), (2, "too long")], "k INT, body STRING")
    assert rows(jn.hydrate(keys, records, "k", "body", 3)) == [(1, "ok"), (3, None)]


def test_apply_scores(spark, rows):
    state = spark.createDataFrame([("g", "keep", 1), ("g", "gone", 2), ("g", "set", 3)], "g STRING, m STRING, s INT")
    changes = spark.createDataFrame([("g", "gone", 0, 1), ("g", "set", 0, 2), ("g", "set", 8, 3), ("g", "new", 5, 4),
                                     ("g", "new", None, 5), ("h", "set", 4, 6)], "g STRING, m STRING, s INT, o INT")
    assert rows(rk.apply_scores(state, changes, "g", "m", "s", "o")) == [("g", "keep", 1), ("g", "set", 8), ("h", "set", 4)]
    assert rows(rk.apply_scores(None, changes, "g", "m", "s", "o")) == [("g", "set", 8), ("h", "set", 4)]


def test_leaderboard_ties_go_to_the_later_name(spark):
    df = spark.createDataFrame([("g", "a", 1), ("g", "b", 1), ("g", "c", 0)], "g STRING, m STRING, s INT")
    got = rk.leaderboard(df, "g", "m", "s", 2).orderBy("rank").collect()
    assert [r.m for r in got] == ["b", "a"]


def test_observed_counts_rows(spark):
    df, seen = ag.observed(spark.range(7), "sent")
    df.collect()
    assert seen.get["rows"] == 7


def test_requests(spark, rows):
    messages = spark.createDataFrame(
        [("me", "opt out", "1"), ("ann", " Opt Out", "2"), ("bob", "OPT OUT", "3"), ("cy", "opt out", None),
         ("dee", "hello", "5"), (None, None, "6")], "handle STRING, body STRING, userId STRING")
    entities = spark.createDataFrame([("ann", "ref-a", False), ("bob", "ref-b", True)],
                                     "handle STRING, tokenRef STRING, isOptedOut BOOLEAN")
    judged = rq.classify_requests(messages, entities, "me", "wrong")
    assert rows(judged.select("userId", "error", "optedOut", "tokenRef")) == [
        (None, "No social token was found for cy", None, None), ("2", None, True, "ref-a"),
        ("3", "bob has already been opted out", None, None), ("5", "wrong", None, None), ("6", "wrong", None, None)]
    assert rows(rq.reply_outbox(judged)) == [
        ("2", "Opt Out Successful! We're sorry to see you go."), ("3", "bob has already been opted out"), ("5", "wrong"),
        ("6", "wrong")]


def test_flatten_drops_other_events_and_keeps_unknown_senders(spark, rows):
    raw = spark.createDataFrame([("1", "9", ("u", ("hi",))), ("2", "9", None), ("3", "9", ("x", ("yo",)))], rq.RAW_MESSAGE)
    users = spark.createDataFrame([("u", "ann", "Ann")], "userId STRING, handle STRING, name STRING")
    assert rows(rq.flatten_messages(raw, users)) == [(None, None, "yo", "3", "x", "9"), ("ann", "Ann", "hi", "1", "u", "9")]
