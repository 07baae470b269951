"""Sources, sinks, projections, filters, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.functions import scalars as sc
from tidemark.functions.json_text import json_field, json_fields
from tidemark.operators import filters as flt
from tidemark.operators.aggregates import dedup
from tidemark.operators.joins import hydrate
from tidemark.operators.paging import covered_ranges, not_covered, publish_batches, range_gaps
from tidemark.operators.ranking import apply_scores
from tidemark.operators.recency import reuse_distance
from tidemark.sources.topics import incremental_since, json_topic, match_topics
from tidemark.streaming.sinks import append_into, with_event_time


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


@query("src_json_topic", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def _(t):
    raw = t.events.select(F.col("event_id").cast("string").alias("key"), F.col("props").alias("value"))
    return json_topic(raw, "event_id BIGINT, k INT", key="event_id")


@query("src_topic_pattern", """
    SELECT event_id, 'ledger.' || event_type AS topic FROM events WHERE event_type IN ('click', 'error', 'view')""")
def _(t):
    records = t.events.select("event_id", F.concat(F.lit("ledger."), "event_type").alias("topic"))
    return match_topics(records, r"ledger\.(click|error|view)")


@query("src_incremental", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_shipdate > (SELECT max(o_orderdate) FROM orders)""")
def _(t):
    done = t.orders.select(F.col("o_orderdate").alias("l_shipdate"))
    return incremental_since(t.lineitem, done, "l_shipdate").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("src_incremental_start", """
    SELECT event_id, user_id FROM events WHERE event_id > (SELECT max(p_partkey) FROM part)""")
def _(t):
    nothing = t.events.where(F.col("event_type") == "no such type")
    newest = t.part.agg(F.max("p_partkey")).scalar()
    return incremental_since(t.events, nothing, "event_id", start=newest).select("event_id", "user_id")


@query("snk_append_into", """
    SELECT event_id, user_id, props FROM events WHERE event_type = 'signup'
    UNION ALL SELECT event_id, user_id, props FROM events WHERE event_type = 'purchase'""")
def _(t):
    return append_into(
        flt.of_type(t.events, "signup", "event_type").select("event_id", "user_id", "props"),
        flt.of_type(t.events, "purchase", "event_type").select("props", "user_id", "event_id"),
    )


@query("set_union", """
    SELECT c_custkey AS party, c_nationkey AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_nationkey FROM supplier""")
def _(t):
    return append_into(
        t.customer.select(F.col("c_custkey").alias("party"), F.col("c_nationkey").alias("nation")),
        t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("party")),
    )


@query("snk_event_time", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(epoch(o_orderdate) AS BIGINT) ELSE 0 END AS stamped,
           CASE WHEN o_orderstatus = 'F' THEN CAST(epoch(o_orderdate) AS BIGINT) * 1000 ELSE 0 END AS millis
    FROM orders""")
def _(t):
    orders = t.orders
    seconds = F.when(F.col("o_orderstatus") == "F", sc.epoch_seconds(orders, "o_orderdate"))
    stamped = with_event_time(orders.withColumn("blockTime", seconds))
    return stamped.select("o_orderkey", F.unix_seconds("timestamp").alias("stamped"),
                          sc.seconds_to_millis("blockTime").alias("millis"))


@query("snk_scores", """
    WITH latest AS (SELECT * FROM (
           SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN 0
                                  ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS score,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)
    SELECT 'all' AS board, c_custkey AS member, CAST(round(c_acctbal * 100) AS BIGINT) AS score FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM latest)
    UNION ALL SELECT 'all', o_custkey, score FROM latest WHERE score <> 0""")
def _(t):
    state = t.customer.select(F.lit("all").alias("board"), F.col("c_custkey").alias("member"),
                              cents("c_acctbal").alias("score"))
    score = F.when(F.col("o_orderstatus") == "F", F.lit(0).cast("bigint")).when(
        F.col("o_orderstatus") != "P", cents("o_totalprice"))
    changes = t.orders.select(F.lit("all").alias("board"), F.col("o_custkey").alias("member"), score.alias("score"),
                              "o_orderkey")
    return apply_scores(state, changes, "board", "member", "score", "o_orderkey")


@query("prj_alias", "SELECT n_nationkey AS \"nationKey\", n_name AS \"nationName\" FROM nation")
def _(t):
    return t.nation.select(F.col("n_nationkey").alias("nationKey"), F.col("n_name").alias("nationName"))


@query("prj_json_fields", """
    SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS missing FROM events""")
def _(t):
    return json_fields(t.events.select("event_id", "props"), "props", {"k": "k", "missing": "missing"}).drop("props")


@query("prj_try_cast", """
    SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           TRY_CAST(event_type AS INTEGER) AS bad FROM events""")
def _(t):
    return t.events.select("event_id", sc.tolerant(json_field("props", "k"), "int").alias("k"),
                           sc.tolerant("event_type", "int").alias("bad"))


@query("prj_tags", "SELECT c_custkey, 'early' AS tag, 'v1' AS version FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.lit("early").alias("tag"), F.lit("v1").alias("version"))


@query("prj_key_copy", "SELECT c_custkey AS \"key\", c_custkey AS destination FROM customer")
def _(t):
    return t.customer.select(F.col("c_custkey").alias("key"), F.col("c_custkey").alias("destination"))


@query("flt_route_program", "SELECT event_id, user_id FROM events WHERE json_extract_string(props, '$.k') = '9'")
def _(t):
    routes = flt.route_by(t.events, json_field("props", "k"), {"seven": "7", "nine": "9"})
    return routes["nine"].select("event_id", "user_id")


@query("flt_route_column", """
    SELECT event_id, CASE json_extract_string(props, '$.k') WHEN '7' THEN 'seven' WHEN '9' THEN 'nine' END AS route
    FROM events""")
def _(t):
    route = flt.route_column(json_field("props", "k"), {"seven": "7", "nine": "9"})
    return t.events.select("event_id", route.alias("route"))


@query("flt_route_type", "SELECT event_id, user_id FROM events WHERE event_type = 'signup'")
def _(t):
    return flt.of_type(t.events, "signup", "event_type").select("event_id", "user_id")


@query("flt_like_any", """
    SELECT event_id, props FROM events WHERE event_type = 'error' AND (props LIKE '%"k": 1%' OR props LIKE '%9}%')""")
def _(t):
    errors = flt.of_type(t.events, "error", "event_type")
    return flt.like_any(errors, "props", ['%"k": 1%', "%9}%"]).select("event_id", "props")


@query("flt_eligible", """
    SELECT event_id, user_id FROM events WHERE ts < TIMESTAMP '2024-01-10' AND user_id NOT IN (1, 2, 3, 4, 5)""")
def _(t):
    cutoff = F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'")
    return flt.eligible(t.events, "ts", cutoff, "user_id", [1, 2, 3, 4, 5]).select("event_id", "user_id")


@query("set_exclude", """
    SELECT event_id, user_id FROM events
    WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def _(t):
    builders = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return flt.not_in(t.events, "user_id", builders).select("event_id", "user_id")


@query("flt_succeeded", "SELECT event_id FROM events WHERE event_type <> 'error'")
def _(t):
    failed = F.when(F.col("event_type") == "error", F.col("props"))
    return flt.succeeded(t.events, failed).select("event_id")


@query("flt_has_body", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'")
def _(t):
    records = t.orders.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderpriority", "o_totalprice")
    found = hydrate(t.orders.select("o_orderkey"), records, "o_orderkey", "o_orderpriority")
    return flt.has_body(found, "o_orderpriority").select("o_orderkey", "o_totalprice")


@query("flt_max_bytes", "SELECT doc_id FROM documents WHERE octet_length(encode(text)) <= 500")
def _(t):
    return flt.max_bytes(t.documents, "text", 500).select("doc_id")


@query("flt_maybe_eq", """
    SELECT 'one' AS choice, c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT 'all', c_custkey FROM customer""")
def _(t):
    one = flt.maybe_eq(t.customer, "c_mktsegment", "BUILDING")
    every = flt.maybe_eq(t.customer, "c_mktsegment")
    return one.select(F.lit("one").alias("choice"), "c_custkey").union(
        every.select(F.lit("all").alias("choice"), "c_custkey"))


@query("flt_relevant", "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_partkey IN (1, 2, 3, 4, 5)")
def _(t):
    return flt.relevant_ids(t.lineitem, "l_orderkey", "l_partkey", [1, 2, 3, 4, 5])


@query("flt_relevant_table", """
    SELECT DISTINCT l_orderkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 1)""")
def _(t):
    wanted = t.part.where(F.col("p_size") == 1).select("p_partkey")
    return flt.relevant_ids(t.lineitem, "l_orderkey", "l_partkey", wanted)


@query("flt_relevant_rows", """
    SELECT l_orderkey, len(list(l_partkey)) AS n_keys FROM lineitem GROUP BY l_orderkey
    HAVING bool_or(l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 2))""")
def _(t):
    orders = t.lineitem.groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("keys"))
    wanted = t.part.where(F.col("p_size") <= 2).select("p_partkey")
    return flt.relevant_rows(orders, "l_orderkey", "keys", wanted).select("l_orderkey", F.size("keys").alias("n_keys"))


@query("flt_relevant_array", """
    SELECT page_id FROM pages WHERE list_has_any(string_split(url, '/'), ['fr', 'en', 'blog', 'news', '1', '2'])""")
def _(t):
    pages = t.pages.withColumn("parts", F.split("url", "/"))
    return flt.relevant(pages, "parts", ["fr", "en", "blog", "news", "1", "2"]).select("page_id")


@query("flt_not_self", "SELECT event_id, user_id FROM events WHERE user_id IS DISTINCT FROM 0")
def _(t):
    return flt.not_self(t.events, "user_id", 0).select("event_id", "user_id")


@query("set_dedup", """
    SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
    FROM events) WHERE rn = 1""")
def _(t):
    return dedup(t.events, ["user_id"], "event_id").select("event_id", "user_id")


DEDUP_HORIZON_SQL = """
    SELECT event_id, user_id FROM (SELECT event_id, user_id, event_id - lag(event_id) OVER
    (PARTITION BY user_id ORDER BY event_id) AS gap FROM events) WHERE gap IS NULL OR gap > 100"""


@query("set_dedup_horizon", DEDUP_HORIZON_SQL)
def _(t):
    return dedup(t.events, ["user_id"], "event_id", "event_id", 100).select("event_id", "user_id")


# From the definition: fewer than so many other keys came since the key's last row.
@query("set_dedup_last_n", " UNION ALL ".join(f"""
    SELECT CAST({n} AS INTEGER) AS remembered, event_id, user_id FROM (SELECT event_id, user_id, lag(event_id) OVER
      (PARTITION BY user_id ORDER BY event_id) AS last FROM events) AS e
    WHERE last IS NULL OR (SELECT count(DISTINCT b.user_id) FROM events AS b
                           WHERE b.event_id > e.last AND b.event_id < e.event_id) >= {n}""" for n in (5, 20)))
def _(t):
    rows = reuse_distance(t.events.select("event_id", "user_id"), ["user_id"], "event_id")
    rows = rows.withColumn("remembered", F.explode(F.array(F.lit(5), F.lit(20))))
    return rows.where(F.col("__distance").isNull() | (F.col("__distance") >= F.col("remembered"))).drop("__distance")


@query("sc_shift_decimal", """
    SELECT o_orderkey, TRY_CAST(left(lpad(t, 27, '0'), 25) || '.' || right(lpad(t, 27, '0'), 2) AS DECIMAL(27, 9))
           AS amount
    FROM (SELECT o_orderkey, CASE WHEN length(t) <= 27 THEN t END AS t FROM (
      SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN repeat('7', 19 + CAST(o_orderkey % 10 AS INT)) ELSE '' END
             || CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS t FROM orders))""")
def _(t):
    sevens = F.when(F.col("o_orderkey") % 5 == 0, F.repeat(F.lit("7"), (19 + F.col("o_orderkey") % 10).cast("int"))).otherwise("")
    text = F.concat(sevens, cents("o_totalprice").cast("string"))
    return t.orders.select("o_orderkey", sc.shift_decimal(text, F.lit(2)).alias("amount"))


@query("sc_normalise", """
    SELECT conv_id, turn, role, lower(role) = 'user' AND turn % 6 <> 5 AS is_user FROM conversations""")
def _(t):
    # white space of five kinds around the role; in every sixth turn there is some inside, which has to stay
    around = F.element_at(F.array(*[F.lit(x) for x in ("", " ", "\t", "\r\n", " \u00a0\n", "")]), (F.col("turn") % 6 + 1).cast("int"))
    typed = F.when(F.col("turn") % 6 == 5, F.concat(F.lit("us \t"), F.col("role"))).otherwise(F.concat(around, "role", around))
    return t.conversations.select("conv_id", "turn", "role", (sc.shout(typed) == "USER").alias("is_user"))


@query("sc_template", "SELECT n_nationkey, 'Welcome ' || n_name || '! ' || n_name || ' is live.' AS text FROM nation")
def _(t):
    text = sc.fill_template("Welcome {handle}! {handle} is live.", handle="n_name")
    return t.nation.select("n_nationkey", text.alias("text"))


@query("sc_to_json", """
    SELECT n_nationkey, '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' ||
           n_regionkey || '}' AS record FROM nation""")
def _(t):
    return t.nation.select("n_nationkey", sc.record_json("n_nationkey", "n_name", "n_regionkey").alias("record"))


@query("sc_bytes", "SELECT doc_id, CAST(octet_length(encode(text)) AS INTEGER) AS bytes FROM documents")
def _(t):
    return t.documents.select("doc_id", sc.utf8_size("text").alias("bytes"))


@query("sc_text_parts", """
    SELECT p_partkey, lpad(p_name, 27, '0') AS padded, substr(p_name, 3, 4) AS middle, p_brand || '.' || p_type AS joined
    FROM part""")
def _(t):
    return t.part.select("p_partkey", F.lpad("p_name", 27, "0").alias("padded"), F.substring("p_name", 3, 4).alias("middle"),
                         F.concat("p_brand", F.lit("."), "p_type").alias("joined"))


@query("sc_or_default", """
    SELECT event_id, CASE WHEN k = 0 OR k IS NULL THEN -1 ELSE k END AS k
    FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")
def _(t):
    k = sc.tolerant(json_field("props", "k"), "int")
    return t.events.select("event_id", sc.or_default(k, -1).alias("k"))


@query("sc_strip_nul", "SELECT n_nationkey, n_name FROM nation")
def _(t):
    padded = F.concat("n_name", F.lit("\u0000\u0000"))
    return t.nation.select("n_nationkey", sc.strip_nul(padded).alias("n_name"))


@query("sc_marker", "SELECT o_orderkey, o_orderkey // 248 AS marker FROM orders")
def _(t):
    return t.orders.select("o_orderkey", sc.floor_div(F.col("o_orderkey"), 248).alias("marker"))


@query("sc_predicates", """
    SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' OR o_orderpriority LIKE '%URGENT%')
    AND o_totalprice >= 1000 AND o_orderstatus NOT IN ('P') AND o_custkey IS NOT NULL""")
def _(t):
    keep = (F.col("o_orderstatus") == "F") | F.col("o_orderpriority").like("%URGENT%")
    keep = keep & (F.col("o_totalprice") >= 1000) & ~F.col("o_orderstatus").isin("P") & F.col("o_custkey").isNotNull()
    return t.orders.where(keep).select("o_orderkey")


def loaded(t):
    """Ranges that earlier runs covered: of every third page of 1,000 order keys, and every fifth of 700, what they hold."""
    pages = [t.orders.groupBy(F.floor(F.col("o_orderkey") / size).alias("page")).agg(
        F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")).where(F.col("page") % every == 0) for size, every in ((1000, 3), (700, 5))]
    return append_into(*pages).select("low", "high")


LOADED_SQL = """WITH r AS (
    SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders GROUP BY o_orderkey // 1000 HAVING o_orderkey // 1000 % 3 = 0
    UNION ALL SELECT min(o_orderkey), max(o_orderkey) FROM orders GROUP BY o_orderkey // 700 HAVING o_orderkey // 700 % 5 = 0)"""


@query("src_incremental_gaps", LOADED_SQL + """
    SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM r WHERE o_orderkey BETWEEN low AND high)""")
def _(t):
    return not_covered(t.orders.select("o_orderkey", "o_custkey"), loaded(t), "o_orderkey")


# Islands by points: a cursor starts one if it is covered and its forerunner is not.
@query("src_covered_ranges", LOADED_SQL + """,
    p AS (SELECT DISTINCT unnest(range(low, high + 1)) AS c FROM r),
    i AS (SELECT c, c - row_number() OVER (ORDER BY c) AS island FROM p),
    covered AS (SELECT min(c) AS low, max(c) AS high FROM i GROUP BY island)
    SELECT 'covered' AS kind, low, high FROM covered UNION ALL
    SELECT 'gap', last + 1, low - 1 FROM (SELECT low, lag(high) OVER (ORDER BY low) AS last FROM covered) WHERE last IS NOT NULL""")
def _(t):
    ranges = loaded(t)
    return append_into(covered_ranges(ranges).select(F.lit("covered").alias("kind"), "low", "high"),
                       range_gaps(ranges).select(F.lit("gap").alias("kind"), "low", "high"))


@query("snk_batches", """
    SELECT event_id, (n - 1) // 100 + (greatest(b, 1) - 1) // (2000 - greatest(largest, 1) + 1) AS batch FROM (
      SELECT event_id, row_number() OVER (ORDER BY event_id) AS n, CAST(sum(strlen(props)) OVER (ORDER BY event_id) AS BIGINT) AS b,
             max(strlen(props)) OVER () AS largest FROM events)""")
def _(t):
    rows = t.events.select("event_id", F.octet_length("props").alias("size"))
    return publish_batches(rows, "event_id", "size", 100, 2000).select("event_id", "batch")
