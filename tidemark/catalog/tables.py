"""Keyed tables, changelogs, stale-row removal, rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.joins import ZIPPED, yearly
from tidemark.catalog.registry import query
from tidemark.catalog.rows import cents
from tidemark.functions.scalars import epoch_seconds, shift_decimal
from tidemark.operators import aggregates as ag
from tidemark.operators import ranking as rk
from tidemark.operators.filters import like_any, of_type
from tidemark.operators.joins import enrich


@query("ag_count_by", """
    SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey""")
def _(t):
    return ag.count_by(of_type(t.orders, "F", "o_orderstatus"), ["o_custkey"], "o_orderkey", "n")


CHANGELOG_SQL = """
    SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n,
           max(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS top
    FROM orders WHERE o_orderstatus = 'F'"""


def order_changelog(t, **split):
    rows = of_type(t.orders, "F", "o_orderstatus").select("o_orderkey", "o_custkey", "o_orderpriority")
    values = {"n": ("count", "o_orderkey"), "top": ("max", "o_orderpriority")}
    return ag.changelog(rows, ["o_custkey"], values, "o_orderkey", **split).drop("o_orderpriority")


@query("ag_changelog", CHANGELOG_SQL)
def _(t):
    return order_changelog(t)


@query("ag_changelog_split", CHANGELOG_SQL)
def _(t):
    # The same with keys above 3 rows cut into chunks of 1000 offsets.
    return order_changelog(t, width=1000)


@query("ag_latest_by", """
    SELECT user_id, arg_max(props, event_id) FILTER (WHERE event_type = 'signup') AS signup,
           arg_max(props, event_id) FILTER (WHERE event_type = 'error') AS error
    FROM events GROUP BY user_id""")
def _(t):
    def only(name):
        return F.when(F.col("event_type") == name, F.col("props")).alias(name)
    rows = t.events.select("event_id", "user_id", only("signup"), only("error"))
    return ag.latest_by(rows, ["user_id"], ["signup", "error"], "event_id")


@query("ag_max", """
    SELECT o_custkey, CAST(max(epoch(o_orderdate)) AS BIGINT) AS newest FROM orders GROUP BY o_custkey""")
def _(t):
    orders = t.orders
    return ag.max_by_key(orders.select("o_custkey", epoch_seconds(orders, "o_orderdate").alias("at")),
                         ["o_custkey"], "at", "newest")


@query("ag_global_last", """
    SELECT arg_max(o_custkey, o_orderkey) AS o_custkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
    FROM orders""")
def _(t):
    return ag.latest_by(t.orders, [], ["o_custkey", "o_orderpriority"], "o_orderkey")


@query("ag_collect", """
    SELECT o_custkey, page, string_agg(o_orderkey || '=' || o_orderstatus, ',' ORDER BY o_orderkey) AS items
    FROM (SELECT *, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4 AS page FROM orders)
    GROUP BY o_custkey, page""")
def _(t):
    pages = ag.collect_pages(t.orders, "o_custkey", "o_orderkey", ["o_orderstatus"], page_size=4)
    text = F.transform("items", lambda i: F.concat_ws("=", i["o_orderkey"].cast("string"), i["o_orderstatus"]))
    return pages.select("o_custkey", "page", F.array_join(text, ",").alias("items"))


@query("ag_upsert_stats", f"""
    SELECT count(*) AS members, count(*) FILTER (WHERE pre_n IS DISTINCT FROM post_n) AS changed FROM ({ZIPPED})""")
def _(t):
    return ag.upsert_stats(yearly(t, 1995), yearly(t, 1996), ["o_custkey"], "n")


@query("wn_first", """
    SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
    FROM events WHERE event_type = 'error' AND props LIKE '%9%') WHERE rn = 1""")
def _(t):
    errors = like_any(of_type(t.events, "error", "event_type"), "props", ["%9%"])
    return ag.first_per_key(errors, ["user_id"], "event_id").select("event_id", "user_id")


MONOTONE_SQL = """
    SELECT o_orderkey, o_custkey FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM orders)
    WHERE newest IS NULL OR o_orderdate >= newest"""


@query("wn_monotone", MONOTONE_SQL)
def _(t):
    return ag.monotone(t.orders, "o_custkey", "o_orderdate", "o_orderkey").select("o_orderkey", "o_custkey")


@query("wn_monotone_split", MONOTONE_SQL)
def _(t):
    # The same with keys above 5 rows cut into chunks of 700 offsets.
    kept = ag.monotone(t.orders, "o_custkey", "o_orderdate", "o_orderkey", width=700)
    return kept.select("o_orderkey", "o_custkey")


def top_customers(t) -> DataFrame:
    """Who are the top-10 customers of each nation by their latest order amount, ignoring stale updates?"""
    amount = shift_decimal(cents("o_totalprice").cast("string"), F.lit(2))
    changes = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", amount.alias("amount"))
    fresh = ag.monotone(changes, "o_custkey", "o_orderdate", "o_orderkey")
    # A customer has one nation, so the rows are reduced to one per customer before the join.
    latest = rk.apply_scores(None, fresh.withColumn("board", F.lit("amount")), "board", "o_custkey", "amount", "o_orderkey")
    scored = enrich(latest, t.customer.select("c_custkey", "c_nationkey"), ("o_custkey", "c_custkey"))
    best = rk.leaderboard(scored, "c_nationkey", "o_custkey", "amount", 10)
    return best.select("c_nationkey", "o_custkey", "amount", "rank")


@query("wn_leaderboard", f"""
    WITH fresh AS ({MONOTONE_SQL}),
    latest AS (SELECT o.o_custkey, arg_max(o.o_totalprice, o.o_orderkey) AS price FROM orders o
               JOIN fresh f ON o.o_orderkey = f.o_orderkey GROUP BY o.o_custkey),
    scored AS (SELECT c_nationkey, o_custkey,
                      CAST(CAST(CAST(round(price * 100) AS BIGINT) AS DECIMAL(27, 9)) / 100 AS DECIMAL(27, 9)) AS amount
               FROM latest LEFT JOIN customer ON o_custkey = c_custkey),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY amount DESC, o_custkey DESC) AS "rank"
               FROM scored WHERE amount <> 0)
    SELECT c_nationkey, o_custkey, amount, CAST("rank" AS INTEGER) AS "rank" FROM ranked WHERE "rank" <= 10""")
def _(t):
    return top_customers(t)


@query("wn_rank_all", """
    SELECT c_mktsegment, c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS score, row_number() OVER
    (PARTITION BY c_mktsegment ORDER BY round(c_acctbal * 100) DESC, c_custkey DESC) AS "rank" FROM customer""")
def _(t):
    scores = t.customer.select("c_mktsegment", "c_custkey", cents("c_acctbal").alias("score"))
    return rk.leaderboard(scores, "c_mktsegment", "c_custkey", "score")


NUMBER_SQL = """
    WITH supply AS (SELECT user_id, count(*) AS supply FROM events WHERE event_type = 'purchase'
                    AND ts < TIMESTAMP '2024-01-10' GROUP BY user_id),
    numbered AS (SELECT e.event_id, e.user_id, coalesce(s.supply, 0) + row_number() OVER
                 (PARTITION BY e.user_id ORDER BY e.event_id) AS edition FROM events e LEFT JOIN supply s
                 ON e.user_id = s.user_id WHERE e.event_type = 'purchase' AND e.ts >= TIMESTAMP '2024-01-10')
    SELECT event_id, user_id, CAST(edition AS BIGINT) AS edition, CAST(edition // 248 AS BIGINT) AS marker FROM numbered"""


def numbered_purchases(t, **split):
    purchases = of_type(t.events, "purchase", "event_type").select("event_id", "user_id", "ts")
    early = F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'")
    supply = ag.count_by(purchases.where(early), ["user_id"], "event_id", "supply")
    return rk.next_number(purchases.where(~early).drop("ts"), supply, "user_id", "event_id", **split)


@query("wn_next_number", NUMBER_SQL)
def _(t):
    return numbered_purchases(t)


@query("wn_next_number_split", NUMBER_SQL)
def _(t):
    # The same with keys above 5 rows cut into chunks of 500 offsets.
    return numbered_purchases(t, width=500)
