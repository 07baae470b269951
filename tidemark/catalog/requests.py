"""Request, reply and award tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.operators import requests as rq
from tidemark.operators.aggregates import count_by
from tidemark.operators.ranking import next_number

WRONG = "Send OPT OUT to leave."
CLASSIFIED = f"""
    SELECT e.event_id AS id, e.user_id AS handle, e.user_id AS "userId",
      CASE WHEN e.event_type <> 'signup' THEN '{WRONG}'
           WHEN c.c_custkey IS NULL THEN 'No social token was found for ' || e.user_id
           WHEN c.c_acctbal < 0 THEN e.user_id || ' has already been opted out' END AS error,
      CASE WHEN e.event_type = 'signup' AND c.c_acctbal >= 0 THEN true END AS "optedOut",
      CASE WHEN e.event_type = 'signup' AND c.c_acctbal >= 0 THEN c.c_name END AS "tokenRef"
    FROM events e LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON e.user_id = c.c_custkey"""


def classified(t, me=None):
    body = F.when(F.col("event_type") == "signup", F.lit(" opt out ")).otherwise(F.col("event_type"))
    messages = t.events.select(F.col("event_id").alias("id"), F.col("user_id").alias("handle"),
                               F.col("user_id").alias("userId"), body.alias("body"))
    entities = t.customer.where(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("handle"), F.col("c_name").alias("tokenRef"), (F.col("c_acctbal") < 0).alias("isOptedOut"))
    return rq.classify_requests(messages, entities, -1, WRONG)


@query("rq_classify", CLASSIFIED)
def _(t):
    return classified(t).drop("body")


@query("rq_replies", f"""
    SELECT "userId", coalesce(error, CASE WHEN "optedOut" THEN 'Opt Out Successful! We''re sorry to see you go.' END)
    AS text FROM ({CLASSIFIED})""")
def _(t):
    return rq.reply_outbox(classified(t))


@query("rq_announce", """
    SELECT n_name AS handle, 'Say hello to ' || n_name || '!' AS text FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE r_name = 'ASIA'
    UNION ALL SELECT n_name, 'New: ' || n_name FROM nation""")
def _(t):
    tokens = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("tokenMetadataName"), F.col("r_name").alias("collective"))
    return rq.announce_outbox(tokens, "Say hello to {handle}!", "ASIA").unionByName(
        rq.announce_outbox(tokens, "New: {handle}"))


@query("rq_awards", """
    WITH early AS (SELECT event_id, user_id FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-10'
                   AND user_id NOT IN (1, 2, 3))
    SELECT user_id AS "key", 'alpha_tester' AS "trophyShortName", 'meta' AS "trophyMasterEditionMeta",
           user_id AS destination FROM early""")
def _(t):
    users = t.events.where(F.col("event_type") == "signup")
    cutoff = F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'")
    return rq.award_requests(users, "user_id", "ts", cutoff, [1, 2, 3], "alpha_tester", "meta")


@query("rq_award_numbers", """
    WITH supply AS (SELECT c_nationkey, count(*) AS supply FROM customer WHERE c_acctbal < 0 GROUP BY 1)
    SELECT c.c_custkey, c.c_nationkey, CAST(coalesce(s.supply, 0) + row_number() OVER
           (PARTITION BY c.c_nationkey ORDER BY c.c_custkey) AS BIGINT) AS edition
    FROM customer c LEFT JOIN supply s ON c.c_nationkey = s.c_nationkey WHERE c.c_acctbal >= 0""")
def _(t):
    supply = count_by(t.customer.where(F.col("c_acctbal") < 0), ["c_nationkey"], "c_custkey", "supply")
    asked = t.customer.where(F.col("c_acctbal") >= 0).select("c_custkey", "c_nationkey")
    return next_number(asked, supply, "c_nationkey", "c_custkey").drop("marker")


@query("rq_flatten", """
    SELECT c.c_custkey AS handle, c.c_name AS name, m.text AS body, m.conv_id || '-' || m.turn AS id,
           '' || m.conv_id AS "userId", '' || m.turn AS "createdTimestamp"
    FROM conversations m LEFT JOIN customer c ON m.conv_id = c.c_custkey WHERE m.role = 'user'""")
def _(t):
    created = F.struct(F.col("conv_id").cast("string").alias("sender_id"),
                       F.struct(F.col("text")).alias("message_data"))
    raw = t.conversations.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.col("turn").cast("string").alias("created_timestamp"),
        F.when(F.col("role") == "user", created).alias("message_create"))
    users = t.customer.select(F.col("c_custkey").cast("string").alias("userId"), F.col("c_custkey").alias("handle"),
                              F.col("c_name").alias("name"))
    return rq.flatten_messages(raw, users)
