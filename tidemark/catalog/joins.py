"""Join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.catalog.rows import cents
from tidemark.operators import joins as jn
from tidemark.operators.filters import of_type


def kind(t, name: str, **columns: str):
    """Events of one type with the given output names for their columns."""
    rows = of_type(t.events, name, "event_type")
    return rows.select(*[F.col(source).alias(out) for out, source in columns.items()])


INTERVAL_SQL = """
    SELECT s.event_id AS signup_id, p.event_id AS purchase_id, s.user_id
    FROM events s JOIN events p ON s.user_id = p.user_id AND p.ts BETWEEN s.ts - INTERVAL 2 HOUR AND s.ts + INTERVAL 2 HOUR
    WHERE s.event_type = 'signup' AND p.event_type = 'purchase'"""


@query("jn_interval", INTERVAL_SQL)
def _(t):
    signups = kind(t, "signup", signup_id="event_id", user_id="user_id", signup_ts="ts")
    purchases = kind(t, "purchase", purchase_id="event_id", buyer="user_id", purchase_ts="ts")
    pairs = jn.interval_join(signups, purchases, ("user_id", "buyer"), ("signup_ts", "purchase_ts"), 7200)
    return pairs.select("signup_id", "purchase_id", "user_id")


def as_of_sql(left: str, right: str, join: str) -> str:
    return f"""
    SELECT v.event_id, v.user_id, s.props AS seen_props, s.event_id AS seen_id
    FROM (SELECT * FROM events WHERE event_type = '{left}') v
    {join} (SELECT * FROM events WHERE event_type = '{right}') s
    ON v.user_id = s.user_id AND v.event_id >= s.event_id"""


def as_of(t, left: str, right: str, **options):
    asking = kind(t, left, event_id="event_id", user_id="user_id")
    telling = kind(t, right, owner="user_id", at="event_id", seen_props="props", seen_id="event_id")
    return jn.lookup_join(asking, telling, ("user_id", "owner"), ("event_id", "at"), ["seen_props", "seen_id"], **options)


@query("jn_as_of", as_of_sql("view", "signup", "ASOF JOIN"))
def _(t):
    return as_of(t, "view", "signup")


@query("jn_as_of_alt", as_of_sql("click", "purchase", "ASOF JOIN"))
def _(t):
    return as_of(t, "click", "purchase")


@query("jn_left_lookup", as_of_sql("view", "signup", "ASOF LEFT JOIN"))
def _(t):
    return as_of(t, "view", "signup", how="left")


@query("jn_as_of_split", as_of_sql("view", "signup", "ASOF JOIN"))
def _(t):
    # The same join with every key above 20 rows treated as hot and cut into chunks of 500 offsets.
    return as_of(t, "view", "signup", width=500)


@query("jn_latest", """
    SELECT v.event_id, v.user_id, s.seen_props, s.seen_id FROM events v JOIN
    (SELECT user_id, arg_max(props, event_id) AS seen_props, max(event_id) AS seen_id FROM events
     WHERE event_type = 'signup' GROUP BY user_id) s ON v.user_id = s.user_id WHERE v.event_type = 'view'""")
def _(t):
    return as_of(t, "view", "signup", mode="latest")


ZIPPED = """
    SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, a.n AS pre_n, b.n AS post_n,
           coalesce(a.tier, b.tier) AS tier
    FROM (SELECT o_custkey, count(*) AS n, min(o_orderpriority) AS tier FROM orders
          WHERE year(o_orderdate) = 1995 GROUP BY o_custkey) a
    FULL JOIN (SELECT o_custkey, count(*) AS n, min(o_orderpriority) AS tier FROM orders
          WHERE year(o_orderdate) = 1996 GROUP BY o_custkey) b ON a.o_custkey = b.o_custkey"""


def yearly(t, year: int):
    rows = t.orders.where(F.year("o_orderdate") == year)
    return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderpriority").alias("tier"))


@query("jn_zip_changes", f"SELECT * FROM ({ZIPPED}) WHERE pre_n IS DISTINCT FROM post_n")
def _(t):
    return jn.zip_changes(yearly(t, 1995), yearly(t, 1996), ["o_custkey"], "n", shared=["tier"])


@query("jn_zip_last", """
    SELECT coalesce(a.c, b.c) AS c, a.v AS pre_v, b.v AS post_v
    FROM (SELECT o_custkey AS c, arg_max(o_orderstatus, o_orderkey) AS v FROM orders
          WHERE year(o_orderdate) = 1995 GROUP BY 1) a
    FULL JOIN (SELECT o_custkey AS c, arg_max(o_orderstatus, o_orderkey) AS v FROM orders
          WHERE year(o_orderdate) = 1996 GROUP BY 1) b ON a.c = b.c WHERE a.v IS DISTINCT FROM b.v""")
def _(t):
    def side(year):
        return t.orders.where(F.year("o_orderdate") == year).select(
            F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("v"), "o_orderkey")
    return jn.zip_changes(side(1995), side(1996), ["c"], "v", order="o_orderkey")


@query("jn_positional", """
    SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[label + 1] AS DOUBLE) AS own FROM embeddings""")
def _(t):
    return t.embeddings.select(
        "vec_id", jn.at_position("embedding", 0).cast("double").alias("first"),
        jn.at_position("embedding", F.col("label")).cast("double").alias("own"))


@query("jn_dictionary", """
    SELECT n_nationkey, n_name, code FROM nation JOIN (VALUES (0, 'AF'), (2, 'AS'), (3, 'EU')) d(k, code)
    ON n_regionkey = k""")
def _(t):
    codes = t.spark.createDataFrame([(0, "AF"), (2, "AS"), (3, "EU")], "n_regionkey INT, code STRING")
    return jn.with_dictionary(t.nation, codes, ["n_regionkey"]).select("n_nationkey", "n_name", "code")


@query("jn_hydrate", """
    SELECT k.l_orderkey, o.o_orderpriority AS body FROM (SELECT DISTINCT l_orderkey FROM lineitem) k
    LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'F') o ON k.l_orderkey = o.o_orderkey""")
def _(t):
    records = t.orders.where(F.col("o_orderstatus") != "F").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("body"))
    return jn.hydrate(t.lineitem.select("l_orderkey").distinct(), records, "l_orderkey", "body")


@query("jn_hydrate_cap", """
    SELECT p.page_id, d.text IS NULL AS missing FROM pages p LEFT JOIN documents d ON p.page_id = d.doc_id
    WHERE d.text IS NULL OR octet_length(encode(d.text)) <= 2000""")
def _(t):
    records = t.documents.select(F.col("doc_id").alias("page_id"), "text")
    found = jn.hydrate(t.pages.select("page_id"), records, "page_id", "text", max_size=2000)
    return found.select("page_id", F.col("text").isNull().alias("missing"))


@query("jn_enrich", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    return jn.enrich(t.customer, t.nation, ("c_nationkey", "n_nationkey")).select("c_custkey", "n_name")
