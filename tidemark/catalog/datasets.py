"""The named datasets, over ledger events derived from the driver's tables.

Each event family below is written once, as plain expressions that Spark SQL and the oracle's SQL share.  Spark
packs them into JSON payloads and runs the dataset over all families together; the oracle reads the same
expressions as columns, so routing, extraction and everything after are checked against plain SQL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.functions.scalars import epoch_seconds
from tidemark.operators.extract import json_pieces
from tidemark.plans import datasets as ds
from tidemark.plans import dictionaries as fixed


@dataclass
class Family:
    table: str
    number: str  # unique integer per row of the table
    lane: int  # keeps offsets of different families apart
    type: str
    time: str  # epoch seconds
    program: str | None = None
    paths: list[str] = field(default_factory=list)
    values: dict[str, str] = field(default_factory=dict)  # path -> expression; others get a made-up text

    @property
    def offset(self) -> str:
        return f"({self.number} * 16 + {self.lane})"

    def value(self, path: str) -> str:
        return self.values.get(path, f"('{path.replace('.', '-')}-' || {self.number})")


def _typed(name: str, **rest) -> Family:
    _, kind, paths = ds.TYPED[name]
    return Family(type=rest.pop("type", kind), paths=paths, **rest)


_STEP = "1630000000 + {0} * 100"
FAMILIES = {
    "balances": _typed(
        "token_account_balance_changes", table="ordered", number="o_orderkey", lane=0, time="o_seconds",
        values={"pubkey": "('acct-' || o_custkey)", "mint": "('mint-' || c_mktsegment)", "preAmount": "'0'",
                "postAmount": "('' || cents)", "decimals": "'2'", "instructionIndex": "('' || o_orderkey)"}),
    "bondings": _typed(
        "token_bonding_initializes", table="customer", number="c_custkey", lane=1, program=fixed.BONDING_PROGRAM,
        time=_STEP.format("c_custkey"),
        values={"accounts.targetMint": "('mint-' || c_mktsegment)", "accounts.baseStorage": "('acct-' || c_custkey)"}),
    "unclaimed": Family(
        table="customer", number="c_custkey", lane=2, type="initializeUnclaimedSocialTokenV0",
        time=_STEP.format("c_custkey"), program=fixed.COLLECTIVE_PROGRAM,
        paths=[*ds.UNCLAIMED, "accounts.initializeArgs.tokenMetadata"],
        values={"accounts.initializeArgs.tokenMetadata": "('meta-' || c_custkey)"}),
    "metadata": _typed(
        "create_metadata_events", table="customer", number="c_custkey", lane=3, type="CreateMetadataV2",
        program=fixed.METADATA_PROGRAM, time=_STEP.format("c_custkey") + " + CAST(floor(c_acctbal) AS BIGINT)",
        values={"accounts.tokenMetadata": "('meta-' || c_custkey)"}),
    "owned": _typed(
        "collective_create_owned_tokens", table="customer", number="c_custkey", lane=4,
        program=fixed.COLLECTIVE_PROGRAM, time="1632000000 + c_custkey * 1000",
        values={"accounts.owner": "('owner-' || c_nationkey)"}),
    "claims": _typed(
        "collective_token_claims", table="supplier", number="s_suppkey", lane=5, program=fixed.COLLECTIVE_PROGRAM,
        time="1632700000 + s_suppkey * 1000",
        values={"accounts.owner": "('owner-' || s_nationkey)",
                "accounts.tokenBonding": "CASE WHEN s_acctbal < 3000 THEN NULL ELSE ('claimed-' || s_suppkey) END"}),
    "accounts": _typed("accounts", table="part", number="p_partkey", lane=6, time=_STEP.format("p_partkey"),
                       program=fixed.TOKEN_PROGRAM),
    "created": _typed("create_name_events", table="part", number="p_partkey", lane=7,
                      time=_STEP.format("p_partkey"), program=fixed.NAME_PROGRAM),
    "updated": _typed("update_name_events", table="part", number="p_partkey", lane=8,
                      time=_STEP.format("p_partkey"), program=fixed.NAME_PROGRAM),
}
ORDERED = """
    SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CAST(epoch(o_orderdate) AS BIGINT) AS o_seconds
    FROM orders JOIN customer ON o_custkey = c_custkey"""


def family_rows(t, family: Family) -> DataFrame:
    table = t.customer if family.table == "customer" else t.orders if family.table == "ordered" else getattr(t, family.table)
    if family.table == "ordered":
        orders = t.orders
        seconds = epoch_seconds(orders, "o_orderdate")
        table = orders.withColumns({"cents": F.round(F.col("o_totalprice") * 100).cast("bigint"), "o_seconds": seconds})
        table = table.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    paths = sorted([*family.paths, *(["programId"] if family.program else [])])
    pieces, tail = json_pieces(paths)
    values = [f"'{family.program}'" if p == "programId" else family.value(p) for p in paths]
    parts = [f"'{piece}', coalesce('\"' || {value} || '\"', 'null')" for piece, value in zip(pieces, values)]
    payload = F.expr(f"concat({', '.join(parts)}, '{tail}')")
    nothing = F.lit(None).cast("string")
    return table.select(
        F.expr(family.offset).cast("bigint").alias("offset"), F.lit(family.type).alias("type"),
        F.expr(family.number).cast("bigint").alias("slot"), F.expr(family.time).cast("bigint").alias("blockTime"),
        nothing.alias("blockhash"), F.expr(f"'hash-' || {family.number}").alias("recentBlockhash"),
        payload.alias("payload"))


def ledger_events(t) -> DataFrame:
    """All families as one event stream."""
    families = iter(FAMILIES.values())
    events = family_rows(t, next(families))
    for family in families:
        events = events.unionByName(family_rows(t, family))
    return events


def family_sql(name: str, extra: str = "") -> str:
    """The columns a typed stream must have for one family."""
    family = FAMILIES[name]
    source = f"({ORDERED})" if family.table == "ordered" else family.table
    leaves = ", ".join(f'{family.value(p)} AS "{p.rsplit(".", 1)[-1]}"' for p in family.paths)
    return f"""SELECT CAST({family.offset} AS BIGINT) AS seq, CAST({family.number} AS BIGINT) AS slot,
        CAST(NULL AS VARCHAR) AS blockhash, 'hash-' || {family.number} AS "recentBlockhash",
        CAST({family.time} AS BIGINT) AS "blockTime", {leaves}{extra} FROM {source}"""


def _register_routed(stream: str, program: str) -> None:
    families = [n for n, f in FAMILIES.items() if f.program == program]
    sql = " UNION ALL ".join(
        f"SELECT seq AS \"offset\", slot, \"blockTime\", '{FAMILIES[n].type}' AS type FROM ({family_sql(n)})" for n in families)

    @query(f"ds_{stream}", sql)
    def _(t):
        return ds.routed(ledger_events(t), stream).select("offset", "slot", "blockTime", "type")


for _stream, _program in ds.PROGRAMS.items():
    _register_routed(_stream, _program)


def _register_typed(name: str, family: str) -> None:
    @query(f"ds_{name}", family_sql(family))
    def _(t):
        return ds.typed(ledger_events(t), name)


for _name, _family in [
    ("create_metadata_events", "metadata"), ("collective_create_owned_tokens", "owned"),
    ("collective_token_claims", "claims"), ("token_bonding_initializes", "bondings"), ("accounts", "accounts"),
    ("create_name_events", "created"), ("update_name_events", "updated"),
]:
    _register_typed(_name, _family)

CHANGES = f"""SELECT * REPLACE (CAST(decimals AS INTEGER) AS decimals), 'TokenAccountBalanceChange' AS type
    FROM ({family_sql('balances')})"""


@query("ds_token_account_balance_changes", CHANGES)
def _(t):
    return ds.token_account_balance_changes(ledger_events(t))


@query("ds_collective_create_unclaimed_tokens", f"""
    SELECT u.* EXCLUDE ("tokenMetadata"), m.name AS "tokenMetadataName", m.symbol AS "tokenMetadataSymbol",
           m.uri AS "tokenMetadataUri", m."tokenMetadata"
    FROM ({family_sql('unclaimed')}) u JOIN ({family_sql('metadata')}) m ON u."tokenMetadata" = m."tokenMetadata"
    AND abs(u."blockTime" - m."blockTime") <= 7200""")
def _(t):
    return ds.collective_create_unclaimed_tokens(ledger_events(t))


USERS = " UNION ALL ".join(
    f'SELECT seq, {", ".join(chr(34) + c + chr(34) for c in ds.USER)} FROM ({family_sql(f)})' for f in ("claims", "owned"))


@query("ds_collective_users", USERS)
def _(t):
    return ds.collective_users(ledger_events(t))


@query("ds_collective_users_table", "SELECT owner, " + ", ".join(
    f'arg_max("{c}", seq) FILTER (WHERE "{c}" IS NOT NULL) AS "{c}"' for c in ds.USER[1:]) + f" FROM ({USERS}) GROUP BY owner")
def _(t):
    return ds.collective_users_table(ledger_events(t))


def _latest_bonding(key: str) -> str:
    return f'SELECT "{key}", arg_max("tokenBonding", seq) AS "tokenBonding" FROM ({family_sql("bondings")}) GROUP BY "{key}"'


@query("ds_token_bonding_target_mint", _latest_bonding("targetMint"))
def _(t):
    return ds.token_bonding_target_mint(ledger_events(t))


@query("ds_token_bonding_base_storage", _latest_bonding("baseStorage"))
def _(t):
    return ds.token_bonding_base_storage(ledger_events(t))


def _enriched(left: str, right: str) -> str:
    return f"""SELECT c.*, b."tokenBonding" FROM ({CHANGES}) c ASOF JOIN ({family_sql('bondings')}) b
        ON c."{left}" = b."{right}" AND c.seq >= b.seq"""


BONDED, RESERVED = _enriched("mint", "targetMint"), _enriched("pubkey", "baseStorage")


@query("ds_bonding_token_account_balance_changes", BONDED)
def _(t):
    return ds.bonding_token_account_balance_changes(ledger_events(t))


@query("ds_reserve_token_account_balance_changes", RESERVED)
def _(t):
    return ds.reserve_token_account_balance_changes(ledger_events(t))


def _balances(source: str) -> str:
    return f"""SELECT seq, pubkey, type, slot, blockhash, "blockTime", "recentBlockhash",
        TRY_CAST("instructionIndex" AS INTEGER) AS "instructionIndex", TRY_CAST("innerIndex" AS INTEGER) AS "innerIndex",
        mint, TRY_CAST(left(lpad("postAmount", 27, '0'), 25) || '.' || right(lpad("postAmount", 27, '0'), 2)
        AS DECIMAL(27, 9)) AS "tokenAmount", "tokenBonding", decimals
        FROM (SELECT *, max("blockTime") OVER (PARTITION BY pubkey ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING
        AND 1 PRECEDING) AS newest FROM ({source})) WHERE newest IS NULL OR "blockTime" >= newest"""


@query("ds_latest_bonding_token_account_balances", _balances(BONDED))
def _(t):
    return ds.latest_bonding_token_account_balances(ledger_events(t))


@query("ds_latest_bonding_split", _balances(BONDED))
def _(t):
    # Mints and accounts above 3 rows are cut into chunks, so the five hot mints are folded in pieces.
    return ds.latest_bonding_token_account_balances(ledger_events(t), width=20_000)


@query("ds_latest_reserve_token_account_balances", _balances(RESERVED))
def _(t):
    return ds.latest_reserve_token_account_balances(ledger_events(t))


def _watermark(source: str) -> str:
    return f'SELECT pubkey, max("blockTime") AS "maxBlockTime" FROM ({_balances(source)}) GROUP BY pubkey'


@query("ds_bonding_high_watermark", _watermark(BONDED))
def _(t):
    return ds.high_watermark(ds.latest_bonding_token_account_balances(ledger_events(t)))


@query("ds_reserve_high_watermark", _watermark(RESERVED))
def _(t):
    return ds.high_watermark(ds.latest_reserve_token_account_balances(ledger_events(t)))


def _board(source: str, prefix: str, group: str, member: str) -> str:
    return f"""WITH latest AS (SELECT "{group}", "{member}", arg_max("tokenAmount", seq) AS "tokenAmount"
        FROM ({_balances(source)}) GROUP BY "{group}", "{member}")
        SELECT *, '{prefix}' || "{group}" AS board FROM (SELECT *, CAST(row_number() OVER (PARTITION BY "{group}" ORDER BY "tokenAmount" DESC, "{member}"
        DESC) AS INTEGER) AS "rank" FROM latest WHERE "tokenAmount" <> 0) WHERE "rank" <= 10"""


@query("ds_top_holders", _board(BONDED, "accounts-by-balance-", "tokenBonding", "pubkey"))
def _(t):
    return ds.top_holders(ledger_events(t), 10)


@query("ds_top_tokens", _board(RESERVED, "bonding-by-tvl-", "mint", "tokenBonding"))
def _(t):
    return ds.top_tokens(ledger_events(t), 10)


BLOCKS = """SELECT event_id AS "offset", CAST(user_id AS INTEGER) AS slot, event_type <> 'view' AS skipped,
    CASE event_type WHEN 'error' THEN 'node: Block not available for slot' WHEN 'click'
    THEN 'Block ' || user_id || ' cleaned up, does not exist on node' WHEN 'signup' THEN 'rate limit' END AS error FROM events"""
SKIPPED = f"""SELECT "offset", slot AS "key", slot FROM ({BLOCKS}) WHERE skipped AND
    (error LIKE '%Block not available%' OR error LIKE '%cleaned up, does not exist on node%')"""


def blocks(t) -> DataFrame:
    error = F.when(F.col("event_type") == "error", F.lit("node: Block not available for slot")).when(
        F.col("event_type") == "click", F.expr("'Block ' || user_id || ' cleaned up, does not exist on node'")).when(
        F.col("event_type") == "signup", F.lit("rate limit"))
    return t.events.select(F.col("event_id").alias("offset"), F.col("user_id").cast("int").alias("slot"),
                           (F.col("event_type") != "view").alias("skipped"), error.alias("error"))


@query("ds_retriable_blocks", f'SELECT "key", count(*) AS count, "key" AS slot FROM ({SKIPPED}) GROUP BY "key"')
def _(t):
    return ds.retriable_blocks(blocks(t))


@query("ds_raw_retriable_blocks", f"""SELECT *, count(*) OVER (PARTITION BY "key" ORDER BY "offset") AS count
    FROM ({SKIPPED})""")
def _(t):
    return ds.raw_retriable_blocks(blocks(t))


@query("ds_missed_slots", f'SELECT DISTINCT "key", slot FROM ({SKIPPED})')
def _(t):
    return ds.missed_slots(blocks(t))


_LISTED = ", ".join(f"'{a}'" for a in fixed.AWARD_EXCLUDED)


@query("ds_trophies", f"""
    SELECT owner AS "key", '{fixed.AWARD_NAME}' AS "trophyShortName", '{fixed.AWARD_META}' AS "trophyMasterEditionMeta",
           owner AS destination
    FROM (SELECT *, max("blockTime") OVER (PARTITION BY owner ORDER BY seq) * 1000 AS rowtime FROM ({USERS}))
    WHERE rowtime < {fixed.AWARD_CUTOFF_MILLIS} AND owner NOT IN ({_LISTED})""")
def _(t):
    return ds.trophies(ledger_events(t))
