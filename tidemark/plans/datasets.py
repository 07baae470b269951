"""The named datasets: every routed stream, typed stream, keyed table and enriched stream over ledger events.

Inputs are event rows (``type, slot, blockTime, blockhash, recentBlockhash, payload``) plus an ``offset`` column
that orders them totally; it is carried through every dataset, so "latest" always means offset order.
A typed stream is one plan from the event scan on.  The enriched and latest balances pass over their input more
than once, so they first write it as a narrow Parquet table (``save``); that parses each payload once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.json_text import json_field, json_fields
from tidemark.functions.scalars import shift_decimal, tolerant
from tidemark.operators.aggregates import changelog, count_by, first_per_key, latest_by, max_by_key, monotone, present
from tidemark.operators.filters import like_any, of_type
from tidemark.operators.joins import interval_join, lookup_join
from tidemark.operators.ranking import apply_scores, leaderboard
from tidemark.operators.requests import award_requests
from tidemark.plans import dictionaries as fixed
from tidemark.session import save_table
from tidemark.streaming.sinks import append_into

Save = Callable[[DataFrame, str], DataFrame]

EVENT = ["slot", "blockhash", "recentBlockhash", "blockTime"]
USER = ["owner", "tokenRef", "reverseTokenRef", "tokenBonding", "blockTime", "collective"]
JOIN_WITHIN_SECONDS = 2 * 60 * 60

# Routed stream -> program id.
PROGRAMS = {
    "spl_token_collective_events": fixed.COLLECTIVE_PROGRAM,
    "spl_token_bonding_events": fixed.BONDING_PROGRAM,
    "spl_token_metadata_events": fixed.METADATA_PROGRAM,
    "spl_name_service_events": fixed.NAME_PROGRAM,
}

# Typed stream -> (source stream, event type or None, payload paths; a column is named after the
# last part of its path).
_ROYALTIES = "buyBaseRoyalties buyTargetRoyalties sellBaseRoyalties sellTargetRoyalties"
_START = ["instructionIndex", "innerIndex"]


def _under(prefix: str, names: str) -> list[str]:
    return [f"{prefix}.{name}" for name in names.split()]


TYPED = {
    "create_metadata_events": ("spl_token_metadata_events", None, [
        *_START, *_under("data.data", "name symbol uri sellerFeeBasisPoints"),
        *_under("accounts", "tokenMetadata mint mintAuthority payer updateAuthority")]),
    "collective_create_owned_tokens": ("spl_token_collective_events", "initializeOwnedSocialTokenV0", [
        *_START, *_under("data.args", "nameParent nameClass"),
        *_under("accounts.initializeArgs", f"payer collective tokenBonding {_ROYALTIES} targetMint tokenMetadata"),
        *_under("accounts", "owner reverseTokenRef tokenRef")]),
    "collective_token_claims": ("spl_token_collective_events", "claimSocialTokenV0", [
        *_START, *_under("accounts", "collective tokenRef newTokenRef reverseTokenRef tokenBonding "
                         "tokenBondingAuthority newBuyBaseRoyalties newBuyTargetRoyalties newSellBaseRoyalties "
                         "newSellTargetRoyalties name owner")]),
    "token_bonding_initializes": ("spl_token_bonding_events", "initializeTokenBondingV0", [
        *_START, *_under("data.args", "buyBaseRoyaltyPercentage buyTargetRoyaltyPercentage "
                         "sellBaseRoyaltyPercentage sellTargetRoyaltyPercentage targetRoyaltyPercentage mintCap "
                         "purchaseCap goLiveUnixTime freezeBuyUnixTime generalAuthority reserveAuthority "
                         "curveAuthority buyFrozen"),
        *_under("accounts", f"payer tokenBonding curve baseMint targetMint {_ROYALTIES} baseStorage "
                "baseStorageAuthority")]),
    "token_account_balance_changes": ("solana_events", "TokenAccountBalanceChange", [
        *_START, "pubkey", "mint", "preAmount", "postAmount", "decimals"]),
    "accounts": ("solana_events", "InitializeTokenAccount", [
        *_START, *_under("accounts", "account mint owner")]),
    "create_name_events": ("spl_name_service_events", "CreateNameServiceName", [
        *_START, *_under("data", "hashedName lamports space"),
        *_under("accounts", "name owner class parent parentOwner")]),
    "update_name_events": ("spl_name_service_events", "UpdateNameServiceName", [
        *_START, *_under("data", "offset data"), *_under("accounts", "name ownerOrClass")]),
}
# Payload paths of a newly created unclaimed token (the metadata columns come from the join).
UNCLAIMED = [
    *_START, *_under("data.args", "nameParent nameClass"),
    *_under("accounts.initializeArgs", f"payer collective tokenBonding {_ROYALTIES} targetMint"),
    *_under("accounts", "name reverseTokenRef tokenRef"),
]


def _leaf(path: str) -> str:
    return path.rsplit(".", 1)[-1]


def routed(events: DataFrame, stream: str) -> DataFrame:
    """Events of one program (or all of them for the source stream itself)."""
    if stream not in PROGRAMS:
        return events
    return events.where(json_field("payload", "programId") == PROGRAMS[stream])


def typed(events: DataFrame, name: str, order: str = "offset") -> DataFrame:
    """A typed stream: events of its program and type with their payload fields as text columns.

    The order column is called ``seq`` there, because ``offset`` is also the name of a payload field.
    """
    stream, kind, paths = TYPED[name]
    rows = events if kind is None else of_type(events, kind)
    head = [*EVENT, "type"] if stream == "solana_events" and name != "accounts" else EVENT
    return _flatten(routed(rows, stream).select(F.col(order).alias("seq"), *head, "payload"), paths)


def _flatten(rows: DataFrame, paths: list[str]) -> DataFrame:
    """Replace the payload by its fields."""
    return json_fields(rows, "payload", {_leaf(p): p for p in paths}).drop("payload")


def collective_create_unclaimed_tokens(events: DataFrame, within: int = JOIN_WITHIN_SECONDS) -> DataFrame:
    """New unclaimed tokens with the metadata created for them within two hours before or after."""
    tokens = of_type(routed(events, "spl_token_collective_events"), "initializeUnclaimedSocialTokenV0")
    # Fields and join key come from one parse, and the payload stays out of the join's shuffle.
    fields = {**{_leaf(p): p for p in UNCLAIMED}, "__wanted": "accounts.initializeArgs.tokenMetadata"}
    rows = tokens.select(F.col("offset").alias("seq"), *EVENT, "payload", _rowtime("__at"))
    left = json_fields(rows, "payload", fields).drop("payload")
    right = typed(events, "create_metadata_events").select(
        F.col("name").alias("tokenMetadataName"), F.col("symbol").alias("tokenMetadataSymbol"),
        F.col("uri").alias("tokenMetadataUri"), "tokenMetadata", _rowtime("__made"),
    )
    pairs = interval_join(left, right, ("__wanted", "tokenMetadata"), ("__at", "__made"), within)
    found = ["tokenMetadataName", "tokenMetadataSymbol", "tokenMetadataUri", "tokenMetadata"]
    return pairs.select("seq", *EVENT, *found, *[_leaf(p) for p in UNCLAIMED])


def _rowtime(out: str):
    """Record time in epoch seconds; a missing block time counts as 0."""
    return F.coalesce("blockTime", F.lit(0).cast("bigint")).alias(out)


def token_account_balance_changes(events: DataFrame) -> DataFrame:
    rows = typed(events, "token_account_balance_changes")
    return rows.withColumn("decimals", tolerant("decimals", "int"))


def collective_users(events: DataFrame) -> DataFrame:
    """Owners as they appear in claims and in newly owned tokens (claims carry the old token reference)."""
    return append_into(
        *[typed(events, name).select("seq", *USER)
          for name in ("collective_token_claims", "collective_create_owned_tokens")]
    )


def collective_users_table(events: DataFrame) -> DataFrame:
    return latest_by(collective_users(events), ["owner"], USER[1:], "seq")


def token_bonding_target_mint(events: DataFrame) -> DataFrame:
    return latest_by(typed(events, "token_bonding_initializes"), ["targetMint"], ["tokenBonding"], "seq")


def token_bonding_base_storage(events: DataFrame) -> DataFrame:
    return latest_by(typed(events, "token_bonding_initializes"), ["baseStorage"], ["tokenBonding"], "seq")


def bonding_token_account_balance_changes(
    events: DataFrame, mode: str = "as_of", save: Save = save_table, **split
) -> DataFrame:
    """Balance changes of accounts that hold a bonded token."""
    return _with_bonding(events, "mint", "targetMint", mode, save, split)


def reserve_token_account_balance_changes(
    events: DataFrame, mode: str = "as_of", save: Save = save_table, **split
) -> DataFrame:
    """Balance changes of reserve accounts."""
    return _with_bonding(events, "pubkey", "baseStorage", mode, save, split)


def _with_bonding(events: DataFrame, left: str, right: str, mode: str, save: Save, split: dict) -> DataFrame:
    changes = token_account_balance_changes(events)
    updates = typed(events, "token_bonding_initializes").select(right, "tokenBonding", "seq")
    if mode == "as_of":
        changes, updates = save(changes, "balance-changes"), save(updates, "bondings")
    return lookup_join(changes, updates, (left, right), ("seq", "seq"), ["tokenBonding"], mode=mode, **split)


def latest_bonding_token_account_balances(
    events: DataFrame, mode: str = "as_of", save: Save = save_table, **split
) -> DataFrame:
    """Bonded balances without stale rows, amounts scaled to decimals."""
    return _latest_balances(bonding_token_account_balance_changes(events, mode, save, **split), save, split)


def latest_reserve_token_account_balances(
    events: DataFrame, mode: str = "as_of", save: Save = save_table, **split
) -> DataFrame:
    """Reserve balances without stale rows, amounts scaled to decimals."""
    return _latest_balances(reserve_token_account_balance_changes(events, mode, save, **split), save, split)


def _latest_balances(changes: DataFrame, save: Save, split: dict) -> DataFrame:
    fresh = monotone(save(changes, "enriched-changes"), "pubkey", "blockTime", "seq", **split)
    return fresh.select(
        "seq", "pubkey", "type", "slot", "blockhash", "blockTime", "recentBlockhash",
        tolerant("instructionIndex", "int").alias("instructionIndex"),
        tolerant("innerIndex", "int").alias("innerIndex"), "mint",
        shift_decimal("postAmount", "decimals").alias("tokenAmount"), "tokenBonding", "decimals",
    )


def high_watermark(balances: DataFrame) -> DataFrame:
    """Newest accepted block time per account."""
    return max_by_key(balances, ["pubkey"], "blockTime", "maxBlockTime")


def top_holders(events: DataFrame, k: int | None = None, mode: str = "as_of", save: Save = save_table) -> DataFrame:
    """Holders per token by balance, on one board per token."""
    balances = latest_bonding_token_account_balances(events, mode, save)
    return _board(balances, "accounts-by-balance-", "tokenBonding", "pubkey", k)


def top_tokens(events: DataFrame, k: int | None = None, mode: str = "as_of", save: Save = save_table) -> DataFrame:
    """Tokens by value locked, on one board per reserve mint."""
    balances = latest_reserve_token_account_balances(events, mode, save)
    return _board(balances, "bonding-by-tvl-", "mint", "tokenBonding", k)


# Leaderboards by the name they are configured with; the first is the default.
BOARDS = {"ACCOUNT": top_holders, "TOP_TOKENS": top_tokens}


def _board(balances: DataFrame, prefix: str, group: str, member: str, k: int | None) -> DataFrame:
    scores = apply_scores(None, balances, group, member, "tokenAmount", "seq")
    ranked = leaderboard(scores, group, member, "tokenAmount", k)
    return ranked.withColumn("board", F.concat(F.lit(prefix), group))


def _skipped(blocks: DataFrame) -> DataFrame:
    rows = like_any(blocks.where(F.col("skipped")), "error", fixed.RETRIABLE_ERRORS)
    return rows.withColumn("key", F.col("slot"))


def retriable_blocks(blocks: DataFrame) -> DataFrame:
    """Per slot, how often its block was reported as not available yet."""
    return count_by(_skipped(blocks), ["key"], "slot").withColumn("slot", F.col("key"))


def raw_retriable_blocks(blocks: DataFrame, **split) -> DataFrame:
    """Every update of that count."""
    return changelog(_skipped(blocks), ["key"], {"count": ("count", "slot")}, "offset", **split).select(
        "offset", "key", "slot", "count")


def missed_slots(blocks: DataFrame) -> DataFrame:
    """A slot once, when its count becomes 1: at its first row (map tasks keep one row per slot)."""
    return first_per_key(_skipped(blocks).where(present(["key"])), ["key"], "offset").select("key", "slot")


def trophies(events: DataFrame, **split) -> DataFrame:
    """Award requests: one per update of an early user who is not excluded."""
    users = collective_users(events).withColumn("__seconds", F.coalesce("blockTime", F.lit(0).cast("bigint")))
    updates = changelog(users, ["owner"], {"rowtime": ("max", "__seconds")}, "seq", **split)
    millis = updates.withColumn("rowtime", F.col("rowtime") * 1000)
    return award_requests(millis, "owner", "rowtime", F.lit(fixed.AWARD_CUTOFF_MILLIS), fixed.AWARD_EXCLUDED,
                          fixed.AWARD_NAME, fixed.AWARD_META)
