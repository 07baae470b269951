"""Message requests as tables: flatten, classify, reply, announce, award."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import fill_template, shout
from tidemark.operators.filters import eligible, maybe_eq, not_self
from tidemark.operators.joins import enrich
from tidemark.plans.dictionaries import OPT_OUT_COMMAND, OPT_OUT_DONE

RAW_MESSAGE = (
    "id STRING, created_timestamp STRING, "
    "message_create STRUCT<sender_id: STRING, message_data: STRUCT<text: STRING>>"
)


def flatten_messages(raw: DataFrame, users: DataFrame) -> DataFrame:
    """Nested message events as flat rows with the sender's handle and name; other events are dropped.

    ``users`` has unique ``userId`` with ``handle`` and ``name``.
    """
    flat = raw.where(F.col("message_create").isNotNull()).select(
        F.col("message_create.message_data.text").alias("body"), "id",
        F.col("message_create.sender_id").alias("__sender"), F.col("created_timestamp").alias("createdTimestamp"),
    )
    return enrich(flat, users, ("__sender", "userId")).select(
        "handle", "name", "body", "id", F.col("__sender").alias("userId"), "createdTimestamp"
    )


def classify_requests(messages: DataFrame, entities: DataFrame, me, wrong_reply: str) -> DataFrame:
    """Add ``error``, ``optedOut`` and ``tokenRef`` to messages not sent by ``me``; the first case that holds wins.

    ``entities`` has unique ``handle`` with ``tokenRef`` and ``isOptedOut``.
    """
    known = entities.select(
        F.col("handle").alias("__handle"), F.col("tokenRef").alias("__ref"), F.col("isOptedOut").alias("__out")
    )
    rows = enrich(not_self(messages, "handle", me), known, ("handle", "__handle"))
    handle = F.coalesce(F.col("handle").cast("string"), F.lit(""))
    asked = F.coalesce(shout("body") == OPT_OUT_COMMAND, F.lit(False))
    error = (
        F.when(~asked, F.lit(wrong_reply))
        .when(F.col("__ref").isNull(), F.concat(F.lit("No social token was found for "), handle))
        .when(F.col("__out"), F.concat(handle, F.lit(" has already been opted out")))
    )
    judged = rows.withColumn("error", error)
    fine = F.col("error").isNull()
    return judged.select(
        *messages.columns, "error", F.when(fine, F.lit(True)).alias("optedOut"),
        F.when(fine, F.col("__ref")).alias("tokenRef"),
    )


def reply_outbox(results: DataFrame) -> DataFrame:
    """One reply per result with a user id: its error, else the success text, else no text."""
    text = F.coalesce(F.nullif("error", F.lit("")), F.when(F.col("optedOut"), F.lit(OPT_OUT_DONE)))
    addressed = results.where(F.coalesce(F.col("userId").cast("string"), F.lit("")) != "")
    return addressed.select("userId", text.alias("text"))


def announce_outbox(tokens: DataFrame, template: str, collective: str | None = None) -> DataFrame:
    """One announcement per new token, of one collective when given; ``{handle}`` becomes the token's name."""
    chosen = maybe_eq(tokens, "collective", collective)
    return chosen.select(
        F.col("tokenMetadataName").alias("handle"),
        fill_template(template, handle="tokenMetadataName").alias("text"),
    )


def award_requests(
    users: DataFrame, owner: str, time: str, before: Column, exclude: Iterable | DataFrame, name: str, meta: str
) -> DataFrame:
    """Award rows for users recorded before a cutoff and not excluded."""
    return eligible(users, time, before, owner, exclude).select(
        F.col(owner).alias("key"), F.lit(name).alias("trophyShortName"),
        F.lit(meta).alias("trophyMasterEditionMeta"), F.col(owner).alias("destination"),
    )
