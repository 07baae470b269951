"""From record ids to the event stream: merge id topics, drop repeats, fetch transactions, extract events."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import dedup
from tidemark.operators.extract import (
    TRANSACTION, Extractor, balance_array, balance_changes, extract_once, instruction_array, instruction_events,
)
from tidemark.operators.filters import MAX_RECORD_BYTES, has_body
from tidemark.operators.joins import hydrate
from tidemark.plans import dictionaries as fixed
from tidemark.sources.topics import match_topics


def extractors(interfaces: Iterable[dict] = ()) -> dict[str, Extractor]:
    """The event extractors by name: balance changes, and the commands of all known programs.

    ``interfaces`` are interface definitions of further programs.  All commands share one pass over the
    instructions.  To add an extractor, add a function from transactions to events to the result.
    """
    commands = fixed.opcode_commands() + [c for idl in interfaces for c in fixed.idl_commands(idl)]
    return {
        "balances": balance_changes,
        "instructions": lambda txns: instruction_events(txns, commands),
    }


def unique_ids(records: DataFrame, pattern: str, key: str = "key", order: str = "offset") -> DataFrame:
    """The first record of every id over all id topics matching ``pattern``."""
    return dedup(match_topics(records, pattern), [key], order)


def fetch_transactions(
    ids: DataFrame, store: DataFrame, on: str, value: str = "value", max_size: int | None = MAX_RECORD_BYTES
) -> DataFrame:
    """The stored transaction (JSON text) of each id, parsed; unknown ids and oversize records are dropped."""
    found = has_body(hydrate(ids.select(on), store.select(on, value), on, value, max_size), value)
    return found.select(on, F.from_json(value, TRANSACTION).alias("__t")).select(on, "__t.*")


def event_stream(txns: DataFrame, interfaces: Iterable[dict] = (), more: Iterable[Column] = ()) -> DataFrame:
    """All events of complete, successful transactions, found in one pass.

    ``more`` are further extractors: arrays of :data:`tidemark.operators.extract.FOUND` computed inside the row.
    """
    commands = fixed.opcode_commands() + [c for idl in interfaces for c in fixed.idl_commands(idl)]
    programs = {c["programId"] for c in commands}
    return extract_once(txns, [balance_array(), instruction_array(programs), *more], commands)
