"""Keyed state over streams: latest values, first occurrence, dedup, stale-row removal, changelog, table lookup.

The last three take a key's rows of one micro-batch in one task: bound the micro-batch at the source, or use the forms
in ``batches``, which cut hot keys.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.aggregates import latest_by


def latest_table(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str) -> DataFrame:
    """Latest non-NULL value per key and column; write it in update mode."""
    return latest_by(df, keys, columns, order)


def first_seen(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first row per key, ever; the set of seen keys is kept for good."""
    return df.dropDuplicates(list(keys))


def dedup_within(df: DataFrame, keys: Sequence[str], time: str, horizon: str) -> DataFrame:
    """Drop repeats of a key that arrive within ``horizon`` of its first row; older keys are forgotten."""
    return df.withWatermark(time, horizon).dropDuplicatesWithinWatermark(list(keys))


def monotone_stream(df: DataFrame, key: str, time: str, order: str, ttl: int | None = None) -> DataFrame:
    """Streaming form of ``monotone``: state per key is one number, the newest accepted time.

    ``time`` is an integer or TIMESTAMP column.  A key's rows of a micro-batch are taken in ``order``, so bound
    the batch at the source.  ``ttl`` (milliseconds) forgets idle keys.
    """
    def keep(rows: pd.DataFrame, state: str | None):
        newest, passed = None if state is None else int(state), []
        for value in rows["__time"]:
            now = None if value is None else int(value)
            fine = newest is None or (now is not None and now >= newest)
            passed.append(fine)
            if fine and now is not None:
                newest = now
        return rows[passed], None if newest is None else str(newest)

    whole = F.unix_micros(time) if isinstance(df.schema[time].dataType, T.TimestampType) else F.col(time)
    return _fold_rows(df.withColumn("__time", whole.cast("bigint")), key, [order], keep, ttl).drop("__time")


def count_stream(df: DataFrame, key: str, order: str, out: str = "count", ttl: int | None = None) -> DataFrame:
    """Row-exact changelog of a count: every input row with the number of rows of its key so far."""
    def number(rows: pd.DataFrame, state: str | None):
        seen = int(state or 0)
        return rows.assign(**{out: [str(seen + i + 1) for i in range(len(rows))]}), str(seen + len(rows))

    return _fold_rows(df.withColumn(out, F.lit(0).cast("bigint")), key, [order], number, ttl)


def lookup_stream(
    events: DataFrame, updates: DataFrame, on: tuple[str, str], order: tuple[str, str], values: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Streaming form of ``lookup_join``: both sides are streams, only events give rows.

    State per key is the table row: the latest non-NULL value of each column.  Inside a micro-batch updates and
    events are taken in their common order; an update that arrives in a later batch does not change earlier rows.
    """
    held = [f"__held_{v}" for v in values]
    asking = events.select("*", F.col(order[0]).alias("__order"), F.lit(1).alias("__side"))
    telling = updates.select(
        F.col(on[1]).alias(on[0]), F.col(order[1]).alias("__order"), F.lit(0).alias("__side"),
        *[F.col(v).alias(h) for v, h in zip(values, held)],
    )
    both = asking.unionByName(telling, allowMissingColumns=True).where(F.col(on[0]).isNotNull())

    def answer(rows: pd.DataFrame, state: str | None):
        table, out = None if state is None else json.loads(state), []
        for row in rows.to_dict("records"):
            if row["__side"] == "0":
                table = {h: (table or {}).get(h) if row[h] is None else row[h] for h in held}
            elif table is not None or how == "left":
                out.append({**row, **(table or {})})
        return pd.DataFrame(out, columns=rows.columns, dtype=object), None if table is None else json.dumps(table)

    found = _fold_rows(both, on[0], ["__order", "__side"], answer, None)
    return found.select(*events.columns, *[F.col(h).alias(v) for v, h in zip(values, held)])


def _fold_rows(df: DataFrame, key: str, order: Sequence[str], step, ttl: int | None) -> DataFrame:
    """Run ``step(ordered rows, state text) -> (rows, state text)`` per key and micro-batch.

    All columns travel as text and are cast back, so nullable integers and decimals stay exact.
    """
    names = df.columns

    def fold(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches), ignore_index=True).astype(object)
        rows = rows.where(rows.notna(), None)
        places = pd.DataFrame({o: rows[o].map(int) for o in order}).sort_values(list(order)).index
        kept, value = step(rows.loc[places], state.get[0] if state.exists else None)
        if value is not None:
            state.update((value,))
            if ttl:
                state.setTimeoutDuration(ttl)
        yield kept[names]

    text = df.where(F.col(key).isNotNull()).select(*[F.col(c).cast("string") for c in names])
    kept = text.groupBy(key).applyInPandasWithState(
        fold, ", ".join(f"`{c}` STRING" for c in names), "value STRING", "append",
        GroupStateTimeout.ProcessingTimeTimeout if ttl else GroupStateTimeout.NoTimeout,
    )
    return kept.select(*[F.col(f.name).cast(f.dataType) for f in df.schema.fields])
