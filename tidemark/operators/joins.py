"""Joins: interval, as-of and latest lookups, zip of two snapshots, dictionary, hydration, enrichment."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import epoch_seconds, floor_div
from tidemark.operators.aggregates import latest_by, latest_rows
from tidemark.operators.filters import MAX_RECORD_BYTES, max_bytes
from tidemark.operators.running import Running, running


def interval_join(
    left: DataFrame, right: DataFrame, on: tuple[str, str], times: tuple[str, str], within: int,
    delay: str = "24 hours", width: int | None = None,
) -> DataFrame:
    """Inner join of equal keys whose times lie at most ``within`` seconds apart; all pairs are kept.

    Both sides are also matched on a time bucket of ``width`` seconds (twice the interval unless given; a right
    row then falls into two at most), so a hot key is spread over its buckets and only near rows are compared.
    Narrower buckets split a very hot key further, at the price of more copies of the right rows.  Works on streams too: there
    each side needs a TIMESTAMP column and gets a watermark of ``delay`` (a stream starts with a watermark of 1970,
    so rows stamped with the epoch itself count as late there).  Column names must not overlap.
    (Whole seconds are enough for the buckets: times at most ``within`` apart are so after rounding down too.)
    """
    (left_key, right_key), (left_time, right_time) = on, times
    if left.isStreaming or right.isStreaming:
        left, right = left.withWatermark(left_time, delay), right.withWatermark(right_time, delay)
    width = width or max(2 * within, 1)
    near = left.withColumn("__bucket", floor_div(epoch_seconds(left, left_time), width))
    moment = epoch_seconds(right, right_time)
    spread = F.sequence(floor_div(moment - within, width), floor_div(moment + within, width))
    far = right.withColumn("__spread", F.explode(spread))
    gap = _span(left, left_time, within)
    close = (F.col(right_time) >= F.col(left_time) - gap) & (F.col(right_time) <= F.col(left_time) + gap)
    match = (F.col(left_key) == F.col(right_key)) & (F.col("__bucket") == F.col("__spread")) & close
    return near.join(far, match, "inner").drop("__bucket", "__spread")


def _span(df: DataFrame, time: str, seconds: int) -> Column:
    if isinstance(df.schema[time].dataType, T.IntegralType):
        return F.lit(seconds)
    return F.make_dt_interval(secs=F.lit(seconds))


def lookup_join(
    events: DataFrame, updates: DataFrame, on: tuple[str, str], order: tuple[str, str], values: Sequence[str],
    mode: str = "as_of", how: str = "inner", width: int | None = None,
) -> DataFrame:
    """Join a stream of events with a table given by its updates; the table keeps the latest non-NULL values.

    ``as_of``: an event meets the table as it stood at the event's place in the common order (an update at the
    same place counts as earlier).  One shuffle of the union of both sides, no range join.
    ``latest``: an event meets the final table.
    """
    if mode == "latest":
        table = latest_by(updates, [on[1]], list(values), order[1]).withColumnRenamed(on[1], "__key")
        return events.join(table, F.col(on[0]) == F.col("__key"), how).drop("__key")
    if mode != "as_of":
        raise ValueError(mode)
    both, folds, finish = as_of_parts(events, updates, on, order, values, how)
    return finish(running(both, [on[0]], AS_OF_ORDER, folds, width=width))


AS_OF_ORDER = ["__order", "__side"]


def as_of_parts(
    events: DataFrame, updates: DataFrame, on: tuple[str, str], order: tuple[str, str], values: Sequence[str], how: str
) -> tuple[DataFrame, list[Running], Callable[[DataFrame], DataFrame]]:
    """The as-of join as a running fold: both sides as one, the folds over it, and how to read off the answer."""
    held = [f"__held_{v}" for v in values]
    asking = events.select("*", F.col(order[0]).alias("__order"), F.lit(1).alias("__side"))
    telling = updates.where(F.col(on[1]).isNotNull()).select(
        F.col(on[1]).alias(on[0]), F.col(order[1]).alias("__order"), F.lit(0).alias("__side"),
        F.lit(True).alias("__row"), *[F.col(v).alias(h) for v, h in zip(values, held)],
    )
    if how == "inner":
        asking = asking.where(F.col(on[0]).isNotNull())
    folds = [Running("__found", "max", F.col("__row"))]
    folds += [Running(f"__now_{v}", "last", F.col(h)) for v, h in zip(values, held)]

    def finish(seen: DataFrame) -> DataFrame:
        answered = seen.where(F.col("__side") == 1)
        if how == "inner":
            answered = answered.where(F.col("__found"))
        return answered.select(*events.columns, *[F.col(f"__now_{v}").alias(v) for v in values])

    return asking.unionByName(telling, allowMissingColumns=True), folds, finish


def zip_changes(
    before: DataFrame, after: DataFrame, keys: Sequence[str], value: str, order: str | None = None,
    shared: Sequence[str] = (),
) -> DataFrame:
    """Full outer join of two keyed snapshots, keeping keys whose value differs.

    With ``order`` the last row per key on a side wins.  ``shared`` columns come from *before* when present
    there, else from *after*.  A key missing on one side always counts as changed.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        rows = latest_rows(df, keys, order) if order else df
        return rows.select(*keys, F.col(value).alias(f"{tag}_{value}"), *[F.col(c).alias(f"__{tag}_{c}") for c in shared])

    both = side(before, "pre").join(side(after, "post"), list(keys), "full_outer")
    changed = both.where(~F.col(f"pre_{value}").eqNullSafe(F.col(f"post_{value}")))
    return changed.select(
        *keys, f"pre_{value}", f"post_{value}",
        *[F.coalesce(f"__pre_{c}", f"__post_{c}").alias(c) for c in shared],
    )


def at_position(items: Column | str, index: Column | int) -> Column:
    """The array element at a 0-based index; NULL when out of range."""
    place = F.lit(index) if isinstance(index, int) else index
    return F.get(items, place)


def with_dictionary(df: DataFrame, dictionary: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join with a literal dictionary: no entry, no row.

    No broadcast hint: Spark broadcasts what it knows to be under its size threshold.
    """
    return df.join(dictionary, list(on), "inner")


def hydrate(keys: DataFrame, records: DataFrame, on: str, body: str, max_size: int | None = None) -> DataFrame:
    """Every key with its full record; a missing record leaves the body NULL.  ``max_size`` drops keys with a larger one."""
    found = keys.join(records, on, "left")
    if max_size is None:
        return found
    return found.where(F.col(body).isNull() | (F.octet_length(F.col(body)) <= max_size))


def enrich(df: DataFrame, table: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Left join with an attribute table of unique keys.

    No broadcast hint: Spark broadcasts when the measured size is under its threshold and otherwise runs a
    shuffled join, whose skewed partitions adaptive execution splits.
    """
    return df.join(table, F.col(on[0]) == F.col(on[1]), "left")
