"""Keyed tables: counts, latest values, maxima, changelogs, first rows, stale-row removal.

Every aggregate here combines rows before the shuffle, so a hot key costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import floor_div
from tidemark.operators.running import Running, present, running


def _order(order: str | Sequence[str]) -> Column:
    return F.col(order) if isinstance(order, str) else F.struct(*order)


def count_by(df: DataFrame, keys: Sequence[str], column: str, out: str = "count") -> DataFrame:
    """Non-NULL values per key; NULL keys form no group."""
    return df.where(present(keys)).groupBy(*keys).agg(F.count(column).alias(out))


def max_by_key(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    return df.where(present(keys)).groupBy(*keys).agg(F.max(column).alias(out))


def latest_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """Per key and per column, the last non-NULL value in order.  No keys: one row over everything."""
    rank = _order(order)
    latest = [
        F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns
    ]
    grouped = df.where(present(keys)) if keys else df
    return grouped.groupBy(*keys).agg(*latest)


def latest_rows(df: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """The whole last row per key (each map task keeps one row per key before the shuffle)."""
    return _edge_rows(df, keys, [F.col(c).desc() for c in ([order] if isinstance(order, str) else order)])


def first_per_key(df: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """The whole first row per key."""
    return _edge_rows(df, keys, [F.col(c).asc() for c in ([order] if isinstance(order, str) else order)])


def _edge_rows(df: DataFrame, keys: Sequence[str], sort: list[Column]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort))
    return df.withColumn("__place", place).where(F.col("__place") == 1).drop("__place")


def dedup(
    df: DataFrame, keys: Sequence[str], order: str, horizon_column: str | None = None, horizon: int | None = None,
    width: int | None = None,
) -> DataFrame:
    """Drop rows whose key was seen before, ever or within ``horizon`` units of ``horizon_column``.

    A repeat refreshes the key, so with a horizon a row passes only after a quiet gap longer than that.
    """
    if horizon is None:
        return first_per_key(df, keys, order)
    seen = running(df, keys, [order], [Running("__seen", "max", F.col(horizon_column))], inclusive=False,
                   width=width)
    fresh = F.col("__seen").isNull() | (F.col(horizon_column) - F.col("__seen") > horizon)
    return seen.where(fresh).drop("__seen")


def changelog(
    df: DataFrame, keys: Sequence[str], values: dict[str, tuple[str, str]], order: str,
    width: int | None = None,
) -> DataFrame:
    """One row per input row, with the key's aggregates so far.

    ``values`` maps an output name to (``count``, ``max``, ``sum`` or ``last``, column).
    """
    folds = [Running(out, kind, F.col(column)) for out, (kind, column) in values.items()]
    return running(df.where(present(keys)), keys, [order], folds, width=width)


def monotone(
    df: DataFrame, key: str, time: str, order: str, width: int | None = None
) -> DataFrame:
    """Drop rows older than the newest time already accepted for their key.

    A rejected row is below the accepted maximum by definition, so that maximum equals the maximum of all
    earlier rows and no recursion is needed.  Equal times pass; a key without a time so far passes anything.
    """
    folds, finish = monotone_parts(key, time)
    return finish(running(df, [key], [order], folds, inclusive=False, width=width))


def monotone_parts(key: str, time: str) -> tuple[list[Running], Callable[[DataFrame], DataFrame]]:
    """``monotone`` as a running fold (of the rows before each row) and the filter on it."""
    newest = F.col("__newest")
    fresh = newest.isNull() | F.col(key).isNull() | (F.col(time) >= newest)
    return [Running("__newest", "max", F.col(time))], lambda rows: rows.where(fresh).drop("__newest")


def collect_pages(
    df: DataFrame, group: str, order: str, columns: Sequence[str], page_size: int = 1000,
    width: int | None = None,
) -> DataFrame:
    """A group's rows as ordered lists of at most ``page_size`` entries: (group, page, items).

    Paging bounds every list; a group of any size becomes more pages, not a longer list.
    """
    numbered = running(df.where(F.col(group).isNotNull()), [group], [order], [Running("__n", "count", F.lit(1))],
                       width=width)
    paged = numbered.withColumn("page", floor_div(F.col("__n") - 1, page_size))
    items = F.sort_array(F.collect_list(F.struct(order, *[c for c in columns if c != order])))
    return paged.groupBy(group, "page").agg(items.alias("items"))


def upsert_stats(before: DataFrame, after: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row: how many members there are on either side and how many changed."""
    old = before.select(*keys, F.col(value).alias("__old"))
    new = after.select(*keys, F.col(value).alias("__new"))
    same = F.col("__old").eqNullSafe(F.col("__new"))
    return old.join(new, list(keys), "full_outer").agg(
        F.count(F.lit(1)).alias("members"), F.count_if(~same).alias("changed")
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows with a row counter on the side; read it as ``observation.get["rows"]`` after an action."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
