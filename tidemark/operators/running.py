"""Running values per key ("as of this row"), safe for keys that hold a large share of all rows.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task.  Here every key is cut into chunks of its order
column; each chunk is folded on its own, the per-chunk totals (one small row per chunk) are folded over the chunks, and the
two are combined.  The result equals the plain window, whatever the chunk width: NULL keys form one group, NULL orders come
first, in a chunk of their own.  Only sums of floating values differ, in the last digits: cast them to DECIMAL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import epoch_seconds, floor_div

# Width of a chunk in order units: offsets for integer orders, seconds for times.
OFFSETS_PER_CHUNK = 1_000_000
SECONDS_PER_CHUNK = 3_600

_CHUNK, _CELL = "__chunk", "__cell"


@dataclass(frozen=True)
class Fold:
    """How a running value is built: inside a chunk, over whole chunks, and both together."""

    inside: Callable[[Column], Column]
    total: Callable[[Column, Column], Column]
    over_totals: Callable[[Column], Column]
    combine: Callable[[Column, Column], Column]


def _latest_present(value: Column, order: Column) -> Column:
    return F.max_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), order))


FOLDS = {
    "max": Fold(F.max, lambda v, o: F.max(v), F.max, lambda before, here: F.greatest(before, here)),
    "count": Fold(F.count, lambda v, o: F.count(v), F.sum, lambda b, h: F.coalesce(b, F.lit(0)) + h),
    "sum": Fold(F.sum, lambda v, o: F.sum(v), F.sum,
                lambda b, h: F.when(b.isNull(), h).otherwise(b + F.coalesce(h, F.lit(0)))),
    "last": Fold(lambda v: F.last(v, ignorenulls=True), _latest_present,
                 lambda v: F.last(v, ignorenulls=True), lambda b, h: F.coalesce(h, b)),
}


@dataclass(frozen=True)
class Running:
    """One output column: ``kind`` (a name in FOLDS) applied to ``value`` and stored as ``out``."""

    out: str
    kind: str
    value: Column


def totals_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], folds: Sequence[Running]) -> DataFrame:
    """The folds over all rows of each key, as columns ``__all_<out>``; NULL keys form no group."""
    return _totals(df.where(present(keys)), keys, order, folds)


def _totals(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], folds: Sequence[Running]) -> DataFrame:
    rank = F.struct(*order)  # a struct with a NULL order is the least one
    return df.groupBy(*keys).agg(*[FOLDS[f.kind].total(f.value, rank).alias(f"__all_{f.out}") for f in folds])


def order_chunk(df: DataFrame, order: str, width: int | None = None) -> Column:
    """A coarse, order-preserving bucket of the order column."""
    if isinstance(df.schema[order].dataType, T.IntegralType):
        return floor_div(F.col(order).cast("bigint"), width or OFFSETS_PER_CHUNK)
    return floor_div(epoch_seconds(df, order), width or SECONDS_PER_CHUNK)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    folds: Sequence[Running],
    inclusive: bool = True,
    width: int | None = None,
) -> DataFrame:
    """Add running values over ``keys`` in ``order``; ``inclusive=False`` leaves the row itself out.

    ``order[0]`` must be an integer offset or a time, and the whole list must order a key's rows totally.
    The rows are shuffled once; a second, narrow read of the input gives the totals: save it first when it is costly to make.
    """
    cut = df.withColumn(_CHUNK, order_chunk(df, order[0], width))
    return running_by_chunk(cut, keys, _CHUNK, order, folds, inclusive).drop(_CHUNK)


def present(keys: Sequence[str]) -> Column:
    """All key columns are there (a pushable predicate)."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition


def running_by_chunk(
    df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[Column | str], folds: Sequence[Running],
    inclusive: bool = True,
) -> DataFrame:
    """The two-level fold itself, for rows that already carry a chunk in key order.

    Key and chunk are one struct column, whose equality holds for NULL fields too.  The rows are shuffled once, by that
    column; the join with the carried values reuses the partitioning.
    """
    frame_end = Window.currentRow if inclusive else -1
    inside = Window.partitionBy(_CELL).orderBy(*order).rowsBetween(Window.unboundedPreceding, frame_end)
    rows = df.withColumn(_CELL, F.struct(F.struct(*keys).alias("of"), F.col(chunk).alias("chunk")))
    here = rows.select("*", *[FOLDS[f.kind].inside(f.value).over(inside).alias(f"__here_{f.out}") for f in folds])

    totals = _totals(rows, [_CELL], order, folds)
    earlier = Window.partitionBy(f"{_CELL}.of").orderBy(f"{_CELL}.chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        _CELL, *[FOLDS[f.kind].over_totals(F.col(f"__all_{f.out}")).over(earlier).alias(f"__before_{f.out}") for f in folds]
    )
    both = here.join(carried, _CELL, "left")
    return both.select(
        *df.columns,
        *[FOLDS[f.kind].combine(F.col(f"__before_{f.out}"), F.col(f"__here_{f.out}")).alias(f.out) for f in folds],
    )
