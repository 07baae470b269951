"""Loads that can be resumed, and publishing plans: covered cursor ranges, what lies outside them, batches under two limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.running import Running, running

_ALL = "__all"


def covered_ranges(ranges: DataFrame, low: str = "low", high: str = "high", step: int = 1, width: int | None = None) -> DataFrame:
    """(low, high): the ranges, both ends included, that together cover the same integer cursors; none meet or touch.

    A range starts a new one when it begins beyond all that start before it.  Ranges with a NULL end, or ends the wrong way
    round, cover nothing.  Running values, so no task gets all ranges.
    """
    fine = ranges.where(F.col(low) <= F.col(high)).select(F.col(low).alias("low"), F.col(high).alias("high"), F.lit(0).alias(_ALL))
    reach = running(fine, [_ALL], ["low", "high"], [Running("__reach", "max", F.col("high"))], inclusive=False, width=width)
    starts = F.col("__reach").isNull() | (F.col("low") > F.col("__reach") + step)
    marked = reach.withColumn("__start", F.when(starts, F.col("low")))
    named = running(marked, [_ALL], ["low", "high"], [Running("__island", "max", F.col("__start"))], width=width)
    return named.groupBy(F.col("__island").alias("low")).agg(F.max("high").alias("high"))


def range_gaps(ranges: DataFrame, low: str = "low", high: str = "high", width: int | None = None) -> DataFrame:
    """(low, high): the cursors between the covered ranges, which an interrupted newest-first load still owes."""
    islands = covered_ranges(ranges, low, high, width=width).withColumn(_ALL, F.lit(0))
    before = running(islands, [_ALL], ["low"], [Running("__before", "max", F.col("high"))], inclusive=False, width=width)
    return before.where(F.col("__before").isNotNull()).select((F.col("__before") + 1).alias("low"), (F.col("low") - 1).alias("high"))


def not_covered(df: DataFrame, ranges: DataFrame, cursor: str, low: str = "low", high: str = "high", width: int | None = None) -> DataFrame:
    """The rows whose cursor lies in none of the ranges: what a resumed load has to take, gaps and newer rows alike.

    A cursor is covered if the farthest range that starts at or before it reaches it, so one pass in cursor order answers all
    rows, without a range join.  A NULL cursor is never covered.
    """
    asked = df.select(F.struct("*").alias("__row"), F.col(cursor).cast("long").alias("__at"), F.lit(1).alias("__side"), F.lit(0).alias(_ALL))
    told = ranges.where(F.col(low) <= F.col(high)).select(
        F.col(low).cast("long").alias("__at"), F.lit(0).alias("__side"), F.lit(0).alias(_ALL), F.col(high).cast("long").alias("__high"))
    both = asked.unionByName(told, allowMissingColumns=True)
    seen = running(both, [_ALL], ["__at", "__side"], [Running("__reach", "max", F.col("__high"))], width=width)
    free = F.col("__reach").isNull() | F.col("__at").isNull() | (F.col("__reach") < F.col("__at"))
    return seen.where((F.col("__side") == 1) & free).select("__row.*")


def publish_batches(df: DataFrame, order: str, size: str, max_rows: int, max_bytes: int, width: int | None = None) -> DataFrame:
    """The rows with ``batch``: numbers that ascend in ``order``, each of at most ``max_rows`` rows and ``max_bytes`` of ``size``.

    Running counts and sums (per chunk, then over chunks) give each row its place in rows and bytes; a batch ends where either
    crosses a window.  A byte window is shorter than the limit by the largest row, so the row that crosses into it fits too.
    Numbers may leave gaps.  Rows over ``max_bytes`` have no place in any batch: filter them first (``filters.max_bytes``),
    they raise an error here.  A NULL size counts as 0.
    """
    sized = df.withColumn("__size", F.coalesce(F.col(size).cast("long"), F.lit(0))).withColumn(_ALL, F.lit(0))
    largest = sized.agg(F.max("__size")).first()[0] or 0
    if largest > max_bytes:
        raise ValueError(f"a row of {largest} bytes does not fit a batch of {max_bytes}")
    window = max_bytes - max(largest, 1) + 1
    placed = running(sized, [_ALL], [order], [Running("__rows", "count", F.lit(1)), Running("__bytes", "sum", F.col("__size"))], width=width)
    by_rows = F.floor((F.col("__rows") - 1) / max_rows)
    by_bytes = F.floor((F.greatest("__bytes", F.lit(1)) - 1) / window)
    return placed.select(*df.columns, (by_rows + by_bytes).alias("batch"))
