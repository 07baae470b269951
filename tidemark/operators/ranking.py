"""Sorted sets, leaderboards and running numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import floor_div
from tidemark.operators.aggregates import latest_rows
from tidemark.operators.running import Running, running, running_by_chunk
from tidemark.session import cut_lineage

MARKER_BUCKET = 248


def apply_scores(
    state: DataFrame | None, changes: DataFrame, group: str, member: str, score: str, order: str | Sequence[str]
) -> DataFrame:
    """A sorted set after a batch: the latest change per member wins; a zero or NULL score deletes the member."""
    latest = latest_rows(changes, [group, member], order).select(group, member, score)
    alive = latest.where(F.col(score) != 0)
    if state is None:
        return alive
    untouched = state.select(group, member, score).join(latest.select(group, member), [group, member], "left_anti")
    return untouched.unionByName(alive)


def leaderboard(state: DataFrame, group: str, member: str, score: str, k: int | None = None) -> DataFrame:
    """Members ranked by score within their group, highest first, ties by member descending.

    With ``k`` each map task keeps its own best ``k`` per group before the shuffle.  Without ``k`` every
    member is ranked: see :func:`rank_all`, which runs a job.
    """
    if k is None:
        return rank_all(state, group, member, score)
    best = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(member).desc())
    return state.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def rank_all(state: DataFrame, group: str, member: str, score: str, partitions: int | None = None) -> DataFrame:
    """Full ranking of groups of any size, over ``partitions`` ranges (``spark.sql.shuffle.partitions`` unless given).

    The rows are range-partitioned by (group, score, member), so a large group spans many partitions; the
    partition number is the chunk of a running count.  Range bounds come from a sample, so the partitioned
    rows are checkpointed once and both passes read the same chunks.
    """
    places = [F.col(group), F.col(score).desc(), F.col(member).desc()]
    spread = state.repartitionByRange(partitions, *places) if partitions else state.repartitionByRange(*places)
    ranged = spread.withColumn("__part", F.spark_partition_id())
    fixed = cut_lineage(ranged)
    ranked = running_by_chunk(fixed, [group], "__part", places[1:], [Running("rank", "count", F.lit(1))])
    return ranked.select(*state.columns, "rank")


def next_number(
    requests: DataFrame, supply: DataFrame, group: str, order: str, supply_column: str = "supply",
    width: int | None = None,
) -> DataFrame:
    """Number requests per group in order, continuing after the group's current supply (none counts as 0)."""
    counted = running(requests, [group], [order], [Running("__place", "count", F.lit(1))],
                      width=width)
    current = supply.select(group, F.col(supply_column).cast("bigint").alias("__supply"))
    edition = F.coalesce("__supply", F.lit(0)) + F.col("__place")
    numbered = counted.join(current, group, "left").withColumn("edition", edition)
    return numbered.withColumn("marker", floor_div(F.col("edition"), MARKER_BUCKET)).drop("__place", "__supply")
