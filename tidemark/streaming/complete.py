"""Streaming joins and dedup that lose no row: what came before is kept as tables, not as state with a watermark.

Rows may come as late as they like, also without a time; every answer is the batch operator's over all rows so far.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.scalars import epoch_seconds, floor_div
from tidemark.operators.joins import interval_join
from tidemark.operators.running import Running
from tidemark.streaming.batches import running_log
from tidemark.streaming.keyed import existing
from tidemark.streaming.sinks import triggered

#: Seconds of event time in one folder of a side's history.
SLOT_SECONDS = 86_400


def interval_join_log(
    left: DataFrame, right: DataFrame, path: str, checkpoint: str, on: tuple[str, str], times: tuple[str, str], within: int,
    slot: int = SLOT_SECONDS, width: int | None = None, once: bool = True, every: str = "1 minute",
) -> StreamingQuery:
    """``interval_join`` of two streams as a log of pairs, every pair once; read it by ``batches.read_rows``.

    Each side's rows are kept in folders by slots of event time.  A micro-batch joins its new rows with each other and with
    the old rows of the slots within reach (a hot key is spread over its time buckets as in the batch form), so its cost
    follows its own rows and the slots they touch.  A pair appears in the batch of its later row.  Rows stamped with the epoch
    for want of a time meet those stamped so too; a NULL key or time joins nothing, as in the batch form.  A replayed batch
    reads only folders of earlier batches and overwrites its own.  Column names of the sides must not overlap.
    """
    sides = {"left": (left, on[0], times[0]), "right": (right, on[1], times[1])}
    both = left.select(F.struct("*").alias("left")).unionByName(right.select(F.struct("*").alias("right")), allowMissingColumns=True)

    def new_rows(batch: DataFrame, side: str) -> DataFrame:
        _, key, time = sides[side]
        rows = batch.where(F.col(side).isNotNull()).select(f"{side}.*")
        return rows.where(F.col(key).isNotNull() & F.col(time).isNotNull())

    def reached(rows: DataFrame, side: str) -> list[int]:
        """The slots that partners of these rows can lie in (few numbers: days of event time in a micro-batch)."""
        moment = epoch_seconds(rows, sides[side][2])
        slots = F.explode(F.sequence(floor_div(moment - within - 1, slot), floor_div(moment + within + 1, slot)))
        return sorted(r[0] for r in rows.select(slots).distinct().collect())

    def old_rows(batch: DataFrame, side: str, slots: list[int], batch_id: int) -> DataFrame:
        spark, history = batch.sparkSession, f"{path}/{side}"
        folders = existing(spark, [f"{history}/slot={s}" for s in slots]) if batch_id else []
        if not folders:
            return new_rows(batch.limit(0), side)
        old = spark.read.option("basePath", history).parquet(*folders).where(F.col("batch") < batch_id)
        return old.select(*sides[side][0].columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read several times below; a lost executor's part is read again from the source
        try:
            new = {side: new_rows(batch, side) for side in sides}
            old_right = old_rows(batch, "right", reached(new["left"], "left"), batch_id)
            old_left = old_rows(batch, "left", reached(new["right"], "right"), batch_id)
            match = lambda a, b: interval_join(a, b, on, times, within, width=width)
            pairs = match(new["left"], new["right"].unionByName(old_right)).unionByName(match(old_left, new["right"]))
            pairs.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
            for side, (_, _, time) in sides.items():
                place = floor_div(epoch_seconds(new[side], time), slot)
                kept = new[side].select("*", place.alias("slot"), F.lit(batch_id).cast("long").alias("batch"))
                writer = kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.partitionBy("slot", "batch").parquet(f"{path}/{side}")
        finally:
            batch.unpersist()

    return triggered(both.writeStream.foreachBatch(write), checkpoint, once, every).start()


def dedup_log(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: str, horizon_column: str | None = None,
    horizon: int | None = None, **options,
) -> StreamingQuery:
    """``dedup`` over a stream as a log of the rows that pass; read it by ``batches.read_rows``.

    Kept per key is one number, the latest ``horizon_column`` (without a horizon: ``order``) so far, in key-hash buckets of which a
    batch opens those of its own keys.  A key never seen passes however late its row; a repeat refreshes its key.  Inside a
    micro-batch rows follow ``order``; NULL keys are one key.
    """
    column = horizon_column or order
    seen = F.col("__seen")
    fresh: Column = seen.isNull() if horizon is None else seen.isNull() | (F.col(column) - seen > horizon)
    return running_log(
        stream.withColumn("__key", F.struct(*keys)), path, checkpoint, ["__key"], [order], [Running("__seen", "max", F.col(column))],
        lambda rows: rows.where(fresh).drop("__seen", "__key"), inclusive=False, **options)
