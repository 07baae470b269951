"""Running values over streams of any skew: each micro-batch runs the batch operator and continues the earlier state.

The keyed-state operators in ``stateful`` answer with little delay, but take a key's rows of a micro-batch in one
task.  Here a micro-batch may be large (a whole backlog) and one key may hold most of it: the batch operators cut hot
keys, and what earlier batches left behind is one row per key, joined in.

Results go to ``<path>/rows/batch=<id>``, the state to a keyed table in ``<path>/state``: a batch opens and rewrites the
buckets of its own keys only.  It reads the state of earlier batches and overwrites its own, so a replay after a failure
changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.aggregates import monotone_parts
from tidemark.operators.joins import AS_OF_ORDER, as_of_parts
from tidemark.operators.running import FOLDS, Running, present, running, totals_by
from tidemark.streaming.keyed import BUCKETS, KeyedTable
from tidemark.streaming.sinks import triggered


def running_log(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], folds: Sequence[Running],
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows, inclusive: bool = True, once: bool = True,
    every: str = "1 minute", width: int | None = None, buckets: int = BUCKETS,
) -> StreamingQuery:
    """Write every row with its running values over everything so far, after ``finish``; read it by ``read_rows``."""
    keys = list(keys)
    table = KeyedTable(f"{path}/state", keys, buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Read several times below; a lost executor's part is read again from the source.
        batch.persist()
        try:
            rows = running(batch, keys, order, folds, inclusive, width)
            totals = totals_by(batch, keys, order, folds)
            touched = table.touched(totals)
            state = table.read(spark, touched, before=batch_id)
            if state is not None:
                idle = state.join(totals.select(*keys), keys, "left_anti")
                rows = _continue(rows, state, keys, {f.out: f for f in folds})
                totals = _continue(totals, state, keys, {f"__all_{f.out}": f for f in folds}).unionByName(idle)
            finish(rows).write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
            table.replace(totals, batch_id, touched)
        finally:
            batch.unpersist()

    return triggered(stream.writeStream.foreachBatch(write), checkpoint, once, every).start()


def _continue(df: DataFrame, state: DataFrame, keys: list[str], folds: dict[str, Running]) -> DataFrame:
    """Combine the columns named in ``folds`` with what earlier batches left."""
    past = state.select(*keys, *[F.col(c).alias(f"__past{c}") for c in state.columns if c not in keys])

    def value(column: str):
        fold = folds.get(column)
        if fold is None:
            return F.col(column)
        return FOLDS[fold.kind].combine(F.col(f"__past__all_{fold.out}"), F.col(column)).alias(column)

    return df.join(past, keys, "left").select(*[value(c) for c in df.columns])


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop("batch")


def monotone_log(
    stream: DataFrame, path: str, checkpoint: str, key: str, time: str, order: str, **options
) -> StreamingQuery:
    """Stale-row removal over a stream: the accepted rows as a log."""
    folds, finish = monotone_parts(key, time)
    return running_log(stream, path, checkpoint, [key], [order], folds, finish, inclusive=False, **options)


def changelog_log(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], values: dict[str, tuple[str, str]], order: str,
    **options,
) -> StreamingQuery:
    """Every row with its key's aggregates so far, as a log; ``values`` as for ``changelog``."""
    folds = [Running(out, kind, F.col(column)) for out, (kind, column) in values.items()]
    return running_log(stream.where(present(keys)), path, checkpoint, keys, [order], folds, **options)


def lookup_log(
    events: DataFrame, updates: DataFrame, path: str, checkpoint: str, on: tuple[str, str], order: tuple[str, str],
    values: Sequence[str], how: str = "inner", **options,
) -> StreamingQuery:
    """Stream-table join of two streams as a log of answered events.

    Inside a micro-batch both sides follow their common order; an update that arrives in a later batch does not
    change earlier answers.
    """
    both, folds, finish = as_of_parts(events, updates, on, order, values, how)
    return running_log(both, path, checkpoint, [on[0]], AS_OF_ORDER, folds, finish, **options)
