"""Writing streams: append logs, keyed tables, several producers into one dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.functions.scalars import record_json, seconds_to_time
from tidemark.operators.aggregates import latest_rows
from tidemark.streaming.keyed import BUCKETS, KeyedTable


def with_event_time(df: DataFrame, seconds: str = "blockTime", out: str = "timestamp") -> DataFrame:
    """Stamp records with their event time; a missing time is the epoch."""
    return df.withColumn(out, seconds_to_time(seconds))


def to_records(df: DataFrame, key: str) -> DataFrame:
    """Rows as (key, value) text records for a Kafka sink."""
    return df.select(F.col(key).cast("string").alias("key"), record_json(*df.columns).alias("value"))


def append_into(*producers: DataFrame) -> DataFrame:
    """Several producers as one dataset, matched by column name."""
    merged = producers[0]
    for producer in producers[1:]:
        merged = merged.unionByName(producer)
    return merged


def write_stream(
    df: DataFrame, path: str, checkpoint: str, once: bool = True, every: str = "10 seconds",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append every result row to the Parquet dataset at ``path``, each once; ``once`` drains what is there.

    Partitioned by a ``topic`` column made with ``route_column``, one pass writes all routes of a router, in the
    layout that ``topic_pattern`` reads.
    """
    writer = df.writeStream.format("parquet").outputMode("append")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    return triggered(writer, checkpoint, once, every).start(path)


def write_kafka(
    df: DataFrame, key: str, servers: str, topic: str, checkpoint: str, once: bool = True, every: str = "10 seconds"
) -> StreamingQuery:
    """Append every result row to a Kafka topic as JSON (needs Spark's Kafka connector on the class path)."""
    writer = to_records(df, key).writeStream.format("kafka").outputMode("append")
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    return triggered(writer, checkpoint, once, every).start()


def upsert(
    df: DataFrame, path: str, keys: Sequence[str], checkpoint: str, order: str | None = None, once: bool = True,
    every: str = "10 seconds", mode: str = "update", buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep a keyed table in key-hash buckets, of which a micro-batch rewrites those of its keys; ``current`` reads the table.

    With ``order`` a batch is first reduced to its last row per key; an aggregation in update mode already is.
    A batch replayed after a failure starts from the table before it, so it leaves its rows once.
    """
    table = KeyedTable(path, list(keys), buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Written first: the merge reads the rows twice, and a batch of an aggregation is not to be computed twice.
        rows = latest_rows(batch, keys, order) if order else batch
        rows.write.mode("overwrite").parquet(f"{path}/incoming")
        table.merge(batch.sparkSession.read.parquet(f"{path}/incoming"), batch_id)

    writer = df.writeStream.outputMode(mode).foreachBatch(write)
    return triggered(writer, checkpoint, once, every).start()


def triggered(writer: DataStreamWriter, checkpoint: str, once: bool, every: str) -> DataStreamWriter:
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Everything appended so far by ``write_stream``."""
    return spark.read.parquet(path)


def current(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The keyed table: one version of each bucket, whatever the number of batches written."""
    table = KeyedTable(path, list(keys)).read(spark)
    if table is None:
        raise ValueError(f"no keyed table at {path}")
    return table


def compact(spark: SparkSession, path: str, keys: Sequence[str], target: str, buckets: int = BUCKETS) -> None:
    """Write the keyed table without superseded versions to ``target``, where a restarted stream can go on (with any
    number of buckets)."""
    table = KeyedTable(target, list(keys), buckets)
    rows = current(spark, path, keys)
    table.replace(rows, KeyedTable(path, list(keys)).versions(spark)[0], table.touched(rows))


def scores_now(spark: SparkSession, path: str, group: str, member: str, score: str) -> DataFrame:
    """The sorted sets kept by ``upsert`` of score changes: members whose latest score is not zero or NULL."""
    return current(spark, path, [group, member]).where(F.col(score) != 0).select(group, member, score)


def drain(query: StreamingQuery) -> None:
    """Wait until a query started with ``once`` has processed all input."""
    query.awaitTermination()
