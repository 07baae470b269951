"""JSON topics: declared schemas, topic patterns, start positions, incremental reads.

A topic is either a Kafka topic or a folder of files with the same envelope columns, one sub-folder
``topic=<name>`` per topic.  Both can be read as a batch or as a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = "key STRING, value STRING, timestamp TIMESTAMP, partition INT, offset BIGINT, topic STRING"

# Declared streams, their columns and (after the bar) the column filled from the record key.
SCHEMAS = {
    "blocks": "slot INT, skipped BOOLEAN, error STRING",
    "slots": "key INT, slot INT | key",
    "raw_retriable_blocks": "key INT, slot INT, count INT | key",
    "missed_slots": "key INT, slot INT | key",
    "solana_events": "type STRING, slot BIGINT, blockTime BIGINT, blockhash STRING, recentBlockhash STRING, "
                     "payload STRING",
    "collective_users": "owner STRING, tokenRef STRING, reverseTokenRef STRING, tokenBonding STRING, "
                        "blockTime BIGINT, collective STRING",
    "latest_bonding_token_account_balances":
        "pubkey STRING, type STRING, slot BIGINT, blockhash STRING, blockTime BIGINT, recentBlockhash STRING, "
        "instructionIndex INT, innerIndex INT, mint STRING, tokenAmount DECIMAL(27,9), tokenBonding STRING, "
        "decimals INT | pubkey",
    "latest_reserve_token_account_balances":
        "pubkey STRING, type STRING, slot BIGINT, blockhash STRING, blockTime BIGINT, recentBlockhash STRING, "
        "instructionIndex INT, innerIndex INT, mint STRING, tokenAmount DECIMAL(27,9), decimals INT, "
        "tokenBonding STRING | pubkey",
    "trophies": "key STRING, trophyShortName STRING, trophyMasterEditionMeta STRING, destination STRING | key",
    "raw_users": "owner STRING | owner",
}


def declared(name: str) -> tuple[T.StructType, str | None]:
    """Schema and key column of a declared stream."""
    columns, _, key = SCHEMAS[name].partition("|")
    return T.StructType.fromDDL(columns.strip()), key.strip() or None


def json_topic(raw: DataFrame, schema: T.StructType | str, key: str | None = None, value: str = "value") -> DataFrame:
    """Records of a JSON topic as typed columns, followed by the other envelope columns.

    An absent field is NULL; the ``key`` column, if any, is cast from the record key.  Only the fields of the
    schema are parsed.
    """
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parsed = raw.withColumn("__value", F.from_json(F.col(value), shape))
    fields = [
        (F.col("key").try_cast(f.dataType) if f.name == key else F.col("__value").getField(f.name)).alias(f.name)
        for f in shape.fields
    ]
    names = {f.name.lower() for f in shape.fields}
    rest = [c for c in raw.columns if c not in (value, "key") and c.lower() not in names]
    return parsed.select(*fields, *rest)


def kafka_options(
    servers: str, topic: str | None = None, pattern: str | None = None, start: str = "earliest",
    per_trigger: int | None = None, min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source for one topic or for every topic matching a regular expression."""
    if (topic is None) == (pattern is None):
        raise ValueError("give either topic or pattern")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": _start(start)}
    options |= {"subscribe": topic} if topic else {"subscribePattern": pattern}
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def _start(start: str) -> str:
    if start not in ("earliest", "latest"):
        raise ValueError(start)
    return start


def read_kafka(spark: SparkSession, streaming: bool = True, **settings) -> DataFrame:
    """A Kafka topic or topic pattern as envelope columns (needs Spark's Kafka connector on the class path)."""
    reader = spark.readStream if streaming else spark.read
    raw = reader.format("kafka").options(**kafka_options(**settings)).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp", "partition", "offset",
                      "topic")


def read_folder(
    spark: SparkSession, path: str, schema: T.StructType | str = ENVELOPE, streaming: bool = False,
    files_per_trigger: int | None = None, start: str = "earliest", now: Column | None = None,
) -> DataFrame:
    """Topics stored as Parquet under ``path``.  ``start="latest"`` keeps records stamped from ``now`` on."""
    reader = spark.readStream if streaming else spark.read
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.schema(schema).parquet(path)
    if _start(start) == "latest":
        rows = rows.where(F.col("timestamp") >= (F.current_timestamp() if now is None else now))
    return rows


def match_topics(records: DataFrame, pattern: str) -> DataFrame:
    """Records of every topic whose whole name matches ``pattern``."""
    return records.where(F.col("topic").rlike(f"^(?:{pattern})$"))


def topic_pattern(spark: SparkSession, path: str, pattern: str, **settings) -> DataFrame:
    """Every stored topic whose whole name matches ``pattern``, as one; the folder names prune the scan."""
    return match_topics(read_folder(spark, path, **settings), pattern)


def incremental_since(df: DataFrame, sink: DataFrame, cursor: str, start=None) -> DataFrame:
    """Rows after the last one already in ``sink``; with an empty sink after ``start``, else after the newest row.

    The cursor is a scalar subquery, so nothing runs here and the comparison reaches the scan of ``df``.
    """
    resume = [sink.agg(F.max(cursor)).scalar()]
    resume.append(F.lit(start) if start is not None else df.agg(F.max(cursor)).scalar())
    return df.where(F.col(cursor) > F.coalesce(*resume))
