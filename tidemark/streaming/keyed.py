"""Keyed tables kept by micro-batches: one row per key, dealt into key-hash buckets.

A batch reads and rewrites only the buckets its keys fall into, so reading the table opens one version per bucket, however
many batches there were.  Version ``n`` of a bucket lies in ``<path>/data/version=n/bucket=b``; which version holds is written
to ``<path>/manifest-0`` and ``-1`` in turns, so the manifest of the batch before is whole while a new one is written.  A replayed
batch starts from the manifest of the batch before it and overwrites its own version.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregates import latest_rows

#: A bucket is rewritten whole: choose more for larger tables.
BUCKETS = 32


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of the paths that are there, in any store Spark reaches."""
    jvm, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    return [p for p in paths if (where := jvm.Path(p)).getFileSystem(conf).exists(where)]


@dataclass(frozen=True)
class KeyedTable:
    """NULL keys are one key, as in a grouping."""

    path: str
    keys: Sequence[str]
    buckets: int = BUCKETS

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that rows fall into: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def versions(self, spark: SparkSession, before: int | None = None) -> tuple[int, dict[int, int]]:
        """The last batch (below ``before``) and the version of every bucket after it; -1 when there is none."""
        best: tuple[int, dict[int, int]] = (-1, {})
        for folder in existing(spark, [f"{self.path}/manifest-{i}/_SUCCESS" for i in (0, 1)]):
            rows = spark.read.parquet(folder.removesuffix("/_SUCCESS")).collect()
            batch = rows[0]["batch"]
            if batch > best[0] and (before is None or batch < before):
                best = batch, {r["bucket"]: r["version"] for r in rows if r["bucket"] >= 0}
        return best

    def read(self, spark: SparkSession, only: Sequence[int] | None = None, before: int | None = None) -> DataFrame | None:
        """The rows of the table, or of some buckets, as of the last batch (below ``before``); None when there are none."""
        versions = self.versions(spark, before)[1]
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(versions.items()) if only is None or b in only]
        return spark.read.parquet(*paths) if paths else None

    def replace(self, rows: DataFrame, batch: int, buckets: Sequence[int]) -> None:
        """``rows`` are from now on all rows of ``buckets``; a bucket may become empty."""
        spark = rows.sparkSession
        if buckets:
            dealt = rows.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
            dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={batch}")
        folders = {f"{self.path}/data/version={batch}/bucket={b}": b for b in buckets}
        filled = [folders[p] for p in existing(spark, list(folders))]
        versions = {b: v for b, v in self.versions(spark, batch)[1].items() if b not in buckets} | dict.fromkeys(filled, batch)
        manifest = spark.createDataFrame([(batch, -1, -1), *((batch, b, v) for b, v in versions.items())], "batch long, bucket int, version long")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest-{batch % 2}")

    def merge(self, rows: DataFrame, batch: int) -> None:
        """``rows`` (one per key) take the place of the rows of their keys."""
        buckets = self.touched(rows)
        old = self.read(rows.sparkSession, buckets, before=batch)
        if old is not None:
            both = rows.withColumn("__newer", F.lit(1)).unionByName(old.withColumn("__newer", F.lit(0)))
            rows = latest_rows(both, self.keys, "__newer").drop("__newer")
        self.replace(rows, batch, buckets)
