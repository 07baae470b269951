"""Leaderboards kept up to date by micro-batches of score changes.

The members of all groups lie in one order, (group, score, member), cut into ranges of at most about ``capacity`` rows.  A batch
reads and rewrites only the ranges its changes leave or enter; a range that grew past ``capacity`` is split, neighbours that
shrank are put together.  The manifest has one row per range with its least place, its size and the sizes of its first and last
group, so a rank is the rows of the group in the ranges above plus the place inside one range, and a group of any size is
ranked range by range.

The ranges of version ``n`` lie in ``<path>/ranges/version=n``, in order and many to a file (a shelf), so that a board of small
ranges is not as many files, tasks and folders; the manifests in ``<path>/manifest-0`` and ``-1`` in turns, and
``<path>/members`` is a keyed table of every member's score.  A replayed batch starts from the manifest of the batch before it
and overwrites its own version.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.operators.aggregates import latest_rows
from tidemark.streaming.keyed import BUCKETS, KeyedTable, existing
from tidemark.streaming.sinks import triggered

#: Rows of one range: they are sorted in one task.
CAPACITY = 1_000_000
#: Rows of one file of ranges, where ranges are smaller.
SHELF = 500_000
#: What tells the ranges of all versions apart, and the order of one version's.
SPOT = ["version", "shelf", "place", "piece"]


@dataclass(frozen=True)
class Board:
    """Ranked members of any number of groups; a NULL group is a group, a NULL member a member."""

    path: str
    group: str
    member: str
    score: str
    capacity: int = CAPACITY
    buckets: int = BUCKETS

    @property
    def members(self) -> KeyedTable:
        return KeyedTable(f"{self.path}/members", [self.group, self.member], self.buckets)

    def _key(self) -> Column:
        return F.struct(self.group, self.score, self.member)

    def _same_member(self, a: DataFrame, b: DataFrame) -> Column:
        return a[self.group].eqNullSafe(b[self.group]) & a[self.member].eqNullSafe(b[self.member])

    def ranges(self, spark: SparkSession, before: int | None = None) -> list[Row]:
        """The manifest after the last batch (below ``before``), lowest range first: one row per ``capacity`` members."""
        best, found = -1, []
        for folder in existing(spark, [f"{self.path}/manifest-{i}/_SUCCESS" for i in (0, 1)]):
            rows = spark.read.parquet(folder.removesuffix("/_SUCCESS")).collect()
            batch = rows[0]["batch"]
            if batch > best and (before is None or batch < before):
                best, found = batch, sorted((r for r in rows if r["at"] >= 0), key=lambda r: r["at"])
        return found

    def _located(self, rows: DataFrame, ranges: list[Row], manifest: StructType) -> DataFrame:
        """``rows`` with ``__at``, the number of the range each belongs to: a binary search among the ranges' least places."""
        if len(ranges) < 2:
            return rows.withColumn("__at", F.lit(0))
        table = rows.sparkSession.createDataFrame([(r["low"],) for r in ranges[1:]], StructType([manifest["low"]]))
        lows = table.agg(F.sort_array(F.collect_list("low"))).scalar()
        steps = [1 << i for i in reversed(range(len(ranges).bit_length()))]

        def further(at: Column, step: Column) -> Column:
            reached = (at + step < len(ranges)) & (F.get("__lows", at + step - 1) <= F.col("__key"))
            return F.when(reached, at + step).otherwise(at)

        keyed = rows.withColumns({"__lows": lows, "__key": self._key()})
        return keyed.withColumn("__at", F.aggregate(F.lit(steps), F.lit(0), further)).drop("__lows", "__key")

    def _rows(self, spark: SparkSession, ranges: Sequence[Row]) -> DataFrame | None:
        """The rows of some ranges with ``version``, ``shelf`` (the folder they lie in), ``place`` and ``piece``."""
        paths = sorted({f"{self.path}/ranges/version={r['version']}/shelf={r['shelf']}" for r in ranges})
        if not paths:
            return None
        rows = spark.read.option("basePath", f"{self.path}/ranges").parquet(*paths)
        # A shelf also holds ranges that were not asked for or were rewritten since.
        asked = spark.createDataFrame([tuple(r[c] for c in SPOT) for r in ranges], "version long, shelf int, place int, piece int")
        return rows.withColumn("version", F.col("version").cast("long")).join(asked, SPOT, "left_semi")

    def apply(self, changes: DataFrame, order: str | Sequence[str], batch: int) -> None:
        """Take in a batch of changes: the latest per member wins; a zero or NULL score removes the member."""
        spark, columns = changes.sparkSession, [self.group, self.member, self.score]
        latest_rows(changes, [self.group, self.member], order).select(*columns).write.mode("overwrite").parquet(
            f"{self.path}/changes/batch={batch}")
        latest = spark.read.schema(changes.select(*columns).schema).parquet(f"{self.path}/changes/batch={batch}")
        alive = latest.where(F.col(self.score) != 0)
        manifest = _manifest_schema(latest.select(self._key().alias("low")).schema["low"], latest.schema[self.group])
        ranges = self.ranges(spark, before=batch)

        buckets = self.members.touched(latest)
        known = self.members.read(spark, buckets, before=batch)
        moved = alive
        if known is not None:
            moved = alive.unionByName(known.join(latest, self._same_member(known, latest), "left_semi").select(*columns))
        touched = {r[0] for r in self._located(moved, ranges, manifest).select("__at").distinct().collect()}
        inside = self._rows(spark, [r for i, r in enumerate(ranges) if i in touched])
        now = alive
        if inside is not None:
            now = now.unionByName(inside.join(latest, self._same_member(inside, latest), "left_anti").select(*columns))
        located = self._located(now, ranges, manifest)
        sizes = {r["__at"]: r["count"] for r in located.groupBy("__at").count().collect()}

        pieces = self._rewrite(located, sizes, touched, max(1, len(ranges)), batch)
        self._publish(spark, ranges, touched, pieces, manifest, batch)
        members = alive
        if known is not None:
            members = alive.unionByName(known.join(latest, self._same_member(known, latest), "left_anti").select(*columns))
        self.members.replace(members, batch, buckets)

    def _rewrite(self, located: DataFrame, sizes: dict[int, int], touched: set[int], n_ranges: int, batch: int) -> list[Row]:
        """Write the touched ranges anew, large ones in pieces, small neighbours together; a row per piece in its order."""
        if not sizes:
            return []
        leader, together = list(range(n_ranges)), dict(sizes)
        for at in sorted(touched):
            before = leader[at - 1] if at - 1 in touched else at
            if before != at and together.get(before, 0) + sizes.get(at, 0) <= self.capacity // 2:
                leader[at] = before
                together[before] = together.get(before, 0) + together.pop(at, 0)
        large = [together.get(at, 0) > self.capacity for at in range(n_ranges)]
        half, key = max(1, self.capacity // 2), self._key()
        shelves = -(-sum(sizes.values()) // max(SHELF, half))
        spark = located.sparkSession
        plan = spark.createDataFrame([(leader, large)], "leader array<int>, large array<boolean>")
        dealt = located.withColumn("place", F.get(plan.select("leader").scalar(), F.col("__at"))).drop("__at")
        # Bounds come from a sample: shelves are near their size, and what they hold is read back from the files.
        dealt = dealt.repartitionByRange(shelves, "place", key).withColumn("shelf", F.spark_partition_id())
        piece = F.floor((F.row_number().over(Window.partitionBy("shelf").orderBy("place", key)) - 1) / half).cast("int")
        dealt = dealt.withColumn("piece", F.when(F.get(plan.select("large").scalar(), F.col("place")), piece).otherwise(0))
        folder = f"{self.path}/ranges/version={batch}"
        dealt.write.mode("overwrite").partitionBy("shelf").parquet(folder)
        written = spark.read.parquet(folder)
        spot = ["place", "shelf", "piece"]
        by_group = written.groupBy(*spot, self.group).agg(F.count("*").alias("n"), F.min(F.struct(self.score, self.member)).alias("least"))
        first = F.min(F.struct(self.group, "n", "least")).alias("first")
        last = F.max(F.struct(self.group, "n")).alias("last")
        return by_group.groupBy(*spot).agg(F.sum("n").alias("n"), first, last).orderBy(*spot).collect()

    def _publish(
        self, spark: SparkSession, ranges: list[Row], touched: set[int], pieces: list[Row], manifest: StructType, batch: int
    ) -> None:
        """The manifest after the batch: untouched ranges as they were, touched ones by their pieces; empty ones go."""
        rows = [(at, tuple(r[name] for name in manifest.names[2:])) for at, r in enumerate(ranges) if at not in touched]
        for r in pieces:
            first, least, last = r["first"], r["first"]["least"], r["last"]
            low = Row(first[self.group], least[self.score], least[self.member])
            rows.append((r["place"], (batch, r["shelf"], r["place"], r["piece"], low, r["n"], first[self.group], first["n"],
                                      last[self.group], last["n"])))
        rows.sort(key=lambda r: r[0])  # stable: pieces of a range stay in their order
        table = [(batch, at, *row) for at, (_, row) in enumerate(rows)]
        table.append((batch, -1, *[None] * (len(manifest) - 2)))
        spark.createDataFrame(table, manifest).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest-{batch % 2}")

    def ranks(self, spark: SparkSession, only: DataFrame | None = None) -> DataFrame | None:
        """Members with ``rank``, best score first, ties by member descending; None before the first member.

        ``only`` has the columns ``group`` and ``member``: then just the ranges these members lie in are read.
        """
        ranges = self.ranges(spark)
        if not ranges:
            return None
        above, carry = [], 0
        for at in reversed(range(len(ranges))):
            r, higher = ranges[at], ranges[at + 1] if at + 1 < len(ranges) else None
            if higher is None or higher["first_group"] != r["last_group"]:
                carry = 0
            else:
                carry = higher["n_first"] + (carry if higher["first_group"] == higher["last_group"] else 0)
            above.append((*(r[c] for c in SPOT), carry))
        read = ranges
        if only is not None:
            buckets = self.members.touched(only)
            known = self.members.read(spark, buckets)
            if known is None:
                return self._rows(spark, ranges[:1]).select(self.group, self.member, self.score, F.lit(0).alias("rank")).limit(0)
            asked = known.join(only, self._same_member(known, only), "left_semi")
            manifest = _manifest_schema(known.select(self._key().alias("low")).schema["low"], known.schema[self.group])
            wanted = {r[0] for r in self._located(asked, ranges, manifest).select("__at").distinct().collect()}
            read = [r for at, r in enumerate(ranges) if at in wanted] or ranges[:1]
        # One row per range; the carried count belongs to the highest group of a range alone.
        carried = spark.createDataFrame(above, "version long, shelf int, place int, piece int, above long")
        rows, spot = self._rows(spark, read), SPOT
        best = Window.partitionBy(*spot, self.group).orderBy(F.col(self.score).desc(), F.col(self.member).desc())
        highest = F.struct(self.group).eqNullSafe(F.max(F.struct(self.group)).over(Window.partitionBy(*spot)))
        counted = rows.withColumns({"rank": F.row_number().over(best), "__highest": highest}).join(carried, spot)
        place = F.col("rank") + F.when(F.col("__highest"), F.col("above")).otherwise(0)
        ranked = counted.select(self.group, self.member, self.score, place.alias("rank"))
        return ranked if only is None else ranked.join(only, self._same_member(ranked, only), "left_semi")


def _manifest_schema(low: StructField, group: StructField) -> StructType:
    long = LongType()
    return StructType([
        StructField("batch", long), StructField("at", IntegerType()), StructField("version", long),
        StructField("shelf", IntegerType()), StructField("place", IntegerType()), StructField("piece", IntegerType()), StructField("low", low.dataType), StructField("n", long),
        StructField("first_group", group.dataType), StructField("n_first", long),
        StructField("last_group", group.dataType), StructField("n_last", long)])


def keep_board(
    changes: DataFrame, board: Board, checkpoint: str, order: str | Sequence[str], once: bool = True, every: str = "1 minute"
) -> StreamingQuery:
    """Keep ``board`` up to date from a stream of score changes; inside a micro-batch they follow ``order``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        board.apply(batch, order, batch_id)

    return triggered(changes.writeStream.foreachBatch(write), checkpoint, once, every).start()
