"""Dedup against the last N distinct keys: reuse distances by dominance counting, in groups of bounded size.

Number the rows 1..n.  A row at ``t`` whose key was last seen at ``p`` has as many distinct keys between as there are rows
``j`` in between that are their key's first after ``p``, that is, whose own last place lies before ``p``.  All ``j <= p`` have
that too, so the distance is (rows before ``t`` whose last place is below ``p``, or who have none) minus ``p``.  Rows without a
last place are a running count; the rest is a count of dominated points (t, p), in which every place occurs at most once per axis.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.running import Running, running

#: Places in a strip: a strip's points are counted in one task.
STRIP = 1_000_000
#: Up to so many strips an axis, their cells (at most the square of it) are counted together.
STRIPS_TOGETHER = 1_000


def below(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For each point the total weight of the points with a smaller x and a smaller y.

    Two ranks of x are told apart at exactly one bit: the highest in which they differ.  For each bit, points that agree
    above it are sorted by y together, and those with the bit get the weight of those without it that come before.
    """
    rank = np.unique(x, return_inverse=True)[1]
    out = np.zeros(len(x), np.int64)
    for bit in range(int(rank.max()).bit_length() if len(rank) else 0):
        pair, upper = rank >> (bit + 1), (rank >> bit) & 1
        order = np.lexsort((-upper, y, pair))  # at equal y the asking points come first, so only smaller ones count
        given = np.cumsum(np.where(upper[order] == 0, weight[order], 0))
        of = pair[order]
        first = np.searchsorted(of, of)  # where each pair begins
        before = np.concatenate([[0], given])
        out[order] += np.where(upper[order] == 1, before[:-1] - before[first], 0)
    return out


def dominated(points: DataFrame, most: int, strip: int = STRIP, together: int = STRIPS_TOGETHER) -> DataFrame:
    """(x, y, below): for each distinct point (x, y; weight w) the weight of all points smaller in both; values up to ``most``.

    Points of one strip of x are counted in a group, points of one strip of y in another; what lies in smaller strips of
    both is the same question over cells, which are points of strips.
    """
    shape = "x long, y long, below long"

    def count(axis: str, other: str):
        def run(part: pd.DataFrame) -> pd.DataFrame:
            x, y, w = (part[c].to_numpy() for c in (other, axis, "w"))
            return pd.DataFrame({"x": part["x"], "y": part["y"], "below": below(x, y, w)})

        return run

    if most < together:
        return points.withColumn("__all", F.lit(0)).groupBy("__all").applyInPandas(count("y", "x"), shape)
    cut = points.select("x", "y", "w", F.floor(F.col("x") / strip).alias("of_x"), F.floor(F.col("y") / strip).alias("of_y"))
    inside = cut.groupBy("of_x").applyInPandas(count("y", "x"), shape)  # the same strip of x: smaller x and y
    beside = cut.groupBy("of_y").applyInPandas(count("y", "of_x"), shape)  # the same strip of y: a smaller strip of x, smaller y
    cells = cut.groupBy(F.col("of_x").alias("x"), F.col("of_y").alias("y")).agg(F.sum("w").alias("w"))
    coarse = dominated(cells, most // strip, max(2, strip // 1000), together).toDF("of_x", "of_y", "coarse")
    both = cut.select("x", "y", "of_x", "of_y").join(coarse, ["of_x", "of_y"])
    parts = both.select("x", "y", F.col("coarse").alias("below")).unionByName(inside).unionByName(beside)
    return parts.groupBy("x", "y").agg(F.sum("below").alias("below"))


def reuse_distance(df: DataFrame, keys: Sequence[str], order: str, width: int | None = None, strip: int = STRIP) -> DataFrame:
    """The rows with ``__distance``: how many other distinct keys came since their key's last row (NULL: never seen).

    ``order`` orders all rows totally; NULL keys are one key.  No step needs a key's rows, or all keys, in one task: places and
    last places are running values, and distances are counted in strips of ``strip`` places.
    """
    rows = df.withColumn("__all", F.lit(0))
    rows = running(rows, ["__all"], [order], [Running("__place", "count", F.lit(1))], width=width)
    rows = running(rows, keys, ["__place"], [Running("__last", "max", F.col("__place"))], inclusive=False, width=width)
    new = F.when(F.col("__last").isNull(), 1)
    rows = running(rows, ["__all"], ["__place"], [Running("__new", "count", new)], inclusive=False, width=width)
    again = rows.where(F.col("__last").isNotNull()).select(F.col("__place").alias("x"), F.col("__last").alias("y"), F.lit(1).cast("long").alias("w"))
    most = df.count()
    counted = dominated(again, most, strip, STRIPS_TOGETHER).select(F.col("x").alias("__place"), "below")
    distance = F.coalesce("__new", F.lit(0)) + F.col("below") - F.col("__last")
    return rows.join(counted, "__place", "left").select(*df.columns, distance.alias("__distance"))


def dedup_last(df: DataFrame, keys: Sequence[str], order: str, last: int, width: int | None = None, strip: int = STRIP) -> DataFrame:
    """Drop rows whose key is among the ``last`` distinct keys seen most recently (a dropped repeat refreshes its key too)."""
    rows = reuse_distance(df, keys, order, width, strip)
    return rows.where(F.col("__distance").isNull() | (F.col("__distance") >= last)).drop("__distance")
