"""Neighbour search in the plane as an equi-join on square buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def near_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    reach: tuple[float, float],
    left_xy: tuple[str, str],
    right_xy: tuple[str, str],
    keep: Column,
    how: str = "inner",
) -> DataFrame:
    """Join rows that agree on ``on`` and lie within ``reach`` of each other on both axes.

    ``keep`` is the exact test.  Every right row goes to the 3 x 3 buckets it
    can reach and every left row only to its own, so each pair meets once.
    Apart from the test the two sides may not share column names besides ``on``.
    The spread side is never broadcast: its size is known only before its rows
    are repeated, and the driver would hold it whole.
    """
    wx, wy = float(reach[0]), float(reach[1])
    home = left.withColumn("_bx", F.floor(F.col(left_xy[0]) / wx)).withColumn(
        "_by", F.floor(F.col(left_xy[1]) / wy)
    )
    around = F.sequence(F.lit(-1), F.lit(1))
    spread = (
        right.withColumn("_ox", F.explode(around))
        .withColumn("_oy", F.explode(around))
        .withColumn("_bx", F.floor(F.col(right_xy[0]) / wx) + F.col("_ox"))
        .withColumn("_by", F.floor(F.col(right_xy[1]) / wy) + F.col("_oy"))
        .drop("_ox", "_oy")
    )
    keys = [*on, "_bx", "_by"]
    shared = [home[k] == spread[k] for k in keys]
    condition = keep
    for test in shared:
        condition = test & condition
    joined = home.join(spread.hint("merge"), condition, how)
    for k in keys:
        joined = joined.drop(spread[k])
    return joined.drop("_bx", "_by")
