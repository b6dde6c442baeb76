"""Row numbers and medians that never put a whole table or group into one task.

A window without partition keys, or with a hot key, sorts all its rows in one
task.  Here the rows are range-sorted on the full order instead:
rows with one key and different places in the order go to different tasks, every
task numbers its own rows, and only one count per partition is added up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotweave.session import settle

_ROW_BITS = 33  # monotonically_increasing_id keeps the row in the low 33 bits


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "row_no") -> DataFrame:
    """Add the 0-based position of each row in the given order.

    The order should be unique; equal rows get an arbitrary mutual order.
    """
    numbered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    placed = settle(numbered.withColumn("_pid", F.shiftright("_mid", _ROW_BITS)), "numbered")
    sizes = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per sort partition, so this window is small whatever the data.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    in_task = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.join(starts, "_pid").select(*df.columns, (F.col("_start") + in_task).alias(name))


def number_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "ordinal"
) -> DataFrame:
    """Add the 0-based position of each row inside its group; hot groups are fine."""
    rows = number_rows(df, [*[F.col(k) for k in keys], *order], "_row")
    first = rows.groupBy(*keys).agg(F.min("_row").alias("_first"))
    joined = rows.join(first, list(keys))
    return joined.select(*df.columns, (F.col("_row") - F.col("_first")).alias(name))


def dense_number(df: DataFrame, cols: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    """0-based number of each distinct value of ``cols`` in the given order."""
    return number_rows(df.select(*cols).distinct(), order, name)


def exact_median(df: DataFrame, value: str, name: str = "median") -> DataFrame:
    """One row with the exact median of a column of any size.

    Equal values are counted first, so a value that most rows have is one row
    when the distinct values are sorted.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    spread = settle(counts.orderBy(value).withColumn("_pid", F.spark_partition_id()), "counted")
    sums = spread.groupBy("_pid").agg(F.sum("_n").alias("_all"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per sort partition
    starts = sums.select("_pid", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_start"))
    end = F.col("_start") + F.sum("_n").over(Window.partitionBy("_pid").orderBy(value))
    total = spread.agg(F.sum("_n")).first()[0] or 0
    placed = spread.join(starts, "_pid").withColumn("_end", end)
    holds = [((F.col("_end") > at) & (F.col("_end") - F.col("_n") <= at)).cast("int") for at in ((total - 1) // 2, total // 2)]
    middle = placed.withColumn("_times", holds[0] + holds[1]).where("_times > 0")
    return middle.agg((F.sum(F.col(value) * F.col("_times")) / F.sum("_times")).alias(name))
