"""Counts kept up to date while tiles arrive.

``counts_path`` holds ``part/batch=n``, the counts of one batch each, and
``merged/upto=n``, versions that add up all batches to ``n``.  A version counts
from the moment its success marker appears, which the writer adds last; until
then readers use the version before and its later batches, which both stay
until the next version is complete.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Transform = Callable[[DataFrame], DataFrame]


class _Store:
    """Folders of one ``counts_path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def part(self, number: int) -> str:
        return f"{self.path}/part/batch={number}"

    def version(self, number: int) -> str:
        return f"{self.path}/merged/upto={number}"

    def _complete(self, folder: str) -> list[int]:
        at = self._hadoop(f"{self.path}/{folder}")
        if not self._fs.exists(at):
            return []
        found = [str(status.getPath()) for status in self._fs.listStatus(at)]
        return sorted(int(f.rsplit("=", 1)[1]) for f in found if "=" in f and self._fs.exists(self._hadoop(f"{f}/_SUCCESS")))

    def parts(self) -> list[int]:
        return self._complete("part")

    def versions(self) -> list[int]:
        return self._complete("merged")

    def sources(self) -> list[str]:
        """Folders whose counts add up to all batches so far."""
        newest = max(self.versions(), default=-1)
        later = [self.part(n) for n in self.parts() if n > newest]
        return ([self.version(newest)] if newest >= 0 else []) + later

    def delete(self, path: str) -> None:
        self._fs.delete(self._hadoop(path), True)


def update_counts(
    spark: SparkSession,
    source: str,
    schema: StructType,
    transform: Transform,
    counts_path: str,
    checkpoint_path: str,
    files_per_batch: int = 1000,
    merge_every: int = 50,
    count: str = "n",
) -> None:
    """Count the files that have arrived under ``source`` since the last call.

    Every micro-batch writes its own partial counts under its batch number and
    overwrites them when it is replayed, so a restart neither loses nor doubles
    a file.  The checkpoint is the list of files already done.  Every
    ``merge_every`` batches all counts are added up into one new version;
    ``count`` is the column to add, all others are keys.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    store = _Store(spark, counts_path)

    def write(batch: DataFrame, number: int) -> None:
        if number in store.versions():  # replayed after it was merged
            return
        transform(batch).write.mode("overwrite").parquet(store.part(number))
        if (number + 1) % merge_every == 0:
            _merge(spark, store, number, count)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _merge(spark: SparkSession, store: _Store, number: int, count: str) -> None:
    """Write the version up to batch ``number``, then drop what the version before it replaced."""
    before = store.versions()
    found = spark.read.parquet(*store.sources())
    keys = [c for c in found.columns if c != count]
    found.groupBy(*keys).agg(F.sum(count).alias(count)).write.mode("overwrite").parquet(store.version(number))
    if before:
        for old in before[:-1]:
            store.delete(store.version(old))
        for part in store.parts():
            if part <= before[-1]:
                store.delete(store.part(part))


def read_counts(spark: SparkSession, counts_path: str, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Counts over all batches so far: the newest version and the batches after it."""
    found = spark.read.parquet(*_Store(spark, counts_path).sources())
    return found.groupBy(*keys).agg(F.sum(count).alias(count))


def rows_of_tiles(table: DataFrame, batch: DataFrame, tile: str = "fov") -> DataFrame:
    """The rows of a large table, such as a mask, that belong to a tile of ``batch``.

    The span of tile numbers reaches the scan, so files and row groups of other
    tiles are not read; its two ends come to the driver.  The batch's tile
    numbers are sent to all tasks, so that the table is neither sorted nor
    moved for them, and rows that a plan puts together per tile are not put
    together for others.
    """
    low, high = batch.agg(F.min(tile), F.max(tile)).first()
    tiles = F.broadcast(batch.select(tile).distinct())
    span = F.lit(False) if low is None else F.col(tile).between(low, high)
    return table.where(span).join(tiles, tile, "left_semi")
