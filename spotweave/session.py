"""Session defaults and the shared folder that long jobs settle into."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own settings."""
    warehouse = tempfile.mkdtemp(prefix="spotweave-warehouse-")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("spotweave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.checkpoint.dir", f"{warehouse}/settled")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a session inside one process may do without: it uses a folder of its
    own warehouse.  On a cluster the machines share no folder unless one is named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("name a folder that driver and executors share in spark.checkpoint.dir")
        named = f"{spark.conf.get('spark.sql.warehouse.dir')}/settled"
    return named.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the queries that run inside."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def settle(
    df: DataFrame,
    label: str = "settled",
    batch: int | None = None,
    codec: str | None = None,
    settings: Mapping[str, str] | None = None,
) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the table.

    Cuts the lineage of iterative jobs, survives the loss of executors, and
    gives the optimizer true sizes for its broadcast decisions.  The shuffle
    files behind the table are deleted as soon as it is written.  ``batch``
    bounds the rows that reach a Python task at once, for rows that are large;
    ``codec`` is another compression of the table than the session's, and
    ``settings`` are others of the session that hold while it is written.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", **(settings or {})}
    if batch:
        settings["spark.sql.execution.arrow.maxRecordsPerBatch"] = str(batch)
    if codec:
        settings["spark.sql.parquet.compression.codec"] = codec
    with configured(spark, settings):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a settled table that no later step reads."""
    sc = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
