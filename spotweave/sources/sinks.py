"""Writers for the results of a run."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.operators.assign import global_cell_id
from spotweave.operators.codebook import short_rows
from spotweave.operators.expression import wide_matrix
from spotweave.operators.ranking import number_rows


def run_stamp(at: datetime | None = None) -> str:
    """Minute stamp used in output names."""
    return (at or datetime.now()).strftime("%Y%m%d%H%M")


def write_tsv(df: DataFrame, path: str, order: Sequence[str | Column] | None = None) -> None:
    """Tab-separated with a header; with ``order`` a fresh 0-based index column comes first."""
    if order is not None:
        df = number_rows(df, order, "index").select("index", *df.columns)
    df.write.csv(path, sep="\t", header=True)


def write_spot_csvs(spots: DataFrame, path: str) -> None:
    """One folder per tile: rows of a tile come together, so that it gets one file, or several of bounded size if it is large.

    Tasks put their files in place themselves; the driver would take the many folders one after the other.
    """
    together = spots.hint("rebalance", "tile_name")
    together.write.partitionBy("tile_name").option("mapreduce.fileoutputcommitter.algorithm.version", "2").csv(path, header=True)


def write_matrix(expr: DataFrame, cells: DataFrame, codebook: DataFrame, path: str) -> None:
    """Cells x genes with lower-cased gene names as headers, in codebook order.

    The codebook names the columns of the file, so its short list is read first.
    """
    genes = short_rows(codebook.select("gene_id", F.lower("gene").alias("gene")))
    wide = wide_matrix(expr, cells, [g["gene_id"] for g in genes], [g["gene"] for g in genes])
    wide.write.csv(path, sep="\t", header=True)


def write_annotated(expr: DataFrame, neurons: DataFrame, codebook: DataFrame, path: str) -> None:
    """Annotated matrix as three tables: counts ``X``, cells ``obs`` and genes ``var``."""
    obs = neurons.select(
        F.col("id").alias("cell_id"),
        F.col("pos10x_x").alias("pos_x"),
        F.col("pos10x_y").alias("pos_y"),
        "slice",
        F.array("pos10x_x", "pos10x_y").alias("spatial"),
    )
    counts = expr.select(global_cell_id().alias("cell_id"), "gene_id", "n")
    counts.join(obs.select("cell_id"), "cell_id", "left_semi").write.parquet(f"{path}/X")
    obs.write.parquet(f"{path}/obs")
    codebook.select("gene_id", F.col("gene").alias("gene_symbol")).write.parquet(f"{path}/var")


def write_params(params: DataFrame, path: str) -> None:
    """One JSON document per row."""
    params.write.json(path)


def write_by_position(manifest: DataFrame, path: str) -> None:
    """Manifest partitioned by position, so that later reads prune."""
    manifest.write.partitionBy("position").parquet(path)


def store_by_pixel(df: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Save a pixel, mask or spot table bucketed by pixel.

    Tables stored with the same number of buckets join on the pixel without
    moving either of them, which pays for images that many steps read.
    """
    writer = df.write.bucketBy(buckets, "fov", "r", "c").sortBy("fov", "r", "c")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
