"""Readers for the tables a run leaves behind, all with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.schemas import TABLES

SPOT_CSV = "m1 DOUBLE, m2 DOUBLE, j INT"
PARAMS = "threshold DOUBLE, noise_first DOUBLE, noise_final DOUBLE, trim INT, cropf DOUBLE, median_max ARRAY<DOUBLE>"
TILE_TEXT = "MAX_Pos\\d+_\\d+_\\d+"


def read_tsv(spark: SparkSession, path: str, schema: str, comment: str = "#") -> DataFrame:
    """Tab-separated table with a header and declared types."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema, comment=comment)


def read_codebook(spark: SparkSession, path: str) -> DataFrame:
    """Codebook whose index column is the gene id."""
    return read_tsv(spark, path, TABLES["codebook"])


def read_matrix(spark: SparkSession, path: str, n_cols: int) -> DataFrame:
    """Numeric matrix with an index column, long form ``(row, col, w)``."""
    names = [f"c{k}" for k in range(n_cols)]
    wide = read_tsv(spark, path, "row INT, " + ", ".join(f"{n} DOUBLE" for n in names))
    long = wide.unpivot(["row"], names, "col", "w")
    return long.select("row", F.substr("col", F.lit(2)).cast("int").alias("col"), "w")


def read_spot_csvs(spark: SparkSession, path: str) -> DataFrame:
    """Spots of all tiles in one read; the tile is named in the path, m1 is the row and m2 the column."""
    spots = spark.read.csv(path, header=True, schema=SPOT_CSV, recursiveFileLookup=True)
    return spots.select(
        F.regexp_extract(F.col("_metadata.file_path"), f"({TILE_TEXT})", 1).alias("tile_name"),
        F.col("m1").alias("lroi_x"),
        F.col("m2").alias("lroi_y"),
        F.col("j").alias("gene_id"),
    )


def read_spot_tables(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Spot tables of several runs or tiles in one read."""
    return spark.read.parquet(*paths)


def flatten_tiles(tiles: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per entry of the parallel lists of a tile."""
    zipped = tiles.select(key, F.explode(F.arrays_zip(*columns)).alias("_e"))
    return zipped.select(key, *[F.col(f"_e.{c}").alias(c) for c in columns])


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def read_stitched_text(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``file: a; position: (x, y); grid: (i, j)`` as columns."""
    lines = spark.read.text(path)
    part = lambda pattern, k: F.regexp_extract("value", pattern, k)
    spot, grid = r"position:\s*\(\s*(-?\d+),\s*(-?\d+)\s*\)", r"grid:\s*\(\s*(-?\d+),\s*(-?\d+)\s*\)"
    return lines.where(F.col("value").contains("file:")).select(
        F.trim(part(r"file:\s*([^;]+)", 1)).alias("tile"),
        part(spot, 1).cast("int").alias("pos_x"),
        part(spot, 2).cast("int").alias("pos_y"),
        part(grid, 1).cast("int").alias("grid_x"),
        part(grid, 2).cast("int").alias("grid_y"),
    )


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """Stitched positions per position file: column 0 is y, column 1 is x, rows in tile order."""
    raw = spark.read.csv(path, sep="\t", header=True, schema="tile_no INT, p0 DOUBLE, p1 DOUBLE", recursiveFileLookup=True)
    return raw.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"(Pos\d+)", 1).alias("position"),
        "tile_no",
        F.col("p1").alias("pos_x"),
        F.col("p0").alias("pos_y"),
    )


def read_params(spark: SparkSession, path: str) -> DataFrame:
    """Decoding parameters of a run."""
    return spark.read.schema(PARAMS).json(path)


