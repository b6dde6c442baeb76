"""The list of image files of an experiment as a table.

A manifest has one row per file: ``mode``, ``cycle`` (0-based, in the order of
the directories of the mode), ``position``, ``col``, ``row`` and ``path``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotweave.functions.names import (
    MODE_PATTERNS,
    TILE_PATTERNS,
    directory,
    file_name,
    first_match,
    merged_output_path,
    natural_key,
)
from spotweave.operators.ranking import dense_number, number_rows, number_within

TILE = ["position", "col", "row"]


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths under ``root``, relative to it; file contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    return listed.select(F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("path"))


def scan_manifest(
    paths: DataFrame,
    modes: Mapping[str, str] = MODE_PATTERNS,
    tiles: Sequence[str] = TILE_PATTERNS,
) -> DataFrame:
    """Manifest of the files whose directory and name follow the patterns; others drop out.

    A tile pattern without groups puts its files into position 0, one column
    per file in path order.
    """
    mode = F.lit(None).cast("string")
    for name, pattern in reversed(modes.items()):
        mode = F.when(F.col("dir").rlike(pattern), F.lit(name)).otherwise(mode)
    stem = F.regexp_replace(file_name("path"), r"\.[^.]*$", "")
    named = paths.withColumn("dir", directory("path")).withColumn("stem", stem)
    named = named.withColumn("mode", mode).where(F.col("mode").isNotNull())
    # Cycles are the directories of a mode: dozens, whatever the number of files.
    dirs = named.select("mode", "dir").distinct()
    cycles = dirs.withColumn("cycle", F.row_number().over(Window.partitionBy("mode").orderBy("dir")) - 1)
    follows = reduce(lambda a, b: a | b, [F.col("stem").rlike(t) for t in tiles])
    matched = named.where(follows).join(cycles, ["mode", "dir"])
    # Rows that got here follow one of the patterns, so a single pattern needs no second test.
    part = lambda g: F.regexp_extract("stem", tiles[0], g) if len(tiles) == 1 else first_match("stem", tiles, g)
    if all("(" in t for t in tiles):
        return matched.select(
            "mode",
            "cycle",
            F.trim(part(1)).alias("position"),
            part(2).cast("int").alias("col"),
            part(3).cast("int").alias("row"),
            "path",
        )
    counted = number_within(matched.select("mode", "cycle", "path"), ["mode", "cycle"], ["path"], "col")
    return counted.select(
        "mode", "cycle", F.lit("0").alias("position"), F.col("col").cast("int").alias("col"), F.lit(0).alias("row"), "path"
    )


def missing_files(manifest: DataFrame) -> DataFrame:
    """(mode, cycle, tile) combinations without a file.

    The rounds of an experiment fit in one short list, which every tile is
    compared with, so rounds and tiles are never multiplied.
    """
    rounds = F.struct("mode", "cycle")
    every = manifest.agg(F.collect_set(rounds).alias("_r")).scalar()
    have = manifest.groupBy(*TILE).agg(F.collect_set(rounds).alias("_h"))
    lost = have.select(*TILE, F.explode(F.array_except(every, F.col("_h"))).alias("_m"))
    return lost.select("_m.mode", "_m.cycle", *TILE)


def file_sets(manifest: DataFrame, kind: str, modes: Sequence[str]) -> DataFrame:
    """Files grouped for a stage, long form: ``set_key``, ``ordinal`` in the set, ``path``.

    ``cycle``: the i-th cycles of all modes; ``position``: one position of one
    cycle; ``tileset``: one tile over all cycles and modes; ``filelist``: all
    files.  Sets of any size stay spread over the cluster.
    """
    order_of = F.lit(len(modes))
    for k, name in reversed(list(enumerate(modes))):
        order_of = F.when(F.col("mode") == name, F.lit(k)).otherwise(order_of)
    files = manifest.where(F.col("mode").isin(list(modes))).withColumn("_m", order_of)
    text = lambda *cols: F.concat_ws("/", *[F.col(c).cast("string") for c in cols])
    keys: dict[str, tuple[Column, list[str]]] = {
        "cycle": (text("cycle"), ["_m", "path"]),
        "position": (text("mode", "cycle", "position"), ["col", "row", "path"]),
        "tileset": (text("position", "col", "row"), ["_m", "cycle", "path"]),
        "filelist": (F.lit("all"), ["_m", "cycle", "position", "col", "row", "path"]),
    }
    if kind not in keys:
        raise ValueError(f"unknown kind of file set: {kind}")
    key, order = keys[kind]
    keyed = files.withColumn("set_key", key)
    return number_within(keyed, ["set_key"], [F.col(c) for c in order]).select("set_key", "ordinal", "path")


def merged_outputs(sets: DataFrame, mode: str, **naming) -> DataFrame:
    """One output per file set, named after its first file."""
    first = sets.groupBy("set_key").agg(F.min_by("path", "ordinal").alias("_first"))
    return first.select("set_key", merged_output_path("_first", mode, **naming).alias("output"))


def pending_work(work: DataFrame, done: DataFrame) -> DataFrame:
    """Work whose output does not exist yet."""
    return work.join(done.select("output"), "output", "left_anti").select(*work.columns)


def chunk_work(work: DataFrame, order: Sequence[str], size: int, n_chunks: int | None = None) -> DataFrame:
    """Number work in chunks of ``size`` and keep the first ``n_chunks``."""
    numbered = number_rows(work, [F.col(c) for c in order], "_i")
    chunked = numbered.withColumn("chunk", F.floor(F.col("_i") / size)).drop("_i")
    return chunked if n_chunks is None else chunked.where(F.col("chunk") < n_chunks)


def position_index(tiles: DataFrame, name: str = "tile_name", patterns: Sequence[str] = TILE_PATTERNS) -> DataFrame:
    """0-based number of each tile's position, positions in natural order of their tiles."""
    keyed = tiles.withColumn("_pos", first_match(name, patterns, 1)).withColumn("_nat", natural_key("_pos"))
    numbers = dense_number(keyed, ["_pos", "_nat"], ["_nat"], "position_index")
    return keyed.join(numbers.select("_pos", "position_index"), "_pos").drop("_pos", "_nat")


def fov_index(tiles: DataFrame, name: str = "tile_name") -> DataFrame:
    """0-based number of each tile in natural order."""
    return number_rows(tiles.withColumn("_nat", natural_key(name)), ["_nat"], "fov_index").drop("_nat")


def slim(manifest: DataFrame, position: str, cols: tuple[int, int], rows: tuple[int, int], shift: bool = False) -> DataFrame:
    """Files of a rectangle of tiles of one position, optionally renumbered from 0."""
    kept = manifest.where(
        (F.col("position") == position) & F.col("col").between(*cols) & F.col("row").between(*rows)
    )
    if shift:
        kept = kept.withColumn("col", F.col("col") - cols[0]).withColumn("row", F.col("row") - rows[0])
    digits = lambda c: F.lpad(F.col(c).cast("string"), 3, "0")
    target = F.concat(
        directory("path"), F.lit(f"/MAX_Pos{position}_"), digits("col"), F.lit("_"), digits("row"), F.lit(".tif")
    )
    return kept.withColumn("target", target)


def arrange_by_position(manifest: DataFrame) -> DataFrame:
    """Target path of every file under the directory of its position."""
    number = F.lpad((F.col("cycle") + 1).cast("string"), 2, "0")
    target = F.concat_ws("/", F.concat(F.lit("Pos"), F.col("position")), F.concat(F.col("mode"), number), file_name("path"))
    return manifest.withColumn("target", target)


def inventory(spots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of entries under every key."""
    return spots.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
