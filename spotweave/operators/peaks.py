"""Peaks that stand out by their prominence, plateaus included.

A pixel is a peak when every way from it to a higher pixel goes down by at
least the prominence.  That is what is left when the image, lowered by the
prominence, is raised again under the image (reconstruction).  Frames are cut
into blocks; each block is reconstructed as an array, the levels of its border
pixels go to the neighbouring blocks, and blocks whose border was raised are
reconstructed again until nothing changes.  Small blocks are handled many at a
time.  Levels only rise, so a block that
is computed twice gives the same result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from spotweave.operators.blocks import HOME, cut_blocks, swept
from spotweave.operators.links import components
from spotweave.operators.pixels import PLANE
from spotweave.session import discard, settle

AROUND = {-1: 1, 0: 1, 1: 1}  # the eight neighbours
AT = ("r", "c")
BATCH = 1 << 16  # pixels of the blocks that are reconstructed together


def rebuilt(ceiling: np.ndarray, level: np.ndarray) -> np.ndarray:
    """``level`` of each array of a stack, spread to neighbours as far as ``ceiling`` lets it, until nothing changes."""
    level, moving = level.copy(), np.arange(len(level))
    while moving.size:
        now = level[moving]
        higher = np.minimum(ceiling[moving], swept(now, AROUND, np.maximum, -np.inf))
        level[moving] = higher
        moving = moving[(higher != now).any(axis=(-2, -1))]
    return level


def first_of_group(mask: np.ndarray) -> np.ndarray:
    """For every pixel of the mask the first pixel, as a flat index in its array, that it touches through others."""
    height, width = mask.shape[-2:]
    first = np.where(mask, np.arange(height * width).reshape(height, width), height * width)
    while True:
        lower = np.where(mask, swept(first, AROUND, np.minimum, height * width), height * width)
        if (lower == first).all():
            return first
        first = lower


def numbered(keys: Sequence[str], *tables: pa.Table) -> tuple[np.ndarray, int]:
    """A number for each row of the tables, the same where the keys are, and how many numbers there are."""
    number = np.zeros(sum(t.num_rows for t in tables), dtype=np.int64)
    for name in keys:
        column = pa.chunked_array([chunk for t in tables for chunk in t[name].chunks], tables[0].schema.field(name).type)
        code = column.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        number = np.unique(number * (code.max(initial=0) + 1) + code, return_inverse=True)[1]
    return number, int(number.max(initial=-1)) + 1


def prominent_peaks(
    pixels: DataFrame,
    channels: Mapping[str, tuple[float | None, float]],
    block: int = 256,
    plane: Sequence[str] = PLANE,
) -> DataFrame:
    """One row per peak plateau: ``channel`` (its place in ``channels``), ``r, c`` the
    centroid, ``first_r, first_c`` its first pixel in (r, c) order, ``area`` and ``v``.

    ``channels`` maps a channel to (threshold, prominence).  Pixels at or below
    the threshold count as zero; without one (None) the image is taken as it is.
    The highest pixels of a frame need the prominence over its lowest pixel.
    Absent and null pixels are no way to anywhere.  A prominence must be positive.
    """
    if any(prominence <= 0 for _, prominence in channels.values()):
        raise ValueError("a prominence must be positive")
    values = [F.col(ch).cast("double").alias(ch) for ch in channels]
    home = cut_blocks(pixels.select(*plane, *AT, *values), plane, block, 0)
    base = settle(home.drop(HOME), "blocks")
    keys = [*plane, "_br", "_bc"]

    def level_rows(rows: DataFrame) -> DataFrame:
        """Border pixels, each sent to its own block and to those it touches."""
        near = lambda axis: F.array_distinct(F.array(*[F.floor((F.col(axis) + d) / block) for d in (-1, 0, 1)]))
        return rows.withColumn("_br", F.explode(near("r"))).withColumn("_bc", F.explode(near("c")))

    kinds = [pixels.schema[name] for name in (*plane, *AT)]
    whole = [StructField("channel", IntegerType())]
    border = StructType([*kinds, *whole, StructField("level", DoubleType())])
    found = StructType([*kinds, *whole, StructField("v", DoubleType()), StructField("_r", IntegerType()), StructField("_c", IntegerType())])

    side = block + 2
    together = max(1, BATCH // block**2)
    # As many batches as the blocks need, so that a batch stays small whatever the data.
    batch = F.pmod(F.xxhash64(*keys), F.lit(-(-base.select(*keys).distinct().count() // together) or 1))

    def reconstructed(rows: pa.Table, known: pa.Table):
        """Image, level and known level of every channel, stacked over so many blocks of the batch as fit."""
        number, size = numbered(keys, rows, known)
        number, met = number[: rows.num_rows], number[rows.num_rows :]
        channel, level = (known[name].to_numpy() for name in ("channel", "level"))
        blocks, one = np.unique(number, return_index=True)
        for start in range(0, len(blocks), together):
            chunk, first = blocks[start : start + together], one[start : start + together]
            place = np.full(size, -1)
            place[chunk] = np.arange(len(chunk))
            corner = [rows[name].to_numpy()[first] * block - 1 for name in ("_br", "_bc")]

            def located(table: pa.Table, ours: np.ndarray, own: np.ndarray) -> tuple:
                return own, *(table[axis].to_numpy()[ours] - low[own] for axis, low in zip(AT, corner))

            def stack(dtype, fill) -> np.ndarray:
                return np.full((len(chunk), side, side), fill, dtype)

            ours, theirs = place[number] >= 0, place[met] >= 0
            at = located(rows, ours, place[number[ours]])
            there = located(known, theirs, place[met[theirs]])
            present = stack(bool, False)
            present[at] = True
            for k, (ch, (threshold, prominence)) in enumerate(channels.items()):
                image, before = stack(float, -np.inf), stack(float, -np.inf)
                values = rows[ch].to_numpy()[ours].astype(float)
                image[at] = np.where(np.isnan(values), -np.inf, values)
                if threshold is not None:
                    image[image <= threshold] = -np.inf
                own = channel[theirs] == k
                before[tuple(p[own] for p in there)] = level[theirs][own]
                ceiling = np.where(present, image, before)  # a level from another block stands as it is
                yield k, (first, *corner), present, image, rebuilt(ceiling, np.maximum(image - prominence, before)), before, prominence

    def listed(parts: list, rows: pa.Table, schema: StructType) -> pa.Table:
        """The found pixels ``(channel, a row of each one's plane, columns)`` as a table."""
        target = to_arrow_schema(schema)
        tables = []
        for k, row, columns in parts:
            columns = [*(rows[name].take(pa.array(row)) for name in plane), *map(pa.array, (*columns[:2], np.full(len(row), k), *columns[2:]))]
            tables.append(pa.table([x.cast(t) for x, t in zip(columns, target.types)], schema=target))
        return pa.concat_tables(tables) if tables else target.empty_table()

    def raise_borders(rows: pa.Table, known: pa.Table) -> pa.Table:
        parts = []
        for k, (first, row, col), present, _, level, before, _ in reconstructed(rows, known):
            outer = present.copy()
            outer[:, 2:-2, 2:-2] = False
            at = np.nonzero(outer & (level > before))
            parts.append((k, first[at[0]], [at[1] + row[at[0]], at[2] + col[at[0]], level[at]]))
        return listed(parts, rows, border)

    def pick_peaks(rows: pa.Table, known: pa.Table) -> pa.Table:
        parts = []
        for k, (first, row, col), present, image, level, _, prominence in reconstructed(rows, known):
            peak = present & (image > -np.inf) & (level == image - prominence)
            at = np.nonzero(peak)
            r, c = np.divmod(first_of_group(peak)[at], side)
            row, col = row[at[0]], col[at[0]]
            parts.append((k, first[at[0]], [at[1] + row, at[2] + col, image[at], r + row, c + col]))
        return listed(parts, rows, found)

    def over(blocks: DataFrame, rows: DataFrame, kernel, schema: StructType) -> DataFrame:
        return blocks.groupBy(batch).cogroup(rows.groupBy(batch)).applyInArrow(kernel, schema)

    def emptied() -> DataFrame:
        return base.sparkSession.createDataFrame([], border)

    def own_block(axis: str) -> Column:
        return F.floor(F.col(axis) / block)

    known = raised = settle(over(base, level_rows(emptied()), raise_borders, border), "borders")
    while not raised.isEmpty():
        met = level_rows(raised).where((F.col("_br") != own_block("r")) | (F.col("_bc") != own_block("c")))
        target = met.select(*keys).distinct()
        now = over(base.join(target, keys, "left_semi"), level_rows(known).join(target, keys, "left_semi"), raise_borders, border)
        now = settle(now, "borders")
        highest = known.unionByName(now).groupBy(*plane, *AT, "channel").agg(F.max("level").alias("level"))
        merged = settle(highest, "known")
        discard(known)
        if raised is not known:
            discard(raised)
        known, raised = merged, now
    peaks = settle(over(base, level_rows(known), pick_peaks, found), "peaks")
    discard(known)

    # The lowest pixel of a frame; pixels that the threshold takes out are zero.
    def lowest(ch: str, threshold: float | None) -> Column:
        value = F.col(ch)
        return F.min(value if threshold is None else F.when(value > threshold, value).when(value.isNotNull(), 0.0))

    floors = base.groupBy(*plane).agg(F.array(*[lowest(ch, t) for ch, (t, _) in channels.items()]).alias("_low"))
    needed = F.element_at(F.array(*[F.lit(float(p)) for _, p in channels.values()]), F.col("channel") + 1)
    high = F.col("v") - F.element_at("_low", F.col("channel") + 1) >= needed
    return plateaus(peaks, plane, block).join(floors, list(plane)).where(high).drop("_low")


def plateaus(peaks: DataFrame, plane: Sequence[str], block: int) -> DataFrame:
    """Peak pixels ``plane, channel, r, c, v`` with the first pixel ``_r, _c`` of their group inside the block, as one row per plateau.

    Groups of neighbouring blocks that touch are joined by links between them.
    """
    frame = [*plane, "channel"]
    node = F.struct(*frame, "_r", "_c")
    seam = peaks.where(" or ".join(f"{axis} % {block} in (0, {block - 1})" for axis in AT)).withColumn("_node", node)
    steps = F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr in (-1, 0, 1) for dc in (-1, 0, 1) if (dr, dc) > (0, 0)])
    looking = seam.withColumn("_step", F.explode(steps)).select(
        *frame, F.col("_node").alias("a"), (F.col("r") + F.col("_step.dr")).alias("r"), (F.col("c") + F.col("_step.dc")).alias("c")
    )
    links = looking.join(seam.select(*frame, *AT, F.col("_node").alias("b")), [*frame, *AT]).where("a <> b").select("a", "b")
    roots = components(links.distinct()).select(
        *[F.col(f"node.{name}").alias(name) for name in (*frame, "_r", "_c")], F.col("root._r").alias("first_r"), F.col("root._c").alias("first_c")
    )
    local = peaks.groupBy(*frame, "_r", "_c").agg(
        F.sum("r").alias("_sr"), F.sum("c").alias("_sc"), F.count(F.lit(1)).alias("area"), F.max("v").alias("v")
    )
    joined = local.join(roots, [*frame, "_r", "_c"], "left").select(
        *frame, F.coalesce("first_r", "_r").alias("first_r"), F.coalesce("first_c", "_c").alias("first_c"), "_sr", "_sc", "area", "v"
    )
    total = joined.groupBy(*frame, "first_r", "first_c").agg(
        F.sum("_sr").alias("_sr"), F.sum("_sc").alias("_sc"), F.sum("area").alias("area"), F.max("v").alias("v")
    )
    return total.select(
        *frame, (F.col("_sr") / F.col("area")).alias("r"), (F.col("_sc") / F.col("area")).alias("c"), "first_r", "first_c", "area", "v"
    )
