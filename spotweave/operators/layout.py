"""Tile geometry: grids, placement, transforms and point clouds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.session import discard, settle


def to_global(
    df: DataFrame,
    tforms: DataFrame,
    row: str = "lroi_x",
    col: str = "lroi_y",
    out: Sequence[str] = ("pos10_x", "pos10_y"),
) -> DataFrame:
    """Tile pixels to slice coordinates: x follows the image column, y the row.

    ``tforms(fov, scale, pos_x, pos_y)`` has one row per tile; whether it is
    broadcast is left to the size the optimizer sees.
    """
    t = tforms.select("fov", "scale", "pos_x", "pos_y")
    x = F.col("scale") * F.col(col) + F.col("pos_x")
    y = F.col("scale") * F.col(row) + F.col("pos_y")
    joined = df.join(t, "fov")
    return joined.select(*[joined[c] for c in df.columns], x.alias(out[0]), y.alias(out[1]))


def rescale_positions(positions: DataFrame, factor: float = 0.5) -> DataFrame:
    return positions.withColumn("ref_x", F.col("pos_x") * factor).withColumn("ref_y", F.col("pos_y") * factor)


def flip_axes(positions: DataFrame, flip_x: bool = False, flip_y: bool = False) -> DataFrame:
    sign = lambda flip: -1.0 if flip else 1.0
    return positions.withColumn("pos_x", F.col("pos_x") * sign(flip_x)).withColumn(
        "pos_y", F.col("pos_y") * sign(flip_y)
    )


def nominal_grid(
    tiles: DataFrame, pixels: int = 3200, pixel_size: float = 0.33, overlap: float = 0.23
) -> DataFrame:
    """Stage position of every grid tile, centred on the middle of its slice.

    ``tiles(position, col, row, ...)`` with 0-based grid indexes.  The centre is
    a plain aggregate joined back, so a slice of any size stays spread out.
    """
    step = (1 - overlap) * pixels * pixel_size
    placed = tiles.withColumn("_sx", F.col("col") * step).withColumn("_sy", F.col("row") * step)
    centre = placed.groupBy("position").agg(F.avg("_sx").alias("_mx"), F.avg("_sy").alias("_my"))
    joined = placed.join(centre, "position")
    return joined.select(
        *tiles.columns,
        (F.col("_sx") - F.col("_mx")).alias("stage_x"),
        (F.col("_sy") - F.col("_my")).alias("stage_y"),
    )


def snake_number(col: Column, row: Column, n_cols: Column | int, n_rows: Column | int) -> Column:
    """Visit number of a grid tile: bottom line first, lines alternating in direction.

    ``row`` counts from the top.  The bottom line runs right to left unless it is the only one.
    """
    n_cols = n_cols if isinstance(n_cols, Column) else F.lit(n_cols)
    n_rows = n_rows if isinstance(n_rows, Column) else F.lit(n_rows)
    line = n_rows - 1 - row
    step = F.when((line % 2 == 0) & (n_rows > 1), n_cols - 1 - col).otherwise(col)
    return (line * n_cols + step + 1).cast("long")


def expand_regions(regions: DataFrame, xtiles: int, ytiles: int, tile_size: float) -> DataFrame:
    """Tile positions and names for every region centre ``(region, x, y, z)``."""
    spread = regions.withColumn("xi", F.explode(F.sequence(F.lit(0), F.lit(xtiles - 1)))).withColumn(
        "yi", F.explode(F.sequence(F.lit(0), F.lit(ytiles - 1)))
    )
    digits = lambda c: F.lpad(F.col(c).cast("string"), 3, "0")
    name = F.concat(F.lit("Pos"), F.col("region").cast("string"), F.lit("_"), digits("xi"), F.lit("_"), digits("yi"))
    return spread.select(
        "region",
        name.alias("tile"),
        (F.col("x") + (xtiles - 1) / 2 * tile_size - F.col("xi") * tile_size).alias("tile_x"),
        (F.col("y") - (ytiles - 1) / 2 * tile_size + F.col("yi") * tile_size).alias("tile_y"),
        F.col("z").alias("tile_z"),
    )


def place_tiles(offsets: DataFrame) -> DataFrame:
    """``slice, part, tile, pos_x, pos_y``: tile positions from pairwise offsets, smallest position of a part at 0.

    ``offsets(slice, tile_a, tile_b, dx, dy)`` says b lies (dx, dy) from a; an
    optional ``weight`` says how far that is to be trusted.  Positions follow
    the spanning tree of the heaviest links (the lowest pair of tiles on a tie,
    an unknown weight last).  Tiles that no links join are parts of their own,
    named by their lowest tile; links without an offset do not count.

    All groups of tiles join along their heaviest link out at the same time,
    then one row stands for a group, so links and groups shrink with each round
    and the rounds grow with the logarithm of the tiles.
    """
    weight = F.col("weight").cast("double") if "weight" in offsets.columns else F.lit(0.0)
    tiles = offsets.select("slice", F.explode(F.array("tile_a", "tile_b")).alias("tile")).where("tile IS NOT NULL").distinct()
    turn = F.when(F.col("tile_a") < F.col("tile_b"), 1.0).otherwise(-1.0)
    one_way = offsets.where("tile_a <> tile_b AND dx IS NOT NULL AND dy IS NOT NULL").select(
        "slice",
        F.least("tile_a", "tile_b").alias("a"),
        F.greatest("tile_a", "tile_b").alias("b"),
        (F.col("dx") * turn).alias("dx"),
        (F.col("dy") * turn).alias("dy"),
        (-F.coalesce(weight, F.lit(float("-inf")))).alias("_light"),
    ).withColumn("key", F.struct("_light", "a", "b", "dx", "dy"))
    back = one_way.select("slice", F.col("b").alias("a"), F.col("a").alias("b"), (-F.col("dx")).alias("dx"), (-F.col("dy")).alias("dy"), "key")
    links = settle(one_way.select(*back.columns).unionByName(back), "links")
    levels = []
    while not links.isEmpty():
        levels.append(merged_groups(links))
        held = levels[-1].select("slice", F.col("node").alias("a"), F.col("head").alias("_a"), F.col("x").alias("_xa"), F.col("y").alias("_ya"))
        other = held.toDF("slice", "b", "_b", "_xb", "_yb")
        outer = links.join(held, ["slice", "a"]).join(other, ["slice", "b"]).where("_a <> _b")
        outer = outer.select(
            "slice",
            F.col("_a").alias("a"),
            F.col("_b").alias("b"),
            (F.col("_xa") + F.col("dx") - F.col("_xb")).alias("dx"),
            (F.col("_ya") + F.col("dy") - F.col("_yb")).alias("dy"),
            "key",
        )
        outer = settle(outer, "links")
        discard(links)
        links = outer
    placed = tiles.select("slice", "tile", F.col("tile").alias("head"), F.lit(0.0).alias("pos_x"), F.lit(0.0).alias("pos_y"))
    if levels:
        whole = levels[-1]
        for level in reversed(levels[:-1]):  # each level is a fraction of the one before
            above = whole.select("slice", F.col("node").alias("head"), F.col("head").alias("_top"), F.col("x").alias("_x"), F.col("y").alias("_y"))
            whole = level.join(above, ["slice", "head"], "left").select(
                "slice",
                "node",
                F.coalesce("_top", "head").alias("head"),
                (F.col("x") + F.coalesce("_x", F.lit(0.0))).alias("x"),
                (F.col("y") + F.coalesce("_y", F.lit(0.0))).alias("y"),
            )
        found = whole.select("slice", F.col("node").alias("tile"), F.col("head").alias("_top"), "x", "y")
        placed = tiles.join(found, ["slice", "tile"], "left").select(
            "slice", "tile", F.coalesce("_top", "tile").alias("head"), F.coalesce("x", F.lit(0.0)).alias("pos_x"), F.coalesce("y", F.lit(0.0)).alias("pos_y")
        )
    placed = settle(placed, "placed")
    low = placed.groupBy("slice", "head").agg(F.min("tile").alias("part"), F.min("pos_x").alias("_lx"), F.min("pos_y").alias("_ly"))
    return placed.join(low, ["slice", "head"]).select(
        "slice", "part", "tile", (F.col("pos_x") - F.col("_lx")).alias("pos_x"), (F.col("pos_y") - F.col("_ly")).alias("pos_y")
    )


def merged_groups(links: DataFrame) -> DataFrame:
    """``slice, node, head, x, y``: the group every node joins along its heaviest link, and its position seen from the head.

    ``links(slice, a, b, dx, dy, key)`` go both ways with one key, so two nodes
    that choose the same link close no ring; the lower of them is the head.
    """
    best = links.groupBy("slice", "a").agg(F.min(F.struct("key", "b", "dx", "dy")).alias("_e")).select("slice", "a", "_e.*")
    other = best.select("slice", F.col("a").alias("b"), F.col("key").alias("_key"))
    is_head = (F.col("key") == F.col("_key")) & (F.col("a") < F.col("b"))
    chosen = best.join(other, ["slice", "b"]).select(
        "slice",
        F.col("a").alias("node"),
        F.when(is_head, F.col("a")).otherwise(F.col("b")).alias("head"),
        F.when(is_head, 0.0).otherwise(-F.col("dx")).alias("x"),
        F.when(is_head, 0.0).otherwise(-F.col("dy")).alias("y"),
    )
    group = settle(chosen, "groups")
    while True:
        up = group.select("slice", F.col("node").alias("head"), F.col("head").alias("_top"), F.col("x").alias("_x"), F.col("y").alias("_y"))
        doubled = group.join(up, ["slice", "head"]).select(
            "slice", "node", F.col("_top").alias("head"), (F.col("x") + F.col("_x")).alias("x"), (F.col("y") + F.col("_y")).alias("y"), (F.col("_top") != F.col("head")).alias("_moved")
        )
        doubled = settle(doubled, "groups")
        discard(group)
        group = doubled.drop("_moved")
        if doubled.where("_moved").isEmpty():
            return group


def consensus_shift(shifts: DataFrame) -> DataFrame:
    """Median whole-pixel shift over the tiles of a (position, cycle).

    Shifts are whole pixels inside the search window, so the exact median needs
    only a small count per value.
    """
    return shifts.groupBy("position", "cycle").agg(F.median("dr").alias("dr"), F.median("dc").alias("dc"))


def scale_point_cloud(
    points: DataFrame, functional: DataFrame, stack_id: int, offset: tuple[float, float]
) -> DataFrame:
    """Points of one stack moved by the offset, z halved, flagged when functional."""
    flags = functional.where(F.col("stack_idx") == stack_id).select("sunit_id").distinct().withColumn("_f", F.lit(1))
    kept = points.where(F.col("stack_idx") == stack_id).join(flags, "sunit_id", "left")
    return kept.select(
        "sunit_id",
        F.rint(F.col("sunit_x") - offset[0]).alias("x"),
        F.rint(F.col("sunit_y") - offset[1]).alias("y"),
        F.rint(F.col("sunit_z") * 0.5).alias("z"),
        F.rint(F.col("depth") * 0.25).alias("depth"),
        F.coalesce("_f", F.lit(0)).alias("is_fun"),
    )


def rotate_points(
    points: DataFrame,
    matrix: Sequence[Sequence[float]],
    old_centre: Sequence[float],
    new_centre: Sequence[float],
) -> DataFrame:
    """Rotate (x, y, z) about ``old_centre`` and move the centre to ``new_centre``."""
    axes = ("x", "y", "z")
    centred = [F.col(a) - F.lit(float(o)) for a, o in zip(axes, old_centre)]
    turned = {
        a: sum((F.lit(float(w)) * v for w, v in zip(line, centred)), F.lit(0.0)) + F.lit(float(n))
        for a, line, n in zip(axes, matrix, new_centre)
    }
    return points.withColumns(turned)


def pad_depth(points: DataFrame, reach: int = 2) -> DataFrame:
    """Each point at every plane from z - reach to z + reach."""
    return points.withColumn("_dz", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).withColumn(
        "z", F.col("z") + F.col("_dz")
    ).drop("_dz")
