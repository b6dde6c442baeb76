"""Queries on tile layout and point clouds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.operators import layout
from spotweave.plans.registry import Inputs, Registry, rounded

geometry = Registry()

# Fixed value: the rotation of the derived point cloud (about the z axis, 3-4-5 triangle).
TURN = ((0.6, -0.8, 0.0), (0.8, 0.6, 0.0), (0.0, 0.0, 1.0))


def grid(i: Inputs) -> DataFrame:
    return i.tiles.select(
        "position",
        "fov",
        F.floor(F.col("fov") % 16 / 4).cast("int").alias("col"),
        (F.col("fov") % 4).alias("row"),
    )


@geometry.query(
    """WITH g AS (SELECT position, fov, CAST(fov % 16 // 4 AS INT) AS col, CAST(fov % 4 AS INT) AS row FROM fx_tiles)
    SELECT *, round((col - avg(col) OVER w) * 0.77 * 3200 * 0.33, 6)::DOUBLE AS stage_x, round((row - avg(row) OVER w) * 0.77 * 3200 * 0.33, 6)::DOUBLE AS stage_y
    FROM g WINDOW w AS (PARTITION BY position)"""
)
def nominal_grid(i: Inputs) -> DataFrame:
    return rounded(layout.nominal_grid(grid(i)))


@geometry.query(
    """SELECT fov, CAST((3 - fov % 4) * 4 + CASE WHEN (3 - fov % 4) % 2 = 0 THEN 4 - fov % 16 // 4 ELSE fov % 16 // 4 + 1 END AS BIGINT) AS visit FROM fx_tiles"""
)
def snake_order(i: Inputs) -> DataFrame:
    return grid(i).select("fov", layout.snake_number(F.col("col"), F.col("row"), 4, 4).alias("visit"))


@geometry.query(
    """WITH r AS (SELECT *, each(0, 2) AS xi FROM fx_regions), s AS (SELECT *, each(0, 1) AS yi FROM r)
    SELECT region, 'Pos' || CAST(region AS VARCHAR) || '_00' || CAST(xi AS VARCHAR) || '_00' || CAST(yi AS VARCHAR) AS tile,
      x + 1.0 * 250 - xi * 250 AS tile_x, y - 0.5 * 250 + yi * 250 AS tile_y, z AS tile_z FROM s"""
)
def region_tiles(i: Inputs) -> DataFrame:
    return layout.expand_regions(i.regions, 3, 2, 250.0)


PLACED = """WITH t AS (SELECT slice, tile_a AS tile FROM fx_offsets UNION SELECT slice, tile_b FROM fx_offsets),
    p AS (SELECT t.slice, t.tile, pos_x + (fov * 7) % 11 * 0.25 AS x, pos_y + (fov * 5) % 13 * 0.25 AS y FROM t JOIN fx_tforms f ON f.fov = t.tile)
    SELECT slice, tile, x - min(x) OVER (PARTITION BY slice) AS pos_x, y - min(y) OVER (PARTITION BY slice) AS pos_y FROM p"""


@geometry.query(PLACED)
def placed_tiles(i: Inputs) -> DataFrame:
    return layout.place_tiles(i.offsets).drop("part")


@geometry.query(PLACED)
def weighted_placement(i: Inputs) -> DataFrame:
    """Links across columns are wrong and light, but for the first row; the heavy ones decide."""
    trusted = (F.col("tile_b") - F.col("tile_a") == 1) | (F.col("tile_a") % 4 == 0)
    off = F.when(trusted, 0.0).otherwise(F.col("tile_a") % 5 + 1.0)
    weighed = i.offsets.withColumn("dx", F.col("dx") + off).withColumn("dy", F.col("dy") - off)
    return layout.place_tiles(weighed.withColumn("weight", F.when(trusted, 0.9 - F.col("tile_a") % 3 / 10).otherwise(0.2))).drop("part")


@geometry.query("SELECT fov, -pos_x AS pos_x, pos_y FROM fx_tforms")
def flipped_tiles(i: Inputs) -> DataFrame:
    return layout.flip_axes(i.tforms, flip_x=True).select("fov", "pos_x", "pos_y")


@geometry.query("SELECT fov, pos_x, pos_y, pos_x / 2 AS ref_x, pos_y / 2 AS ref_y FROM fx_tforms")
def rescaled_tiles(i: Inputs) -> DataFrame:
    return layout.rescale_positions(i.tforms.select("fov", "pos_x", "pos_y"))


CLOUD = """
    cloud AS (SELECT p.sunit_id, round_even(sunit_x - 12.5, 0) AS x, round_even(sunit_y + 7.25, 0) AS y, round_even(sunit_z * 0.5, 0) AS z,
      round_even(depth * 0.25, 0) AS depth, CASE WHEN p.sunit_id IN (SELECT sunit_id FROM fx_units WHERE stack_idx = 1) THEN 1 ELSE 0 END AS is_fun
      FROM fx_points p WHERE p.stack_idx = 1)"""


def cloud(i: Inputs) -> DataFrame:
    return layout.scale_point_cloud(i.points, i.units, 1, (12.5, -7.25))


@geometry.query(f"WITH {CLOUD} SELECT * FROM cloud")
def scaled_points(i: Inputs) -> DataFrame:
    return cloud(i)


@geometry.query(
    f"""WITH {CLOUD} SELECT sunit_id, round(0.6 * (x - 100) - 0.8 * (y - 120) + 110, 6)::DOUBLE AS x,
      round(0.8 * (x - 100) + 0.6 * (y - 120) + 130, 6)::DOUBLE AS y, round(z - 40 + 45, 6)::DOUBLE AS z FROM cloud"""
)
def rotated_points(i: Inputs) -> DataFrame:
    turned = layout.rotate_points(cloud(i).select("sunit_id", "x", "y", "z"), TURN, (100, 120, 40), (110, 130, 45))
    return rounded(turned)


@geometry.query(f"WITH {CLOUD} SELECT sunit_id, x, y, z + d AS z FROM cloud, (VALUES (-2), (-1), (0), (1), (2)) t(d)")
def padded_points(i: Inputs) -> DataFrame:
    return layout.pad_depth(cloud(i).select("sunit_id", "x", "y", "z"))
