"""Images made comparable before their shift is searched: grey levels, matched brightness, difference of Gaussians.

Images are ``fov, cycle, r, c, v`` or, as a template, ``fov, r, c, v``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from spotweave.operators.blocks import HOME, Grid, moved, over_blocks
from spotweave.operators.lookup import looked_up
from spotweave.session import settle


def grey_levels(image: DataFrame, plane: Sequence[str], levels: int = 256) -> DataFrame:
    """``v`` scaled by the plane's maximum to whole levels from 0 to ``levels`` - 1; 0 where no pixel is above 0, null stays null."""
    top = image.groupBy(*plane).agg(F.max("v").alias("_top"))
    scaled = F.floor(F.greatest(F.col("v"), F.lit(0.0)) / F.col("_top") * (levels - 1))
    level = F.when(F.col("_top") > 0, scaled).otherwise(F.lit(0))  # ``greatest`` would make a null 0
    return looked_up(image, top, plane).select(*plane, "r", "c", F.when(F.col("v").isNotNull(), level).cast("double").alias("v"))


def level_ranks(image: DataFrame, plane: Sequence[str]) -> DataFrame:
    """``plane, v, q``: the share of pixels at or below each level.  A plane has few levels, so its window is small."""
    counted = image.where("v IS NOT NULL").groupBy(*plane, "v").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*plane)
    return counted.select(*plane, "v", (F.sum("n").over(whole.orderBy("v")) / F.sum("n").over(whole)).alias("q"))


def match_brightness(moving: DataFrame, template: DataFrame) -> DataFrame:
    """``moving`` with the brightness distribution of its tile's template.

    Both hold grey levels.  A level takes the template's value of the same
    rank, between two ranks the value on the line between them.  Ranks of both
    are laid in one order per plane, so levels never meet in pairs.  Tiles
    without a template have no result.
    """
    plane = ["fov", "cycle"]
    mine = settle(level_ranks(moving, plane), "ranks")
    other = looked_up(level_ranks(template, ["fov"]), mine.select(*plane).distinct(), ["fov"])
    known = other.select(*plane, "q", F.lit(None).cast("double").alias("v"), F.struct("q", F.col("v").alias("to")).alias("at"))
    asked = mine.select(*plane, "q", "v", F.lit(None).cast(known.schema["at"].dataType).alias("at"))
    # Both frames grow from an end, so that no row is added again for each row before it.
    so_far = lambda order: Window.partitionBy(*plane).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    below = F.max("at").over(so_far(F.col("q").asc()))
    above = F.min("at").over(so_far(F.col("q").desc()))
    ranked = known.unionByName(asked).select(*plane, "q", "v", below.alias("lo"), above.alias("hi")).where("v IS NOT NULL")
    share = (F.col("q") - F.col("lo.q")) / (F.col("hi.q") - F.col("lo.q"))
    line = F.col("lo.to") + share * (F.col("hi.to") - F.col("lo.to"))
    value = F.when(F.col("lo").isNull(), F.col("hi.to")).when(F.col("lo.q") == F.col("hi.q"), F.col("lo.to")).otherwise(line)
    table = ranked.where("lo IS NOT NULL OR hi IS NOT NULL").select(*plane, "v", value.alias("_to"))
    return looked_up(moving, table, [*plane, "v"]).select(*plane, "r", "c", F.col("_to").alias("v"))


def gauss_weights(sigma: float, reach: int) -> list[float]:
    """Weights from the middle outwards."""
    return [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(reach + 1)]


def difference_of_gaussians(
    image: DataFrame, low: float, high: float, plane: Sequence[str] = ("fov", "cycle"), block: int = 256, reach: int | None = None
) -> DataFrame:
    """``v`` blurred by ``low`` minus ``v`` blurred by ``high``.

    Weights end at ``reach`` pixels, by default four of the wider sigma.  Pixels
    that are absent or null have no weight, so a frame's border is no edge.
    """
    reach = math.ceil(4 * high) if reach is None else reach

    def spread(values: np.ndarray, weights: list[float]) -> np.ndarray:
        for down, right in ((1, 0), (0, 1)):
            out = values * weights[0]
            for d, w in enumerate(weights[1:], 1):
                out = out + w * (moved(values, d * down, d * right, 0.0) + moved(values, -d * down, -d * right, 0.0))
            values = out
        return values

    def kernel(grid: Grid):
        seen = ~np.isnan(grid.array("v", np.nan))
        values, ones = np.where(seen, grid.array("v", 0.0), 0.0), seen.astype(float)
        blurred = []
        for sigma in (low, high):
            weights = gauss_weights(sigma, reach)
            total = spread(ones, weights)
            blurred.append(np.divide(spread(values, weights), total, out=np.full(total.shape, np.nan), where=total > 0))
        return grid.kept({"v": np.where(seen, blurred[0] - blurred[1], np.nan)}, seen).drop_columns([HOME, "_br", "_bc"])

    narrow = image.select(*plane, "r", "c", F.col("v").cast("double").alias("v"))
    schema = StructType([*[narrow.schema[name] for name in (*plane, "r", "c")], StructField("v", DoubleType())])
    return over_blocks(narrow, plane, max(block, reach), reach, kernel, schema, stacked=True)
