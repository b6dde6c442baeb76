"""Extension points for functions on whole tiles or on blocks of pixels."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame

from spotweave.operators.blocks import HOME, cut_blocks

TileFunction = Callable[[pd.DataFrame], pd.DataFrame]


def map_tiles(df: DataFrame, fn: TileFunction, schema: str, keys: Sequence[str] = ("fov",)) -> DataFrame:
    """Run a pandas function on every tile.

    A group must fit into one task: add keys such as the cycle until it does,
    or use ``map_blocks``, which bounds every group by itself.
    """
    return df.groupBy(*keys).applyInPandas(fn, schema)


def map_blocks(
    df: DataFrame, fn: TileFunction, schema: str, plane: Sequence[str] = ("fov", "cycle"), block: int = 256, halo: int = 0
) -> DataFrame:
    """Run a pandas function on square blocks of pixels.

    The function sees the halo as rows whose ``home`` is false.
    """
    placed = cut_blocks(df, plane, block, halo).withColumnRenamed(HOME, "home")
    return placed.groupBy(*plane, "_br", "_bc").applyInPandas(fn, schema)
