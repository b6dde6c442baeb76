"""Column names and types of the tables the operators exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = {
    "manifest": "mode STRING, cycle INT, position STRING, col INT, row INT, path STRING",
    "codebook": "gene_id INT, gene STRING, sequence STRING",
    "mask": "fov INT, r INT, c INT, label BIGINT",
    "cells": "fov INT, cell_num BIGINT, cent_x DOUBLE, cent_y DOUBLE",
    "spots": "fov INT, lroi_x DOUBLE, lroi_y DOUBLE, gene_id INT, signal DOUBLE",
    "tforms": "fov INT, slice INT, scale DOUBLE, pos_x DOUBLE, pos_y DOUBLE",
    "expression": "fov INT, cell_num BIGINT, gene_id INT, n BIGINT",
    "neurons": "id BIGINT, slice INT, fov INT, x DOUBLE, y DOUBLE, total BIGINT",
    "barcode_spots": "cell_id BIGINT, seq STRING",
    "soma_cycles": "cell_id BIGINT, cycle INT, base INT, score DOUBLE, peak DOUBLE",
    "library": "barcode_id BIGINT, sequence STRING, area_id INT, n INT",
    "offsets": "slice INT, tile_a INT, tile_b INT, dx DOUBLE, dy DOUBLE",
}


def pixels(channels: list[str]) -> str:
    """Schema of a pixel table with the given channels."""
    return ", ".join(["fov INT, cycle INT, r INT, c INT", *[f"{ch} INT" for ch in channels]])


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a schema in its order and types; a missing column is an error.

    ``schema`` is a name from ``TABLES`` or a list of columns and types.
    """
    wanted = StructType.fromDDL(TABLES.get(schema, schema))
    missing = [f.name for f in wanted if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])
