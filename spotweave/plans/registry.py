"""How a registered query is declared."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.plans.inputs import load, mask_parts, oracle, parts_of_cells


class Inputs:
    """Lazily loaded inputs of one run: ``i.cells`` is the derived input ``fx_cells``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def mask_parts(self) -> int:
        return mask_parts(self.spark, self.sf_dir)

    @property
    def count_parts(self) -> int:
        """Partitions for counts per cell, which are few beside the pixels: a quarter of the mask's."""
        return -(-self.mask_parts // 4)

    @property
    def mask(self) -> DataFrame:
        """The label mask, dealt by tile into ``mask_parts``."""
        return load(self.spark, self.sf_dir, "fx_mask", self.mask_parts)

    def mask_for(self, n_cells: int) -> tuple[DataFrame, int]:
        """The label mask dealt into as many partitions as so many cells need, and their number."""
        parts = parts_of_cells(self.spark, n_cells)
        return load(self.spark, self.sf_dir, "fx_mask", parts), parts

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, f"fx_{name}")


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None):
        """Register a function of ``Inputs``; ``sql`` is the same result in plain SQL."""

        def add(fn: Callable[[Inputs], DataFrame]):
            self.queries[fn.__name__] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
            if sql is not None:
                self.sql[fn.__name__] = oracle(sql)
            return fn

        return add


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double so that the order of additions does not show."""
    return df.select(
        *[
            F.round(F.col(f.name), places).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
            for f in df.schema.fields
        ]
    )
