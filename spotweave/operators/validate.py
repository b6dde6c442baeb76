"""Comparison of two runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.functions.vectors import similarity


def count_and_sum(run: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Length and sum of every column of every tile, long form, in one pass."""
    stats = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("n"),
            F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0)).alias("total"),
        )
        for c in columns
    ]
    return run.groupBy(key).agg(F.array(*stats).alias("_s")).select(key, F.explode("_s").alias("_s")).select(key, "_s.*")


def compare_runs(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Lengths and sums of two runs side by side, with the similarity of both."""
    one = count_and_sum(a, key, columns).withColumnsRenamed({"n": "n_a", "total": "total_a"})
    two = count_and_sum(b, key, columns).withColumnsRenamed({"n": "n_b", "total": "total_b"})
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    joined = one.join(two, [key, "column"], "full").select(
        key, "column", *[zero(c).alias(c) for c in ("n_a", "n_b", "total_a", "total_b")]
    )
    return joined.withColumn("sim_n", similarity("n_a", "n_b")).withColumn("sim_total", similarity("total_a", "total_b"))


def worst_tile(compared: DataFrame, key: str) -> DataFrame:
    """Per column the lowest similarity over tiles and the first tile that has it."""
    worst = F.min(F.struct(F.least("sim_n", "sim_total").alias("sim"), F.col(key).alias("tile")))
    return compared.groupBy("column").agg(worst.alias("_w")).select("column", F.col("_w.sim").alias("similarity"), F.col("_w.tile").alias(key))


def gene_totals(expr: DataFrame) -> DataFrame:
    return expr.groupBy("gene_id").agg(F.sum("n").alias("total"))


def spearman(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rank correlation of the gene totals of two runs.

    There is one row per codebook gene, so ranking them in one task is fine;
    ties share their average rank.
    """
    joined = gene_totals(a).withColumnRenamed("total", "ta").join(
        gene_totals(b).withColumnRenamed("total", "tb"), "gene_id", "full"
    )
    joined = joined.select("gene_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("ta", "tb")])

    def average_rank(c: str):
        return F.rank().over(Window.orderBy(c)) + (F.count(F.lit(1)).over(Window.partitionBy(c)) - 1) / 2

    ranked = joined.select(average_rank("ta").alias("ra"), average_rank("tb").alias("rb"))
    return ranked.agg(F.corr("ra", "rb").alias("spearman"))


def top_genes(expr: DataFrame, k: int = 20) -> DataFrame:
    """The k genes with the largest totals, lowest id first on a tie."""
    return gene_totals(expr).orderBy(F.col("total").desc(), "gene_id").limit(k)


def same_cell_count(a: DataFrame, b: DataFrame) -> DataFrame:
    """Number of cells of two runs and whether they agree."""
    n = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = a.agg(F.count(F.lit(1)).alias("n_a")).withColumn("n_b", n(b))
    return counts.withColumn("identical", F.col("n_a") == F.col("n_b"))


def compare_transforms(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per tile the difference of positions and of parameter sums of two runs."""
    cols = ["scale", "pos_x", "pos_y"]
    one = a.select("fov", *[F.col(c).alias(f"{c}_a") for c in cols])
    two = b.select("fov", *[F.col(c).alias(f"{c}_b") for c in cols])
    total = lambda side: sum((F.col(f"{c}_{side}") for c in cols), F.lit(0.0))
    return one.join(two, "fov", "full").select(
        "fov",
        (F.col("pos_x_a") - F.col("pos_x_b")).alias("dx"),
        (F.col("pos_y_a") - F.col("pos_y_b")).alias("dy"),
        (total("a") - total("b")).alias("d_sum"),
    )
