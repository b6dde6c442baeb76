"""The usual order of the operators, from pixels to neurons.

Each step takes and returns tables.  A table that several later steps read is
written to the shared folder once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.operators import assign, basecall, expression, layout, overlaps, peaks as pk, pixels as px, registration
from spotweave.session import settle


def preprocess(
    pixels: DataFrame,
    channels: Sequence[str],
    background: int = 31,
    shifts: Sequence[tuple[float, float]] = px.CHANNEL_SHIFTS,
    profile=px.BLEED_PROFILE,
    block: int = 256,
) -> DataFrame:
    """Background, channel alignment and bleed-through, in this order."""
    aligned = px.flatten_and_align(pixels, channels, size=background, shifts=shifts, block=block)
    return px.unmix(aligned, channels, profile)


def register_cycles(
    pixels: DataFrame, channels: Sequence[str], height: int, width: int, reach: int, block: int = 256
) -> DataFrame:
    """Every cycle moved onto the first one of its tile."""
    pixels = settle(pixels, "pixels")
    total = reduce(lambda a, b: a + b, [F.col(ch).cast("double") for ch in channels])
    summed = pixels.select("fov", "cycle", "r", "c", total.alias("v"))
    found = registration.estimate_shift(summed.where("cycle = 1").drop("cycle"), summed, reach, block=block)
    back = found.select("fov", "cycle", (-F.col("dr")).alias("dr"), (-F.col("dc")).alias("dc"))
    return px.apply_shift(pixels, back, height, width)


def call_genes(
    pixels: DataFrame,
    channels: Sequence[str],
    codebook: DataFrame,
    n_cycles: int,
    noise_first: float = 0.001,
    noise_final: float = 0.005,
    limit: float = 0.05,
    block: int = 256,
) -> DataFrame:
    """Gene spots above the threshold that keeps false discoveries under the limit.

    The pixels are decoded once; threshold and spots come from the same peaks.
    Without a threshold that meets the limit this is an error.
    """
    vectors = basecall.signal_vectors(pixels, channels, n_cycles)
    table = basecall.code_table(codebook, n_cycles)
    peaks = settle(basecall.decoded_peaks(basecall.decode(vectors, table, noise_final), block=block), "peaks")
    threshold = basecall.fdr_threshold(vectors, peaks, table, noise_first, limit).first()["threshold"]
    if threshold is None:
        raise ValueError(f"no threshold keeps the false-discovery rate under {limit}")
    called = peaks.where(F.col("score") > F.lit(threshold).cast("double"))
    return called.select(
        "fov", F.col("r").cast("double").alias("lroi_x"), F.col("c").cast("double").alias("lroi_y"), "gene_id", F.col("score").alias("signal")
    )


def call_hyb_spots(
    pixels: DataFrame,
    limits: Mapping[str, tuple[float | None, float]],
    genes: Mapping[int, int] = basecall.HYB_GENE_OF_CHANNEL,
    blank: int = basecall.HYB_ALL_GENES_CHANNEL,
    block: int = 256,
) -> tuple[DataFrame, DataFrame]:
    """Spots of hybridisation images, and the picture of gene_id + 1 at their pixels.

    ``limits`` maps every channel, in order, to (threshold, prominence).  The
    all-genes channel has no peaks and counts as 0.  A spot lies at the
    centroid of a plateau; the strongest channel at the plateau's first pixel
    gives the gene.  Where spots share a pixel the last channel wins, then the
    last plateau in (r, c) order.
    """
    names = list(limits)
    shown = {number: ch for number, ch in enumerate(names) if number != blank}
    found = pk.prominent_peaks(pixels, {ch: limits[ch] for ch in shown.values()}, block=block)
    plateau = found.select(
        "fov", "cycle", "channel", F.col("first_r").alias("r"), F.col("first_c").alias("c"), F.col("r").alias("lroi_x"), F.col("c").alias("lroi_y"), F.col("v").alias("_top")
    )
    # Peaks are few beside the pixels, which are hashed against and never sorted.
    met = plateau.hint("shuffle_hash").join(pixels.select("fov", "cycle", "r", "c", *names), ["fov", "cycle", "r", "c"])
    called = basecall.call_hyb(met, names, genes, blank).withColumn("signal", F.col("_top"))
    called = settle(called.withColumn("place", F.struct("channel", "r", "c")).drop("_top", *names), "hyb")
    spots = called.select("fov", "lroi_x", "lroi_y", "gene_id", "signal")
    return spots, basecall.gene_raster(called, "place")


def finish_neurons(
    spots: DataFrame, mask: DataFrame, cells: DataFrame, tforms: DataFrame, parts: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Neurons counted once, and their long cells x genes matrix; ``parts`` is that of ``assign_by_mask``."""
    expr = settle(expression.cell_gene_counts(assign.assign_by_mask(spots, mask, parts=parts), cells), "expression")
    totals = expression.total_expression(expr, cells)
    placed = layout.to_global(totals, tforms, "cent_x", "cent_y", ("x", "y"))
    table = placed.join(tforms.select("fov", "slice"), "fov").withColumn("id", assign.global_cell_id())
    kept = settle(overlaps.drop_duplicates(table, overlaps.half_box()), "kept")
    return kept, expr.join(kept.select("fov", "cell_num").hint("merge"), ["fov", "cell_num"], "left_semi")
