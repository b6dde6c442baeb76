"""Base calls, soma calls, codebook decoding and false-discovery control."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.functions.vectors import as_col, call_score, called_channel, strongest
from spotweave.operators.blocks import Grid, is_first_highest, over_blocks
from spotweave.operators.codebook import binary_codes, is_control, short_rows
from spotweave.operators.pixels import crop_centre, median_max, normalise_median, stack_cycles, trim
from spotweave.operators.ranking import exact_median
from spotweave.session import settle

# Base letters by call number, and hybridisation gene by channel index.
CALL_LETTERS = "GTAC"
HYB_GENE_OF_CHANNEL = {0: 0, 1: 1, 3: 2}
HYB_ALL_GENES_CHANNEL = 2
NO_CALL = 5

MAX_SCORES = 4_000_000  # pixel times code scores held at once in a task


# ---- spots ------------------------------------------------------------------


def read_signal(spots: DataFrame, pixels: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Channel signals of every cycle at each spot's pixel, one row per spot and cycle.

    The pixel table is by far the larger side: the distinct spot pixels are
    hashed and it is not sorted.
    """
    keys = ["fov", "r", "c"]
    spot_pixels = spots.select(*keys).distinct().hint("shuffle_hash")
    seen = spot_pixels.join(pixels.select("fov", "cycle", "r", "c", *channels), keys)
    return spots.join(seen, keys)


def call_cycles(signal: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Base (1-based channel), score and intensity of each signal row."""
    return signal.withColumns(
        {
            "base": called_channel(channels),
            "score": call_score(channels),
            "intensity": strongest(channels).cast("double"),
        }
    )


def base_letter(call: str | Column) -> Column:
    return F.substr(F.lit(CALL_LETTERS), as_col(call), F.lit(1))


def spell(calls: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per spot with its bases, scores and intensities in cycle order.

    The lists are as long as the number of cycles.
    """
    per_cycle = F.struct("cycle", "base", "score", "intensity")
    listed = calls.groupBy(*keys).agg(F.array_sort(F.collect_list(per_cycle)).alias("_c"))
    return listed.select(
        *keys,
        F.array_join(F.transform("_c", lambda x: x["base"].cast("string")), "").alias("seq"),
        F.transform("_c", lambda x: x["score"]).alias("score"),
        F.transform("_c", lambda x: x["intensity"]).alias("intensity"),
    )


def call_hyb(
    signal: DataFrame,
    channels: Sequence[str],
    genes: Mapping[int, int] = HYB_GENE_OF_CHANNEL,
    blank: int = HYB_ALL_GENES_CHANNEL,
) -> DataFrame:
    """Gene of the strongest channel, the all-genes channel counted as 0."""
    seen = [F.lit(0) if k == blank else F.col(ch) for k, ch in enumerate(channels)]
    channel = called_channel(seen) - 1
    gene = F.lit(None).cast("int")
    for number, gene_id in genes.items():
        gene = F.when(channel == number, F.lit(gene_id)).otherwise(gene)
    return signal.withColumn("gene_id", gene).withColumn("signal", strongest(seen).cast("double"))


def gene_raster(spots: DataFrame, order: str) -> DataFrame:
    """Picture of gene_id + 1 at each spot's pixel; the last spot in ``order`` wins."""
    pixel = [F.rint("lroi_x").cast("int").alias("r"), F.rint("lroi_y").cast("int").alias("c")]
    return spots.groupBy("fov", *pixel).agg((F.max_by("gene_id", order) + 1).alias("value"))


# ---- somata -----------------------------------------------------------------


def call_somata(label_means: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Calls from the mean over all pixels of a label; an undefined score is 0.5."""
    return call_cycles(label_means, channels)


def good_pixels(pixels: DataFrame, channels: Sequence[str], threshold: float = 0.85, k: int = 3) -> DataFrame:
    """Pixels whose k-th lowest quality over cycles exceeds the threshold.

    With fewer cycles than ``k`` the highest one decides.  Fewer than k of the
    n qualities at or below the threshold means the k-th lowest is above it,
    so counting is enough and no list is built.
    """
    quality = call_score(channels, undefined=0.0)
    counted = pixels.groupBy("fov", "r", "c").agg(
        F.count_if(quality <= threshold).alias("_low"), F.count(F.lit(1)).alias("_n")
    )
    return counted.where(F.col("_low") < F.least(F.lit(k), F.col("_n"))).select("fov", "r", "c")


def call_somata_good(
    mask: DataFrame,
    pixels: DataFrame,
    channels: Sequence[str],
    threshold: float = 0.85,
    min_pixels: int = 50,
) -> DataFrame:
    """Calls from good pixels only; cells with too few get base 5, score 0, signal 0."""
    good = good_pixels(pixels, channels, threshold).withColumn("_good", F.lit(True))
    inside = pixels.join(mask.select("fov", "r", "c", "label"), ["fov", "r", "c"]).join(good, ["fov", "r", "c"], "left")
    means = inside.groupBy("fov", "label", "cycle").agg(
        F.count_if("_good").alias("n_good"),
        *[F.coalesce(F.avg(F.when(F.col("_good"), F.col(ch))), F.lit(0.0)).alias(ch) for ch in channels],
    )
    enough = F.col("n_good") > min_pixels
    called = {
        "base": F.when(enough, called_channel(channels)).otherwise(NO_CALL),
        "score": F.when(enough, call_score(channels, undefined=0.0)).otherwise(0.0),
    }
    return means.withColumns(called).withColumns({ch: F.when(enough, F.col(ch)).otherwise(0.0) for ch in channels})


def call_somata_relative(
    label_means: DataFrame, channels: Sequence[str], threshold: float, first: int = 15, by: str = "position"
) -> DataFrame:
    """Calls after dividing each channel by its mean over the cells of a position.

    Means are cut to whole numbers first.  A cell is barcoded when any of its
    first cycles scores above the threshold.
    """
    whole = label_means.withColumns({ch: F.floor(ch).cast("double") for ch in channels})
    level = whole.groupBy(by, "cycle").agg(*[F.avg(ch).alias(f"_m_{ch}") for ch in channels])
    relative = whole.join(level, [by, "cycle"]).withColumns(
        {ch: F.coalesce(F.try_divide(F.col(ch), F.col(f"_m_{ch}")), F.lit(0.0)) for ch in channels}
    )
    calls = call_cycles(relative, channels)
    spelled = spell(calls, [by, "fov", "label"])
    passing = F.exists(F.slice("score", 1, first), lambda s: s > threshold)
    return spelled.select(by, "fov", "label", "seq", passing.alias("barcoded"))


# ---- decoding ----------------------------------------------------------------


def code_table(codebook: DataFrame, n_cycles: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gene ids, 0/1 codes and control flags, in gene order."""
    rows = short_rows(binary_codes(codebook, n_cycles).withColumn("control", is_control()))
    ids = np.array([row["gene_id"] for row in rows], dtype=np.int32)
    codes = np.array([row["code"] for row in rows], dtype=float)
    return ids, codes, np.array([row["control"] for row in rows], dtype=bool)


def evidence_function(codes: np.ndarray, noise: float) -> Callable[[np.ndarray], np.ndarray]:
    """Scores of a few pixels: sum(signal * code) / ((|signal| + noise) * |code|).

    The function carries its codes and needs nothing but NumPy on the workers.
    """
    code_size = np.sqrt(codes.sum(axis=1))[None, :]

    def evidence(signals: np.ndarray) -> np.ndarray:
        size = np.sqrt((signals * signals).sum(axis=1))[:, None] + noise
        return np.round((signals @ codes.T) / (size * code_size), 9)

    return evidence


def decode(pixels: DataFrame, table: tuple[np.ndarray, np.ndarray, np.ndarray], noise: float) -> DataFrame:
    """Best code of every pixel ``(fov, r, c, sig)``: ``gene_id``, ``score`` and ``control``.

    The product of pixels and codes is a small matrix product per piece of an
    Arrow batch, so no row is ever multiplied by the codebook.
    """
    ids, codes, control = table
    evidence = evidence_function(codes, noise)
    step = max(1, MAX_SCORES // len(ids))

    @F.pandas_udf("gene_id int, score double, control boolean")
    def best(sig: pd.Series) -> pd.DataFrame:
        signals = np.stack(sig.to_numpy())
        top, score = [], []
        for start in range(0, len(signals), step):
            e = evidence(signals[start : start + step])
            top.append(e.argmax(axis=1))
            score.append(e.max(axis=1))
        top = np.concatenate(top)
        return pd.DataFrame({"gene_id": ids[top], "score": np.concatenate(score), "control": control[top]})

    return pixels.select("fov", "r", "c", best("sig").alias("_b")).select("fov", "r", "c", "_b.*")


def control_maxima(pixels: DataFrame, table: tuple[np.ndarray, np.ndarray, np.ndarray], noise: float) -> DataFrame:
    """Highest evidence of every control code in every tile."""
    ids, codes, control = table
    ids = ids[control]
    evidence = evidence_function(codes[control], noise)
    step = max(1, MAX_SCORES // max(1, len(ids)))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per batch, tile and control code."""
        for batch in batches:
            fovs, place = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            signals = np.stack(batch.column(1).to_numpy(zero_copy_only=False))
            top = np.full((len(fovs), len(ids)), -np.inf)
            for start in range(0, len(signals), step):
                np.maximum.at(top, place[start : start + step], evidence(signals[start : start + step]))
            columns = [np.repeat(fovs, len(ids)).astype(np.int64), np.tile(ids, len(fovs)), top.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["fov", "gene_id", "evidence"])

    seen = pixels.select("fov", "sig").mapInArrow(per_batch, "fov long, gene_id int, evidence double")
    kind = pixels.schema["fov"].dataType
    return seen.groupBy(F.col("fov").cast(kind).alias("fov"), "gene_id").agg(F.max("evidence").alias("evidence"))


def base_threshold(maxima: DataFrame) -> DataFrame:
    """Median over all tiles and control codes of their highest evidence."""
    return exact_median(maxima, "evidence", "threshold")


def decoded_peaks(decoded: DataFrame, reach: int = 1, block: int = 256) -> DataFrame:
    """Decoded pixels that score highest within (2*reach+1)-squares, first in (r, c) order on a tie."""

    def kernel(grid: Grid) -> pa.Table:
        return grid.kept({}, is_first_highest(grid.array("score", -np.inf), reach) & grid.present)

    return over_blocks(decoded, ["fov"], block, reach, kernel, decoded.schema)


def sweep_thresholds(peaks: DataFrame, base: float, span: float = 0.1, steps: int = 10) -> DataFrame:
    """Control and other hits per tile at evenly spaced thresholds around the base.

    All thresholds are counted in one pass over the peaks.
    """
    grid = [F.lit(base + (-span + 2 * span * k / (steps - 1))) for k in range(steps)]
    counts = []
    for k, t in enumerate(grid):
        counts.append(F.count_if((F.col("score") > t) & F.col("control")).alias(f"_err_{k}"))
        counts.append(F.count_if((F.col("score") > t) & ~F.col("control")).alias(f"_tot_{k}"))
    wide = peaks.groupBy("fov").agg(*counts)
    steps_list = F.array(
        *[
            F.struct(F.lit(k).alias("step"), grid[k].alias("threshold"), F.col(f"_err_{k}").alias("n_control"), F.col(f"_tot_{k}").alias("n_gene"))
            for k in range(steps)
        ]
    )
    return wide.select("fov", F.explode(steps_list).alias("_s")).select("fov", "_s.*")


def fdr_curve(sweep: DataFrame, n_genes: int, n_controls: int) -> DataFrame:
    """False-discovery rate per threshold from the mean hits over tiles."""
    rate = F.avg("n_control") / n_controls * (n_genes - n_controls) / F.avg(F.col("n_gene") + 1)
    return sweep.groupBy("step").agg(F.max("threshold").alias("threshold"), rate.alias("fdr"))


def pick_threshold(curve: DataFrame, limit: float = 0.05) -> DataFrame:
    """Lowest threshold under the limit, one row; null where none is."""
    return curve.agg(F.min(F.when(F.col("fdr") < limit, F.col("threshold"))).alias("threshold"))


def signal_vectors(pixels: DataFrame, channels: Sequence[str], n_cycles: int, medians: DataFrame | None = None) -> DataFrame:
    """Signals of all cycles per pixel, every plane divided by its median maximum, or by the one given; written once."""
    normal = normalise_median(pixels, channels, median_max(pixels, channels) if medians is None else medians)
    return settle(stack_cycles(normal, channels, n_cycles), "vectors")


def fdr_threshold(
    vectors: DataFrame,
    peaks: DataFrame,
    table: tuple[np.ndarray, np.ndarray, np.ndarray],
    noise_first: float = 0.001,
    limit: float = 0.05,
) -> DataFrame:
    """One row with the lowest threshold under the false-discovery limit, or null."""
    base = base_threshold(control_maxima(vectors, table, noise_first)).first()["threshold"]
    curve = fdr_curve(sweep_thresholds(peaks, base), len(table[0]), int(table[2].sum()))
    return pick_threshold(curve, limit)


def calibrate(
    pixels: DataFrame,
    channels: Sequence[str],
    codebook: DataFrame,
    n_cycles: int,
    noise_first: float = 0.001,
    noise_final: float = 0.005,
    limit: float = 0.05,
    block: int = 256,
    frame: tuple[int, int] | None = None,
    margin: int = 0,
    crop: float = 0.0,
) -> DataFrame:
    """One row of decoding parameters: threshold under the false-discovery limit,
    noise floors, trimming, and the normalising median of every plane.

    Medians and the sweep of thresholds use the centre of each tile, without
    ``crop`` of its height and width on every side; the threshold it starts
    from uses all but ``margin`` pixels at the edges.  Both need the tile's
    ``frame`` (height, width).  Only the codebook and one threshold ever reach the driver.
    """
    if frame is None and (margin or crop):
        raise ValueError("trimming needs the frame")
    inner = crop_centre(pixels, *frame, crop) if crop else pixels
    medians = median_max(inner, channels)
    if margin or crop:
        medians = settle(medians, "medians")
    vectors = signal_vectors(inner, channels, n_cycles, medians)
    wide = vectors
    if margin or crop:
        wide = signal_vectors(trim(pixels, *frame, margin) if margin else pixels, channels, n_cycles, medians)
    table = code_table(codebook, n_cycles)
    peaks = decoded_peaks(decode(vectors, table, noise_final), block=block)
    planes = F.flatten(
        F.transform(
            F.array_sort(F.collect_list(F.struct("cycle", F.array(*[F.col(f"_med_{ch}") for ch in channels]).alias("m")))),
            lambda row: row["m"],
        )
    )
    return fdr_threshold(wide, peaks, table, noise_first, limit).select(
        "threshold",
        F.lit(noise_first).alias("noise_first"),
        F.lit(noise_final).alias("noise_final"),
        F.lit(margin).alias("trim"),
        F.lit(float(crop)).alias("cropf"),
        medians.agg(planes.alias("median_max")).scalar().alias("median_max"),
    )


def call_set_fdr(calls: DataFrame, n_genes: int, n_controls: int, by: Sequence[str] = ()) -> DataFrame:
    """False-discovery rate of a set of calls with a ``control`` flag."""
    share = F.try_divide(F.count_if("control").cast("double"), F.count(F.lit(1)))
    return calls.groupBy(*by).agg((share / n_controls * (n_genes - n_controls)).alias("fdr"))


def decode_summary(calls: DataFrame, positions: DataFrame, by: str = "position") -> DataFrame:
    """Spots, control spots, error rate and distinct genes of every position, 0 where there are none."""
    n = F.count(F.lit(1))
    got = calls.groupBy(by).agg(
        n.alias("n_spots"),
        F.count_if("control").alias("n_control"),
        F.count_distinct("gene_id").alias("n_genes"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    out = positions.select(by).distinct().join(got, by, "left").select(by, zero("n_spots"), zero("n_control"), zero("n_genes"))
    return out.withColumn("error_rate", F.coalesce(F.try_divide(F.col("n_control").cast("double"), F.col("n_spots")), F.lit(0.0)))


def union_calls(parts: Sequence[tuple[DataFrame, int]]) -> DataFrame:
    """All rows of call tables, each gene number raised by its table's codebook offset."""
    shifted = [calls.withColumn("gene_id", F.col("gene_id") + offset) for calls, offset in parts]
    return reduce(lambda a, b: a.unionByName(b), shifted)


def accumulate_calls(parts: Sequence[tuple[DataFrame, int]], tiles: DataFrame) -> DataFrame:
    """Number of calls per tile over call tables with codebook offsets, 0 for empty tiles."""
    counts = union_calls(parts).groupBy("fov").agg(F.count(F.lit(1)).alias("n_calls"), F.sum("gene_id").alias("id_sum"))
    return tiles.select("fov").join(counts, "fov", "left").select(
        "fov", F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("id_sum", F.lit(0)).alias("id_sum")
    )
