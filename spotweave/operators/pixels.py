"""Image arithmetic over pixel tables.

A pixel table has one row per ``(fov, cycle, r, c)`` and one column per
channel.  Frames are full, as the camera makes them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from spotweave.functions.vectors import similarity, to_uint16
from spotweave.operators.blocks import Grid, is_first_highest, moved, over_blocks, swept
from spotweave.operators.lookup import looked_up
from spotweave.operators.ranking import number_rows

KEYS = ("fov", "cycle", "r", "c")
PLANE = ("fov", "cycle")

# Measured bleed-through between the four channels, its rows the
# true channel and its columns the observed one; and an older mixing matrix.
BLEED_PROFILE = (
    (1.0, 0.4114560939252672, 0.0, 0.0),
    (0.41794176904378794, 2.2039796290882334, 0.0, 0.0),
    (0.0, 0.0, 1.1856509364593357, 0.9711972305576704),
    (0.0, 0.0, 0.06855628472849186, 1.1365546564399172),
)
MIXING = (
    (1.0, 0.1383, 0.0, 0.0),
    (0.3674, 1.0, 0.0, 0.0),
    (0.0, 0.0, 1.0, 0.6551),
    (0.0, 0.0, 0.0799, 1.0),
)
# Fixed values: (x, y) shift of each channel against the first.
CHANNEL_SHIFTS = (
    (0.0, 0.0),
    (-0.5542476199839899, -1.2915655039741525),
    (-0.9163560325386895, 0.8915773169199748),
    (-0.9121990284428629, 1.1455597498141568),
)
SIMILAR = 0.95


def select_channels(pixels: DataFrame, wanted: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Channels by name, in the order asked for; an unknown name is an error."""
    missing = [name for name in wanted if name not in pixels.columns]
    if missing:
        raise ValueError(f"no such channel: {', '.join(missing)}")
    return pixels.select(*[k for k in keys if k in pixels.columns], *wanted)


def keep_rectangle(pixels: DataFrame, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """Pixels of ``rows[0] <= r < rows[1]`` and the same for columns, counted from the corner."""
    inside = (F.col("r") >= rows[0]) & (F.col("r") < rows[1]) & (F.col("c") >= cols[0]) & (F.col("c") < cols[1])
    return pixels.where(inside).withColumn("r", F.col("r") - rows[0]).withColumn("c", F.col("c") - cols[0])


def trim(pixels: DataFrame, height: int, width: int, margin: int) -> DataFrame:
    return keep_rectangle(pixels, (margin, height - margin), (margin, width - margin))


def untrim(points: DataFrame, margin: int, row: str = "r", col: str = "c") -> DataFrame:
    """Coordinates inside a trimmed frame back to the full frame."""
    return points.withColumn(row, F.col(row) + margin).withColumn(col, F.col(col) + margin)


def crop_centre(pixels: DataFrame, height: int, width: int, fraction: float) -> DataFrame:
    span = lambda n: (round(n * fraction), round(n * (1 - fraction)))
    return keep_rectangle(pixels, span(height), span(width))


def _mixed(channels: Sequence[str], weights: np.ndarray) -> list[Column]:
    """Linear combinations of the channels, zero weights left out."""
    out = []
    for line in weights:
        terms = [F.col(ch) * F.lit(float(w)) for ch, w in zip(channels, line) if w != 0]
        out.append(reduce(lambda a, b: a + b, terms))
    return out


def unmix(pixels: DataFrame, channels: Sequence[str], profile=BLEED_PROFILE) -> DataFrame:
    """Undo bleed-through: solve ``profile' * y = x`` per pixel, to 16 bits; other columns pass through."""
    weights = np.linalg.inv(np.asarray(profile, dtype=float).T)
    weights[np.abs(weights) < 1e-15] = 0.0
    return pixels.withColumns({ch: to_uint16(y) for ch, y in zip(channels, _mixed(channels, weights))})


def correct_colour(pixels: DataFrame, channels: Sequence[str], mixing=MIXING) -> DataFrame:
    """Multiply each pixel by the inverse mixing matrix and clip at 0."""
    weights = np.linalg.inv(np.asarray(mixing, dtype=float)).T
    weights[np.abs(weights) < 1e-15] = 0.0
    return pixels.withColumns(
        {ch: F.greatest(y, F.lit(0.0)) for ch, y in zip(channels, _mixed(channels, weights))}
    )


def flat_field(pixels: DataFrame, profile: DataFrame, channels: Sequence[str]) -> DataFrame:
    """``max(v - dark, 0) / flat`` cut to whole numbers, profiles per pixel of the frame."""
    joined = looked_up(pixels, profile, ["r", "c"])
    fixed = {
        ch: F.try_divide(F.greatest(F.col(ch) - F.col("dark"), F.lit(0.0)), F.col("flat")).cast("int") for ch in channels
    }
    return joined.withColumns(fixed).select(*pixels.columns)


def ellipse_spans(size: int) -> dict[int, int]:
    """Half width of every line of an elliptic element of the given odd size."""
    half = size // 2
    return {dy: round(half * math.sqrt((half * half - dy * dy) / (half * half))) for dy in range(-half, half + 1)}


def element_spans(size: int, shape: str) -> dict[int, int]:
    if shape == "square":
        half = size // 2
        return dict.fromkeys(range(-half, half + 1), half)
    if shape == "ellipse":
        return ellipse_spans(size)
    raise ValueError(f"unknown shape {shape}")


def _without_background(grid: Grid, name: str, spans: Mapping[int, int]) -> np.ndarray:
    low = swept(grid.array(name, np.inf), spans, np.minimum, np.inf)
    opened = swept(np.where(grid.present, low, -np.inf), spans, np.maximum, -np.inf)
    return np.where(grid.present, grid.array(name, 0) - opened, 0.0)


def _bilinear(values: np.ndarray, shift: tuple[float, float]) -> np.ndarray:
    """Content moved by (x, y), along the rows first, 0 from outside the frame."""
    for by, (down, right) in zip(shift, ((0, 1), (1, 0))):
        if by:
            low = math.floor(-by)
            part = -by - low
            near, far = (moved(values, down * k, right * k, 0.0) for k in (low, low + 1))
            values = near * (1 - part) + far * part
    return values


def _shift_reach(shifts: Sequence[tuple[float, float]]) -> int:
    return math.ceil(max(max(abs(x), abs(y)) for x, y in shifts)) + 1


def _as_double(schema: StructType, channels: Sequence[str]) -> StructType:
    return StructType([StructField(f.name, DoubleType() if f.name in channels else f.dataType) for f in schema])


def subtract_background(
    pixels: DataFrame,
    channels: Sequence[str],
    size: int = 31,
    shape: str = "ellipse",
    block: int = 256,
    plane: Sequence[str] = PLANE,
) -> DataFrame:
    """Subtract the grey opening (lowest then highest value under the element) of each channel."""
    spans = element_spans(size, shape)

    def kernel(grid: Grid) -> pa.Table:
        return grid.kept({ch: _without_background(grid, ch, spans) for ch in channels})

    return over_blocks(pixels, plane, block, 2 * (size // 2), kernel, pixels.schema, tight=True)


def align_channels(
    pixels: DataFrame,
    channels: Sequence[str],
    shifts: Sequence[tuple[float, float]] = CHANNEL_SHIFTS,
    block: int = 256,
    plane: Sequence[str] = PLANE,
) -> DataFrame:
    """Move each channel's content by its (x, y) shift, bilinear, 0 outside the frame, to 16 bits."""

    def kernel(grid: Grid) -> pa.Table:
        return grid.kept({ch: _bilinear(grid.array(ch, 0), shift) for ch, shift in zip(channels, shifts)})

    work = over_blocks(pixels, plane, block, _shift_reach(shifts), kernel, _as_double(pixels.schema, channels), tight=True)
    return work.withColumns({ch: to_uint16(ch) for ch in channels})


def flatten_and_align(
    pixels: DataFrame,
    channels: Sequence[str],
    size: int = 31,
    shape: str = "ellipse",
    shifts: Sequence[tuple[float, float]] = CHANNEL_SHIFTS,
    block: int = 256,
    plane: Sequence[str] = PLANE,
) -> DataFrame:
    """Background, then alignment, under one halo of the summed reach: the pixels move once."""
    spans = element_spans(size, shape)

    def kernel(grid: Grid) -> pa.Table:
        flat = {ch: _without_background(grid, ch, spans) for ch in channels}
        return grid.kept({ch: _bilinear(flat[ch], shift) for ch, shift in zip(channels, shifts)})

    halo = 2 * (size // 2) + _shift_reach(shifts)
    work = over_blocks(pixels, plane, block, halo, kernel, _as_double(pixels.schema, channels), tight=True)
    return work.withColumns({ch: to_uint16(ch) for ch in channels})


def apply_shift(pixels: DataFrame, shifts: DataFrame, height: int, width: int) -> DataFrame:
    """Move all channels by the (dr, dc) of their tile and cycle; pixels leaving the frame are lost."""
    placed = looked_up(pixels, shifts.select("fov", "cycle", "dr", "dc"), ["fov", "cycle"])
    placed = placed.withColumn("r", (F.col("r") + F.col("dr")).cast("int")).withColumn(
        "c", (F.col("c") + F.col("dc")).cast("int")
    )
    inside = F.col("r").between(0, height - 1) & F.col("c").between(0, width - 1)
    return placed.where(inside).select(*pixels.columns)


def apply_fine_shift(
    pixels: DataFrame, shifts: DataFrame, channels: Sequence[str], height: int, width: int, block: int = 256
) -> DataFrame:
    """Move ``channels`` by the fractional (dr, dc) of their tile and cycle, as doubles.

    The whole part moves the pixels; the rest, in [0, 1), weighs each pixel
    with the one before it on both axes.  Nothing (0) comes in from outside the
    frame, and places that no pixel's whole part reaches have no row, as in
    ``apply_shift``.  ``pixels`` keep their other columns.
    """
    parts = shifts.select(
        "fov",
        "cycle",
        *[F.floor(d).cast("int").alias(f"_whole_{d}") for d in ("dr", "dc")],
        *[(F.col(d) - F.floor(d)).cast("double").alias(f"_rest_{d}") for d in ("dr", "dc")],
    )
    placed = pixels.withColumns({ch: F.col(ch).cast("double") for ch in channels}).join(parts, ["fov", "cycle"])
    placed = placed.withColumn("r", F.col("r") + F.col("_whole_dr")).withColumn("c", F.col("c") + F.col("_whole_dc"))
    placed = placed.where(F.col("r").between(-1, height - 1) & F.col("c").between(-1, width - 1))

    def kernel(grid: Grid) -> pa.Table:
        down, right = (grid.rows[f"_rest_{d}"][0].as_py() for d in ("dr", "dc"))

        def resampled(ch: str) -> np.ndarray:
            v = grid.array(ch, 0.0)
            v = (1 - down) * v + down * moved(v, -1, 0, 0.0)
            return (1 - right) * v + right * moved(v, 0, -1, 0.0)

        return grid.kept({ch: resampled(ch) for ch in channels})

    work = over_blocks(placed, ["fov", "cycle"], block, 1, kernel, placed.schema, signed=True)
    return work.where("r >= 0 AND c >= 0").select(*pixels.columns)


def segmentation_input(
    gene_pixels: DataFrame, gene_channels: Sequence[str], hyb_pixels: DataFrame, cyto: Sequence[str], nuclear: str
) -> DataFrame:
    """Cyto image (hyb cyto channels plus all cycles and channels of the gene images) and nuclear image."""
    add = lambda names: reduce(lambda a, b: a + b, [F.col(n).cast("double") for n in names])
    spot = ["fov", "r", "c"]
    gene = gene_pixels.select(*spot, add(gene_channels).alias("cyto"), F.lit(0.0).alias("nuclear"))
    hyb = hyb_pixels.select(*spot, add(cyto).alias("cyto"), F.col(nuclear).cast("double").alias("nuclear"))
    both = gene.unionByName(hyb).groupBy(*spot).agg(F.sum("cyto").alias("cyto"), F.sum("nuclear").alias("nuclear"))
    return both.select(*spot, to_uint16("cyto").alias("cyto"), to_uint16("nuclear").alias("nuclear"))


def max_projection(stack: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Highest value over all planes of a stack."""
    return stack.groupBy("fov", "r", "c").agg(*[F.max(ch).alias(ch) for ch in channels])


def rgb(pixels: DataFrame, channels: Sequence[str], strength: float = 1.0) -> DataFrame:
    """Red, green and blue as sums of three of the four channels each."""
    c0, c1, c2, c3 = [F.col(ch) for ch in channels]
    clip = lambda v: F.least(F.greatest(v * F.lit(float(strength)), F.lit(0.0)), F.lit(255.0)).cast("int")
    return pixels.select(
        *[k for k in KEYS if k in pixels.columns],
        clip(c1 + c2 + c3).alias("red"),
        clip(c1 + c0 + c3).alias("green"),
        clip(c0 + c2 + c3).alias("blue"),
    )


def normalise_range(pixels: DataFrame, channels: Sequence[str], plane: Sequence[str] = PLANE) -> DataFrame:
    """Each plane scaled from its lowest to its highest value; a flat plane becomes null."""
    span = pixels.groupBy(*plane).agg(
        *[F.min(ch).alias(f"_lo_{ch}") for ch in channels], *[F.max(ch).alias(f"_hi_{ch}") for ch in channels]
    )
    scaled = {
        ch: F.try_divide((F.col(ch) - F.col(f"_lo_{ch}")).cast("double"), F.col(f"_hi_{ch}") - F.col(f"_lo_{ch}"))
        for ch in channels
    }
    return looked_up(pixels, span, plane).withColumns(scaled).select(*pixels.columns)


def plane_max(pixels: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Highest value of every plane, long form ``(fov, cycle, channel, v)``."""
    high = pixels.groupBy(*PLANE).agg(*[F.max(ch).alias(ch) for ch in channels])
    return high.unpivot(list(PLANE), list(channels), "channel", "v")


def median_max(pixels: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Per cycle one row with the median over tiles of each channel's highest value.

    Values are 16-bit, so the exact median keeps at most 65,536 counts.
    """
    high = pixels.groupBy(*PLANE).agg(*[F.max(ch).alias(ch) for ch in channels])
    return high.groupBy("cycle").agg(*[F.median(ch).alias(f"_med_{ch}") for ch in channels])


def normalise_median(pixels: DataFrame, channels: Sequence[str], medians: DataFrame) -> DataFrame:
    scaled = {ch: F.try_divide(F.col(ch).cast("double"), F.col(f"_med_{ch}")) for ch in channels}
    # One row per cycle; the pixels, whose size before the cycles are spread looks small, must not be the side that is sent.
    return pixels.join(F.broadcast(medians), "cycle").withColumns(scaled).select(*pixels.columns)


def stack_cycles(pixels: DataFrame, channels: Sequence[str], n_cycles: int) -> DataFrame:
    """One row per pixel with the signals of all cycles, cycle-major then channel."""
    slots = [
        F.max(F.when(F.col("cycle") == t, F.col(ch).cast("double"))).alias(f"_{t}_{ch}")
        for t in range(1, n_cycles + 1)
        for ch in channels
    ]
    names = [f"_{t}_{ch}" for t in range(1, n_cycles + 1) for ch in channels]
    wide = pixels.groupBy("fov", "r", "c").agg(*slots)
    return wide.select("fov", "r", "c", F.array(*[F.coalesce(F.col(n), F.lit(0.0)) for n in names]).alias("sig"))


def find_peaks(
    pixels: DataFrame,
    channels: Mapping[str, tuple[float, float]],
    reach: int = 1,
    block: int = 256,
    plane: Sequence[str] = PLANE,
) -> DataFrame:
    """Local maxima above a threshold that stand out from their surroundings.

    ``channels`` maps a channel to (threshold, prominence).  A peak is the
    highest pixel of its (2*reach+1)-square, the first in (r, c) order on a
    tie, above the threshold and at least the prominence over the lowest one.
    """
    around = element_spans(2 * reach + 1, "square")

    def kernel(grid: Grid) -> pa.Table:
        found = []
        for number, (ch, (threshold, prominence)) in enumerate(channels.items()):
            values = grid.array(ch, -np.inf)
            lowest = swept(grid.array(ch, np.inf), around, np.minimum, np.inf)
            is_peak = is_first_highest(values, reach) & (values > threshold) & (values - lowest >= prominence)
            hits = grid.kept({}, is_peak & grid.present)
            hits = hits.append_column("channel", pa.array(np.full(hits.num_rows, number)))
            found.append(hits.append_column("v", hits[ch].cast(pa.float64())).select([*plane, "r", "c", "channel", "v"]))
        return pa.concat_tables(found)

    keys = [pixels.schema[name] for name in (*plane, "r", "c")]
    schema = StructType([*keys, StructField("channel", IntegerType()), StructField("v", DoubleType())])
    return over_blocks(pixels, plane, block, reach, kernel, schema)


def suppress_adjacent(peaks: DataFrame) -> DataFrame:
    """Distinct peak positions, without those that have another peak at (r+1, c+1),
    (r, c+1), (r-1, c+1) or (r-1, c).
    """
    # The positions a peak knocks out, relative to itself.
    knocked = [(-1, -1), (0, -1), (1, -1), (1, 0)]
    spots = peaks.select("fov", "r", "c").distinct()
    gone = spots.select(
        "fov",
        F.explode(
            F.array(*[F.struct((F.col("r") + dr).alias("r"), (F.col("c") + dc).alias("c")) for dr, dc in knocked])
        ).alias("p"),
    ).select("fov", F.col("p.r").alias("r"), F.col("p.c").alias("c"))
    return spots.join(gone, ["fov", "r", "c"], "left_anti")


def measure_labels(mask: DataFrame) -> DataFrame:
    return mask.groupBy("fov", "label").agg(
        F.avg("r").alias("cent_x"), F.avg("c").alias("cent_y"), F.count(F.lit(1)).alias("area")
    )


def expand_labels(mask: DataFrame, height: int, width: int, distance: int = 3) -> DataFrame:
    """Background pixels within the distance take the nearest label, the lowest on a tie.

    Labels spread along the rows first and the nearest one per pixel spreads
    across them: for one line of the disc the nearest label is the same
    whichever line it is, so two short sweeps replace the whole disc.
    """
    steps = range(-distance, distance + 1)

    def spread(df: DataFrame, axis: str, size: int) -> DataFrame:
        moves = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(d * d).alias("d2")) for d in steps])
        moved = df.withColumn("_m", F.explode(moves)).select(
            "fov",
            *[(F.col(a) + F.col("_m.d")).alias(a) if a == axis else F.col(a) for a in ("r", "c")],
            F.struct((F.col("_n.d2") + F.col("_m.d2")).alias("d2"), F.col("_n.label").alias("label")).alias("_n"),
        )
        inside = F.col(axis).between(0, size - 1) & (F.col("_n.d2") <= distance * distance)
        return moved.where(inside).groupBy("fov", "r", "c").agg(F.min("_n").alias("_n"))

    start = mask.select("fov", "r", "c", F.struct(F.lit(0).alias("d2"), F.col("label")).alias("_n"))
    return spread(spread(start, "c", width), "r", height).select("fov", "r", "c", "_n.label")


def fuse_masks(nuclei: DataFrame, cyto: DataFrame) -> DataFrame:
    """Cyto labels raised by the tile's highest nucleus label, then the larger of both masks."""
    top = nuclei.groupBy("fov").agg(F.max("label").alias("_top"))
    raised = cyto.join(top, "fov", "left").select(
        "fov", "r", "c", (F.col("label") + F.coalesce("_top", F.lit(0))).alias("label")
    )
    both = nuclei.select("fov", "r", "c", "label").unionByName(raised)
    return both.groupBy("fov", "r", "c").agg(F.max("label").alias("label"))


def label_signal(mask: DataFrame, pixels: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Mean signal of every label, cycle and channel."""
    inside = pixels.join(mask.select("fov", "r", "c", "label"), ["fov", "r", "c"])
    return inside.groupBy("fov", "label", "cycle").agg(*[F.avg(ch).alias(ch) for ch in channels])


def place_mosaic(
    pixels: DataFrame, tforms: DataFrame, channels: Sequence[str], rescale: float = 0.2, strength: float = 1.0
) -> DataFrame:
    """Tiles in one picture per slice: highest value per output pixel, scaled and clipped to 8 bits."""
    placed = pixels.join(tforms.select("fov", "slice", "scale", "pos_x", "pos_y"), "fov")
    gx = F.floor((F.col("scale") * F.col("c") + F.col("pos_x")) * rescale).cast("int")
    gy = F.floor((F.col("scale") * F.col("r") + F.col("pos_y")) * rescale).cast("int")
    top = placed.groupBy("slice", "cycle", gx.alias("gx"), gy.alias("gy")).agg(*[F.max(ch).alias(ch) for ch in channels])
    clip = lambda ch: F.least(F.greatest(F.col(ch) * F.lit(float(strength)), F.lit(0.0)), F.lit(255.0)).cast("int")
    return top.withColumns({ch: clip(ch) for ch in channels})


def channel_stats(pixels: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Frame size and per channel lowest, highest, mean and sum, long form."""
    stats = []
    for ch in channels:
        v = F.col(ch)
        stats.append(
            F.struct(
                F.lit(ch).alias("channel"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"), F.sum(v).alias("total")
            )
        )
    wide = pixels.groupBy(*PLANE).agg(
        (F.max("r") + 1).alias("height"), (F.max("c") + 1).alias("width"), F.array(*stats).alias("_s")
    )
    return wide.select(*PLANE, "height", "width", F.explode("_s").alias("_s")).select(*PLANE, "height", "width", "_s.*")


def compare_images(a: DataFrame, b: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Similarity of lowest, highest and mean value per plane of two runs, and whether sums agree."""
    keys = [*PLANE, "channel"]
    one, two = channel_stats(a, channels), channel_stats(b, channels)
    two = two.select(*keys, *[F.col(n).alias(f"{n}_b") for n in ("low", "high", "mean", "total")])
    joined = one.join(two, keys, "full")
    sims = {f"sim_{n}": similarity(n, f"{n}_b") for n in ("low", "high", "mean")}
    out = joined.select(*keys, *[c.alias(n) for n, c in sims.items()], F.col("total").eqNullSafe(F.col("total_b")).alias("identical"))
    worst = F.least(*sims)
    return out.withColumn("similar", F.coalesce(worst >= SIMILAR, F.lit(False)))


def registration_score(pixels: DataFrame, channels: Sequence[str], bins: int = 100) -> DataFrame:
    """Normalised mutual information between the first and every later cycle of a tile.

    The joint histogram is counted per (tile, cycle), so only bins meet, never images.
    """
    v = reduce(lambda a, b: a + b, [F.col(ch).cast("double") for ch in channels])
    summed = pixels.select(*KEYS, v.alias("v"))
    span = summed.groupBy("fov", "cycle").agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    place = F.floor(F.coalesce(F.try_divide((F.col("v") - F.col("_lo")) * bins, F.col("_hi") - F.col("_lo")), F.lit(0.0)))
    binned = summed.join(span, ["fov", "cycle"]).select(
        *KEYS, F.least(place, F.lit(bins - 1)).cast("int").alias("bin")
    )
    first = binned.where("cycle = 1").select("fov", "r", "c", F.col("bin").alias("bin1"))
    joint = (
        binned.where("cycle > 1")
        .join(first, ["fov", "r", "c"])
        .groupBy("fov", "cycle", "bin1", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    whole = joint.groupBy("fov", "cycle").agg(F.sum("n").alias("_n"))

    def entropy(by: list[str], name: str) -> DataFrame:
        counts = joint.groupBy("fov", "cycle", *by).agg(F.sum("n").alias("n")).join(whole, ["fov", "cycle"])
        p = F.col("n") / F.col("_n")
        return counts.groupBy("fov", "cycle").agg((-F.sum(p * F.ln(p))).alias(name))

    h = (
        entropy(["bin1"], "h1")
        .join(entropy(["bin"], "h2"), ["fov", "cycle"])
        .join(entropy(["bin1", "bin"], "h12"), ["fov", "cycle"])
    )
    return h.select("fov", "cycle", F.try_divide(F.col("h1") + F.col("h2"), F.col("h12")).alias("nmi"))


def registration_flags(scores: DataFrame, contents: DataFrame, threshold: float) -> DataFrame:
    """Tiles whose best rescaled score stands out from the median one, with their image variance.

    The scores of one tile are as few as its cycles.
    """
    span = scores.groupBy("fov").agg(F.min("nmi").alias("_lo"), F.max("nmi").alias("_hi"))
    scaled = scores.join(span, "fov").select(
        "fov", F.try_divide(F.col("nmi") - F.col("_lo"), F.col("_hi") - F.col("_lo")).alias("s")
    )
    ratio = scaled.groupBy("fov").agg(F.try_divide(F.max("s"), F.median("s")).alias("score"))
    return ratio.where(F.abs("score") > threshold).join(contents, "fov")


def focus_score(stack: DataFrame, channels: Sequence[str], z: str = "z") -> DataFrame:
    """Per plane the median over channels of the z-scored spread of the image, and
    per tile whether signal reaches the first or the last plane.
    """
    spread = stack.groupBy("fov", z).agg(*[F.stddev_samp(ch).alias(ch) for ch in channels])
    long = spread.unpivot(["fov", z], list(channels), "channel", "s")
    level = long.groupBy("fov", "channel").agg(F.avg("s").alias("_m"), F.stddev_pop("s").alias("_d"))
    scored = long.join(level, ["fov", "channel"]).select(
        "fov", z, F.coalesce(F.try_divide(F.col("s") - F.col("_m"), F.col("_d")), F.lit(0.0)).alias("q")
    )
    planes = scored.groupBy("fov", z).agg(F.median("q").alias("score"))
    ends = planes.groupBy("fov").agg(
        ((F.min_by("score", z) > 0) | (F.max_by("score", z) > 0)).alias("warn")
    )
    return planes.join(ends, "fov")


def sample_positions(positions: DataFrame, every: int) -> DataFrame:
    """Every n-th distinct position, starting from the middle of the first interval."""
    numbered = number_rows(positions.distinct(), positions.columns, "_i")
    start = int(every / 2 + 0.5)
    place = F.col("_i") + 1
    return numbered.where((place >= start) & ((place - start) % every == 0)).drop("_i")
