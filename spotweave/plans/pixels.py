"""Queries over pixel tables: corrections, masks, peaks, shifts and checks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.functions.vectors import to_uint16
from spotweave.operators import brightness, layout, peaks, pixels as px, registration
from spotweave.plans.inputs import CHANNELS, HEIGHT, WIDTH
from spotweave.plans.registry import Inputs, Registry, rounded

pixels = Registry()
CH = list(CHANNELS)
BLOCK = 16  # small, so that the frames of the derived data are cut into several blocks
U16 = "CAST(least(greatest(round_even({}, 0), 0), 65535) AS INT)"


def each_channel(template: str) -> str:
    return ", ".join(template.format(ch=ch) for ch in CH)


@pixels.query("SELECT fov, cycle, r, c, ch_a, ch_g FROM fx_px")
def channels_by_name(i: Inputs) -> DataFrame:
    return px.select_channels(i.px, ["ch_a", "ch_g"])


@pixels.query(
    f"""SELECT fov, cycle, r - 3 AS r, c - 3 AS c, {', '.join(CH)} FROM fx_px
    WHERE r >= 3 AND r < {HEIGHT - 3} AND c >= 3 AND c < {WIDTH - 3}"""
)
def trimmed_pixels(i: Inputs) -> DataFrame:
    return px.trim(i.px, HEIGHT, WIDTH, 3)


@pixels.query(
    f"""SELECT fov, cycle, r - round_even({HEIGHT} * 0.3, 0)::INT AS r, c - round_even({WIDTH} * 0.3, 0)::INT AS c, {', '.join(CH)} FROM fx_px
    WHERE r >= round_even({HEIGHT} * 0.3, 0) AND r < round_even({HEIGHT} * 0.7, 0)
      AND c >= round_even({WIDTH} * 0.3, 0) AND c < round_even({WIDTH} * 0.7, 0)"""
)
def cropped_pixels(i: Inputs) -> DataFrame:
    return px.crop_centre(i.px, HEIGHT, WIDTH, 0.3)


@pixels.query(
    f"""SELECT fov, cycle, r, c, {each_channel(U16.format('CAST({ch} AS DOUBLE) * 2.5 * ({ch} - 20)') + ' AS {ch}')} FROM fx_px"""
)
def clipped_pixels(i: Inputs) -> DataFrame:
    return i.px.withColumns({ch: to_uint16(F.col(ch).cast("double") * 2.5 * (F.col(ch) - 20)) for ch in CH})


def _pair(first: str, second: str, m) -> tuple[str, str]:
    """Solution of the 2 x 2 system m' * y = x, by determinants."""
    (a, b), (c, d) = m
    det = f"({a!r}::DOUBLE * {d!r} - {b!r}::DOUBLE * {c!r})"
    return (
        f"(({d!r}::DOUBLE * {first} - {c!r}::DOUBLE * {second}) / {det})",
        f"(({a!r}::DOUBLE * {second} - {b!r}::DOUBLE * {first}) / {det})",
    )


def solved_sql(matrix) -> list[str]:
    top = [row[:2] for row in matrix[:2]]
    low = [row[2:] for row in matrix[2:]]
    return [*_pair(CH[0], CH[1], top), *_pair(CH[2], CH[3], low)]


@pixels.query(
    "SELECT fov, cycle, r, c, "
    + ", ".join(f"{U16.format(e)} AS {ch}" for e, ch in zip(solved_sql(px.BLEED_PROFILE), CH))
    + " FROM fx_px"
)
def unmixed_pixels(i: Inputs) -> DataFrame:
    return px.unmix(i.px, CH)


@pixels.query(
    "SELECT fov, cycle, r, c, "
    + ", ".join(f"round(greatest({e}, 0), 6) AS {ch}" for e, ch in zip(solved_sql(px.MIXING), CH))
    + " FROM fx_px"
)
def colour_corrected(i: Inputs) -> DataFrame:
    return rounded(px.correct_colour(i.px, CH))


@pixels.query(
    f"""SELECT p.fov, p.cycle, p.r, p.c, {each_channel('CAST(trunc(greatest({ch} - dark, 0) / flat) AS INT) AS {ch}')}
    FROM fx_px p JOIN fx_flat f ON f.r = p.r AND f.c = p.c"""
)
def flat_fielded(i: Inputs) -> DataFrame:
    return px.flat_field(i.px, i.flat, CH)


def _opening(kernel: str) -> str:
    lo = ", ".join(f"min(q.{ch}) AS {ch}" for ch in CH)
    hi = ", ".join(f"any_value(p.{ch}) - max(q.{ch}) AS {ch}" for ch in CH)
    near = f"q.fov = p.fov AND q.cycle = p.cycle AND ({kernel})"
    return f"""WITH px AS MATERIALIZED (SELECT * FROM fx_px),
    lo AS MATERIALIZED (SELECT p.fov, p.cycle, p.r, p.c, {lo} FROM px p JOIN px q ON {near} GROUP BY ALL)
    SELECT p.fov, p.cycle, p.r, p.c, {hi} FROM px p JOIN lo q ON {near} GROUP BY p.fov, p.cycle, p.r, p.c"""


@pixels.query(_opening("(abs(q.r - p.r) = 2 AND q.c = p.c) OR (abs(q.r - p.r) <= 1 AND abs(q.c - p.c) <= 2)"))
def background_ellipse(i: Inputs) -> DataFrame:
    return px.subtract_background(i.px, CH, size=5, block=BLOCK)


@pixels.query(_opening("abs(q.r - p.r) <= 15 AND abs(q.c - p.c) <= round_even(15 * sqrt((225 - (q.r - p.r) * (q.r - p.r)) / 225), 0)"))
def background_full_size(i: Inputs) -> DataFrame:
    """The element of 31 pixels that a run uses."""
    return px.subtract_background(i.px, CH, block=32)


@pixels.query(_opening("abs(q.r - p.r) <= 1 AND abs(q.c - p.c) <= 1"))
def background_square(i: Inputs) -> DataFrame:
    return px.subtract_background(i.px, CH, size=3, shape="square", block=BLOCK)


def aligned_sql(ch: str, shift: tuple[float, float]) -> str:
    tx, ty = shift
    at = lambda dr, dc: f"coalesce(max(CAST({ch} AS DOUBLE)) FILTER (WHERE dr = {dr} AND dc = {dc}), 0)"
    x0, y0 = int(np.floor(-tx)), int(np.floor(-ty))
    fx, fy = -tx - x0, -ty - y0
    parts = [
        f"{wy!r}::DOUBLE * {wx!r} * {at(y0 + a, x0 + b)}"
        for a, wy in ((0, 1 - fy), (1, fy))
        for b, wx in ((0, 1 - fx), (1, fx))
        if wx * wy
    ]
    return U16.format(" + ".join(parts)) + f" AS {ch}"


@pixels.query(
    f"""WITH px AS MATERIALIZED (SELECT * FROM fx_px),
    near AS (SELECT p.fov, p.cycle, p.r, p.c, q.r - p.r AS dr, q.c - p.c AS dc, {', '.join(f'q.{ch}' for ch in CH)}
      FROM px p JOIN px q ON q.fov = p.fov AND q.cycle = p.cycle AND abs(q.r - p.r) <= 2 AND abs(q.c - p.c) <= 2)
    SELECT fov, cycle, r, c, {', '.join(aligned_sql(ch, s) for ch, s in zip(CH, px.CHANNEL_SHIFTS))} FROM near GROUP BY fov, cycle, r, c"""
)
def aligned_channels(i: Inputs) -> DataFrame:
    return px.align_channels(i.px, CH, block=BLOCK)


@pixels.query(
    f"""WITH p AS (SELECT *, (fov + cycle) % 5 - 2 AS dr, (fov * 2 + cycle) % 5 - 2 AS dc FROM fx_px)
    SELECT fov, cycle, r + dr AS r, c + dc AS c, {', '.join(CH)} FROM p
    WHERE r + dr BETWEEN 0 AND {HEIGHT - 1} AND c + dc BETWEEN 0 AND {WIDTH - 1}"""
)
def shifted_pixels(i: Inputs) -> DataFrame:
    shifts = i.px.select("fov", "cycle").distinct().select(
        "fov", "cycle", ((F.col("fov") + F.col("cycle")) % 5 - 2).alias("dr"), ((F.col("fov") * 2 + F.col("cycle")) % 5 - 2).alias("dc")
    )
    return px.apply_shift(i.px, shifts, HEIGHT, WIDTH)


def summed(i: Inputs, cycle: int | None = None) -> DataFrame:
    v = sum((F.col(ch) for ch in CH), F.lit(0)).cast("double")
    table = i.px if cycle is None else i.px.where(F.col("cycle") == cycle)
    return table.select("fov", "cycle", "r", "c", v.alias("v"))


VOTE = """
    SELECT t.fov, m.cycle, m.r - t.r AS dr, m.c - t.c AS dc, sum(t.v * m.v) AS vote
    FROM {t} t JOIN {m} m ON m.fov = t.fov AND abs(m.r - t.r) <= {reach} AND abs(m.c - t.c) <= {reach} GROUP BY ALL"""
BEST = "SELECT {keys}, dr, dc, vote FROM votes QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY vote DESC, dr, dc) = 1"


@pixels.query(
    f"""WITH t AS MATERIALIZED (SELECT fov, r, c, CAST(ch_g + ch_t + ch_a + ch_c AS DOUBLE) AS v FROM fx_px WHERE cycle = 1),
    m AS MATERIALIZED (SELECT * FROM fx_moving), votes AS ({VOTE.format(t='t', m='m', reach=2)}) {BEST.format(keys='fov, cycle')}"""
)
def cycle_shift(i: Inputs) -> DataFrame:
    return registration.estimate_shift(summed(i, 1).drop("cycle"), i.moving, 2, block=BLOCK)


BESIDE = ", ".join(
    f"max(v.vote) FILTER (WHERE v.dr = b.dr + ({dr}) AND v.dc = b.dc + ({dc})) AS {name}"
    for name, dr, dc in (
        ("n", -1, 0), ("s", 1, 0), ("w", 0, -1), ("e", 0, 1), ("nw", -1, -1), ("ne", -1, 1), ("sw", 1, -1), ("se", 1, 1)
    )
)


@pixels.query(
    f"""WITH t AS MATERIALIZED (SELECT fov, r, c, CAST(ch_g + ch_t + ch_a + ch_c AS DOUBLE) AS v FROM fx_px WHERE cycle = 1),
    m AS MATERIALIZED (SELECT * FROM fx_moving), votes AS MATERIALIZED ({VOTE.format(t='t', m='m', reach=2)}),
    best AS ({BEST.format(keys='fov, cycle')}),
    beside AS (SELECT b.fov, b.cycle, b.dr, b.dc, b.vote, abs(b.dr) < 2 AS row_in, abs(b.dc) < 2 AS col_in, {BESIDE}
      FROM best b JOIN votes v USING (fov, cycle) GROUP BY ALL),
    bend AS (SELECT *, CASE WHEN row_in THEN (s - n) / 2 END AS r, CASE WHEN row_in THEN s - 2 * vote + n END AS rr,
        CASE WHEN col_in THEN (e - w) / 2 END AS c, CASE WHEN col_in THEN e - 2 * vote + w END AS cc,
        CASE WHEN row_in AND col_in THEN (se - sw - ne + nw) / 4 END AS rc FROM beside),
    tops AS (SELECT *, CASE WHEN rr * cc - rc * rc > 0 THEN (rc * c - cc * r) / (rr * cc - rc * rc) END AS down,
        CASE WHEN rr * cc - rc * rc > 0 THEN (rc * r - rr * c) / (rr * cc - rc * rc) END AS rgt FROM bend),
    picked AS (SELECT *, coalesce(rr < 0 AND abs(down) <= 1 AND abs(rgt) <= 1, false) AS joint FROM tops)
    SELECT fov, cycle, vote, round(dr + CASE WHEN joint THEN down WHEN rr < 0 THEN -r / rr ELSE 0 END, 6) AS dr,
      round(dc + CASE WHEN joint THEN rgt WHEN cc < 0 THEN -c / cc ELSE 0 END, 6) AS dc FROM picked"""
)
def fine_cycle_shift(i: Inputs) -> DataFrame:
    """Shift between cycles in fractions of a pixel."""
    return rounded(registration.estimate_fine_shift(summed(i, 1).drop("cycle"), i.moving, 2, block=BLOCK))


FINE = "fov, cycle, ((fov + cycle) % 5 - 2) * 0.75::DOUBLE AS dr, ((fov * 2 + cycle) % 5 - 2) * 0.25::DOUBLE AS dc"


@pixels.query(
    f"""WITH q AS MATERIALIZED (SELECT fov, cycle, r + CAST(floor(dr) AS INT) AS r, c + CAST(floor(dc) AS INT) AS c, dr - floor(dr) AS fr, dc - floor(dc) AS fc,
        CAST(ch_g AS DOUBLE) AS ch_g, CAST(ch_a AS DOUBLE) AS ch_a FROM (SELECT {FINE}, r, c, ch_g, ch_a FROM fx_px) z),
    w AS (SELECT fov, cycle, r + dy AS r, c + dx AS c, (CASE WHEN dy = 1 THEN fr ELSE 1 - fr END) * (CASE WHEN dx = 1 THEN fc ELSE 1 - fc END) AS w, ch_g, ch_a
      FROM q, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) d(dy, dx))
    SELECT q.fov, q.cycle, q.r, q.c, sum(w.w * w.ch_g) AS ch_g, sum(w.w * w.ch_a) AS ch_a
    FROM q JOIN w USING (fov, cycle, r, c) WHERE q.r BETWEEN 0 AND {HEIGHT - 1} AND q.c BETWEEN 0 AND {WIDTH - 1} GROUP BY q.fov, q.cycle, q.r, q.c"""
)
def finely_shifted_pixels(i: Inputs) -> DataFrame:
    images = i.px.select("fov", "cycle", "r", "c", "ch_g", "ch_a")
    shifts = images.select("fov", "cycle").distinct().select(
        "fov", "cycle", (((F.col("fov") + F.col("cycle")) % 5 - 2) * 0.75).alias("dr"), (((F.col("fov") * 2 + F.col("cycle")) % 5 - 2) * 0.25).alias("dc")
    )
    return px.apply_fine_shift(images, shifts, ["ch_g", "ch_a"], HEIGHT, WIDTH, block=BLOCK)


@pixels.query(
    f"""WITH n AS (SELECT fov, cycle, r, c, (ch_g - min(ch_g) OVER w) / CAST(max(ch_g) OVER w - min(ch_g) OVER w AS DOUBLE) AS v
      FROM fx_px WINDOW w AS (PARTITION BY fov, cycle)),
    t AS MATERIALIZED (SELECT fov, r, c, v FROM n WHERE cycle = 1),
    m AS MATERIALIZED (SELECT fov, cycle, r, c, v FROM n WHERE cycle > 1),
    votes AS (SELECT fov, cycle, dr, dc, round(vote, 6) AS vote FROM ({VOTE.format(t='t', m='m', reach=1)}) q)
    {BEST.format(keys='fov, cycle')}"""
)
def reference_channel_shift(i: Inputs) -> DataFrame:
    """Shift on one reference channel after scaling both images to the same range."""
    scaled = px.normalise_range(i.px.select("fov", "cycle", "r", "c", "ch_g"), ["ch_g"]).withColumnRenamed("ch_g", "v")
    votes = registration.displacement_votes(
        scaled.where("cycle = 1").drop("cycle"), scaled.where("cycle > 1"), 1, block=BLOCK
    )
    return registration.best_shift(rounded(votes))


# The moved images with another brightness curve, as whole levels, and the template's levels.
MATCHED = """
    raw AS MATERIALIZED (SELECT fov, cycle, r, c, floor(v * v / 64) AS v FROM fx_moving),
    m0 AS MATERIALIZED (SELECT fov, cycle, r, c, floor(v / max(v) OVER (PARTITION BY fov, cycle) * 255) AS v FROM raw),
    t0 AS MATERIALIZED (SELECT fov, r, c, floor(v / max(v) OVER (PARTITION BY fov) * 255) AS v
      FROM (SELECT fov, r, c, CAST(ch_g + ch_t + ch_a + ch_c AS DOUBLE) AS v FROM fx_px WHERE cycle = 1) z),
    mq AS MATERIALIZED (SELECT fov, cycle, v, sum(n) OVER (PARTITION BY fov, cycle ORDER BY v) / CAST(sum(n) OVER (PARTITION BY fov, cycle) AS DOUBLE) AS q
      FROM (SELECT fov, cycle, v, count(*) AS n FROM m0 GROUP BY ALL) z),
    tq AS MATERIALIZED (SELECT fov, v, sum(n) OVER (PARTITION BY fov ORDER BY v) / CAST(sum(n) OVER (PARTITION BY fov) AS DOUBLE) AS q
      FROM (SELECT fov, v, count(*) AS n FROM t0 GROUP BY ALL) z),
    pair AS (SELECT m.fov, m.cycle, m.v, m.q, max(t.q) FILTER (WHERE t.q <= m.q) AS lq, max_by(t.v, t.q) FILTER (WHERE t.q <= m.q) AS lv,
        min(t.q) FILTER (WHERE t.q >= m.q) AS hq, min_by(t.v, t.q) FILTER (WHERE t.q >= m.q) AS hv
      FROM mq m JOIN tq t ON t.fov = m.fov GROUP BY m.fov, m.cycle, m.v, m.q),
    matched AS MATERIALIZED (SELECT m0.fov, m0.cycle, r, c, CASE WHEN lq IS NULL THEN hv WHEN lq = hq THEN lv ELSE lv + (q - lq) / (hq - lq) * (hv - lv) END AS v
      FROM m0 JOIN pair p ON p.fov = m0.fov AND p.cycle = m0.cycle AND p.v = m0.v)"""


def matched_images(i: Inputs) -> tuple[DataFrame, DataFrame]:
    template = brightness.grey_levels(summed(i, 1).drop("cycle"), ["fov"])
    curved = i.moving.withColumn("v", F.floor(F.col("v") * F.col("v") / 64).cast("double"))
    return template, brightness.match_brightness(brightness.grey_levels(curved, ["fov", "cycle"]), template)


@pixels.query(f"WITH {MATCHED} SELECT fov, cycle, r, c, round(v, 6) AS v FROM matched")
def matched_brightness(i: Inputs) -> DataFrame:
    return rounded(matched_images(i)[1])


def dog_sql(source: str) -> str:
    def blurred(sigma: float) -> str:
        weight = f"exp(-((q.r - p.r) * (q.r - p.r) + (q.c - p.c) * (q.c - p.c)) / {2 * sigma * sigma}::DOUBLE)"
        return f"sum({weight} * q.v) / sum({weight})"

    return f"""SELECT p.fov, p.cycle, p.r, p.c, {blurred(0.5)} - {blurred(1.0)} AS v FROM {source} p
      JOIN {source} q ON q.fov = p.fov AND q.cycle = p.cycle AND abs(q.r - p.r) <= 2 AND abs(q.c - p.c) <= 2 GROUP BY ALL"""


@pixels.query(
    f"""WITH {MATCHED}, t1 AS (SELECT *, 1 AS cycle FROM t0),
    t AS MATERIALIZED (SELECT fov, r, c, v FROM ({dog_sql('t1')}) z), m AS MATERIALIZED ({dog_sql('matched')}),
    votes AS (SELECT fov, cycle, dr, dc, round(vote, 3) AS vote FROM ({VOTE.format(t='t', m='m', reach=2)}) q)
    {BEST.format(keys='fov, cycle')}"""
)
def matched_shift(i: Inputs) -> DataFrame:
    """Shift after the images were given one brightness and reduced to their details."""
    template, matched = matched_images(i)
    sharp = lambda image, plane: brightness.difference_of_gaussians(image, 0.5, 1.0, plane, block=BLOCK, reach=2)
    votes = registration.displacement_votes(sharp(template, ["fov"]), sharp(matched, ["fov", "cycle"]), 2, block=BLOCK)
    return registration.best_shift(rounded(votes, 3))


@pixels.query(
    f"""WITH t AS MATERIALIZED (SELECT fov, r, c, 1.0::DOUBLE AS v FROM fx_mask_px),
    m AS MATERIALIZED (SELECT fov, CAST(2 AS INT) AS cycle, r, c, 1.0::DOUBLE AS v FROM fx_mask_nuc),
    votes AS ({VOTE.format(t='t', m='m', reach=2)}) {BEST.format(keys='fov, cycle')}"""
)
def label_mask_shift(i: Inputs) -> DataFrame:
    moving = i.mask_nuc.withColumn("cycle", F.lit(2))
    return registration.mask_shift(i.mask_px, moving, 2, block=BLOCK)


def spots_on_pixels(i: Inputs) -> tuple[DataFrame, DataFrame]:
    at = i.spots.select("fov", "modality", F.rint("lroi_x").cast("int").alias("r"), F.rint("lroi_y").cast("int").alias("c"))
    return at.where("modality = 'geneseq'"), at.where("modality = 'hyb'")


@pixels.query(
    f"""WITH s AS MATERIALIZED (SELECT fov, modality, round_even(lroi_x, 0)::INT AS r, round_even(lroi_y, 0)::INT AS c FROM fx_spots),
    votes AS (SELECT a.fov, b.r - a.r AS dr, b.c - a.c AS dc, count(*) AS vote FROM s a JOIN s b ON a.fov = b.fov
      AND a.modality = 'geneseq' AND b.modality = 'hyb' AND abs(b.r - a.r) <= 3 AND abs(b.c - a.c) <= 3 GROUP BY ALL)
    {BEST.format(keys='fov')}"""
)
def spot_displacement(i: Inputs) -> DataFrame:
    a, b = spots_on_pixels(i)
    return registration.spot_shift(a, b, 3)


@pixels.query(
    f"""WITH t AS MATERIALIZED (SELECT fov, r, c, CAST(ch_g + ch_t + ch_a + ch_c AS DOUBLE) AS v FROM fx_px WHERE cycle = 1),
    m AS MATERIALIZED (SELECT * FROM fx_moving), votes AS ({VOTE.format(t='t', m='m', reach=2)}),
    best AS ({BEST.format(keys='fov, cycle')})
    SELECT 'Pos' || CAST(fov // 4 + 1 AS VARCHAR) AS position, cycle, median(dr) AS dr, median(dc) AS dc FROM best GROUP BY ALL"""
)
def consensus_shift(i: Inputs) -> DataFrame:
    found = registration.estimate_shift(summed(i, 1).drop("cycle"), i.moving, 2, block=BLOCK)
    position = F.concat(F.lit("Pos"), (F.floor(F.col("fov") / 4) + 1).cast("string"))
    return layout.consensus_shift(found.withColumn("position", position))


@pixels.query(
    f"""WITH g AS (SELECT fov, r, c, sum(ch_g + ch_t + ch_a + ch_c) AS v FROM fx_px GROUP BY ALL)
    SELECT g.fov, g.r, g.c, CAST(least(g.v + h.ch_g + h.ch_t, 65535) AS INT) AS cyto, h.ch_c AS nuclear
    FROM g JOIN fx_px h ON h.fov = g.fov AND h.r = g.r AND h.c = g.c AND h.cycle = 1"""
)
def segmentation_input(i: Inputs) -> DataFrame:
    return px.segmentation_input(i.px, CH, i.px.where("cycle = 1"), ["ch_g", "ch_t"], "ch_c")


@pixels.query(f"SELECT fov, r, c, {each_channel('max({ch}) AS {ch}')} FROM fx_px GROUP BY fov, r, c")
def max_projection(i: Inputs) -> DataFrame:
    return px.max_projection(i.px, CH)


@pixels.query(
    """SELECT fov, cycle, r, c, CAST(trunc(least((ch_t + ch_a + ch_c) * 1.5::DOUBLE, 255)) AS INT) AS red,
      CAST(trunc(least((ch_t + ch_g + ch_c) * 1.5::DOUBLE, 255)) AS INT) AS green,
      CAST(trunc(least((ch_g + ch_a + ch_c) * 1.5::DOUBLE, 255)) AS INT) AS blue FROM fx_px"""
)
def rgb_composite(i: Inputs) -> DataFrame:
    return px.rgb(i.px, CH, 1.5)


@pixels.query(
    f"""SELECT fov, cycle, r, c,
      {each_channel('round(({ch} - min({ch}) OVER w) / CAST(nullif(max({ch}) OVER w - min({ch}) OVER w, 0) AS DOUBLE), 6) AS {ch}')}
    FROM fx_px WINDOW w AS (PARTITION BY fov, cycle)"""
)
def range_normalised(i: Inputs) -> DataFrame:
    return rounded(px.normalise_range(i.px, CH))


@pixels.query(
    " UNION ALL ".join(f"SELECT fov, cycle, '{ch}' AS channel, max({ch}) AS v FROM fx_px GROUP BY ALL" for ch in CH)
)
def plane_maxima(i: Inputs) -> DataFrame:
    return px.plane_max(i.px, CH)


MEDIANS = f"""
    med AS (SELECT cycle, {each_channel('median({ch}) AS {ch}')} FROM
      (SELECT fov, cycle, {each_channel('max({ch}) AS {ch}')} FROM fx_px GROUP BY fov, cycle) q GROUP BY cycle)"""


@pixels.query(f"WITH {MEDIANS} SELECT * FROM med")
def median_of_maxima(i: Inputs) -> DataFrame:
    return px.median_max(i.px, CH).withColumnsRenamed({f"_med_{ch}": ch for ch in CH})


@pixels.query(
    f"""WITH {MEDIANS} SELECT p.fov, p.cycle, p.r, p.c, {each_channel('round(p.{ch} / m.{ch}, 6) AS {ch}')}
    FROM fx_px p JOIN med m USING (cycle)"""
)
def median_normalised(i: Inputs) -> DataFrame:
    return rounded(px.normalise_median(i.px, CH, px.median_max(i.px, CH)))


PEAKS = {"ch_g": (60, 30), "ch_t": (80, 40), "ch_a": (60, 30), "ch_c": (70, 30)}
PEAK_SQL = " UNION ALL ".join(
    f"""SELECT p.fov, p.cycle, p.r, p.c, {k} AS channel, CAST(any_value(p.{ch}) AS DOUBLE) AS v
    FROM px p JOIN px q ON q.fov = p.fov AND q.cycle = p.cycle AND abs(q.r - p.r) <= 1 AND abs(q.c - p.c) <= 1
    GROUP BY p.fov, p.cycle, p.r, p.c
    HAVING any_value(p.{ch}) > {t} AND any_value(p.{ch}) - min(q.{ch}) >= {h}
      AND NOT bool_or(q.{ch} > p.{ch} OR (q.{ch} = p.{ch} AND (q.r < p.r OR (q.r = p.r AND q.c < p.c))))"""
    for k, (ch, (t, h)) in enumerate(PEAKS.items())
)


def first_cycle_peaks(i: Inputs) -> DataFrame:
    return px.find_peaks(i.px.where("cycle = 1"), PEAKS, block=BLOCK)


@pixels.query(f"WITH px AS MATERIALIZED (SELECT * FROM fx_px) {PEAK_SQL}")
def signal_peaks(i: Inputs) -> DataFrame:
    return px.find_peaks(i.px, PEAKS, block=BLOCK)


# Brightness in coarse steps, as of a saturated or compressed image, makes plateaus that cross blocks.
STEP, OVER, PROMINENCE = 24, 20, 24


# From ``v(fov, cycle, channel, r, c, v, thr, prom)``: floods of all pixels, the pixels that meet nothing higher, their plateaus.
PLATEAUS = """
    low AS (SELECT fov, cycle, channel, min(CASE WHEN v > thr THEN v ELSE 0 END) AS low FROM v GROUP BY ALL),
    near AS MATERIALIZED (SELECT p.*, q.r AS r2, q.c AS c2, q.v AS v2 FROM v p, (VALUES (-1), (0), (1)) a(dr), (VALUES (-1), (0), (1)) b(dc), v q
      WHERE q.fov = p.fov AND q.cycle = p.cycle AND q.channel = p.channel AND q.r = p.r + dr AND q.c = p.c + dc AND p.v > p.thr AND q.v > q.thr),
    reach AS (SELECT fov, cycle, channel, r AS r0, c AS c0, v AS v0, prom, r, c, v FROM v WHERE v > thr
      UNION SELECT p.fov, p.cycle, p.channel, p.r0, p.c0, p.v0, p.prom, n.r2, n.c2, n.v2 FROM reach p JOIN near n
        ON n.fov = p.fov AND n.cycle = p.cycle AND n.channel = p.channel AND n.r = p.r AND n.c = p.c AND n.v2 > p.v0 - p.prom),
    hit AS MATERIALIZED (SELECT fov, cycle, channel, r0 AS r, c0 AS c, v0 AS v FROM reach JOIN low USING (fov, cycle, channel)
      GROUP BY ALL HAVING max(reach.v) <= v0 AND v0 - any_value(low) >= any_value(prom)),
    joined AS (SELECT fov, cycle, channel, r AS r0, c AS c0, r, c FROM hit
      UNION SELECT p.fov, p.cycle, p.channel, p.r0, p.c0, n.r2, n.c2 FROM joined p JOIN near n
        ON n.fov = p.fov AND n.cycle = p.cycle AND n.channel = p.channel AND n.r = p.r AND n.c = p.c
        JOIN hit h ON h.fov = n.fov AND h.cycle = n.cycle AND h.channel = n.channel AND h.r = n.r2 AND h.c = n.c2),
    first AS (SELECT fov, cycle, channel, r0 AS r, c0 AS c, min(struct_pack(r := r, c := c)) AS f FROM joined GROUP BY ALL),
    plateau AS (SELECT fov, cycle, channel, f.r AS first_r, f.c AS first_c, avg(r) AS r, avg(c) AS c, count(*) AS area, max(v) AS v
      FROM first JOIN hit USING (fov, cycle, channel, r, c) GROUP BY ALL)"""


def unpivoted(source: str, values: dict[str, str], limits: dict[str, tuple]) -> str:
    """The rows ``v`` of the channels' values (as SQL) with their threshold and prominence."""
    return " UNION ALL ".join(
        f"SELECT fov, cycle, {k} AS channel, r, c, CAST({values[ch]} AS DOUBLE) AS v, {t} AS thr, {h} AS prom FROM {source}"
        for k, (ch, (t, h)) in enumerate(limits.items())
    )


@pixels.query(
    f"""WITH RECURSIVE v AS MATERIALIZED ({unpivoted('fx_px', {ch: f'{ch} - {ch} % {STEP}' for ch in CH}, {ch: (OVER, PROMINENCE) for ch in CH})}), {PLATEAUS}
    SELECT fov, cycle, channel, first_r, first_c, round(r, 6) AS r, round(c, 6) AS c, area, v FROM plateau"""
)
def prominent_peaks(i: Inputs) -> DataFrame:
    coarse = i.px.select("fov", "cycle", "r", "c", *[(F.col(ch) - F.col(ch) % STEP).alias(ch) for ch in CH])
    return rounded(peaks.prominent_peaks(coarse, {ch: (float(OVER), float(PROMINENCE)) for ch in CH}, block=BLOCK))


SPOT_PEAKS = f"""
    px AS MATERIALIZED (SELECT * FROM fx_px WHERE cycle = 1), peaks AS MATERIALIZED (SELECT DISTINCT fov, r, c FROM ({PEAK_SQL}) u),
    rolony AS MATERIALIZED (SELECT * FROM peaks p WHERE NOT EXISTS (SELECT 1 FROM peaks q WHERE q.fov = p.fov
      AND ((q.c = p.c + 1 AND abs(q.r - p.r) <= 1) OR (q.c = p.c AND q.r = p.r - 1))))"""


@pixels.query(f"WITH {SPOT_PEAKS} SELECT * FROM rolony")
def separate_peaks(i: Inputs) -> DataFrame:
    return px.suppress_adjacent(first_cycle_peaks(i))


@pixels.query("SELECT fov, label, round(avg(r), 6) AS cent_x, round(avg(c), 6) AS cent_y, count(*) AS area FROM fx_mask_px GROUP BY fov, label")
def label_measures(i: Inputs) -> DataFrame:
    return rounded(px.measure_labels(i.mask_px))


@pixels.query(
    f"""WITH px AS (SELECT DISTINCT fov, r, c FROM fx_px)
    SELECT p.fov, p.r, p.c, min_by(m.label, struct_pack(d := (m.r - p.r) * (m.r - p.r) + (m.c - p.c) * (m.c - p.c), l := m.label)) AS label
    FROM px p JOIN fx_mask_px m ON m.fov = p.fov AND (m.r - p.r) * (m.r - p.r) + (m.c - p.c) * (m.c - p.c) <= 9 GROUP BY p.fov, p.r, p.c"""
)
def expanded_labels(i: Inputs) -> DataFrame:
    return px.expand_labels(i.mask_px, HEIGHT, WIDTH)


@pixels.query(
    """WITH top AS (SELECT fov, max(label) AS t FROM fx_mask_nuc GROUP BY fov),
    cyto AS (SELECT m.fov, r, c, label + coalesce(t, 0) AS label FROM fx_mask_px m LEFT JOIN top USING (fov))
    SELECT coalesce(n.fov, y.fov) AS fov, coalesce(n.r, y.r) AS r, coalesce(n.c, y.c) AS c, greatest(coalesce(n.label, 0), coalesce(y.label, 0)) AS label
    FROM fx_mask_nuc n FULL JOIN cyto y ON y.fov = n.fov AND y.r = n.r AND y.c = n.c"""
)
def fused_masks(i: Inputs) -> DataFrame:
    return px.fuse_masks(i.mask_nuc, i.mask_px)


@pixels.query(
    f"""SELECT p.fov, m.label, p.cycle, {each_channel('round(avg({ch}), 6) AS {ch}')} FROM fx_px p
    JOIN fx_mask_px m ON m.fov = p.fov AND m.r = p.r AND m.c = p.c GROUP BY p.fov, m.label, p.cycle"""
)
def label_signals(i: Inputs) -> DataFrame:
    return rounded(px.label_signal(i.mask_px, i.px, CH))


@pixels.query(
    f"""SELECT slice, cycle, CAST(floor((0.5 * c + pos_x) * 0.2) AS INT) AS gx, CAST(floor((0.5 * r + pos_y) * 0.2) AS INT) AS gy,
      {each_channel('CAST(least(max({ch}) * 3, 255) AS INT) AS {ch}')}
    FROM fx_px p JOIN (SELECT fov, CAST(fov // 16 + 1 AS INT) AS slice, (fov % 16 // 4) * 8 AS pos_x, (fov % 4) * 8 AS pos_y
      FROM (SELECT DISTINCT fov FROM fx_px) t) u USING (fov) GROUP BY 1, 2, 3, 4"""
)
def mosaic(i: Inputs) -> DataFrame:
    tforms = i.px.select("fov").distinct().select(
        "fov",
        (F.floor(F.col("fov") / 16) + 1).cast("int").alias("slice"),
        F.lit(0.5).alias("scale"),
        (F.floor(F.col("fov") % 16 / 4) * 8).alias("pos_x"),
        (F.col("fov") % 4 * 8).alias("pos_y"),
    )
    return px.place_mosaic(i.px, tforms, CH, rescale=0.2, strength=3)


@pixels.query(
    " UNION ALL ".join(
        f"""SELECT fov, cycle, max(r) + 1 AS height, max(c) + 1 AS width, '{ch}' AS channel, min({ch}) AS low, max({ch}) AS high,
        round(avg({ch}), 6) AS mean, CAST(sum({ch}) AS BIGINT) AS total FROM fx_px GROUP BY fov, cycle""" for ch in CH
    )
)
def channel_statistics(i: Inputs) -> DataFrame:
    return rounded(px.channel_stats(i.px, CH))


SIM = "CASE WHEN {a} = {b} THEN 1.0 WHEN {a} = 0 OR {b} = 0 THEN round(CAST(least({a}, {b}) + 1 AS DOUBLE) / (greatest({a}, {b}) + 1), 3) ELSE round(CAST(least({a}, {b}) AS DOUBLE) / greatest({a}, {b}), 3) END"


@pixels.query(
    "WITH s AS ("
    + " UNION ALL ".join(
        f"""SELECT fov, cycle, '{ch}' AS channel, min({ch}) AS l1, max({ch}) AS h1, trunc(avg({ch}))::BIGINT AS m1, sum({ch}) AS t1,
        min(w) AS l2, max(w) AS h2, trunc(avg(w))::BIGINT AS m2, sum(w) AS t2
        FROM (SELECT *, CASE WHEN fov % 3 = 0 THEN {ch} ELSE {ch} * 9 // 10 END AS w FROM fx_px) q GROUP BY fov, cycle""" for ch in CH
    )
    + f"""), t AS (SELECT *, {SIM.format(a='l1', b='l2')} AS sim_low, {SIM.format(a='h1', b='h2')} AS sim_high, {SIM.format(a='m1', b='m2')} AS sim_mean FROM s)
    SELECT fov, cycle, channel, CAST(sim_low AS DOUBLE) AS sim_low, CAST(sim_high AS DOUBLE) AS sim_high, CAST(sim_mean AS DOUBLE) AS sim_mean,
      t1 = t2 AS identical, least(sim_low, sim_high, sim_mean) >= 0.95 AS similar FROM t"""
)
def image_similarity(i: Inputs) -> DataFrame:
    other = i.px.withColumns({ch: F.when(F.col("fov") % 3 == 0, F.col(ch)).otherwise(F.floor(F.col(ch) * 9 / 10).cast("int")) for ch in CH})
    return px.compare_images(i.px, other, CH)


def _entropy(by: str) -> str:
    group = f", {by}" if by else ""
    return f"""(SELECT fov, cycle, -sum(n / t * ln(n / t)) AS h FROM (
      SELECT fov, cycle, CAST(sum(n) AS DOUBLE) AS n, sum(sum(n)) OVER (PARTITION BY fov, cycle) AS t FROM j GROUP BY fov, cycle{group}) q GROUP BY fov, cycle)"""


NMI = f"""
    s AS (SELECT fov, cycle, r, c, CAST(ch_g + ch_t + ch_a + ch_c AS DOUBLE) AS v FROM fx_px),
    b AS MATERIALIZED (SELECT fov, cycle, r, c, CAST(least(floor((v - min(v) OVER w) * 20 / (max(v) OVER w - min(v) OVER w)), 19) AS INT) AS bin
      FROM s WINDOW w AS (PARTITION BY fov, cycle)),
    j AS (SELECT x.fov, x.cycle, f.bin AS b1, x.bin AS b2, count(*) AS n FROM b x JOIN b f
      ON f.fov = x.fov AND f.r = x.r AND f.c = x.c AND f.cycle = 1 WHERE x.cycle > 1 GROUP BY ALL),
    nmi AS (SELECT a.fov, a.cycle, (a.h + b.h) / c.h AS nmi FROM {_entropy('b1')} a
      JOIN {_entropy('b2')} b USING (fov, cycle) JOIN {_entropy('b1, b2')} c USING (fov, cycle))"""


@pixels.query(f"WITH {NMI} SELECT fov, cycle, round(nmi, 6) AS nmi FROM nmi")
def registration_scores(i: Inputs) -> DataFrame:
    return rounded(px.registration_score(i.px, CH, bins=20))


@pixels.query(
    f"""WITH {NMI}, z AS (SELECT fov, (nmi - min(nmi) OVER w) / (max(nmi) OVER w - min(nmi) OVER w) AS z FROM nmi WINDOW w AS (PARTITION BY fov)),
    f AS (SELECT fov, max(z) / median(z) AS score FROM z GROUP BY fov)
    SELECT f.fov, round(score, 6) AS score, round(content, 6) AS content FROM f
    JOIN (SELECT fov, var_pop(v) AS content FROM s WHERE cycle = 1 GROUP BY fov) v USING (fov) WHERE abs(score) > 1.5"""
)
def registration_flags(i: Inputs) -> DataFrame:
    scores = px.registration_score(i.px, CH, bins=20)
    contents = summed(i, 1).groupBy("fov").agg(F.var_pop("v").alias("content"))
    return rounded(px.registration_flags(scores, contents, 1.5))


@pixels.query(
    "WITH s AS ("
    + " UNION ALL ".join(f"SELECT fov, cycle AS z, '{ch}' AS ch, stddev_samp({ch}) AS s FROM fx_px GROUP BY fov, cycle" for ch in CH)
    + """), q AS (SELECT fov, z, (s - avg(s) OVER w) / stddev_pop(s) OVER w AS q FROM s WINDOW w AS (PARTITION BY fov, ch)),
    p AS (SELECT fov, z, median(q) AS score FROM q GROUP BY fov, z)
    SELECT fov, z, round(score, 6) AS score, (first_value(score) OVER w > 0 OR last_value(score) OVER w > 0) AS warn
    FROM p WINDOW w AS (PARTITION BY fov ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""
)
def focus_scores(i: Inputs) -> DataFrame:
    return rounded(px.focus_score(i.px.withColumnRenamed("cycle", "z"), CH))


@pixels.query(
    """SELECT position FROM (SELECT tile_name AS position, row_number() OVER (ORDER BY tile_name) AS k FROM fx_tiles) q
    WHERE k >= 3 AND (k - 3) % 5 = 0"""
)
def sampled_positions(i: Inputs) -> DataFrame:
    return px.sample_positions(i.tiles.select(F.col("tile_name").alias("position")), 5)
