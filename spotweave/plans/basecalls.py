"""Queries for codebooks, base calls, decoding and false-discovery control."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave import workflow
from spotweave.operators import basecall, codebook as books, pixels as px
from spotweave.plans.inputs import BASES, CHANNELS, HEIGHT, N_CYCLES, N_GENES, N_UNUSED, WIDTH
from spotweave.plans.pixels import BLOCK, MEDIANS, PLATEAUS, SPOT_PEAKS, first_cycle_peaks, unpivoted
from spotweave.plans.registry import Inputs, Registry, rounded
from spotweave.session import fresh_path, settle
from spotweave.sources import readers, sinks

basecalls = Registry()
CH = list(CHANNELS)
SIG = ["s1", "s2", "s3", "s4"]
NOISE_FIRST, NOISE_FINAL = 0.001, 0.005




# ---- codebooks ----------------------------------------------------------------

BITS = [f"(substr(sequence, {p}, 1) = '{b}')::INT" for p in range(1, N_CYCLES + 1) for b in BASES]


@basecalls.query("SELECT gene_id, gene, " + " || ".join(f"CAST({b} AS VARCHAR)" for b in BITS) + " AS code FROM fx_codebook")
def binary_codes(i: Inputs) -> DataFrame:
    coded = books.binary_codes(i.codebook, N_CYCLES)
    return coded.withColumn("code", F.array_join(F.col("code").cast("array<string>"), ""))


@basecalls.query("SELECT gene_id, gene, gene LIKE 'unused%' AS control FROM fx_codebook")
def control_codes(i: Inputs) -> DataFrame:
    return i.codebook.select("gene_id", "gene", books.is_control().alias("control"))


@basecalls.query(
    f"""WITH RECURSIVE w AS (SELECT '' AS s, 0 AS n UNION ALL SELECT s || b, n + 1 FROM w, (VALUES ('A'), ('C'), ('G'), ('T')) t(b) WHERE n < {N_CYCLES}),
    free AS (SELECT s FROM w WHERE n = {N_CYCLES} AND s NOT IN (SELECT sequence FROM fx_codebook)),
    pick AS (SELECT s, row_number() OVER (ORDER BY md5(s), s) AS k FROM free)
    SELECT gene_id, gene, sequence FROM fx_codebook UNION ALL
    SELECT CAST((SELECT max(gene_id) FROM fx_codebook) + k AS INT), 'unused-' || CAST(k AS VARCHAR), s FROM pick WHERE k <= 5"""
)
def added_controls(i: Inputs) -> DataFrame:
    return books.add_controls(i.codebook, 5, N_CYCLES)


@basecalls.query(
    f"""SELECT gene_id, gene, sequence FROM fx_codebook UNION ALL
    SELECT CAST(gene_id + (SELECT count(*) FROM fx_codebook) AS INT), gene, sequence FROM fx_hyb_codebook"""
)
def combined_codebook(i: Inputs) -> DataFrame:
    return books.combine_codebooks([i.codebook, i.hyb_codebook])


@basecalls.query(
    f"""SELECT gene_id, gene, sequence FROM fx_codebook UNION ALL
    SELECT CAST(gene_id + (SELECT count(*) FROM fx_codebook) AS INT), gene, sequence FROM fx_opt_codebook UNION ALL
    SELECT CAST(gene_id + (SELECT count(*) FROM fx_codebook) + (SELECT count(*) FROM fx_opt_codebook) AS INT), gene, sequence FROM fx_hyb_codebook"""
)
def combined_three_codebooks(i: Inputs) -> DataFrame:
    return books.combine_codebooks([i.codebook, i.opt_codebook, i.hyb_codebook])


@basecalls.query("SELECT spot_id, s.gene_id, gene FROM fx_spots s JOIN fx_codebook USING (gene_id) WHERE modality = 'geneseq'")
def named_spots(i: Inputs) -> DataFrame:
    return books.name_genes(i.spots.where("modality = 'geneseq'"), i.codebook).select("spot_id", "gene_id", "gene")


@basecalls.query(
    """SELECT s.spot_id, s.channel, gene FROM (SELECT spot_id, CASE gene_id WHEN 2 THEN 4 ELSE gene_id + 1 END AS channel FROM fx_spots WHERE modality = 'hyb') s
    JOIN fx_hyb_codebook b ON CAST(b.sequence AS INT) = s.channel"""
)
def hyb_gene_by_channel(i: Inputs) -> DataFrame:
    seen = i.spots.where("modality = 'hyb'").select(
        "spot_id", F.when(F.col("gene_id") == 2, 4).otherwise(F.col("gene_id") + 1).alias("channel")
    )
    return seen.join(books.gene_of_channel(i.hyb_codebook), "channel").select("spot_id", "channel", "gene")


# ---- barcode spots --------------------------------------------------------------

ROLONY = f"""{SPOT_PEAKS}, every AS MATERIALIZED (SELECT * FROM fx_px),
    sig AS MATERIALIZED (SELECT r.fov, r.r, r.c, p.cycle, p.ch_g, p.ch_t, p.ch_a, p.ch_c FROM rolony r JOIN every p ON p.fov = r.fov AND p.r = r.r AND p.c = r.c)"""


def base_sql(cols, none="0.5") -> str:
    g = f"greatest({', '.join(cols)})"
    base = "CASE " + " ".join(f"WHEN {c} = {g} THEN {k + 1}" for k, c in enumerate(cols)) + " END"
    norm = "sqrt(CAST(" + " + ".join(f"{c} * {c}" for c in cols) + " AS DOUBLE))"
    return f"{base} AS base, CASE WHEN {norm} = 0 THEN {none} ELSE {g} / {norm} END AS score, CAST({g} AS DOUBLE) AS intensity"


@basecalls.query(f"WITH {ROLONY} SELECT * FROM sig")
def spot_signal(i: Inputs) -> DataFrame:
    return basecall.read_signal(px.suppress_adjacent(first_cycle_peaks(i)), i.px, CH)


@basecalls.query(
    f"""WITH q AS (SELECT spot_id, cycle, {base_sql(SIG)} FROM fx_bc_signal)
    SELECT spot_id, cycle, base, substr('GTAC', base, 1) AS letter, round(score, 6) AS score, intensity FROM q"""
)
def base_calls(i: Inputs) -> DataFrame:
    called = basecall.call_cycles(i.bc_signal, SIG)
    return rounded(called.select("spot_id", "cycle", "base", basecall.base_letter("base").alias("letter"), "score", "intensity"))


@basecalls.query(
    f"""WITH {ROLONY}, q AS (SELECT fov, r, c, cycle, {base_sql(CH)} FROM sig)
    SELECT fov, r, c, string_agg(CAST(base AS VARCHAR), '' ORDER BY cycle) AS seq, round(min(score), 6) AS worst, round(max(intensity), 6) AS best
    FROM q GROUP BY fov, r, c"""
)
def rolony_barcodes(i: Inputs) -> DataFrame:
    signal = basecall.read_signal(px.suppress_adjacent(first_cycle_peaks(i)), i.px, CH)
    spelled = basecall.spell(basecall.call_cycles(signal, CH), ["fov", "r", "c"])
    return rounded(
        spelled.select("fov", "r", "c", "seq", F.array_min("score").alias("worst"), F.array_max("intensity").alias("best"))
    )


@basecalls.query(
    f"""WITH {ROLONY},
    q AS (SELECT *, greatest(ch_g, ch_t, 0, ch_c) AS top FROM sig)
    SELECT fov, r, c, cycle, CASE WHEN ch_g = top THEN 0 WHEN ch_t = top THEN 1 WHEN top = 0 THEN NULL ELSE 2 END AS gene_id, CAST(top AS DOUBLE) AS signal FROM q"""
)
def hyb_calls(i: Inputs) -> DataFrame:
    signal = basecall.read_signal(px.suppress_adjacent(first_cycle_peaks(i)), i.px, CH)
    return basecall.call_hyb(signal, CH).select("fov", "r", "c", "cycle", "gene_id", "signal")


HYB_LIMITS = {"ch_g": (50, 15), "ch_t": (55, 20), "ch_a": (50, 15), "ch_c": (60, 15)}
HYB_SHOWN = {ch: limits for ch, limits in HYB_LIMITS.items() if ch != "ch_a"}
HYB_SPOTS = f"""v AS MATERIALIZED ({unpivoted('fx_hyb_px', {ch: ch for ch in CH}, HYB_SHOWN)}), {PLATEAUS},
    hyb AS MATERIALIZED (SELECT p.fov, p.channel, p.first_r, p.first_c, p.r AS lroi_x, p.c AS lroi_y, p.v AS signal,
        CASE WHEN h.ch_g = greatest(h.ch_g, h.ch_t, h.ch_c) THEN 0 WHEN h.ch_t = greatest(h.ch_t, h.ch_c) THEN 1 ELSE 2 END AS gene_id
      FROM plateau p JOIN fx_hyb_px h ON h.fov = p.fov AND h.cycle = p.cycle AND h.r = p.first_r AND h.c = p.first_c)"""


def hyb_chain(i: Inputs) -> tuple[DataFrame, DataFrame]:
    limits = {ch: tuple(map(float, pair)) for ch, pair in HYB_LIMITS.items()}
    return workflow.call_hyb_spots(i.hyb_px, limits, block=BLOCK)


@basecalls.query(f"WITH RECURSIVE {HYB_SPOTS} SELECT fov, round(lroi_x, 6) AS lroi_x, round(lroi_y, 6) AS lroi_y, gene_id, signal FROM hyb")
def hyb_image_spots(i: Inputs) -> DataFrame:
    """Peaks of the hybridisation images with their genes."""
    return rounded(hyb_chain(i)[0])


@basecalls.query(
    f"""WITH RECURSIVE {HYB_SPOTS}
    SELECT fov, CAST(round_even(lroi_x, 0) AS INT) AS r, CAST(round_even(lroi_y, 0) AS INT) AS c,
      max_by(gene_id, struct_pack(k := channel, r := first_r, c := first_c)) + 1 AS value FROM hyb GROUP BY ALL"""
)
def hyb_gene_map(i: Inputs) -> DataFrame:
    return hyb_chain(i)[1]


@basecalls.query(
    """SELECT fov, CAST(round_even(lroi_x, 0) AS INT) AS r, CAST(round_even(lroi_y, 0) AS INT) AS c, max_by(gene_id, spot_id) + 1 AS value
    FROM fx_spots WHERE modality = 'hyb' GROUP BY 1, 2, 3"""
)
def gene_raster(i: Inputs) -> DataFrame:
    return basecall.gene_raster(i.spots.where("modality = 'hyb'"), "spot_id")


# ---- somata ---------------------------------------------------------------------


def means_sql(value: str = "{ch}") -> str:
    return ", ".join(f"avg({value.format(ch=ch)}) AS {ch}" for ch in CH)


@basecalls.query(
    f"""WITH m AS (SELECT p.fov, label, cycle, {means_sql()} FROM fx_px p JOIN fx_mask_px k ON k.fov = p.fov AND k.r = p.r AND k.c = p.c GROUP BY ALL)
    SELECT fov, label, cycle, base, round(score, 6) AS score FROM (SELECT fov, label, cycle, {base_sql(CH)} FROM m) q"""
)
def soma_calls(i: Inputs) -> DataFrame:
    called = basecall.call_somata(px.label_signal(i.mask_px, i.px, CH), CH)
    return rounded(called.select("fov", "label", "cycle", "base", "score"))


GOOD = f"""
    q AS (SELECT fov, r, c, cycle, score FROM (SELECT fov, r, c, cycle, {base_sql(CH, '0')} FROM fx_px) z),
    good AS (SELECT fov, r, c FROM (SELECT fov, r, c, list_sort(list(score)) AS s FROM q GROUP BY fov, r, c) z WHERE s[least(3, len(s))] > 0.76)"""


@basecalls.query(f"WITH {GOOD} SELECT * FROM good")
def good_pixels(i: Inputs) -> DataFrame:
    return basecall.good_pixels(i.px, CH, 0.76)


@basecalls.query(
    f"""WITH {GOOD},
    m AS (SELECT p.fov, label, cycle, count(g.fov) AS n_good, {', '.join(f'coalesce(avg({ch}) FILTER (WHERE g.fov IS NOT NULL), 0) AS {ch}' for ch in CH)}
      FROM fx_px p JOIN fx_mask_px k ON k.fov = p.fov AND k.r = p.r AND k.c = p.c
      LEFT JOIN good g ON g.fov = p.fov AND g.r = p.r AND g.c = p.c GROUP BY p.fov, label, cycle),
    b AS (SELECT fov, label, cycle, n_good, {', '.join(CH)}, {base_sql(CH, '0')} FROM m)
    SELECT fov, label, cycle, n_good, CASE WHEN n_good > 2 THEN base ELSE 5 END AS base, CASE WHEN n_good > 2 THEN round(score, 6) ELSE 0 END AS score,
      {', '.join(f'CASE WHEN n_good > 2 THEN round({ch}, 6) ELSE 0 END AS {ch}' for ch in CH)} FROM b"""
)
def soma_calls_good_pixels(i: Inputs) -> DataFrame:
    called = basecall.call_somata_good(i.mask_px, i.px, CH, threshold=0.76, min_pixels=2)
    return rounded(called.select("fov", "label", "cycle", "n_good", "base", "score", *CH))


@basecalls.query(
    f"""WITH m AS (SELECT 'Pos' || CAST(p.fov // 16 + 1 AS VARCHAR) AS position, p.fov, label, cycle, {means_sql()}
      FROM fx_px p JOIN fx_mask_px k ON k.fov = p.fov AND k.r = p.r AND k.c = p.c GROUP BY ALL),
    f AS (SELECT position, fov, label, cycle, {', '.join(f'floor({ch}) AS {ch}' for ch in CH)} FROM m),
    n AS (SELECT position, fov, label, cycle, {', '.join(f'coalesce({ch} / nullif(avg({ch}) OVER w, 0), 0) AS {ch}' for ch in CH)} FROM f WINDOW w AS (PARTITION BY position, cycle)),
    b AS (SELECT position, fov, label, cycle, {base_sql(CH)} FROM n)
    SELECT position, fov, label, string_agg(CAST(base AS VARCHAR), '' ORDER BY cycle) AS seq, bool_or(score > 0.72) AS barcoded FROM b GROUP BY position, fov, label"""
)
def soma_calls_relative(i: Inputs) -> DataFrame:
    means = px.label_signal(i.mask_px, i.px, CH).withColumn(
        "position", F.concat(F.lit("Pos"), (F.floor(F.col("fov") / 16) + 1).cast("string"))
    )
    return basecall.call_somata_relative(means, CH, 0.72)


# ---- decoding -------------------------------------------------------------------

NORM = f"""{MEDIANS},
    v AS MATERIALIZED (SELECT p.fov, p.r, p.c, p.cycle, p.ch_g / m.ch_g AS v0, p.ch_t / m.ch_t AS v1, p.ch_a / m.ch_a AS v2, p.ch_c / m.ch_c AS v3
      FROM fx_px p JOIN med m USING (cycle)),
    size AS (SELECT fov, r, c, sqrt(sum(v0 * v0 + v1 * v1 + v2 * v2 + v3 * v3)) AS size FROM v GROUP BY fov, r, c),
    code AS (SELECT gene_id, gene, t.cycle, position(substr(sequence, t.cycle, 1) IN 'GTAC') - 1 AS ch FROM fx_codebook, (SELECT unnest(range(1, 8))::INT AS cycle) t),
    dot AS (SELECT v.fov, v.r, v.c, gene_id, any_value(gene) AS gene, sum(CASE ch WHEN 0 THEN v0 WHEN 1 THEN v1 WHEN 2 THEN v2 ELSE v3 END) AS d
      FROM v JOIN code USING (cycle) GROUP BY v.fov, v.r, v.c, gene_id)"""


def evidence_sql(noise: float) -> str:
    return f"SELECT fov, r, c, gene_id, gene LIKE 'unused%' AS control, round(d / ((size + {noise}::DOUBLE) * sqrt(7)), 9) AS score FROM dot JOIN size USING (fov, r, c)"


DECODED = f"""{NORM}, ev AS MATERIALIZED ({evidence_sql(NOISE_FINAL)}),
    best AS MATERIALIZED (SELECT fov, r, c, first(gene_id ORDER BY score DESC, gene_id) AS gene_id,
      first(control ORDER BY score DESC, gene_id) AS control, max(score) AS score FROM ev GROUP BY fov, r, c)"""


def signal_vectors(i: Inputs) -> DataFrame:
    pixels = i.px
    normal = px.normalise_median(pixels, CH, px.median_max(pixels, CH))
    return px.stack_cycles(normal, CH, N_CYCLES)


def decoded(i: Inputs) -> DataFrame:
    return basecall.decode(signal_vectors(i), basecall.code_table(i.codebook, N_CYCLES), NOISE_FINAL)


@basecalls.query(f"WITH {DECODED} SELECT fov, r, c, gene_id, control, round(score, 6) AS score FROM best")
def decoded_pixels(i: Inputs) -> DataFrame:
    return rounded(decoded(i))


PEAK = """
    peak AS (SELECT b.fov, b.r, b.c, any_value(b.gene_id) AS gene_id, any_value(b.control) AS control, any_value(b.score) AS score
      FROM best b JOIN best q ON q.fov = b.fov AND abs(q.r - b.r) <= 1 AND abs(q.c - b.c) <= 1 GROUP BY b.fov, b.r, b.c
      HAVING NOT bool_or(q.score > b.score OR (q.score = b.score AND (q.r < b.r OR (q.r = b.r AND q.c < b.c)))))"""


def peaks(i: Inputs) -> DataFrame:
    return basecall.decoded_peaks(decoded(i), block=BLOCK)


@basecalls.query(f"WITH {DECODED},{PEAK} SELECT fov, r + 3 AS r, c + 3 AS c, gene_id, round(score, 6) AS score FROM peak WHERE score > 0.8")
def decoded_spots(i: Inputs) -> DataFrame:
    """Peaks above a threshold, moved back to an untrimmed frame."""
    kept = peaks(i).where(F.col("score") > 0.8)
    return rounded(px.untrim(kept, 3).select("fov", "r", "c", "gene_id", "score"))


MAXIMA = f"""{NORM}, top AS (SELECT fov, gene_id, max(score) AS evidence FROM ({evidence_sql(NOISE_FIRST)}) e WHERE control GROUP BY fov, gene_id)"""


def control_top(i: Inputs) -> DataFrame:
    return basecall.control_maxima(signal_vectors(i), basecall.code_table(i.codebook, N_CYCLES), NOISE_FIRST)


@basecalls.query(f"WITH {MAXIMA} SELECT fov, gene_id, round(evidence, 6) AS evidence FROM top")
def control_maxima(i: Inputs) -> DataFrame:
    return rounded(control_top(i))


@basecalls.query(f"WITH {MAXIMA} SELECT round(median(evidence), 6) AS threshold FROM top")
def base_threshold(i: Inputs) -> DataFrame:
    return rounded(basecall.base_threshold(control_top(i)))


SWEEP = f"""{DECODED},{PEAK},
    top AS (SELECT fov, gene_id, max(score) AS evidence FROM ({evidence_sql(NOISE_FIRST)}) e WHERE control GROUP BY fov, gene_id),
    grid AS (SELECT k::INT AS step, (SELECT median(evidence) FROM top) + (-0.1::DOUBLE + 0.2::DOUBLE * k / 9) AS threshold FROM (SELECT unnest(range(10)) AS k) g),
    sweep AS (SELECT fov, step, threshold, count(*) FILTER (WHERE score > threshold AND control) AS n_control,
      count(*) FILTER (WHERE score > threshold AND NOT control) AS n_gene FROM peak, grid GROUP BY fov, step, threshold),
    curve AS (SELECT step, max(threshold) AS threshold, avg(n_control) / {N_UNUSED} * {N_GENES - N_UNUSED} / avg(n_gene + 1) AS fdr FROM sweep GROUP BY step)"""


def sweep(i: Inputs) -> DataFrame:
    vectors = settle(signal_vectors(i), "vectors")
    table = basecall.code_table(i.codebook, N_CYCLES)
    base = basecall.base_threshold(basecall.control_maxima(vectors, table, NOISE_FIRST)).first()["threshold"]
    found = basecall.decoded_peaks(basecall.decode(vectors, table, NOISE_FINAL), block=BLOCK)
    return basecall.sweep_thresholds(found, base)


@basecalls.query(f"WITH {SWEEP} SELECT fov, step, round(threshold, 6) AS threshold, n_control, n_gene FROM sweep")
def threshold_sweep(i: Inputs) -> DataFrame:
    return rounded(sweep(i))


@basecalls.query(f"WITH {SWEEP} SELECT step, round(threshold, 6) AS threshold, round(fdr, 6) AS fdr FROM curve")
def fdr_curve(i: Inputs) -> DataFrame:
    return rounded(basecall.fdr_curve(sweep(i), N_GENES, N_UNUSED))


@basecalls.query(f"WITH {SWEEP} SELECT round(min(threshold) FILTER (WHERE fdr < 0.05), 6) AS threshold FROM curve")
def picked_threshold(i: Inputs) -> DataFrame:
    return rounded(basecall.pick_threshold(basecall.fdr_curve(sweep(i), N_GENES, N_UNUSED)))


@basecalls.query(
    f"""WITH {SWEEP} SELECT round((SELECT min(threshold) FILTER (WHERE fdr < 0.05) FROM curve), 6) AS threshold,
      {NOISE_FIRST}::DOUBLE AS noise_first, {NOISE_FINAL}::DOUBLE AS noise_final,
      (SELECT string_agg(CAST(CAST(v AS DECIMAL(10, 1)) AS VARCHAR), ',' ORDER BY cycle, k) FROM (
        {' UNION ALL '.join(f'SELECT cycle, {k} AS k, {ch} AS v FROM med' for k, ch in enumerate(CH))}) q) AS median_max"""
)
def decode_parameters(i: Inputs) -> DataFrame:
    params = basecall.calibrate(i.px, CH, i.codebook, N_CYCLES, NOISE_FIRST, NOISE_FINAL, block=BLOCK)
    return rounded(with_text(params).drop("trim", "cropf"))


def with_text(params: DataFrame) -> DataFrame:
    text = F.transform("median_max", lambda v: v.cast("decimal(10,1)").cast("string"))
    return params.withColumn("median_max", F.array_join(text, ","))


MARGIN, CROP = 2, 0.2
# The sweep on the centre of each tile; the threshold it starts from on the tiles without their edges.
_TRIMMED = """,
    tv AS MATERIALIZED (SELECT p.fov, p.r, p.c, p.cycle, p.ch_g / m.ch_g AS v0, p.ch_t / m.ch_t AS v1, p.ch_a / m.ch_a AS v2, p.ch_c / m.ch_c AS v3
      FROM trimmed p JOIN med m USING (cycle)),
    tsize AS (SELECT fov, r, c, sqrt(sum(v0 * v0 + v1 * v1 + v2 * v2 + v3 * v3)) AS size FROM tv GROUP BY fov, r, c),
    tdot AS (SELECT tv.fov, tv.r, tv.c, gene_id, any_value(gene) AS gene, sum(CASE ch WHEN 0 THEN v0 WHEN 1 THEN v1 WHEN 2 THEN v2 ELSE v3 END) AS d
      FROM tv JOIN code USING (cycle) GROUP BY tv.fov, tv.r, tv.c, gene_id)"""
_FIRST = evidence_sql(NOISE_FIRST)
_WINDOW = "SELECT * FROM fx_px WHERE r >= {0} AND r < {1} AND c >= {2} AND c < {3}"
_SIDES = [round(n * part) for n in (HEIGHT, WIDTH) for part in (CROP, 1 - CROP)]
TRIMMED_SWEEP = (
    f"cropped AS MATERIALIZED ({_WINDOW.format(*_SIDES)}), "
    f"trimmed AS MATERIALIZED ({_WINDOW.format(MARGIN, HEIGHT - MARGIN, MARGIN, WIDTH - MARGIN)}), "
    + SWEEP.replace("fx_px", "cropped")
    .replace(NORM.replace("fx_px", "cropped"), NORM.replace("fx_px", "cropped") + _TRIMMED)
    .replace(_FIRST, _FIRST.replace("dot JOIN size", "tdot JOIN tsize"))
)


@basecalls.query(
    f"""WITH {TRIMMED_SWEEP} SELECT round((SELECT min(threshold) FILTER (WHERE fdr < 0.05) FROM curve), 6) AS threshold,
      {NOISE_FIRST}::DOUBLE AS noise_first, {NOISE_FINAL}::DOUBLE AS noise_final, {MARGIN}::INT AS trim, {CROP}::DOUBLE AS cropf,
      (SELECT string_agg(CAST(CAST(v AS DECIMAL(10, 1)) AS VARCHAR), ',' ORDER BY cycle, k) FROM (
        {' UNION ALL '.join(f'SELECT cycle, {k} AS k, {ch} AS v FROM med' for k, ch in enumerate(CH))}) q) AS median_max"""
)
def trimmed_decode_parameters(i: Inputs) -> DataFrame:
    """Parameters from trimmed and cropped tiles, through their document."""
    path = fresh_path(i.spark, "params")
    params = basecall.calibrate(
        i.px, CH, i.codebook, N_CYCLES, NOISE_FIRST, NOISE_FINAL, block=BLOCK, frame=(HEIGHT, WIDTH), margin=MARGIN, crop=CROP
    )
    sinks.write_params(params, path)
    return rounded(with_text(readers.read_params(i.spark, path)))


def calls(i: Inputs) -> DataFrame:
    flags = i.codebook.select("gene_id", books.is_control().alias("control"))
    return i.spots.where("modality = 'geneseq'").join(flags, "gene_id").join(i.tiles.select("fov", "position"), "fov")


CALLS = "c AS (SELECT s.*, gene LIKE 'unused%' AS control, position FROM fx_spots s JOIN fx_codebook USING (gene_id) JOIN fx_tiles USING (fov) WHERE modality = 'geneseq')"


@basecalls.query(
    f"""WITH {CALLS} SELECT position, round(CAST(count(*) FILTER (WHERE control) AS DOUBLE) / count(*) / {N_UNUSED} * {N_GENES - N_UNUSED}, 6) AS fdr
    FROM c GROUP BY position"""
)
def call_set_fdr(i: Inputs) -> DataFrame:
    return rounded(basecall.call_set_fdr(calls(i), N_GENES, N_UNUSED, ["position"]))


@basecalls.query(
    f"""WITH {CALLS} SELECT position, count(*) AS n_spots, count(*) FILTER (WHERE control) AS n_control, count(DISTINCT gene_id) AS n_genes,
      round(CAST(count(*) FILTER (WHERE control) AS DOUBLE) / count(*), 6) AS error_rate FROM c GROUP BY position"""
)
def decode_summary(i: Inputs) -> DataFrame:
    return rounded(basecall.decode_summary(calls(i), i.tiles))


@basecalls.query(
    f"""SELECT t.fov, count(s.fov) AS n_calls, CAST(coalesce(sum(CASE WHEN modality = 'hyb' THEN gene_id + {N_GENES} ELSE gene_id END), 0) AS BIGINT) AS id_sum
    FROM fx_tiles t LEFT JOIN fx_spots s USING (fov) GROUP BY t.fov"""
)
def accumulated_calls(i: Inputs) -> DataFrame:
    spots = i.spots.select("fov", "modality", "gene_id")
    parts = [(spots.where("modality = 'geneseq'"), 0), (spots.where("modality = 'hyb'"), N_GENES)]
    return basecall.accumulate_calls(parts, i.tiles)


@basecalls.query(f"SELECT spot_id, fov, CASE WHEN modality = 'hyb' THEN gene_id + {N_GENES} ELSE gene_id END AS gene_id FROM fx_spots WHERE modality IN ('geneseq', 'hyb')")
def united_calls(i: Inputs) -> DataFrame:
    spots = i.spots.select("spot_id", "fov", "modality", "gene_id")
    parts = [(spots.where("modality = 'geneseq'"), 0), (spots.where("modality = 'hyb'"), N_GENES)]
    return basecall.union_calls(parts).drop("modality")
