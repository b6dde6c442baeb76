"""Queries that chain the operators the way a run does."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave import workflow
from spotweave.operators import assign, expression, pixels as px
from spotweave.plans.basecalls import NOISE_FINAL, NOISE_FIRST, SWEEP
from spotweave.plans.cells import CHAIN, PAIRS, N_GENESEQ
from spotweave.plans.inputs import CHANNELS, HEIGHT, N_CYCLES, WIDTH
from spotweave.plans.pixels import BEST, BLOCK, U16, VOTE, aligned_sql, solved_sql
from spotweave.plans.registry import Inputs, Registry

runs = Registry()
CH = list(CHANNELS)
PIXEL = "fov, cycle, r, c"
ELLIPSE = "(abs(q.r - p.r) = 2 AND q.c = p.c) OR (abs(q.r - p.r) <= 1 AND abs(q.c - p.c) <= 2)"


def _near(test: str) -> str:
    return f"q.fov = p.fov AND q.cycle = p.cycle AND ({test})"


def _all(template: str) -> str:
    return ", ".join(template.format(ch=ch) for ch in CH)


PREPROCESSED = f"""
    raw AS MATERIALIZED (SELECT * FROM fx_px),
    low AS MATERIALIZED (SELECT p.fov, p.cycle, p.r, p.c, {_all('min(q.{ch}) AS {ch}')} FROM raw p JOIN raw q ON {_near(ELLIPSE)} GROUP BY p.fov, p.cycle, p.r, p.c),
    flat AS MATERIALIZED (SELECT p.fov, p.cycle, p.r, p.c, {_all('any_value(p.{ch}) - max(q.{ch}) AS {ch}')} FROM raw p JOIN low q ON {_near(ELLIPSE)}
      GROUP BY p.fov, p.cycle, p.r, p.c),
    near AS MATERIALIZED (SELECT p.fov, p.cycle, p.r, p.c, q.r - p.r AS dr, q.c - p.c AS dc, {_all('q.{ch}')} FROM flat p JOIN flat q ON {_near('abs(q.r - p.r) <= 2 AND abs(q.c - p.c) <= 2')}),
    aligned AS MATERIALIZED (SELECT {PIXEL}, {', '.join(aligned_sql(ch, s) for ch, s in zip(CH, px.CHANNEL_SHIFTS))} FROM near GROUP BY {PIXEL}),
    clean AS MATERIALIZED (SELECT {PIXEL}, {', '.join(f'{U16.format(e)} AS {ch}' for e, ch in zip(solved_sql(px.BLEED_PROFILE), CH))} FROM aligned)"""


@runs.query(f"WITH {PREPROCESSED} SELECT * FROM clean")
def preprocessed_pixels(i: Inputs) -> DataFrame:
    return workflow.preprocess(i.px, CH, background=5, block=BLOCK)


@runs.query(
    f"""WITH {PREPROCESSED},
    m AS MATERIALIZED (SELECT {PIXEL}, CAST(ch_g + ch_t + ch_a + ch_c AS DOUBLE) AS v FROM clean),
    t AS MATERIALIZED (SELECT fov, r, c, v FROM m WHERE cycle = 1),
    votes AS MATERIALIZED ({VOTE.format(t='t', m='m', reach=2)}), best AS MATERIALIZED ({BEST.format(keys='fov, cycle')})
    SELECT p.fov, p.cycle, p.r - b.dr AS r, p.c - b.dc AS c, {_all('p.{ch}')} FROM clean p JOIN best b USING (fov, cycle)
    WHERE p.r - b.dr BETWEEN 0 AND {HEIGHT - 1} AND p.c - b.dc BETWEEN 0 AND {WIDTH - 1}"""
)
def registered_pixels(i: Inputs) -> DataFrame:
    clean = workflow.preprocess(i.px, CH, background=5, block=BLOCK)
    return workflow.register_cycles(clean, CH, HEIGHT, WIDTH, 2, block=BLOCK)


@runs.query(
    f"""WITH {SWEEP},
    spot AS (SELECT fov, r, c, gene_id FROM peak WHERE score > (SELECT min(threshold) FILTER (WHERE fdr < 0.05) FROM curve))
    SELECT s.fov, m.label AS cell_num, s.gene_id, count(*) AS n FROM spot s JOIN fx_mask_px m ON m.fov = s.fov AND m.r = s.r AND m.c = s.c GROUP BY ALL"""
)
def called_gene_counts(i: Inputs) -> DataFrame:
    """Pixels to a cells x genes matrix: calibrate, decode, pick peaks, assign, count."""
    spots = workflow.call_genes(i.px, CH, i.codebook, N_CYCLES, NOISE_FIRST, NOISE_FINAL, block=BLOCK)
    cells = px.measure_labels(i.mask_px).withColumnRenamed("label", "cell_num")
    return expression.cell_gene_counts(assign.assign_by_mask(spots, i.mask_px), cells)


@runs.query(
    f"""{CHAIN},{PAIRS},
    keep AS (SELECT id, fov, cell_num, total FROM neurons n WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.id = n.id AND p.ntotal > p.total))
    SELECT k.id, k.total, count(DISTINCT CASE WHEN modality = 'hyb' THEN h.gene_id + {N_GENESEQ} ELSE h.gene_id END) AS n_genes
    FROM keep k LEFT JOIN hit h ON h.fov = k.fov AND h.cell_num = k.cell_num GROUP BY k.id, k.total"""
)
def finished_neurons(i: Inputs) -> DataFrame:
    """Neurons counted once with the number of genes they express."""
    spots = i.spots
    both = expression.combine_modalities([(spots.where("modality = 'geneseq'"), N_GENESEQ), (spots.where("modality = 'hyb'"), 3)])
    kept, expr = workflow.finish_neurons(both, i.mask, i.cells, i.tforms, i.mask_parts)
    genes = expr.groupBy("fov", "cell_num").agg(F.count(F.lit(1)).alias("n_genes"))
    return kept.join(genes.hint("merge"), ["fov", "cell_num"], "left").select("id", "total", F.coalesce("n_genes", F.lit(0)).alias("n_genes"))
