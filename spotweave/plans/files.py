"""Queries on file lists, readers, sinks, run comparison and streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.functions import names
from spotweave.operators import assign, basecall, expression, pixels as px, tiles, validate
from spotweave.operators.codebook import combine_codebooks
from spotweave.plans.basecalls import NOISE_FINAL, NOISE_FIRST
from spotweave.plans.cells import HIT, ALL_SPOTS, located
from spotweave.plans.inputs import CHANNELS, N_CYCLES, table
from spotweave.plans.registry import Inputs, Registry, rounded
from spotweave.session import fresh_path
from spotweave.sources import manifest as mf
from spotweave.sources import readers, sinks
from spotweave.streaming.incremental import read_counts, rows_of_tiles, update_counts

files = Registry()
MODES = ["geneseq", "hyb", "bcseq"]

MANIFEST = r"""
    named AS (SELECT path, split_part(path, '/', 1) AS dir, regexp_replace(split_part(path, '/', 2), '\.[^.]*$', '') AS stem FROM fx_files),
    moded AS (SELECT *, CASE WHEN dir LIKE '%geneseq%' THEN 'geneseq' WHEN dir LIKE '%hyb%' THEN 'hyb' WHEN dir LIKE '%bcseq%' THEN 'bcseq' END AS mode FROM named),
    man AS (SELECT mode, CAST(dense_rank() OVER (PARTITION BY mode ORDER BY dir) - 1 AS INT) AS cycle, regexp_extract(stem, 'MAX_Pos(\d*)_(\d*)_(\d*)', 1) AS position,
      TRY_CAST(regexp_extract(stem, 'MAX_Pos(\d*)_(\d*)_(\d*)', 2) AS INT) AS col, TRY_CAST(regexp_extract(stem, 'MAX_Pos(\d*)_(\d*)_(\d*)', 3) AS INT) AS row, path, stem
      FROM moded WHERE mode IS NOT NULL),
    manifest AS (SELECT mode, cycle, position, col, row, path FROM man WHERE regexp_matches(stem, 'MAX_Pos\d*_\d*_\d*'))"""
NAT = r"list_transform(regexp_extract_all({c}, '(\d+|\D+)'), lambda x: CASE WHEN regexp_matches(x, '^\d') THEN lpad(x, 20, '0') ELSE x END)"


def manifest(i: Inputs) -> DataFrame:
    return mf.scan_manifest(i.files)


@files.query(f"WITH {MANIFEST} SELECT * FROM manifest")
def scanned_manifest(i: Inputs) -> DataFrame:
    return manifest(i)


@files.query(
    r"""SELECT path, CASE WHEN regexp_matches(path, 'MAX_(Pos\d*)_') THEN regexp_extract(path, 'MAX_(Pos\d*)_', 1)
      WHEN regexp_matches(path, 'tmp_(\d*)') THEN regexp_extract(path, 'tmp_(\d*)', 1) END AS found FROM fx_files"""
)
def first_matches(i: Inputs) -> DataFrame:
    return i.files.select("path", names.first_match("path", [r"MAX_(Pos\d*)_", r"tmp_(\d*)"], 1).alias("found"))


@files.query(
    f"""WITH {MANIFEST}, t AS (SELECT DISTINCT position, col, row FROM manifest), r AS (SELECT DISTINCT mode, cycle FROM manifest)
    SELECT r.mode, r.cycle, t.position, t.col, t.row FROM r, t
    WHERE NOT EXISTS (SELECT 1 FROM manifest m WHERE m.mode = r.mode AND m.cycle = r.cycle AND m.position = t.position AND m.col = t.col AND m.row = t.row)"""
)
def missing_files(i: Inputs) -> DataFrame:
    return mf.missing_files(manifest(i))


ORDERED = "row_number() OVER (PARTITION BY {key} ORDER BY {order}) - 1 AS ordinal"
MODE_ORDER = "CASE mode WHEN 'geneseq' THEN 0 WHEN 'hyb' THEN 1 ELSE 2 END"


@files.query(
    f"WITH {MANIFEST} SELECT CAST(cycle AS VARCHAR) AS set_key, {ORDERED.format(key='cycle', order=f'{MODE_ORDER}, path')}, path FROM manifest"
)
def cycle_sets(i: Inputs) -> DataFrame:
    return mf.file_sets(manifest(i), "cycle", MODES)


@files.query(
    f"""WITH {MANIFEST} SELECT mode || '/' || CAST(cycle AS VARCHAR) || '/' || position AS set_key,
      {ORDERED.format(key='mode, cycle, position', order='col, row, path')}, path FROM manifest"""
)
def position_sets(i: Inputs) -> DataFrame:
    return mf.file_sets(manifest(i), "position", MODES)


@files.query(
    f"""WITH {MANIFEST} SELECT position || '/' || CAST(col AS VARCHAR) || '/' || CAST(row AS VARCHAR) AS set_key,
      {ORDERED.format(key='position, col, row', order=f'{MODE_ORDER}, cycle, path')}, path FROM manifest"""
)
def tile_sets(i: Inputs) -> DataFrame:
    return mf.file_sets(manifest(i), "tileset", MODES)


@files.query(
    f"""WITH {MANIFEST} SELECT 'all' AS set_key, row_number() OVER (ORDER BY {MODE_ORDER}, cycle, position, col, row, path) - 1 AS ordinal, path FROM manifest"""
)
def file_list(i: Inputs) -> DataFrame:
    return mf.file_sets(manifest(i), "filelist", MODES)


@files.query(
    r"""SELECT path, split_part(path, '/', 1) || '/' || split_part(split_part(path, '/', 2), '.', 1) || '.spots.csv' AS output,
      split_part(path, '/', 1) || '/' || split_part(split_part(path, '/', 2), '.', 1) || '.rgb.tif' AS relabelled FROM fx_files"""
)
def mapped_outputs(i: Inputs) -> DataFrame:
    return i.files.select(
        "path",
        names.output_path("path", label="spots", ext="csv").alias("output"),
        names.output_path("path", label="rgb").alias("relabelled"),
    )


@files.query(
    f"""WITH {MANIFEST}, k AS (SELECT position || '/' || CAST(col AS VARCHAR) || '/' || CAST(row AS VARCHAR) AS set_key,
      first(path ORDER BY {MODE_ORDER}, cycle, path) AS path FROM manifest GROUP BY position, col, row)
    SELECT set_key, 'geneseq/' || split_part(split_part(path, '/', 2), '.', 1) || '.spots.csv' AS output FROM k"""
)
def merged_outputs(i: Inputs) -> DataFrame:
    return mf.merged_outputs(mf.file_sets(manifest(i), "tileset", MODES), "geneseq", label="spots", ext="csv")


@files.query(
    r"""WITH s AS (SELECT path, split_part(path, '/', 2) AS name, regexp_replace(split_part(path, '/', 2), '\.[^.]*$', '') AS stem FROM fx_files)
    SELECT path, split_part(path, '/', 1) AS subdir, split_part(stem, '.', 1) AS base,
      CASE WHEN stem LIKE '%.%' THEN substr(stem, position('.' IN stem) + 1) END AS label, regexp_extract(name, '\.([^.]*)$', 1) AS ext,
      CASE WHEN stem LIKE '%.%' THEN regexp_replace(stem, '\.[^.]*$', '') ELSE stem END AS long_base,
      CASE WHEN stem LIKE '%.%' THEN regexp_extract(stem, '\.([^.]*)$', 1) END AS short_label FROM s"""
)
def split_paths(i: Inputs) -> DataFrame:
    base, label = names.long_label("path")
    long_base, short_label = names.last_label("path")
    return i.files.select(
        "path",
        names.directory("path").alias("subdir"),
        base.alias("base"),
        label.alias("label"),
        names.extension("path").alias("ext"),
        long_base.alias("long_base"),
        short_label.alias("short_label"),
    )


@files.query(
    f"""WITH {MANIFEST} SELECT path, regexp_replace(path, '\\.tif$', '.csv') AS output FROM manifest WHERE NOT (mode = 'geneseq' AND cycle < 3)"""
)
def pending_work(i: Inputs) -> DataFrame:
    """Outputs of the first three gene cycles exist already."""
    work = manifest(i).withColumn("output", F.regexp_replace("path", r"\.tif$", ".csv"))
    done = work.where("mode = 'geneseq' AND cycle < 3").select("output")
    return mf.pending_work(work.select("path", "output"), done)


@files.query(
    f"WITH {MANIFEST}, n AS (SELECT path, (row_number() OVER (ORDER BY path) - 1) // 36 AS chunk FROM manifest) SELECT path, chunk FROM n WHERE chunk < 9999"
)
def chunked_work(i: Inputs) -> DataFrame:
    return mf.chunk_work(manifest(i).select("path"), ["path"], 36, 9999)


@files.query(f"SELECT tile_name, row_number() OVER (ORDER BY {NAT.format(c='tile_name')}) - 1 AS fov_index FROM fx_tiles")
def tile_numbers(i: Inputs) -> DataFrame:
    return mf.fov_index(i.tiles.select("tile_name"))


@files.query(
    f"""WITH {MANIFEST}, t AS (SELECT DISTINCT 'MAX_Pos' || position || '_' || CAST(col AS VARCHAR) || '_' || CAST(row AS VARCHAR) AS tile_name, CAST(position AS INT) AS p FROM manifest)
    SELECT tile_name, dense_rank() OVER (ORDER BY p) - 1 AS position_index FROM t"""
)
def position_numbers(i: Inputs) -> DataFrame:
    tile_name = F.concat_ws("_", F.concat(F.lit("MAX_Pos"), F.col("position")), F.col("col"), F.col("row"))
    return mf.position_index(manifest(i).select(tile_name.alias("tile_name")).distinct())


@files.query("SELECT fov, tile_name, CAST(dense_rank() OVER (ORDER BY CAST(substr(position, 4) AS INT)) + 2 AS BIGINT) AS slice FROM fx_tiles")
def slice_numbers(i: Inputs) -> DataFrame:
    numbered = mf.position_index(i.tiles)
    return numbered.select("fov", "tile_name", expression.slice_number(F.col("position_index"), 3).alias("slice"))


@files.query(
    f"""WITH {MANIFEST} SELECT path, col - 1 AS col, row, split_part(path, '/', 1) || '/MAX_Pos2_00' || CAST(col - 1 AS VARCHAR) || '_00' || CAST(row AS VARCHAR) || '.tif' AS target
    FROM manifest WHERE position = '2' AND col BETWEEN 1 AND 2 AND row BETWEEN 0 AND 2"""
)
def slim_dataset(i: Inputs) -> DataFrame:
    return mf.slim(manifest(i), "2", (1, 2), (0, 2), shift=True).select("path", "col", "row", "target")


@files.query(
    f"""WITH {MANIFEST} SELECT path, 'Pos' || position || '/' || mode || '0' || CAST(cycle + 1 AS VARCHAR) || '/' || split_part(path, '/', 2) AS target FROM manifest"""
)
def arranged_by_position(i: Inputs) -> DataFrame:
    arranged = mf.arrange_by_position(manifest(i))
    path = fresh_path(i.spark, "arranged")
    sinks.write_by_position(arranged, path)
    return i.spark.read.parquet(path).select("path", "target")


@files.query("SELECT tile_name, modality, count(*) AS n FROM fx_spots JOIN fx_tiles USING (fov) GROUP BY ALL")
def spot_inventory(i: Inputs) -> DataFrame:
    return mf.inventory(i.spots.join(i.tiles, "fov"), ["tile_name", "modality"])


# ---- readers and sinks ------------------------------------------------------------


@files.query("SELECT gene_id, gene, sequence FROM fx_codebook")
def codebook_file(i: Inputs) -> DataFrame:
    path = fresh_path(i.spark, "codebook")
    sinks.write_tsv(i.codebook, path)
    return readers.read_codebook(i.spark, path)


@files.query("SELECT tile_name, lroi_x, lroi_y, gene_id FROM fx_spots JOIN fx_tiles USING (fov) WHERE modality = 'geneseq'")
def spot_csv_files(i: Inputs) -> DataFrame:
    path = fresh_path(i.spark, "spot-csv")
    spots = i.spots.where("modality = 'geneseq'").join(i.tiles, "fov")
    table = spots.select("tile_name", F.col("lroi_x").alias("m1"), F.col("lroi_y").alias("m2"), F.col("gene_id").alias("j"))
    sinks.write_spot_csvs(table, path)
    return readers.read_spot_csvs(i.spark, path)


@files.query("SELECT spot_id, modality, fov, gene_id FROM fx_spots")
def spot_tables(i: Inputs) -> DataFrame:
    paths = []
    for modality in ("geneseq", "hyb"):
        paths.append(fresh_path(i.spark, f"spots-{modality}"))
        i.spots.where(F.col("modality") == modality).select("spot_id", "modality", "fov", "gene_id").write.parquet(paths[-1])
    return readers.read_spot_tables(i.spark, paths)


@files.query("SELECT vec_id, unnest(embedding) AS embedding, unnest(list_transform(embedding, lambda x: x * 2::FLOAT)) AS doubled FROM embeddings")
def flattened_tiles(i: Inputs) -> DataFrame:
    """Parallel lists under one key, as a run stores the entries of a tile, back to rows."""
    listed = table(i.spark, i.sf_dir, "embeddings").select(
        "vec_id", "embedding", F.transform("embedding", lambda x: (x * 2).cast("float")).alias("doubled")
    )
    return readers.flatten_tiles(listed, "vec_id", ["embedding", "doubled"])


@files.query("SELECT fov, scale, pos_x, pos_y FROM fx_tforms")
def typed_tsv(i: Inputs) -> DataFrame:
    path = fresh_path(i.spark, "tsv")
    sinks.write_tsv(i.tforms.select("fov", "scale", "pos_x", "pos_y"), path)
    return readers.read_tsv(i.spark, path, "fov INT, scale DOUBLE, pos_x DOUBLE, pos_y DOUBLE")


@files.query(
    "SELECT CAST(fov AS INT) AS row, 0 AS col, scale AS w FROM fx_tforms UNION ALL SELECT fov, 1, pos_x FROM fx_tforms UNION ALL SELECT fov, 2, pos_y FROM fx_tforms"
)
def matrix_file(i: Inputs) -> DataFrame:
    path = fresh_path(i.spark, "matrix")
    sinks.write_tsv(i.tforms.select("fov", F.col("scale").alias("0"), F.col("pos_x").alias("1"), F.col("pos_y").alias("2")), path)
    return readers.read_matrix(i.spark, path, 3)


@files.query("SELECT fov, cell_num FROM fx_cells UNION ALL SELECT fov, label FROM fx_mask_px")
def concatenated(i: Inputs) -> DataFrame:
    return readers.concat([i.cells.select("fov", "cell_num"), i.mask_px.select("fov", F.col("label").alias("cell_num"))])


@files.query("SELECT CAST(row_number() OVER (ORDER BY fov, cell_num) - 1 AS BIGINT) AS index, fov, cell_num FROM fx_cells")
def indexed_tsv(i: Inputs) -> DataFrame:
    path = fresh_path(i.spark, "indexed")
    sinks.write_tsv(i.cells.select("fov", "cell_num"), path, order=["fov", "cell_num"])
    return readers.read_tsv(i.spark, path, "index BIGINT, fov INT, cell_num BIGINT")


GENES = [f"gene{g}" if g < 106 else f"unused-{g - 105}" for g in range(111)] + ["hyb0", "hyb1", "hyb2"]


@files.query(
    f"""WITH {HIT},{ALL_SPOTS}
    SELECT c.cell_num + CAST(c.fov AS BIGINT) * 10000 AS cell_id, {', '.join(f'count(*) FILTER (WHERE s.gene_id = {g}) AS "{n}"' for g, n in enumerate(GENES))}
    FROM fx_cells c LEFT JOIN spots s ON s.fov = c.fov AND s.cell_num = c.cell_num GROUP BY c.fov, c.cell_num"""
)
def matrix_sink(i: Inputs) -> DataFrame:
    path = fresh_path(i.spark, "cells-by-genes")
    sinks.write_matrix(expression.cell_gene_counts(located(i), i.cells), i.cells, combine_codebooks([i.codebook, i.hyb_codebook]), path)
    return readers.read_tsv(i.spark, path, "cell_id BIGINT, " + ", ".join(f"`{n}` BIGINT" for n in GENES))


@files.query(
    f"""WITH {HIT},{ALL_SPOTS},
    x AS (SELECT s.cell_num + CAST(s.fov AS BIGINT) * 10000 AS cell_id, s.gene_id, count(*) AS n FROM spots s WHERE cell_num > 0 GROUP BY ALL),
    book AS (SELECT gene_id, gene FROM fx_codebook UNION ALL SELECT gene_id + 111, gene FROM fx_hyb_codebook)
    SELECT cell_id, 0.5 * c.cent_y + t.pos_x AS pos_x, 0.5 * c.cent_x + t.pos_y AS pos_y, t.slice, gene AS gene_symbol, n
    FROM x JOIN fx_cells c ON c.cell_num + CAST(c.fov AS BIGINT) * 10000 = x.cell_id JOIN fx_tforms t ON t.fov = c.fov JOIN book USING (gene_id)"""
)
def annotated_matrix(i: Inputs) -> DataFrame:
    path = fresh_path(i.spark, "annotated")
    expr = expression.cell_gene_counts(located(i), i.cells)
    sinks.write_annotated(expr, expression.neurons(i.cells, i.tforms), combine_codebooks([i.codebook, i.hyb_codebook]), path)
    x, obs, var = (i.spark.read.parquet(f"{path}/{part}") for part in ("X", "obs", "var"))
    joined = x.join(obs, "cell_id").join(var, "gene_id")
    return joined.select("cell_id", "pos_x", "pos_y", "slice", "gene_symbol", "n")


@files.query(
    """WITH med AS (SELECT cycle, median(g) AS g, median(t) AS t, median(a) AS a, median(c) AS c FROM
      (SELECT fov, cycle, max(ch_g) AS g, max(ch_t) AS t, max(ch_a) AS a, max(ch_c) AS c FROM fx_px GROUP BY fov, cycle) q GROUP BY cycle)
    SELECT plane::INT AS plane, v FROM (SELECT (cycle - 1) * 4 AS plane, g AS v FROM med UNION ALL SELECT (cycle - 1) * 4 + 1, t FROM med
      UNION ALL SELECT (cycle - 1) * 4 + 2, a FROM med UNION ALL SELECT (cycle - 1) * 4 + 3, c FROM med) q"""
)
def parameter_document(i: Inputs) -> DataFrame:
    """Parameters written as a JSON document and read back, one row per plane median."""
    path = fresh_path(i.spark, "params")
    params = basecall.calibrate(i.px, list(CHANNELS), i.codebook, N_CYCLES, NOISE_FIRST, NOISE_FINAL, block=16)
    sinks.write_params(params, path)
    return readers.read_params(i.spark, path).select(F.posexplode("median_max").alias("plane", "v"))


@files.query(
    "SELECT tile_name || '.tif' AS tile, CAST(pos_x AS INT) AS pos_x, CAST(pos_y AS INT) AS pos_y, CAST(fov % 16 // 4 AS INT) AS grid_x, CAST(fov % 4 AS INT) AS grid_y FROM fx_tforms JOIN fx_tiles USING (fov)"
)
def stitched_text(i: Inputs) -> DataFrame:
    path = fresh_path(i.spark, "stitched")
    t = i.tforms.join(i.tiles, "fov")
    line = F.format_string(
        "file: %s; position: (%d, %d); grid: (%d, %d);",
        F.concat("tile_name", F.lit(".tif")),
        F.col("pos_x").cast("int"),
        F.col("pos_y").cast("int"),
        F.floor(F.col("fov") % 16 / 4),
        F.col("fov") % 4,
    )
    t.select(line.alias("value")).write.text(path)
    return readers.read_stitched_text(i.spark, path)


@files.query("SELECT position, CAST(fov % 16 AS INT) AS tile_no, pos_x, pos_y FROM fx_tforms JOIN fx_tiles USING (fov)")
def stitched_positions(i: Inputs) -> DataFrame:
    path = fresh_path(i.spark, "positions")
    t = i.tforms.join(i.tiles, "fov").select("position", (F.col("fov") % 16).alias("tile_no"), F.col("pos_y").alias("0"), F.col("pos_x").alias("1"))
    t.write.partitionBy("position").csv(path, sep="\t", header=True)
    return readers.read_positions(i.spark, path)


# ---- two runs -----------------------------------------------------------------------

RUN_B = """
    b AS (SELECT fov, CAST(CASE WHEN spot_id % 5 = 0 THEN (gene_id + 1) % 111 ELSE gene_id END AS INT) AS gene_id, lroi_x, floor(lroi_y) AS lroi_y, modality FROM fx_spots)"""
SIM = "CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN {a} = 0 OR {b} = 0 THEN round((least({a}, {b}) + 1)::DOUBLE / (greatest({a}, {b}) + 1), 3) ELSE round(least({a}, {b})::DOUBLE / greatest({a}, {b}), 3) END"
COMPARED = f"""{RUN_B},
    s AS ({' UNION ALL '.join(
        f"SELECT coalesce(x.fov, y.fov) AS fov, '{c}' AS col, coalesce(x.n, 0) AS n_a, coalesce(y.n, 0) AS n_b, coalesce(x.t, 0) AS total_a, coalesce(y.t, 0) AS total_b "
        f"FROM (SELECT fov, count({c}) AS n, sum({c})::DOUBLE AS t FROM fx_spots GROUP BY fov) x FULL JOIN (SELECT fov, count({c}) AS n, sum({c})::DOUBLE AS t FROM b GROUP BY fov) y ON x.fov = y.fov"
        for c in ('gene_id', 'lroi_x', 'lroi_y'))}),
    cmp AS (SELECT *, {SIM.format(a='n_a', b='n_b')} AS sim_n, {SIM.format(a='trunc(total_a)::BIGINT', b='trunc(total_b)::BIGINT')} AS sim_total FROM s)"""


def second_run(i: Inputs) -> DataFrame:
    moved = F.when(F.col("spot_id") % 5 == 0, (F.col("gene_id") + 1) % 111).otherwise(F.col("gene_id"))
    return i.spots.withColumn("gene_id", moved).withColumn("lroi_y", F.floor("lroi_y").cast("double"))


def compared(i: Inputs) -> DataFrame:
    return validate.compare_runs(i.spots, second_run(i), "fov", ["gene_id", "lroi_x", "lroi_y"])


@files.query(f'WITH {COMPARED} SELECT fov, col AS "column", n_a, n_b, total_a, total_b, sim_n, sim_total FROM cmp')
def compared_runs(i: Inputs) -> DataFrame:
    return compared(i)


@files.query(
    """SELECT DISTINCT a, b, CASE WHEN a = b THEN 1.0 WHEN a = 0 OR b = 0 THEN round((least(a, b) + 1)::DOUBLE / (greatest(a, b) + 1), 3)
      ELSE round(least(a, b)::DOUBLE / greatest(a, b), 3) END::DOUBLE AS similarity
    FROM (SELECT ch_g::BIGINT AS a, ch_t::BIGINT AS b FROM fx_px) q"""
)
def proportion_similarity(i: Inputs) -> DataFrame:
    pairs = i.px.select(F.col("ch_g").cast("long").alias("a"), F.col("ch_t").cast("long").alias("b")).distinct()
    return pairs.withColumn("similarity", validate.similarity("a", "b"))


@files.query(
    f"""WITH {COMPARED} SELECT col AS "column", similarity, fov FROM (
      SELECT col, least(sim_n, sim_total) AS similarity, fov, row_number() OVER (PARTITION BY col ORDER BY least(sim_n, sim_total), fov) AS k FROM cmp) q WHERE k = 1"""
)
def worst_tiles(i: Inputs) -> DataFrame:
    return validate.worst_tile(compared(i), "fov")


def two_matrices(i: Inputs) -> tuple[DataFrame, DataFrame]:
    cells = i.cells
    return tuple(
        expression.cell_gene_counts(assign.assign_by_mask(spots, i.mask, parts=i.mask_parts), cells, i.count_parts) for spots in (i.spots, second_run(i))
    )


TOTALS = f"""{HIT}, {RUN_B},
    hb AS (SELECT b.*, m.label FROM b JOIN fx_mask m ON m.fov = b.fov AND m.r = round_even(b.lroi_x, 0) AND m.c = round_even(b.lroi_y, 0)),
    ta AS (SELECT gene_id, count(*) AS total FROM hit WHERE cell_num > 0 GROUP BY gene_id),
    tb AS (SELECT gene_id, count(*) AS total FROM hb GROUP BY gene_id)"""


@files.query(
    f"""WITH {TOTALS}, j AS (SELECT coalesce(ta.total, 0) AS a, coalesce(tb.total, 0) AS b FROM ta FULL JOIN tb ON ta.gene_id = tb.gene_id),
    r AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM j)
    SELECT round(corr(ra::DOUBLE, rb::DOUBLE), 6) AS spearman FROM r"""
)
def rank_correlation(i: Inputs) -> DataFrame:
    return rounded(validate.spearman(*two_matrices(i)))


@files.query(f"WITH {TOTALS} SELECT gene_id, total FROM tb ORDER BY total DESC, gene_id LIMIT 20")
def top_genes(i: Inputs) -> DataFrame:
    return validate.top_genes(two_matrices(i)[1])


@files.query("SELECT (SELECT count(*) FROM fx_cells) AS n_a, (SELECT count(DISTINCT (fov, label)) FROM fx_mask) AS n_b, (SELECT count(*) FROM fx_cells) = (SELECT count(DISTINCT (fov, label)) FROM fx_mask) AS identical")
def same_cell_count(i: Inputs) -> DataFrame:
    return validate.same_cell_count(i.cells, i.mask.select("fov", "label").distinct())


@files.query("SELECT fov, (-0.25 * (fov % 3))::DOUBLE AS dx, (0.5 * (fov % 2))::DOUBLE AS dy, (-0.25 * (fov % 3) + 0.5 * (fov % 2))::DOUBLE AS d_sum FROM fx_tforms")
def compared_transforms(i: Inputs) -> DataFrame:
    moved = i.tforms.withColumn("pos_x", F.col("pos_x") + (F.col("fov") % 3) * 0.25).withColumn(
        "pos_y", F.col("pos_y") - (F.col("fov") % 2) * 0.5
    )
    return validate.compare_transforms(i.tforms, moved)


# ---- streams and tile functions -------------------------------------------------------


@files.query(f"WITH {HIT},{ALL_SPOTS} SELECT fov, cell_num, gene_id, count(*) AS n FROM spots WHERE cell_num > 0 GROUP BY ALL")
def incremental_counts(i: Inputs) -> DataFrame:
    """Spot files streamed in small batches give the counts of one whole read."""
    source = fresh_path(i.spark, "arriving")
    spots = i.spots
    both = expression.combine_modalities([(spots.where("modality = 'geneseq'"), 111), (spots.where("modality = 'hyb'"), 3)])
    both.repartitionByRange(4, "fov").write.parquet(source)  # a file holds whole tiles, as they arrive
    cells, counts = i.cells, fresh_path(i.spark, "counts")

    def counted(batch: DataFrame) -> DataFrame:
        near = rows_of_tiles(cells, batch)
        mask, parts = i.mask_for(near.count())
        return expression.cell_gene_counts(assign.assign_by_mask(batch, rows_of_tiles(mask, batch), parts=parts), near)

    update_counts(
        i.spark,
        source,
        both.schema,
        counted,
        counts,
        fresh_path(i.spark, "stream"),
        files_per_batch=1,
        merge_every=3,
    )
    return read_counts(i.spark, counts, ["fov", "cell_num", "gene_id"])


@files.query("SELECT fov, cycle, sum(ch_g)::DOUBLE AS total, max(ch_g)::DOUBLE AS top FROM fx_px GROUP BY fov, cycle")
def tile_function(i: Inputs) -> DataFrame:
    def summary(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf["ch_g"].to_numpy(dtype=float)
        return pd.DataFrame({"fov": pdf["fov"].iloc[:1], "cycle": pdf["cycle"].iloc[:1], "total": [v.sum()], "top": [v.max()]})

    return tiles.map_tiles(i.px, summary, "fov int, cycle int, total double, top double", ("fov", "cycle"))


@files.query(
    """WITH px AS MATERIALIZED (SELECT * FROM fx_px)
    SELECT p.fov, p.cycle, p.r, p.c, max(q.ch_g) AS top FROM px p JOIN px q ON q.fov = p.fov AND q.cycle = p.cycle AND abs(q.r - p.r) <= 1 AND abs(q.c - p.c) <= 1
    GROUP BY p.fov, p.cycle, p.r, p.c"""
)
def block_function(i: Inputs) -> DataFrame:
    """A user's 3 x 3 maximum filter run on blocks with a halo."""

    def filtered(pdf: pd.DataFrame) -> pd.DataFrame:
        r, c = pdf["r"].to_numpy(), pdf["c"].to_numpy()
        r0, c0 = r.min() - 1, c.min() - 1
        image = np.full((r.max() - r0 + 2, c.max() - c0 + 2), -1)
        image[r - r0, c - c0] = pdf["ch_g"].to_numpy()
        windows = np.lib.stride_tricks.sliding_window_view(image, (3, 3)).max(axis=(2, 3))
        home = pdf[pdf["home"]]
        top = windows[home["r"].to_numpy() - r0 - 1, home["c"].to_numpy() - c0 - 1]
        return home[["fov", "cycle", "r", "c"]].assign(top=top.astype("int32"))

    return tiles.map_blocks(
        i.px.select(*px.KEYS, "ch_g"), filtered, "fov int, cycle int, r int, c int, top int", block=16, halo=1
    )
