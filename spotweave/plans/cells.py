"""Queries from spots and label masks to cells, and de-duplicated neurons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.operators import assign, expression, layout, overlaps, ranking
from spotweave.operators.codebook import combine_codebooks
from spotweave.plans.registry import Inputs, Registry, rounded

cells = Registry()
N_GENESEQ = 111

# Parts of the checking SQL used by several queries.
HIT = """
  hit AS (
    SELECT s.*, coalesce(m.label, 0) AS cell_num FROM fx_spots s LEFT JOIN fx_mask m
    ON m.fov = s.fov AND m.r = round_even(s.lroi_x, 0) AND m.c = round_even(s.lroi_y, 0))"""
ALL_SPOTS = """
  spots AS (
    SELECT * REPLACE (CAST(CASE WHEN modality = 'hyb' THEN gene_id + 111 ELSE gene_id END AS INT) AS gene_id) FROM hit)"""
NEURONS = """
  neurons AS (
    SELECT c.cell_num + CAST(c.fov AS BIGINT) * 10000 AS id, t.slice, c.fov, c.cell_num,
           0.5 * c.cent_y + t.pos_x AS x, 0.5 * c.cent_x + t.pos_y AS y, count(h.fov) AS total
    FROM fx_cells c JOIN fx_tforms t USING (fov)
    LEFT JOIN hit h ON h.fov = c.fov AND h.cell_num = c.cell_num
    GROUP BY ALL)"""
PAIRS = """
  pairs AS (
    SELECT a.id, a.total, b.id AS nid, b.total AS ntotal FROM neurons a JOIN neurons b
    ON a.slice = b.slice AND a.fov <> b.fov
    AND a.x - b.x < 16 AND b.x - a.x < 16 AND a.x <> b.x
    AND a.y - b.y < 16 AND b.y - a.y < 16 AND a.y <> b.y)"""
CHAIN = f"WITH {HIT},{NEURONS}"
PAIR_CHAIN = f"{CHAIN},{PAIRS}"


def located(i: Inputs) -> DataFrame:
    """All spots with their cell, hyb ids after the geneseq ones."""
    spots = i.spots
    parts = [(spots.where("modality = 'geneseq'"), N_GENESEQ), (spots.where("modality = 'hyb'"), 3)]
    return assign.assign_by_mask(expression.combine_modalities(parts), i.mask, parts=i.mask_parts)


def neuron_totals(i: Inputs) -> DataFrame:
    """Neurons with slice coordinates and total expression."""
    listed = i.cells
    expr = expression.cell_gene_counts(located(i), listed, i.count_parts)
    totals = expression.total_expression(expr, listed)
    placed = layout.to_global(totals, i.tforms, "cent_x", "cent_y", ("x", "y"))
    return placed.join(i.tforms.select("fov", "slice"), "fov").select(
        assign.global_cell_id().alias("id"), "slice", "fov", "cell_num", "x", "y", "total"
    )


def with_gene_names(i: Inputs, spots: DataFrame) -> DataFrame:
    names = combine_codebooks([i.codebook, i.hyb_codebook]).select("gene_id", "gene")
    return spots.join(names, "gene_id")


@cells.query(
    f"""{PAIR_CHAIN}
    SELECT id, slice, fov, x, y, total FROM neurons n
    WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.id = n.id AND p.ntotal > p.total)"""
)
def filtered_neurons(i: Inputs) -> DataFrame:
    return overlaps.drop_duplicates(neuron_totals(i), overlaps.half_box()).select("id", "slice", "fov", "x", "y", "total")


# ---- spots to cells ---------------------------------------------------------


@cells.query(f"WITH {HIT} SELECT spot_id, modality, fov, gene_id, cell_num FROM hit")
def spot_cell_by_mask(i: Inputs) -> DataFrame:
    return assign.assign_by_mask(i.spots, i.mask, parts=i.mask_parts).select("spot_id", "modality", "fov", "gene_id", "cell_num")


@cells.query(
    f"""WITH {HIT} SELECT b.spot_id, b.seq, h.cell_num AS cellidbc, CASE WHEN h.cell_num > 0 THEN h.cell_num + CAST(h.fov AS BIGINT) * 10000 END AS cell_id
    FROM (SELECT DISTINCT spot_id, seq FROM fx_bc_spots) b JOIN (SELECT DISTINCT spot_id, fov, cell_num FROM hit) h USING (spot_id)"""
)
def barcode_spot_cells(i: Inputs) -> DataFrame:
    """Cell of every barcode spot, local and global.

    Spots go to their cells before they meet the barcodes, so that texts move once, and both sides
    of the join are dealt by its key before equal rows are dropped, which then moves nothing.
    """
    spots = i.spots.where("spot_id IS NOT NULL").select("spot_id", "fov", "lroi_x", "lroi_y")
    found = assign.assign_by_mask(spots, i.mask, "cellidbc", i.mask_parts).repartition("spot_id").distinct()
    barcodes = i.bc_spots.where("spot_id IS NOT NULL").select("spot_id", "seq").repartition("spot_id").distinct()
    own = F.when(F.col("cellidbc") > 0, assign.global_cell_id(label="cellidbc"))
    return barcodes.join(found.hint("merge"), "spot_id").select("spot_id", "seq", "cellidbc", own.alias("cell_id"))


def outlined(i: Inputs) -> DataFrame:
    """Cells with a six-cornered outline around the centre."""
    x, y = F.col("cent_x"), F.col("cent_y")
    corner = lambda centre, steps: F.array(*[centre + s for s in steps])
    return i.cells.withColumn("xs", corner(x, (-6, -3, 3, 6, 3, -3))).withColumn("ys", corner(y, (0, 5, 5, 0, -5, -5)))


@cells.query(
    """WITH px AS (SELECT *, CAST(trunc(lroi_x) AS BIGINT) AS px, CAST(trunc(lroi_y) AS BIGINT) AS py FROM fx_spots)
    SELECT s.spot_id, any_value(s.fov) AS fov, coalesce(max(c.cell_num), 0) AS cell_num
    FROM px s LEFT JOIN fx_cells c ON c.fov = s.fov
      AND abs(s.py - c.cent_y) <= 5
      AND 5 * abs(s.px - c.cent_x) + 3 * abs(s.py - c.cent_y) <= 30
    GROUP BY s.spot_id"""
)
def spot_cell_by_outline(i: Inputs) -> DataFrame:
    found = assign.assign_by_outline(i.spots, outlined(i))
    return found.groupBy("spot_id").agg(F.first("fov").alias("fov"), F.max("cell_num").alias("cell_num"))


@cells.query(
    """SELECT c.fov, c.cell_num, c.cell_num + CAST(c.fov AS BIGINT) * 10000 AS cell_id FROM fx_cells c"""
)
def global_cell_ids(i: Inputs) -> DataFrame:
    return i.cells.select("fov", "cell_num", assign.global_cell_id().alias("cell_id"))


@cells.query("SELECT fov, cell_num FROM fx_cells WHERE cell_num >= 250")
def label_overflow(i: Inputs) -> DataFrame:
    return assign.label_overflow(i.cells, 250).select("fov", "cell_num")


@cells.query(
    """SELECT spot_id, modality, 0.5 * lroi_y + pos_x AS pos10_x, 0.5 * lroi_x + pos_y AS pos10_y
    FROM fx_spots JOIN fx_tforms USING (fov)"""
)
def global_spots(i: Inputs) -> DataFrame:
    return layout.to_global(i.spots, i.tforms).select("spot_id", "modality", "pos10_x", "pos10_y")


# ---- aggregation ------------------------------------------------------------


@cells.query(
    """SELECT spot_id, CAST(CASE WHEN modality = 'hyb' THEN gene_id + 111 ELSE gene_id END AS INT) AS gene_id FROM fx_spots"""
)
def combined_spots(i: Inputs) -> DataFrame:
    spots = i.spots
    parts = [(spots.where("modality = 'geneseq'"), N_GENESEQ), (spots.where("modality = 'hyb'"), 3)]
    return expression.combine_modalities(parts).select("spot_id", "gene_id")


@cells.query(
    """SELECT slice, count(*) AS n_spots,
      count(*) FILTER (WHERE g > 0) AS n_called,
      count(*) FILTER (WHERE lroi_x > 223 AND lroi_x < 2977 AND lroi_y > 223 AND lroi_y < 2977) AS n_inside
    FROM (SELECT s.*, t.slice, CASE WHEN modality = 'hyb' THEN gene_id + 111 ELSE gene_id END AS g
          FROM fx_spots s JOIN fx_tforms t USING (fov)) q GROUP BY slice"""
)
def spot_filters(i: Inputs) -> DataFrame:
    spots = i.spots
    both = expression.combine_modalities([(spots.where("modality = 'geneseq'"), N_GENESEQ), (spots.where("modality = 'hyb'"), 3)])
    return both.join(i.tforms.select("fov", "slice"), "fov").groupBy("slice").agg(
        F.count(F.lit(1)).alias("n_spots"),
        F.count_if(expression.called()).alias("n_called"),
        F.count_if(expression.inside_border()).alias("n_inside"),
    )


@cells.query(
    """SELECT id, pos10_x, pos10_y, pos40_x, pos40_y, slice, fov FROM (
      SELECT CAST(CASE WHEN modality = 'hyb' THEN gene_id + 111 ELSE gene_id END AS INT) AS id,
        0.5 * lroi_y + pos_x AS pos10_x, 0.5 * lroi_x + pos_y AS pos10_y,
        lroi_x AS pos40_x, lroi_y AS pos40_y, slice, fov FROM fx_spots JOIN fx_tforms USING (fov)) q
    WHERE id > 0 AND pos40_x > 223 AND pos40_x < 2977 AND pos40_y > 223 AND pos40_y < 2977"""
)
def rolonies(i: Inputs) -> DataFrame:
    spots = i.spots
    both = expression.combine_modalities([(spots.where("modality = 'geneseq'"), N_GENESEQ), (spots.where("modality = 'hyb'"), 3)])
    return expression.rolonies(both, i.tforms)


@cells.query(
    """SELECT cell_num + CAST(fov AS BIGINT) * 10000 AS id, 0.5 * cent_y + pos_x AS pos10x_x, 0.5 * cent_x + pos_y AS pos10x_y,
      cent_x AS pos40x_x, cent_y AS pos40x_y, slice, fov, cell_num FROM fx_cells JOIN fx_tforms USING (fov)"""
)
def neurons(i: Inputs) -> DataFrame:
    return expression.neurons(i.cells, i.tforms)


@cells.query(
    f"""WITH {HIT},{ALL_SPOTS}
    SELECT fov, cell_num, gene_id, count(*) AS n FROM spots WHERE cell_num > 0 GROUP BY ALL"""
)
def cell_gene_counts(i: Inputs) -> DataFrame:
    return expression.cell_gene_counts(located(i), i.cells)


@cells.query(f"{CHAIN} SELECT fov, cell_num, total FROM neurons")
def cell_totals(i: Inputs) -> DataFrame:
    listed = i.cells
    expr = expression.cell_gene_counts(located(i), listed, i.count_parts)
    return expression.total_expression(expr, listed.select("fov", "cell_num"))


@cells.query(
    f"""WITH {HIT},{ALL_SPOTS}
    SELECT c.cell_num + CAST(c.fov AS BIGINT) * 10000 AS cell_id,
      {', '.join(f'count(*) FILTER (WHERE s.gene_id = {g}) AS g{g}' for g in range(114))}
    FROM fx_cells c LEFT JOIN spots s ON s.fov = c.fov AND s.cell_num = c.cell_num GROUP BY c.fov, c.cell_num"""
)
def cells_by_genes(i: Inputs) -> DataFrame:
    listed = i.cells
    expr = expression.cell_gene_counts(located(i), listed, i.count_parts)
    return expression.wide_matrix(expr, listed, range(114), [f"g{g}" for g in range(114)])


@cells.query(
    f"""WITH {HIT},{ALL_SPOTS},
    book AS (SELECT gene_id, gene FROM fx_codebook UNION ALL SELECT gene_id + 111, gene FROM fx_hyb_codebook),
    g AS (SELECT fov, cell_num, s.gene_id, gene, count(*) AS n, min(spot_id) AS first
          FROM spots s JOIN book b ON b.gene_id = s.gene_id WHERE cell_num > 0 GROUP BY ALL)
    SELECT fov, cell_num, string_agg(gene, ',' ORDER BY first, gene_id) AS genes,
      string_agg(CAST(gene_id AS VARCHAR), ',' ORDER BY first, gene_id) AS gene_ids,
      string_agg(CAST(n AS VARCHAR), ',' ORDER BY first, gene_id) AS gene_counts
    FROM g GROUP BY fov, cell_num"""
)
def cell_gene_lists(i: Inputs) -> DataFrame:
    return expression.gene_lists(with_gene_names(i, located(i)))


@cells.query(
    f"""WITH {HIT},{ALL_SPOTS}
    SELECT c.fov, c.cell_num,
      {" || ',' || ".join(f'CAST(count(*) FILTER (WHERE s.gene_id = {g}) AS VARCHAR)' for g in range(114))} AS counts
    FROM fx_cells c LEFT JOIN spots s ON s.fov = c.fov AND s.cell_num = c.cell_num GROUP BY c.fov, c.cell_num"""
)
def cell_gene_vector(i: Inputs) -> DataFrame:
    listed = i.cells
    expr = expression.cell_gene_counts(located(i), listed)
    return expression.gene_vector(expr, listed, 114).withColumn("counts", F.array_join(F.col("counts").cast("array<string>"), ","))


MARKERS = {"excite": 111, "inhib": 112, "it": 113}
MARKED = """
  marked AS (
    SELECT c.fov, c.cell_num,
      count(*) FILTER (WHERE h.gene_id % 3 = 0) AS excite_count,
      count(*) FILTER (WHERE h.gene_id % 3 = 1) AS inhib_count,
      count(*) FILTER (WHERE h.gene_id % 3 = 2) AS it_count
    FROM fx_cells c LEFT JOIN hit h ON h.fov = c.fov AND h.cell_num = c.cell_num GROUP BY c.fov, c.cell_num)"""
CLASSED = """
  classed AS (
    SELECT *, CASE
        WHEN excite_count < 2 AND inhib_count < 2 AND it_count < 2 THEN 'unassigned'
        WHEN excite_count > 3 AND inhib_count > 3 THEN 'unassigned'
        WHEN excite_count > inhib_count THEN 'excitatory'
        WHEN inhib_count > excite_count THEN 'inhibitory' ELSE 'unassigned' END AS cell_class FROM marked)"""


def marked_cells(i: Inputs) -> DataFrame:
    # Every gene counts towards one of the three markers, so that all classes occur.
    spots = assign.assign_by_mask(i.spots, i.mask, parts=i.mask_parts).withColumn("gene_id", F.col("gene_id") % 3)
    return expression.marker_counts(spots, {"excite": 0, "inhib": 1, "it": 2}, i.cells)


@cells.query(
    f"""WITH {HIT} SELECT fov, cell_num, spot_id, CASE gene_id % 3 WHEN 0 THEN 'excite' WHEN 1 THEN 'inhib' ELSE 'it' END AS marker
    FROM hit WHERE cell_num > 0"""
)
def cell_marker_spots(i: Inputs) -> DataFrame:
    spots = assign.assign_by_mask(i.spots, i.mask, parts=i.mask_parts).withColumn("gene_id", F.col("gene_id") % 3)
    return expression.marker_spots(spots, {"excite": 0, "inhib": 1, "it": 2})


def classed_cells(i: Inputs) -> DataFrame:
    kind, sub = expression.cell_class()
    tiles = i.tiles.select("fov", "position")
    return marked_cells(i).select("*", kind.alias("cell_class"), sub.alias("cell_subclass")).join(tiles, "fov")


@cells.query(f"WITH {HIT},{MARKED} SELECT * FROM marked")
def cell_marker_counts(i: Inputs) -> DataFrame:
    return marked_cells(i)


@cells.query(
    f"""WITH {HIT},{MARKED},{CLASSED}
    SELECT fov, cell_num, cell_class,
      CASE WHEN cell_class = 'excitatory' AND it_count > 1 THEN 'IT' ELSE 'unassigned' END AS cell_subclass FROM classed"""
)
def cell_classes(i: Inputs) -> DataFrame:
    return classed_cells(i).select("fov", "cell_num", "cell_class", "cell_subclass")


@cells.query(
    f"""WITH {HIT},{MARKED},{CLASSED},
    n AS (SELECT position, count(*) FILTER (WHERE cell_class = 'excitatory') AS n_excitatory,
      count(*) FILTER (WHERE cell_class = 'inhibitory') AS n_inhibitory,
      count(*) FILTER (WHERE cell_class = 'unassigned') AS n_unassigned
      FROM classed JOIN fx_tiles USING (fov) GROUP BY position)
    SELECT *, round_even(100.0 * n_excitatory / (CAST(0.001 AS DOUBLE) + n_excitatory + n_inhibitory), 0) AS pct_excitatory,
      round_even(100.0 * n_inhibitory / (CAST(0.001 AS DOUBLE) + n_excitatory + n_inhibitory), 0) AS pct_inhibitory FROM n"""
)
def class_summary(i: Inputs) -> DataFrame:
    return expression.class_summary(classed_cells(i))


@cells.query(
    f"""WITH {HIT},{MARKED},{CLASSED}
    SELECT c.cell_num + CAST(c.fov AS BIGINT) * 10000 AS id, c.cent_y AS x, c.cent_x AS y, t.slice * 20 AS z, k.cell_class
    FROM fx_cells c JOIN classed k USING (fov, cell_num) JOIN fx_tforms t USING (fov)"""
)
def final_cell_table(i: Inputs) -> DataFrame:
    joined = i.cells.join(classed_cells(i), ["fov", "cell_num"])
    return joined.select(
        assign.global_cell_id().alias("id"),
        F.col("cent_y").alias("x"),
        F.col("cent_x").alias("y"),
        expression.section_depth().alias("z"),
        "cell_class",
    )


@cells.query(
    f"""WITH {HIT},
    n AS (SELECT position, fov, cell_num, count(*) AS n FROM hit JOIN fx_tiles USING (fov) GROUP BY ALL)
    SELECT position, CAST(sum(n) AS BIGINT) AS n_spots, CAST(sum(n) FILTER (WHERE cell_num > 0) AS BIGINT) AS n_allocated,
      round_even(100.0 * sum(n) FILTER (WHERE cell_num > 0) / sum(n), 1) AS pct_allocated,
      round(avg(n) FILTER (WHERE cell_num > 0), 6) AS mean_per_cell,
      round(stddev_pop(n) FILTER (WHERE cell_num > 0), 6) AS std_per_cell
    FROM n GROUP BY position"""
)
def allocation_stats(i: Inputs) -> DataFrame:
    spots = assign.assign_by_mask(i.spots, i.mask, parts=i.mask_parts).join(i.tiles.select("fov", "position"), "fov")
    return rounded(expression.allocation_stats(spots))


@cells.query(
    """WITH lim AS (SELECT min(gene_id) AS lo, max(gene_id) AS hi FROM fx_spots)
    SELECT CAST(least(floor(CAST((gene_id - lo) * 56 AS DOUBLE) / (hi - lo)), 55) + 1 AS INT) AS bin, count(*) AS n
    FROM fx_spots, lim GROUP BY 1"""
)
def gene_histogram(i: Inputs) -> DataFrame:
    return expression.gene_histogram(i.spots)


@cells.query("SELECT fov, tile_name, CAST(regexp_extract(position, '[0-9]+$') AS INT) * 20 AS z FROM fx_tiles")
def section_depth(i: Inputs) -> DataFrame:
    return i.tiles.select("fov", "tile_name", expression.section_depth().alias("z"))


@cells.query(
    """SELECT fov, cell_num, row_number() OVER (ORDER BY slice, fov, cell_num) - 1 AS running_id
    FROM fx_cells JOIN fx_tforms USING (fov)"""
)
def running_cell_ids(i: Inputs) -> DataFrame:
    placed = i.cells.join(i.tforms.select("fov", "slice"), "fov").select("slice", "fov", "cell_num")
    return expression.running_cell_id(placed, ["slice", "fov", "cell_num"]).select("fov", "cell_num", "running_id")


@cells.query(
    """SELECT spot_id, slice, row_number() OVER (ORDER BY slice, fov, spot_id) - 1 AS running_id
    FROM fx_spots JOIN fx_tforms USING (fov) WHERE modality = 'hyb'"""
)
def running_marker_spot_ids(i: Inputs) -> DataFrame:
    hyb = i.spots.where("modality = 'hyb'").join(i.tforms.select("fov", "slice"), "fov")
    return ranking.number_rows(hyb.select("slice", "fov", "spot_id"), ["slice", "fov", "spot_id"], "running_id").drop("fov")


@cells.query(
    """SELECT fov, cell_num FROM fx_cells WHERE cent_x > 1100 AND cent_x < 2100 AND cent_y > 1100 AND cent_y < 2100"""
)
def central_cells(i: Inputs) -> DataFrame:
    return i.cells.where(expression.in_central_area(500)).select("fov", "cell_num")


@cells.query(
    f"""WITH {HIT},{ALL_SPOTS}
    SELECT c.cell_num + CAST(c.fov AS BIGINT) * 10000 AS id, 0.5 * c.cent_y + t.pos_x AS x, 0.5 * c.cent_x + t.pos_y AS y,
      round(ln(1 + count(*)), 6) AS level
    FROM spots s JOIN fx_cells c ON s.fov = c.fov AND s.cell_num = c.cell_num JOIN fx_tforms t ON t.fov = c.fov
    WHERE s.gene_id = 112 GROUP BY ALL"""
)
def gene_map(i: Inputs) -> DataFrame:
    expr = expression.cell_gene_counts(located(i), i.cells)
    return rounded(expression.gene_map(expr, expression.neurons(i.cells, i.tforms), 112))


@cells.query(
    """SELECT cell_num + CAST(fov AS BIGINT) * 10000 AS id, slice, CAST(7 + slice % 3 AS INT) AS batch_num,
      CAST(slice * 10 AS INT) AS slice_num FROM fx_cells JOIN fx_tforms USING (fov)"""
)
def stamped_cells(i: Inputs) -> DataFrame:
    slices = i.tforms.select("slice").distinct().select(
        "slice", (7 + F.col("slice") % 3).alias("batch_num"), (F.col("slice") * 10).alias("slice_num")
    )
    table = expression.neurons(i.cells, i.tforms).select("id", "slice")
    return expression.stamp_batch(table, slices)


# ---- cells seen twice ---------------------------------------------------------


@cells.query(
    f"""{CHAIN}
    SELECT a.id, count(b.id) AS n_near FROM neurons a LEFT JOIN neurons b
    ON a.slice = b.slice AND a.fov <> b.fov AND b.x BETWEEN a.x - 303 AND a.x + 303
    AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 303 * 303 GROUP BY a.id"""
)
def radius_neighbours(i: Inputs) -> DataFrame:
    return overlaps.radius_neighbours(neuron_totals(i), overlaps.search_radius()).select("id", "n_near")


@cells.query(
    f"""{PAIR_CHAIN}
    SELECT n.id, count(p.nid) AS n_overlap FROM neurons n LEFT JOIN pairs p ON p.id = n.id GROUP BY n.id"""
)
def overlap_counts(i: Inputs) -> DataFrame:
    return overlaps.overlap_counts(neuron_totals(i), overlaps.half_box()).select("id", "n_overlap")


@cells.query(f"{PAIR_CHAIN} SELECT id, total, max(ntotal) AS neigh_exp FROM pairs GROUP BY ALL")
def best_neighbour(i: Inputs) -> DataFrame:
    marked = overlaps.best_neighbour(neuron_totals(i), overlaps.half_box())
    return marked.where("neigh_exp IS NOT NULL").select("id", "total", "neigh_exp")


@cells.query(f"{PAIR_CHAIN} SELECT DISTINCT id FROM pairs WHERE ntotal > total")
def removed_cells(i: Inputs) -> DataFrame:
    return overlaps.removed_cells(neuron_totals(i), overlaps.half_box()).select("id")


@cells.query(
    f"""{PAIR_CHAIN},
    keep AS (SELECT fov, cell_num FROM neurons n WHERE NOT EXISTS
      (SELECT 1 FROM pairs p WHERE p.id = n.id AND p.ntotal > p.total)),{ALL_SPOTS}
    SELECT s.fov, s.cell_num, s.gene_id, count(*) AS n FROM spots s JOIN keep k ON k.fov = s.fov AND k.cell_num = s.cell_num GROUP BY ALL"""
)
def filtered_expression(i: Inputs) -> DataFrame:
    kept = overlaps.drop_duplicates(neuron_totals(i), overlaps.half_box())
    return expression.cell_gene_counts(located(i), kept)


@cells.query(
    f"""{PAIR_CHAIN}
    SELECT n.id, n.slice, n.total, NOT EXISTS (SELECT 1 FROM pairs p WHERE p.id = n.id AND p.ntotal > p.total) AS kept FROM neurons n"""
)
def flagged_neurons(i: Inputs) -> DataFrame:
    return overlaps.flag_duplicates(neuron_totals(i), overlaps.half_box()).select("id", "slice", "total", "kept")


@cells.query(
    f"""{PAIR_CHAIN},
    p AS (SELECT id, count(*) AS n, bool_or(ntotal > total) AS gone FROM pairs GROUP BY id)
    SELECT slice, count(*) AS n_cells, count(p.id) AS n_in_pairs, round(CAST(count(p.id) AS DOUBLE) / count(*), 6) AS frac_in_pairs,
      CAST(coalesce(sum(p.n), 0) AS BIGINT) AS n_pairs, count(*) FILTER (WHERE gone) AS n_removed,
      round(CAST(100 * (count(*) - count(*) FILTER (WHERE gone)) AS DOUBLE) / count(*), 6) AS kept_pct
    FROM neurons n LEFT JOIN p USING (id) GROUP BY slice"""
)
def overlap_report(i: Inputs) -> DataFrame:
    return rounded(overlaps.overlap_report(neuron_totals(i), overlaps.half_box()))


@cells.query(
    f"""WITH RECURSIVE {HIT},{NEURONS},{PAIRS},
    reach AS (SELECT id, id AS other FROM neurons UNION SELECT reach.id, p.nid FROM reach JOIN pairs p ON p.id = reach.other)
    SELECT n.id, NOT EXISTS (SELECT 1 FROM reach r JOIN neurons o ON o.id = r.other
      WHERE r.id = n.id AND (o.total > n.total OR (o.total = n.total AND o.id < n.id))) AS kept FROM neurons n"""
)
def overlap_components(i: Inputs) -> DataFrame:
    return overlaps.overlap_components(neuron_totals(i), overlaps.half_box()).select("id", "kept")


@cells.query(
    """SELECT t.spot_id AS target_id, min_by(c.cell_num, struct_pack(a := d2, b := c.cell_num)) AS source_id, round(sqrt(min(d2)), 6) AS distance
    FROM (SELECT s.spot_id, c.cell_num, (s.lroi_x - c.cent_x) * (s.lroi_x - c.cent_x) + (s.lroi_y - c.cent_y) * (s.lroi_y - c.cent_y) AS d2
          FROM (SELECT DISTINCT spot_id, fov, lroi_x, lroi_y FROM fx_spots) s JOIN fx_cells c ON c.fov = s.fov AND abs(s.lroi_x - c.cent_x) < 10) t, LATERAL (SELECT t.cell_num) c
    WHERE d2 < 100 GROUP BY t.spot_id"""
)
def nearest_match(i: Inputs) -> DataFrame:
    target = i.spots.select(F.col("fov").alias("frame"), F.col("spot_id").alias("id"), F.col("lroi_x").alias("x"), F.col("lroi_y").alias("y")).distinct()
    source = i.cells.select(F.col("fov").alias("frame"), F.col("cell_num").alias("id"), F.col("cent_x").alias("x"), F.col("cent_y").alias("y"))
    return rounded(overlaps.nearest_match(target, source)).drop("frame")
