"""Spots and cells to rolony, neuron and expression tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.operators.assign import global_cell_id
from spotweave.operators.layout import to_global
from spotweave.operators.ranking import number_rows

# Fixed values of the default run.
TILE_SIZE = 3200
BORDER_FRACTION = 0.07
SECTION_UM = 20


def border_px(fraction: float = BORDER_FRACTION, tile: int = TILE_SIZE) -> int:
    return round(fraction * tile)


def inside_border(row: str = "lroi_x", col: str = "lroi_y", fraction: float = BORDER_FRACTION, tile: int = TILE_SIZE) -> Column:
    """Whether a spot lies inside the central part of its tile on both axes."""
    b = border_px(fraction, tile)
    low, high = b - 1, tile - b + 1
    return (F.col(row) > low) & (F.col(row) < high) & (F.col(col) > low) & (F.col(col) < high)


def called(min_gene_id: int = 0) -> Column:
    """Called spots; the default also drops code 0, as the original run does."""
    return F.col("gene_id") > min_gene_id


def slice_number(position_index: Column, start: int = 0) -> Column:
    return position_index + F.lit(start)


def combine_modalities(parts: Sequence[tuple[DataFrame, int]]) -> DataFrame:
    """Union of spot tables, gene ids shifted by the size of the codebooks before them."""
    shifted = []
    offset = 0
    for spots, codebook_size in parts:
        shifted.append(spots.withColumn("gene_id", F.col("gene_id") + F.lit(offset)))
        offset += codebook_size
    return reduce(lambda a, b: a.unionByName(b), shifted)


def rolonies(spots: DataFrame, tforms: DataFrame, min_gene_id: int = 0) -> DataFrame:
    """Called spots off the border with tile and slice coordinates."""
    kept = spots.where(called(min_gene_id) & inside_border())
    placed = to_global(kept, tforms).join(tforms.select("fov", "slice"), "fov")
    return placed.select(
        F.col("gene_id").alias("id"),
        "pos10_x",
        "pos10_y",
        F.col("lroi_x").alias("pos40_x"),
        F.col("lroi_y").alias("pos40_y"),
        "slice",
        "fov",
    )


def neurons(cells: DataFrame, tforms: DataFrame) -> DataFrame:
    """All cells with both coordinate systems."""
    placed = to_global(cells, tforms, "cent_x", "cent_y", ("pos10x_x", "pos10x_y"))
    return placed.join(tforms.select("fov", "slice"), "fov").select(
        global_cell_id().alias("id"),
        "pos10x_x",
        "pos10x_y",
        F.col("cent_x").alias("pos40x_x"),
        F.col("cent_y").alias("pos40x_y"),
        "slice",
        "fov",
        "cell_num",
    )


def cell_gene_counts(spots: DataFrame, cells: DataFrame, parts: int | None = None) -> DataFrame:
    """Long cells x genes matrix ``(fov, cell_num, gene_id, n)`` over listed cells.

    Background and unlisted labels drop out in the join with the cell list.
    ``parts`` deals the cells into that many partitions, in which later steps
    per cell stay; otherwise a task's rows are as many as compress to its share of bytes.
    """
    held = spots.where(F.col("cell_num") > 0).select("fov", "cell_num", "gene_id")
    if parts is not None:
        held = held.repartition(parts, "fov", "cell_num")
    counts = held.groupBy("fov", "cell_num", "gene_id").agg(F.count(F.lit(1)).alias("n"))
    # Cells may be as many as counts: neither side is for the driver to hold.
    return counts.join(cells.select("fov", "cell_num").hint("merge"), ["fov", "cell_num"], "left_semi")


def total_expression(expr: DataFrame, cells: DataFrame) -> DataFrame:
    """Row sums of the matrix, 0 for cells without spots."""
    sums = expr.groupBy("fov", "cell_num").agg(F.sum("n").alias("total"))
    joined = cells.join(sums.hint("merge"), ["fov", "cell_num"], "left")
    return joined.select(*[joined[c] for c in cells.columns], F.coalesce("total", F.lit(0)).alias("total"))


def wide_matrix(expr: DataFrame, cells: DataFrame, gene_ids: Sequence[int], names: Sequence[str]) -> DataFrame:
    """Cells x genes with one column per codebook gene and a row for every cell.

    A cell moves and is sorted with the genes that it has; the columns are only spread at the end.
    """
    summed = expr.where(F.col("gene_id").isin(list(gene_ids))).groupBy("fov", "cell_num", "gene_id").agg(F.sum("n").alias("n"))
    counts = summed.groupBy("fov", "cell_num").agg(F.map_from_entries(F.collect_list(F.struct("gene_id", "n"))).alias("_m"))
    joined = cells.select("fov", "cell_num").join(counts.hint("merge"), ["fov", "cell_num"], "left")
    genes = [F.coalesce(F.try_element_at("_m", F.lit(g)), F.lit(0)).alias(name) for g, name in zip(gene_ids, names)]
    return joined.select(global_cell_id().alias("cell_id"), *genes)


def gene_lists(spots: DataFrame, order: str = "spot_id") -> DataFrame:
    """Per cell the genes, gene ids and counts as aligned lists in first-seen order.

    The lists are as long as the codebook at most: spots are counted per gene first.
    """
    per_gene = (
        spots.where(F.col("cell_num") > 0)
        .groupBy("fov", "cell_num", "gene_id", "gene")
        .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("_first"))
    )
    listed = per_gene.groupBy("fov", "cell_num").agg(
        F.array_sort(F.collect_list(F.struct("_first", "gene_id", "gene", "n"))).alias("_g")
    )

    def text(field: str) -> Column:
        return F.array_join(F.transform("_g", lambda g: g[field].cast("string")), ",")

    return listed.select(
        "fov",
        "cell_num",
        text("gene").alias("genes"),
        text("gene_id").alias("gene_ids"),
        text("n").alias("gene_counts"),
    )


def gene_vector(expr: DataFrame, cells: DataFrame, n_genes: int) -> DataFrame:
    """Per cell an array with the count of every codebook gene."""
    counts = expr.groupBy("fov", "cell_num").agg(
        F.map_from_entries(F.collect_list(F.struct("gene_id", "n"))).alias("_m")
    )
    joined = cells.select("fov", "cell_num").join(counts, ["fov", "cell_num"], "left")
    empty = F.coalesce("_m", F.create_map().cast("map<int,bigint>"))
    genes = F.sequence(F.lit(0), F.lit(n_genes - 1))
    vector = F.transform(genes, lambda i: F.coalesce(F.try_element_at(empty, i), F.lit(0)))
    return joined.select("fov", "cell_num", vector.alias("counts"))


def marker_counts(spots: DataFrame, markers: dict[str, int], cells: DataFrame) -> DataFrame:
    """Spots of each marker gene per cell, 0 where there are none."""
    per = (
        spots.where(F.col("cell_num") > 0)
        .groupBy("fov", "cell_num")
        .agg(*[F.count_if(F.col("gene_id") == gene).alias(f"{name}_count") for name, gene in markers.items()])
    )
    joined = cells.select("fov", "cell_num").join(per, ["fov", "cell_num"], "left")
    return joined.select(
        "fov", "cell_num", *[F.coalesce(f"{name}_count", F.lit(0)).alias(f"{name}_count") for name in markers]
    )


def marker_spots(spots: DataFrame, markers: dict[str, int], spot_id: str = "spot_id") -> DataFrame:
    """``fov, cell_num, marker, spot_id``: every spot of a marker gene in a cell, one row each.

    The long form of lists of spots per cell and marker, which have no bound on
    their length; its counts are those of ``marker_counts``.  A gene under two
    names gives a row for each.
    """
    named = F.array(*[F.struct(F.lit(name).alias("marker"), F.lit(gene).alias("gene")) for name, gene in markers.items()])
    own = F.filter(named, lambda m: m["gene"] == F.col("gene_id"))
    held = spots.where((F.col("cell_num") > 0) & F.col("gene_id").isin(list(markers.values())))
    return held.select("fov", "cell_num", spot_id, F.explode(own["marker"]).alias("marker")).select("fov", "cell_num", "marker", spot_id)


def cell_class(excite: str = "excite_count", inhib: str = "inhib_count", it: str = "it_count") -> tuple[Column, Column]:
    """Class and subclass of a cell from its marker counts; a missing count is 0."""
    e, i, t = (F.coalesce(F.col(c), F.lit(0)) for c in (excite, inhib, it))
    unclear = ((e < 2) & (i < 2) & (t < 2)) | ((e > 3) & (i > 3)) | (e == i)
    kind = F.when(unclear, "unassigned").when(e > i, "excitatory").otherwise("inhibitory")
    sub = F.when((kind == "excitatory") & (t > 1), "IT").otherwise("unassigned")
    return kind, sub


def class_summary(cells: DataFrame, by: str = "position") -> DataFrame:
    """Cells of each class and the share of excitatory and inhibitory ones."""
    ex = F.count_if(F.col("cell_class") == "excitatory")
    inh = F.count_if(F.col("cell_class") == "inhibitory")
    share = lambda part: F.bround(100.0 * part / (F.lit(0.001) + ex + inh), 0)
    return cells.groupBy(by).agg(
        ex.alias("n_excitatory"),
        inh.alias("n_inhibitory"),
        F.count_if(F.col("cell_class") == "unassigned").alias("n_unassigned"),
        share(ex).alias("pct_excitatory"),
        share(inh).alias("pct_inhibitory"),
    )


def allocation_stats(spots: DataFrame, by: str = "position") -> DataFrame:
    """Spots, allocated spots and the mean and spread of spots per occupied cell."""
    per_cell = spots.groupBy(by, "fov", "cell_num").agg(F.count(F.lit(1)).alias("n"))
    in_cell = F.col("cell_num") > 0
    n_in = F.when(in_cell, F.col("n"))
    return per_cell.groupBy(by).agg(
        F.sum("n").alias("n_spots"),
        F.coalesce(F.sum(n_in), F.lit(0)).alias("n_allocated"),
        F.bround(100.0 * F.coalesce(F.sum(n_in), F.lit(0)) / F.sum("n"), 1).alias("pct_allocated"),
        F.avg(n_in).alias("mean_per_cell"),
        F.stddev_pop(n_in).alias("std_per_cell"),
    )


def gene_histogram(spots: DataFrame, bins: int = 56) -> DataFrame:
    """Spots per equal-width bin between the lowest and highest gene id; the last bin is closed."""
    per_gene = spots.groupBy("gene_id").agg(F.count(F.lit(1)).alias("n"))
    span = per_gene.agg(F.min("gene_id").alias("lo"), F.max("gene_id").alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    place = F.when(F.col("gene_id") == hi, F.lit(bins)).otherwise(
        F.width_bucket(F.col("gene_id").cast("double"), lo.cast("double"), hi.cast("double"), F.lit(bins))
    )
    return per_gene.groupBy(place.cast("int").alias("bin")).agg(F.sum("n").alias("n"))


def section_depth(position: str = "position", section_um: int = SECTION_UM) -> Column:
    """Depth of a slice from the number at the end of its name."""
    return F.regexp_extract(F.col(position), r"(\d+)$", 1).cast("int") * section_um


def running_cell_id(cells: DataFrame, order: Sequence[str | Column], start: int = 0) -> DataFrame:
    """Cell number counted on through all positions."""
    numbered = number_rows(cells, order, "running_id")
    return numbered.withColumn("running_id", F.col("running_id") + start)


def in_central_area(half: int = 2000, tile: int = TILE_SIZE, row: str = "cent_x", col: str = "cent_y") -> Column:
    """Whether a cell lies within ``half`` pixels of the image centre on both axes."""
    middle = tile / 2
    return (F.abs(F.col(row) - middle) < half) & (F.abs(F.col(col) - middle) < half)


def gene_map(expr: DataFrame, neuron_table: DataFrame, gene_id: int) -> DataFrame:
    """Position and log count of every cell that expresses one gene."""
    hit = expr.where(F.col("gene_id") == gene_id)
    return hit.join(neuron_table, ["fov", "cell_num"]).select(
        "id", F.col("pos10x_x").alias("x"), F.col("pos10x_y").alias("y"), F.log1p("n").alias("level")
    )


def stamp_batch(cells: DataFrame, slices: DataFrame) -> DataFrame:
    """Attach batch and new slice number by slice."""
    return cells.join(slices.select("slice", "batch_num", "slice_num"), "slice", "left")
