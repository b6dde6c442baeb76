"""Cells seen twice where tiles overlap.

Cells at one place in one tile are folded into a site (their number and their
best expression) before any neighbour join, and a place keeps only its two
strongest tiles on the side that is searched.  The best neighbour from another
tile is always among those two, so nothing is lost, and a crowded place costs
one row instead of all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotweave.operators.links import components
from spotweave.operators.nearcounts import Shape, disc, open_box, other_tile_counts
from spotweave.operators.spatial import near_join
from spotweave.session import settle

PLACE = ["slice", "x", "y"]


def half_box(box_half_um: float = 5.0, pixel_um: float = 0.33, rescale: float = 0.5) -> int:
    """Half width of the overlap box in rescaled pixels."""
    return round(box_half_um / (pixel_um / rescale))


def search_radius(radius_um: float = 200.0, pixel_um: float = 0.33, rescale: float = 0.5) -> int:
    return round(radius_um / (pixel_um / rescale))


def boxes_overlap(half: float) -> Column:
    """Strict overlap of two equal boxes at (x, y) and (nx, ny); aligned edges do not count."""
    dx, dy = F.abs(F.col("x") - F.col("nx")), F.abs(F.col("y") - F.col("ny"))
    return (dx > 0) & (dx < 2 * half) & (dy > 0) & (dy < 2 * half)


def sites(neurons: DataFrame) -> DataFrame:
    return neurons.groupBy(*PLACE, "fov").agg(F.count(F.lit(1)).alias("n"), F.max("total").alias("top"))


def best_neighbour(neurons: DataFrame, half: float) -> DataFrame:
    """``neurons`` with ``neigh_exp``, the highest expression among overlapping
    cells of other tiles, or null where there is none.
    """
    neurons = settle(neurons, "neurons")
    best = _best_at_sites(sites(neurons), half)
    # As many rows as cells may have: merged, so that the driver never holds them.
    return neurons.join(best.hint("merge"), [*PLACE, "fov"], "left").select(*neurons.columns, "neigh_exp")


def _best_at_sites(here: DataFrame, half: float) -> DataFrame:
    # The limit on the rank is applied before the exchange too, so a crowded place stays small.
    ranked = here.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*PLACE).orderBy(F.col("top").desc(), "fov"))
    ).where("_rank <= 2")
    around = ranked.select(
        F.col("slice"), F.col("x").alias("nx"), F.col("y").alias("ny"), F.col("fov").alias("nfov"), F.col("top").alias("ntop")
    )
    met = near_join(
        here.select(*PLACE, "fov"),
        around,
        ["slice"],
        (2 * half, 2 * half),
        ("x", "y"),
        ("nx", "ny"),
        boxes_overlap(half) & (F.col("fov") != F.col("nfov")),
    )
    return met.groupBy(*PLACE, "fov").agg(F.max("ntop").alias("neigh_exp"))


def removed_cells(neurons: DataFrame, half: float) -> DataFrame:
    """Cells whose best overlapping neighbour is stronger; a tie keeps both."""
    return best_neighbour(neurons, half).where(F.col("neigh_exp") > F.col("total")).drop("neigh_exp")


def drop_duplicates(neurons: DataFrame, half: float) -> DataFrame:
    marked = best_neighbour(neurons, half)
    return marked.where(F.coalesce(F.col("neigh_exp") <= F.col("total"), F.lit(True))).drop("neigh_exp")


def flag_duplicates(neurons: DataFrame, half: float) -> DataFrame:
    """Every cell with its expression and whether it is kept."""
    marked = best_neighbour(neurons, half)
    return marked.withColumn("kept", F.coalesce(F.col("neigh_exp") <= F.col("total"), F.lit(True))).drop("neigh_exp")


def _neighbour_count(neurons: DataFrame, shape: Shape, name: str) -> DataFrame:
    neurons = settle(neurons, "neurons")
    counted = neurons.join(other_tile_counts(sites(neurons), shape, name).hint("merge"), [*PLACE, "fov"], "left")
    return counted.select(*neurons.columns, F.coalesce(name, F.lit(0)).cast("long").alias(name))


def radius_neighbours(neurons: DataFrame, radius: float) -> DataFrame:
    """Number of cells of other tiles within ``radius`` of each cell."""
    return _neighbour_count(neurons, disc(radius), "n_near")


def overlap_counts(neurons: DataFrame, half: float) -> DataFrame:
    """Number of cells of other tiles whose box overlaps each cell's box."""
    return _neighbour_count(neurons, open_box(2 * half), "n_overlap")


def overlap_report(neurons: DataFrame, half: float) -> DataFrame:
    """Per slice: cells, cells in pairs, pairs in both directions, removed, kept percent."""
    neurons = settle(neurons, "neurons")
    here = sites(neurons)
    keys = [*PLACE, "fov"]
    counts = other_tile_counts(here, open_box(2 * half), "n_overlap")
    # Counts and best neighbours have one row per site, so the cells meet both at once.
    found = counts.join(_best_at_sites(here, half).hint("merge"), keys, "left")
    marked = neurons.join(found.hint("merge"), keys, "left").withColumn("n_overlap", F.coalesce("n_overlap", F.lit(0)))
    removed = F.count_if(F.col("neigh_exp") > F.col("total"))
    paired = F.count_if(F.col("n_overlap") > 0)
    total = F.count(F.lit(1))
    return marked.groupBy("slice").agg(
        total.alias("n_cells"),
        paired.alias("n_in_pairs"),
        (paired / total).alias("frac_in_pairs"),
        F.sum("n_overlap").alias("n_pairs"),
        removed.alias("n_removed"),
        (100.0 * (total - removed) / total).alias("kept_pct"),
    )


def overlap_components(neurons: DataFrame, half: float) -> DataFrame:
    """``neurons`` with ``component`` (a site number) and ``kept``: the strongest
    member of every group of mutually reachable overlapping cells, lowest id on a tie.

    The rounds grow with the logarithm of the longest chain, see ``components``.
    """
    neurons = settle(neurons, "neurons")
    here = sites(neurons).withColumn(
        "site", F.concat_ws("|", F.col("slice"), F.col("x"), F.col("y"), F.col("fov"))
    )
    here = settle(here, "sites")
    # Three tiles per place are enough to hold its cells together: whatever tile a
    # site is in, two of them differ from it and from each other.
    first = Window.partitionBy(*PLACE).orderBy("fov")
    far = here.withColumn("_rank", F.row_number().over(first)).where("_rank <= 3").select(
        "slice", F.col("x").alias("nx"), F.col("y").alias("ny"), F.col("fov").alias("nfov"), F.col("site").alias("nsite")
    )
    met = near_join(
        here.select(*PLACE, "fov", "site"),
        far,
        ["slice"],
        (2 * half, 2 * half),
        ("x", "y"),
        ("nx", "ny"),
        boxes_overlap(half) & (F.col("fov") != F.col("nfov")),
    ).select("site", "nsite")
    labels = components(met.toDF("a", "b")).toDF("site", "label")
    member = neurons.withColumn("site", F.concat_ws("|", F.col("slice"), F.col("x"), F.col("y"), F.col("fov"))).join(
        labels, "site", "left"
    )
    member = member.withColumn("component", F.coalesce("label", F.concat_ws("#", "site", "id")))
    best = member.groupBy("component").agg(F.max(F.struct("total", (-F.col("id")).alias("_neg"))).alias("_best"))
    return member.join(best, "component").select(
        *neurons.columns, "component", (F.col("id") == -F.col("_best._neg")).alias("kept")
    )


def nearest_match(target: DataFrame, source: DataFrame, allowed: float = 10.0) -> DataFrame:
    """Nearest source of each target point closer than ``allowed``; lowest id on a tie.

    ``target(frame, id, x, y)`` and ``source(frame, id, x, y)``.  Both sides are
    joined as distinct places first, so stacked points do not multiply.
    """
    t = target.select("frame", "x", "y").distinct()
    s = source.groupBy("frame", F.col("x").alias("nx"), F.col("y").alias("ny")).agg(F.min("id").alias("source_id"))
    dx, dy = F.col("x") - F.col("nx"), F.col("y") - F.col("ny")
    squared = dx * dx + dy * dy
    met = near_join(t, s, ["frame"], (allowed, allowed), ("x", "y"), ("nx", "ny"), squared < float(allowed) ** 2)
    best = met.groupBy("frame", "x", "y").agg(F.min(F.struct(squared.alias("d2"), F.col("source_id"))).alias("_b"))
    return target.join(best, ["frame", "x", "y"]).select(
        "frame", F.col("id").alias("target_id"), F.col("_b.source_id").alias("source_id"), F.sqrt("_b.d2").alias("distance")
    )
