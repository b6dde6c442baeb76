"""Spots to cells: by label mask or by cell outline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.session import settle

#: Rows that agree on a part of the join's keys stay where they are, and neither side is broadcast.
IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def assign_by_mask(spots: DataFrame, mask: DataFrame, name: str = "cell_num", parts: int | None = None) -> DataFrame:
    """Label of the pixel under each spot; 0 on background or outside the frame.

    ``mask(fov, r, c, label)`` has at most one row per pixel and is by far the
    larger side, so it is only streamed: the distinct spot pixels, which spread
    evenly however crowded one pixel is, are hashed and the mask's rows looked
    up among them without sorting them.  A mask that is itself put together per
    pixel is so put together whole before, part by part: how many pixels a part
    has decides what a task holds.  ``parts`` is the number of partitions into which the mask is dealt by ``fov``, if it is; the spot
    pixels are then dealt alike and the mask does not move at all.  The labels
    then go back to the spots.
    """
    keys = ["fov", "r", "c"]
    at = spots.withColumn("r", F.rint("lroi_x").cast("int")).withColumn("c", F.rint("lroi_y").cast("int"))
    labels = mask.select(*keys, "label")
    if parts is None:
        hits = labels.join(at.select(*keys).distinct().hint("shuffle_hash"), keys, "left_semi")
    else:
        # Dealt before equal pixels are dropped, so that they move once and a task holds those of its tiles only.
        dealt = at.select(*keys).where("fov IS NOT NULL").repartition(parts, "fov").distinct()
        # Pixels of a tile are together on both sides, so that neither needs to be dealt again by whole keys.
        hits = settle(labels.join(dealt.hint("shuffle_hash"), keys, "left_semi"), "hits", settings=IN_PLACE)
    found = at.join(hits.hint("merge"), keys, "left")  # as many as spots, so never broadcast
    return found.select(*spots.columns, F.coalesce("label", F.lit(0)).cast("long").alias(name))


def global_cell_id(fov: str = "fov", label: str = "cell_num", start: int = 1, per_fov: int = 10_000) -> Column:
    """Cell number that is unique over tiles; a label of ``per_fov`` or more, which would meet the next tile's, is an error."""
    number = F.col(label) + F.col(fov).cast("long") * start * per_fov
    message = F.format_string("label %s of tile %s does not fit the cell numbers", F.col(label).cast("string"), F.col(fov).cast("string"))
    return F.when(F.col(label) >= per_fov, F.raise_error(message).cast("long")).otherwise(number)


def label_overflow(cells: DataFrame, per_fov: int = 10_000) -> DataFrame:
    """Cells whose label does not fit the global numbering; must be empty."""
    return cells.where(F.col("cell_num") >= per_fov)


BUCKET = 64  # columns of a span's lookup bucket


def outline_spans(cells: DataFrame) -> DataFrame:
    """``fov, cell_num, row, from, to``: the whole-number positions in each outline, edges included.

    A row is a whole number on the second axis (``ys``); ``from`` and ``to``
    bound a run on the first (``xs``).  Between crossings of its outline a row
    lies inside by turns; a position on an edge or corner is inside as well.
    Outlines without corners bound nothing; corners that are null or not a number are left out.
    """
    known = lambda v: v.isNotNull() & ~F.isnan(v)
    corners = F.filter(F.arrays_zip("xs", "ys"), lambda p: known(p["xs"]) & known(p["ys"]))
    shapes = cells.select("fov", "cell_num", corners.alias("_p")).where("size(_p) > 0")
    low, high = F.ceil(F.array_min("_p.ys")), F.floor(F.array_max("_p.ys"))
    rows = shapes.where(low <= high).withColumn("row", F.explode(F.sequence(low, high)))
    n, y = F.size("_p"), F.col("row")

    def edge(i: Column) -> Column:
        a, b = F.get("_p", i), F.get("_p", F.when(i == n - 1, F.lit(0)).otherwise(i + 1))
        return F.struct(a["xs"].alias("x1"), a["ys"].alias("y1"), b["xs"].alias("x2"), b["ys"].alias("y2"))

    rows = rows.withColumn("_e", F.transform(F.sequence(F.lit(0), n - 1), edge)).drop("_p")
    met = F.filter("_e", lambda e: (e["y1"] > y) != (e["y2"] > y))
    at = F.transform(met, lambda e: e["x1"] + F.try_divide((y - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"]))
    rows = rows.withColumn("_x", F.array_sort(at))
    turns = F.sequence(F.lit(0), F.greatest(F.floor(F.size("_x") / 2).cast("int") - 1, F.lit(0)))
    inside = F.transform(
        F.when(F.size("_x") > 0, turns).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(F.ceil(F.get("_x", 2 * i)).alias("from"), (F.ceil(F.get("_x", 2 * i + 1)) - 1).alias("to")),
    )

    def touching(e: Column) -> Column:
        """The part of an edge on the row: all of a level one, else the whole number that it meets exactly, if any."""
        left, right = F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])
        point = F.rint(e["x1"] + F.try_divide((y - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"]))
        exact = (e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (point - e["x1"])
        exact = exact & point.between(left, right)
        level = e["y1"] == e["y2"]
        return F.struct(
            F.when(level, F.ceil(left)).when(exact, point.cast("long")).alias("from"),
            F.when(level, F.floor(right)).when(exact, point.cast("long")).alias("to"),
        )

    reached = F.filter("_e", lambda e: y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))
    spans = rows.select("fov", "cell_num", "row", F.explode(F.concat(inside, F.transform(reached, touching))).alias("_s"))
    return spans.select("fov", "cell_num", "row", "_s.from", "_s.to").where("`from` <= `to`")


def assign_by_outline(spots: DataFrame, cells: DataFrame) -> DataFrame:
    """Cell whose outline holds the spot's whole-number position.

    ``cells(fov, cell_num, xs, ys)`` carries the outline, of any size, as vertex
    arrays.  Outlines become runs per row, and a spot looks up the runs of its
    row; where several outlines hold a spot the largest cell number wins.
    Spots are looked up once per distinct pixel, so crowded pixels cost nothing extra.
    """
    at = spots.withColumn("_px", F.col("lroi_x").cast("int")).withColumn("_py", F.col("lroi_y").cast("int"))
    pixels = at.select("fov", "_px", "_py").distinct().withColumn("_bucket", F.floor(F.col("_px") / BUCKET))
    buckets = F.sequence(F.floor(F.col("from") / BUCKET), F.floor(F.col("to") / BUCKET))
    spans = outline_spans(cells).withColumn("_bucket", F.explode(buckets)).withColumnRenamed("row", "_py")
    # The runs' size is known only before their rows are listed, so they are never broadcast.
    held = pixels.join(spans.hint("merge"), ["fov", "_py", "_bucket"]).where(F.col("_px").between(F.col("from"), F.col("to")))
    owner = held.groupBy("fov", "_px", "_py").agg(F.max("cell_num").alias("cell_num"))
    out = at.join(owner, ["fov", "_px", "_py"], "left")
    return out.select(*spots.columns, F.coalesce("cell_num", F.lit(0)).cast("long").alias("cell_num"))
