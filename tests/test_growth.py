"""Joins and groups that stay within a task and off the driver as tables grow."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotweave.operators import assign, barcodes, blocks, expression, nearcounts, overlaps, peaks, pixels as px, registration
from spotweave.operators.spatial import near_join
from spotweave.plans.cells import barcode_spot_cells
from spotweave.plans.registry import Inputs
from spotweave.session import configured
from spotweave.sources import readers, sinks

FOLDER = "/root/testdata/sf0.001"


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_spread_to_buckets_are_never_broadcast(spark):
    left = spark.range(9).select(F.lit(0).alias("k"), F.col("id").cast("double").alias("x"), F.lit(0.0).alias("y"))
    right = left.select("k", F.col("x").alias("nx"), F.col("y").alias("ny"))
    near = F.abs(F.col("x") - F.col("nx")) < 2
    met = near_join(left, right, ["k"], (2, 2), ("x", "y"), ("nx", "ny"), near)
    assert "Broadcast" not in planned(met)
    assert met.count() == 9 + 2 * 8


def test_best_neighbours_return_to_the_cells_without_a_broadcast(spark):
    cells = spark.range(4).select(
        "id", F.lit(1).alias("slice"), (F.col("id") % 2).cast("int").alias("fov"), F.col("id").cast("double").alias("x"),
        (F.col("id") * 2).cast("double").alias("y"), F.col("id").alias("total"),
    )
    for found in (overlaps.best_neighbour(cells, 8), overlaps.overlap_counts(cells, 8), overlaps.overlap_report(cells, 8)):
        assert "Broadcast" not in planned(found)
    assert {r.id: r.neigh_exp for r in overlaps.best_neighbour(cells, 8).collect()} == {0: 3, 1: 2, 2: 3, 3: 2}


def test_outlines_are_never_broadcast(spark):
    corners = lambda v, steps: F.array(*[F.col(v) + s for s in steps])
    cells = spark.range(1, 3).select(F.lit(0).alias("fov"), F.col("id").alias("cell_num"), (F.col("id") * 20).cast("double").alias("x"))
    cells = cells.withColumn("xs", corners("x", (0, 4, 4, 0))).withColumn("ys", F.array(*[F.lit(v) for v in (0.0, 0.0, 4.0, 4.0)]))
    spots = spark.range(50).select(F.lit(0).alias("fov"), F.col("id").cast("double").alias("lroi_x"), F.lit(2.0).alias("lroi_y"))
    found = assign.assign_by_outline(spots, cells)
    assert planned(found).count("SortMergeJoin") == 1  # the runs; the labels that go back may be few
    got = found.where("cell_num > 0")
    assert sorted((r.lroi_x, r.cell_num) for r in got.collect()) == [(float(20 * k + d), k) for k in (1, 2) for d in range(5)]


def test_medians_and_not_pixels_are_sent(spark):
    pixels = spark.range(20).select(F.lit(0).alias("fov"), (F.col("id") % 2).cast("int").alias("cycle"), F.col("id").alias("r"), F.lit(0).alias("c"), F.col("id").alias("v"))
    pixels = pixels.hint("merge")
    found = px.normalise_median(pixels, ["v"], px.median_max(pixels, ["v"]))
    plan = planned(found)
    assert "BuildRight" in plan and "BuildLeft" not in plan
    assert max(r.v for r in found.collect()) == 1.0


def test_mask_dealt_by_tile_does_not_move(spark):
    inputs = Inputs(spark, FOLDER)
    plan = planned(inputs.mask)
    assert plan.count("hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan
    spots = inputs.spots.unionByName(inputs.spots.limit(5).withColumn("fov", F.lit(None).cast("int")))
    dealt = assign.assign_by_mask(spots, inputs.mask, parts=inputs.mask_parts)
    plain = assign.assign_by_mask(spots, inputs.mask)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    assert dealt.where("cell_num > 0").count() > 0 and dealt.where("fov IS NULL AND cell_num = 0").count() == 5


def test_a_short_reach_makes_wide_blocks(spark):
    rng = np.random.default_rng(5)
    cells = [(k, 0, int(rng.integers(3)), float(rng.integers(-4_000, 4_000) / 2), float(rng.integers(0, 80) / 2), 1) for k in range(1_500)]
    df = spark.createDataFrame(cells, "id bigint, slice int, fov int, x double, y double, total bigint")
    counted = nearcounts.other_tile_counts(overlaps.sites(df), nearcounts.open_box(6), "n")
    assert f"/ {nearcounts.LEAST_BLOCK}" in planned(counted)
    fov, x, y = (np.array([c[k] for c in cells]) for k in (2, 3, 4))
    dx, dy = np.abs(x[:, None] - x), np.abs(y[:, None] - y)
    near = (dx > 0) & (dx < 6) & (dy > 0) & (dy < 6) & (fov[:, None] != fov)
    assert {r.id: r.n_overlap for r in overlaps.overlap_counts(df, 3).collect()} == dict(enumerate(near.sum(axis=1).tolist()))


@pytest.mark.parametrize("reach", [1, 3])
def test_few_spots_vote_as_images_do(reach):
    rng = np.random.default_rng(reach)
    block, side = 200, 200 + 2 * reach
    r, c = rng.integers(0, side, 400), rng.integers(0, side, 400)
    home = (r >= reach) & (r < reach + block) & (c >= reach) & (c < reach + block)
    f, m = np.where(home, rng.integers(0, 4, 400), 0).astype(float), rng.integers(0, 3, 400).astype(float)
    dense = lambda v: np.bincount(r * side + c, weights=v, minlength=side * side).reshape(side, side)
    votes = registration.paired(r, c, f, m, reach, side)
    assert votes.tolist() == registration.correlated(dense(f), dense(m), reach, block).tolist()
    assert registration.paired(r, c, f / 3, m, reach, side) is None
    assert registration.paired(r, c, f, np.where(m > 1, np.nan, m), reach, side) is None
    assert registration.paired(r, c, f, m, 60, side) is None
    assert not registration.paired(r, c, f * 0, m, reach, side).any()


@pytest.mark.parametrize("errors", [0, 1, 2, 3])
def test_library_rows_meet_barcodes_on_whole_texts(spark, errors):
    rng = np.random.default_rng(errors)
    texts = ["".join(rng.choice(list("1234"), 6)) for _ in range(60)]
    seqs = [*texts[:40], "12N412", "é23412", "12", "", None]
    cells = spark.createDataFrame(list(enumerate(seqs)), "cell_id bigint, seq string")
    books = [*texts[20:], "12X412", "123412", "123", None]
    library = spark.createDataFrame(list(enumerate(books)), "barcode_id bigint, sequence string")
    matched = barcodes.match_library(cells, library, 6, errors)
    assert "_key" not in planned(matched) and "SortMergeJoin" in planned(matched)
    whole = lambda text: text is not None and len(text) == 6
    near = lambda a, b: sum(x != y for x, y in zip(a, b)) <= errors
    wanted = {k: [b for b, other in enumerate(books) if whole(other) and near(seq, other)] for k, seq in enumerate(seqs) if whole(seq)}
    assert {r.cell_id: r.barcode_id for r in matched.collect()} == {k: max(found) for k, found in wanted.items() if found}


def test_small_blocks_are_reconstructed_many_at_a_time(spark):
    calls = spark.sparkContext.accumulator(0)
    plain = peaks.rebuilt

    def counted(ceiling, level):
        calls.add(1)
        return plain(ceiling, level)

    frames = spark.range(40 * 64).select(
        (F.col("id") % 40).cast("int").alias("fov"), F.lit(1).alias("cycle"),
        F.floor(F.col("id") / 320).cast("int").alias("r"), F.floor(F.col("id") / 40 % 8).cast("int").alias("c"),
    ).withColumn("v", F.when(F.expr("r = fov % 8 AND c = 5 * fov % 8"), 9).otherwise(0))
    peaks.rebuilt = counted
    try:
        found = peaks.prominent_peaks(frames, {"v": (None, 3.0)}, block=4).collect()
    finally:
        peaks.rebuilt = plain
    assert sorted((r.fov, r.first_r, r.first_c, r.area) for r in found) == [(k, k % 8, 5 * k % 8, 1) for k in range(40)]
    assert 0 < calls.value < 40  # 160 blocks, each of them twice at least


def test_blocks_without_home_pixels_and_places_without_pixels_cost_nothing(spark):
    sizes = spark.sparkContext.accumulator(0)
    frame = spark.range(6 * 7).select(F.lit(1).alias("fov"), F.floor(F.col("id") / 7).cast("int").alias("r"), (F.col("id") % 7).cast("int").alias("c"), F.col("id").alias("v"))

    def kernel(grid):
        sizes.add(grid.array("v", 0).size)
        return grid.kept({})

    same = blocks.over_blocks(frame, ["fov"], 16, 15, kernel, frame.schema, tight=True)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, frame.collect()))
    assert sizes.value == 6 * 7
    far = np.arange(6.0).reshape(2, 3)
    assert blocks.moved(far, 3, 0, -1.0).tolist() == blocks.moved(far, 0, -5, -1.0).tolist() == [[-1.0] * 3] * 2


def test_spots_of_a_tile_are_written_to_one_file(spark, tmp_path):
    tiles = F.concat(F.lit("MAX_Pos1_000_00"), (F.col("id") % 10).cast("string"))
    spots = spark.range(0, 1_000, 1, 8).select(tiles.alias("tile_name"), F.col("id").cast("double").alias("m1"), F.lit(1.5).alias("m2"), F.lit(3).alias("j"))
    sinks.write_spot_csvs(spots, str(tmp_path / "spots"))
    assert len(list((tmp_path / "spots").glob("*/*.csv"))) == 10
    got = readers.read_spot_csvs(spark, str(tmp_path / "spots"))
    assert {(r.tile_name, r.lroi_x) for r in got.collect()} == {(f"MAX_Pos1_000_00{k % 10}", float(k)) for k in range(1_000)}


def test_a_task_lists_the_pixels_of_few_cells(spark, tmp_path):
    spark.range(60_000).withColumnRenamed("id", "o_orderkey").write.parquet(str(tmp_path / "orders.parquet"))
    sizes = Inputs(spark, str(tmp_path)).mask.groupBy(F.spark_partition_id().alias("part")).count()
    assert max(r["count"] for r in sizes.collect()) < 800_000


def test_a_matrix_moves_the_genes_a_cell_has(spark):
    counts = [(1, 1, 0, 2), (1, 1, 0, 3), (1, 1, 2, 1), (1, 2, 7, 4), (1, 2, None, 5), (1, 3, 1, None), (2, 1, 1, 6), (2, 9, 1, 8), (None, 1, 1, 9)]
    expr = spark.createDataFrame(counts, "fov int, cell_num bigint, gene_id int, n bigint")
    cells = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (1, 4), (2, 1), (2, 1)], "fov int, cell_num bigint")
    wide = expression.wide_matrix(expr, cells, range(3), ["a", "b", "c"])
    assert "pivotfirst" not in planned(wide) and wide.columns == ["cell_id", "a", "b", "c"]
    got = sorted(map(tuple, wide.collect()))
    assert got == [(10_001, 5, 0, 1), (10_002, 0, 0, 0), (10_003, 0, 0, 0), (10_004, 0, 0, 0), (20_001, 0, 6, 0), (20_001, 0, 6, 0)]


def test_barcode_texts_move_once(spark, tmp_path):
    spark.range(1, 300).withColumnRenamed("id", "o_orderkey").write.parquet(str(tmp_path / "orders.parquet"))
    lines = [(k, 3 * k, k % 5, k % 7 + 1, 1.0) for k in range(1, 300)] * 2 + [(None, 1, 1, 1, 1.0), (4, None, 1, 1, 1.0)]
    columns = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double"
    spark.createDataFrame(lines, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    inputs = Inputs(spark, str(tmp_path))
    with configured(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):  # as on tables that do not fit
        found = barcode_spot_cells(inputs)
        plan = planned(found)
    assert plan.count("Exchange hashpartitioning") == 4  # labels, spots by pixel, cells and texts by spot
    cell_of = assign.assign_by_mask(inputs.spots, inputs.mask).select("spot_id", "fov", "cell_num").distinct()
    wanted = {r.spot_id: (r.cell_num, r.fov * 10_000 + r.cell_num if r.cell_num else None) for r in cell_of.collect() if r.spot_id is not None}
    rows = found.collect()
    assert len(rows) == len(wanted) == 299 and {len(r.seq) for r in rows} == {15}
    assert {r.spot_id: (r.cellidbc, r.cell_id) for r in rows} == wanted and any(r.cell_id for r in rows)


def test_counts_stay_with_cells_dealt_into_parts(spark):
    spots = spark.range(600).select((F.col("id") % 3).cast("int").alias("fov"), (F.col("id") % 7).alias("cell_num"), (F.col("id") % 5).cast("int").alias("gene_id"))
    cells = spots.select("fov", "cell_num").distinct().where("cell_num <> 2")
    plain, dealt = expression.cell_gene_counts(spots, cells), expression.cell_gene_counts(spots, cells, 13)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect())) and plain.count() == 3 * 5 * 5
    totals = expression.total_expression(dealt, cells)
    assert planned(totals).count("REPARTITION_BY_NUM") == 1 and totals.rdd.getNumPartitions() == 13


def test_spot_pixels_are_dealt_once(spark, tmp_path):
    spots = spark.createDataFrame([(k % 4, float(k % 9), 1.2) for k in range(90)] + [(None, 1.0, 1.0), (1, None, 1.0)], "fov int, lroi_x double, lroi_y double")
    mask = spark.createDataFrame([(f, r, 1, 10 * f + r + 1) for f in range(3) for r in range(5)], "fov int, r int, c int, label bigint")
    seen = []
    plain = assign.settle

    def noted(df, *args, **kwargs):
        with configured(spark, assign.IN_PLACE):
            seen.append(planned(df))
        return plain(df, *args, **kwargs)

    assign.settle = noted
    try:
        dealt = assign.assign_by_mask(spots, mask.repartition(5, "fov"), parts=5)
    finally:
        assign.settle = plain
    assert seen[0].count("Exchange hashpartitioning") == 2  # the mask's own and the spot pixels'
    assert sorted(map(str, dealt.collect())) == sorted(map(str, assign.assign_by_mask(spots, mask).collect()))
