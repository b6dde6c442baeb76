"""Operators against brute force, with hot keys and odd cases."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spotweave.operators import assign, barcodes, basecall, codebook, expression, layout, overlaps, pixels, ranking, registration
from spotweave.sources import manifest

FEW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ---- numbering --------------------------------------------------------------------


def test_rows_are_numbered_through_all_partitions(spark):
    values = random.Random(1).sample(range(10_000), 3_000)
    df = frame(spark, [(x,) for x in values], "x int").repartition(7)
    got = {r.x: r.row_no for r in ranking.number_rows(df, ["x"]).collect()}
    assert got == {x: k for k, x in enumerate(sorted(values))}


def test_hot_group_is_numbered_like_any_other(spark):
    rows = [(0 if k % 3 else k % 11, k) for k in range(2_000)]  # two thirds of the rows share one key
    df = frame(spark, rows, "g int, x int").repartition(5)
    got = {(r.g, r.x): r.ordinal for r in ranking.number_within(df, ["g"], ["x"]).collect()}
    want = {}
    for g in {g for g, _ in rows}:
        want |= {(g, x): k for k, x in enumerate(sorted(x for h, x in rows if h == g))}
    assert got == want


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [3.0, 1.0, 2.0], [1.0, 1.0, 4.0, 9.0]])
def test_exact_median(spark, values):
    df = frame(spark, [(x,) for x in values], "x double")
    assert ranking.exact_median(df, "x").first()["median"] == np.median(values)


# ---- spots and cells ----------------------------------------------------------------


def test_spots_on_background_and_outside_get_zero(spark):
    mask = frame(spark, [(0, 2, 3, 7), (0, 4, 4, 8)], "fov int, r int, c int, label bigint")
    spots = frame(
        spark, [(0, 2.5, 3.0), (0, 3.5, 4.5), (0, -9.0, 1.0), (1, 2.0, 3.0)], "fov int, lroi_x double, lroi_y double"
    )
    got = {(r.fov, r.lroi_x): r.cell_num for r in assign.assign_by_mask(spots, mask).collect()}
    assert got == {(0, 2.5): 7, (0, 3.5): 8, (0, -9.0): 0, (1, 2.0): 0}


def test_crowded_pixel_keeps_every_spot(spark):
    mask = frame(spark, [(0, 1, 1, 3)], "fov int, r int, c int, label bigint")
    spots = spark.range(5_000).select(F.lit(0).alias("fov"), F.lit(1.0).alias("lroi_x"), F.lit(1.0).alias("lroi_y"), "id")
    got = assign.assign_by_mask(spots, mask)
    assert got.where("cell_num = 3").count() == 5_000


def test_outline_edge_counts_and_last_cell_wins(spark):
    square = lambda x0, x1: ([x0, x0, x1, x1], [0.0, 4.0, 4.0, 0.0])
    cells = frame(
        spark,
        [(0, 1, 2.0, 2.0, *square(0.0, 4.0)), (0, 2, 6.0, 2.0, *square(4.0, 8.0))],
        "fov int, cell_num bigint, cent_x double, cent_y double, xs array<double>, ys array<double>",
    )
    points = [(0, 4.0, 1.0), (0, 1.0, 1.0), (0, 0.0, 0.0), (0, 9.0, 1.0), (0, 7.9, 3.9), (0, 5.0, 5.0)]
    spots = frame(spark, points, "fov int, lroi_x double, lroi_y double")
    got = {(r.lroi_x, r.lroi_y): r.cell_num for r in assign.assign_by_outline(spots, cells).collect()}
    assert got == {(4.0, 1.0): 2, (1.0, 1.0): 1, (0.0, 0.0): 1, (9.0, 1.0): 0, (7.9, 3.9): 2, (5.0, 5.0): 0}


def test_matrix_sums_to_spots_in_listed_cells(spark):
    spots = frame(spark, [(0, 1, 5), (0, 1, 5), (0, 0, 5), (0, 9, 5), (1, 1, 6)], "fov int, cell_num bigint, gene_id int")
    cells = frame(spark, [(0, 1), (0, 2), (1, 1)], "fov int, cell_num bigint")
    expr = expression.cell_gene_counts(spots, cells)
    assert {tuple(r) for r in expr.collect()} == {(0, 1, 5, 2), (1, 1, 6, 1)}
    totals = {(r.fov, r.cell_num): r.total for r in expression.total_expression(expr, cells).collect()}
    assert totals == {(0, 1): 2, (0, 2): 0, (1, 1): 1}


def test_border_and_called_filter(spark):
    assert expression.border_px() == 224
    xs = [223.0, 223.5, 2976.5, 2977.0]
    df = frame(spark, [(x, 1000.0) for x in xs], "lroi_x double, lroi_y double")
    assert [r.k for r in df.select(expression.inside_border().alias("k")).collect()] == [False, True, True, False]
    ids = frame(spark, [(0,), (1,)], "gene_id int")
    assert ids.where(expression.called()).count() == 1
    assert ids.where(expression.called(-1)).count() == 2


def test_label_that_meets_the_next_tile_is_an_error(spark):
    cells = frame(spark, [(0, 9_999), (1, 0), (2, None)], "fov int, cell_num bigint")
    assert [r.id for r in cells.select(assign.global_cell_id().alias("id")).collect()] == [9_999, 10_000, None]
    with pytest.raises(Exception, match="label 10000 of tile 3"):
        frame(spark, [(3, 10_000)], "fov int, cell_num bigint").select(assign.global_cell_id().alias("id")).collect()


def test_marker_spots_agree_with_counts(spark):
    rows = [(0, 1, 5, "a"), (0, 1, 5, "a"), (0, 1, 6, "b"), (0, 0, 5, "c"), (0, 2, None, "d"), (1, 1, 7, "e")]
    spots = frame(spark, rows, "fov int, cell_num bigint, gene_id int, spot_id string")
    markers = {"x": 5, "y": 6, "both": 5}
    got = sorted(tuple(r) for r in expression.marker_spots(spots, markers).collect())
    assert got == [(0, 1, "both", "a"), (0, 1, "both", "a"), (0, 1, "x", "a"), (0, 1, "x", "a"), (0, 1, "y", "b")]
    counts = expression.marker_counts(spots, markers, spots.select("fov", "cell_num").distinct())
    assert {(r.fov, r.cell_num): (r.x_count, r.y_count, r.both_count) for r in counts.collect()}[(0, 1)] == (2, 1, 2)


# ---- cells seen twice -----------------------------------------------------------------


def brute_overlaps(cells, half):
    best, count = {}, {}
    for a, b in itertools.permutations(cells, 2):
        dx, dy = abs(a[3] - b[3]), abs(a[4] - b[4])
        if a[1] == b[1] and a[2] != b[2] and 0 < dx < 2 * half and 0 < dy < 2 * half:
            best[a[0]] = max(best.get(a[0], -1), b[5])
            count[a[0]] = count.get(a[0], 0) + 1
    return best, count


NEURON = "id bigint, slice int, fov int, x double, y double, total bigint"


@FEW
@given(st.integers(0, 10**6), st.sampled_from([6, 40, 300]))
def test_overlaps_against_all_pairs(spark, seed, spread):
    # A small spread piles many cells of many tiles on the same places.
    rng = random.Random(seed)
    cells = [
        (k, rng.randrange(2), rng.randrange(4), rng.randrange(spread) / 2, rng.randrange(spread) / 2, rng.randrange(5))
        for k in range(60)
    ]
    best, count = brute_overlaps(cells, 8)
    neurons = frame(spark, cells, NEURON)
    got = {r.id: r.neigh_exp for r in overlaps.best_neighbour(neurons, 8).collect()}
    assert got == {c[0]: best.get(c[0]) for c in cells}
    counted = {r.id: r.n_overlap for r in overlaps.overlap_counts(neurons, 8).collect()}
    assert counted == {c[0]: count.get(c[0], 0) for c in cells}
    kept = {r.id for r in overlaps.drop_duplicates(neurons, 8).collect()}
    assert kept == {c[0] for c in cells if best.get(c[0], -1) <= c[5]}
    near = {r.id: r.n_near for r in overlaps.radius_neighbours(neurons, 20).collect()}
    want = {
        a[0]: sum(
            1 for b in cells if a[1] == b[1] and a[2] != b[2] and (a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2 <= 400
        )
        for a in cells
    }
    assert near == want


def test_overlap_is_strict_and_ties_stay(spark):
    cells = [(1, 0, 0, 0.0, 0.0, 5), (2, 0, 1, 0.0, 3.0, 9), (3, 0, 1, 16.0, 3.0, 9), (4, 0, 1, 15.0, 3.0, 5)]
    assert {r.id for r in overlaps.drop_duplicates(frame(spark, cells, NEURON), 8).collect()} == {1, 2, 3, 4}


def test_hot_place(spark):
    """A third of all cells in one place of one slice."""
    cells = [(k, 0, k % 50, 10.0, 10.0, k % 7) for k in range(1_000)]
    cells += [(1_000 + k, 0, 99, 12.0, 12.0, k % 9) for k in range(1_000)]
    got = {r.id: (r.neigh_exp, r.total) for r in overlaps.best_neighbour(frame(spark, cells, NEURON), 8).collect()}
    assert all(got[k][0] == 8 for k in range(1_000))
    assert all(got[1_000 + k][0] == 6 for k in range(1_000))


def test_components_chain(spark):
    chain = [(k, 0, k % 2, 10.0 * k, 5.0 * k, 3) for k in range(9)]
    chain[4] = (4, 0, 0, 40.0, 20.0, 7)
    alone = [(50, 0, 0, 500.0, 500.0, 0), (51, 1, 1, 10.0, 5.0, 0)]
    got = {r.id: r.kept for r in overlaps.overlap_components(frame(spark, chain + alone, NEURON), 8).collect()}
    assert {k for k, kept in got.items() if kept} == {4, 50, 51}


@FEW
@given(st.integers(0, 10**6), st.sampled_from([(8, 2), (40, 5), (200, 6)]))
def test_components_against_all_pairs(spark, seed, shape):
    spread, tiles = shape
    rng = random.Random(seed)
    cells = [(k, 0, rng.randrange(tiles), rng.randrange(spread) / 2, rng.randrange(spread) / 2, rng.randrange(9)) for k in range(40)]
    group = {c[0]: c[0] for c in cells}
    for _ in cells:
        for a, b in itertools.permutations(cells, 2):
            dx, dy = abs(a[3] - b[3]), abs(a[4] - b[4])
            if a[2] != b[2] and 0 < dx < 4 and 0 < dy < 4:
                group[a[0]] = group[b[0]] = min(group[a[0]], group[b[0]])
    total = {c[0]: c[5] for c in cells}
    best = {g: min((k for k in group if group[k] == g), key=lambda k: (-total[k], k)) for g in set(group.values())}
    got = {r.id for r in overlaps.overlap_components(frame(spark, cells, NEURON), 2).where("kept").collect()}
    assert got == set(best.values())


# ---- barcodes ----------------------------------------------------------------------------


def brute_collapse(seqs, errors):
    counts = {s: seqs.count(s) for s in set(seqs)}
    kept = []
    for s, n in sorted(counts.items(), key=lambda t: (-t[1], t[0])):
        dist = [sum(x != y for x, y in zip(s, k[0])) for k in kept]
        if dist and min(dist) <= errors:
            kept[dist.index(min(dist))][1] += n
        else:
            kept.append([s, n])
    return {tuple(k) for k in kept}


@FEW
@given(st.integers(0, 10**6), st.sampled_from([1, 2, 3]))
def test_collapse_against_brute_force(spark, seed, errors):
    rng = random.Random(seed)
    cells = {c: ["".join(rng.choice("12") for _ in range(6)) for _ in range(rng.randrange(1, 60))] for c in range(3)}
    spots = frame(spark, [(c, s) for c, seqs in cells.items() for s in seqs], "cell_id bigint, seq string")
    want = {(c, *k) for c, seqs in cells.items() for k in brute_collapse(seqs, errors)}
    assert {(r.cell_id, r.seq, r.n) for r in barcodes.collapse_barcodes(spots, errors).collect()} == want


def test_dominant_needs_more_than_the_count(spark):
    rows = [(1, "1111")] * 4 + [(1, "2222")] * 4 + [(2, "1111")] * 3 + [(3, "1111")] * 3 + [(3, "3333")]
    spots = frame(spark, rows, "cell_id bigint, seq string")
    got = {tuple(r) for r in barcodes.dominant_barcode(spots, count_min=3, errors=1).collect()}
    # Cell 1 ties and the lower sequence leads; cell 2 has too few spots; cell 3 no barcode with enough.
    assert got == {(1, "1111", 4, True), (1, "2222", 4, False)}


def test_library_last_row_wins(spark):
    cells = frame(spark, [(1, "1234"), (2, "1111"), (3, "4444"), (4, "123")], "cell_id bigint, seq string")
    library = frame(spark, [(0, "1234"), (1, "1233"), (2, "1231"), (3, "1112"), (4, "4411")], "barcode_id bigint, sequence string")
    got = {r.cell_id: r.barcode_id for r in barcodes.match_library(cells, library, 4).collect()}
    assert got == {1: 2, 2: 3}


def test_missing_soma_is_not_barcoded(spark):
    cells = frame(spark, [(1,), (2,)], "cell_id bigint")
    soma = frame(spark, [(1, "123412", [0.9] * 6, [200.0] * 6)], "cell_id bigint, seq string, score array<double>, peak array<double>")
    got = barcodes.attach_soma_barcodes(cells, soma, 6).select("cell_id", "missing", barcodes.is_barcoded().alias("b"))
    assert {tuple(r) for r in got.collect()} == {(1, False, True), (2, True, False)}


# ---- pixels --------------------------------------------------------------------------------


def image(spark, arrays, plane=((0, 1),)):
    rows = []
    for (fov, cycle), stack in zip(plane, arrays):
        for r, c in np.ndindex(stack.shape[1:]):
            rows.append((fov, cycle, r, c, *[int(x) for x in stack[:, r, c]]))
    names = ", ".join(f"k{k} int" for k in range(arrays[0].shape[0]))
    return frame(spark, rows, f"fov int, cycle int, r int, c int, {names}")


def back(df, channel, shape):
    out = np.zeros(shape)
    for row in df.select("r", "c", channel).collect():
        out[row.r, row.c] = row[channel]
    return out


def grey_opening(a, kernel):
    h = kernel.shape[0] // 2
    inside = [(dr - h, dc - h) for dr, dc in np.argwhere(kernel)]

    def sweep(img, pick, fill):
        padded = np.pad(img, h, constant_values=fill)
        return pick([padded[h + dr : h + dr + img.shape[0], h + dc : h + dc + img.shape[1]] for dr, dc in inside], axis=0)

    return sweep(sweep(a, np.min, 10**9), np.max, -(10**9))


@pytest.mark.parametrize("block", [8, 64])
@pytest.mark.parametrize("shape,size", [("ellipse", 7), ("square", 5)])
def test_background_over_blocks(spark, block, shape, size):
    a = np.random.default_rng(3).integers(0, 200, (1, 21, 26))
    half = size // 2
    kernel = np.ones((size, size), bool)
    if shape == "ellipse":
        kernel = np.array([[abs(dc) <= pixels.ellipse_spans(size)[dr] for dc in range(-half, half + 1)] for dr in range(-half, half + 1)])
    got = pixels.subtract_background(image(spark, [a]), ["k0"], size=size, shape=shape, block=block)
    assert (back(got, "k0", a.shape[1:]) == a[0] - grey_opening(a[0], kernel)).all()


def test_ellipse_of_five():
    assert pixels.ellipse_spans(5) == {-2: 0, -1: 2, 0: 2, 1: 2, 2: 0}


def test_alignment_moves_whole_pixels(spark):
    a = np.arange(1, 41).reshape(1, 5, 8)
    got = pixels.align_channels(image(spark, [a]), ["k0"], [(2.0, -1.0)], block=4)
    want = np.zeros((5, 8))
    want[:4, 2:] = a[0, 1:, :-2]
    assert (back(got, "k0", (5, 8)) == want).all()


def test_unmix_inverts_the_profile(spark):
    true = np.array([[[100.0]], [[50.0]], [[30.0]], [[200.0]]])
    seen = np.round(np.asarray(pixels.BLEED_PROFILE).T @ true[:, 0, 0])
    got = pixels.unmix(image(spark, [seen[:, None, None]]), ["k0", "k1", "k2", "k3"]).first()
    assert [got.k0, got.k1, got.k2, got.k3] == pytest.approx([100, 50, 30, 200], abs=1)


def test_unknown_channel(spark):
    with pytest.raises(ValueError, match="no such channel"):
        pixels.select_channels(image(spark, [np.ones((1, 2, 2))]), ["k9"])


def test_plateau_has_one_peak_and_neighbours_are_suppressed(spark):
    a = np.zeros((1, 9, 9))
    a[0, 2, 2] = a[0, 2, 3] = 50
    a[0, 7, 7] = 20
    found = pixels.find_peaks(image(spark, [a]), {"k0": (30, 10)}, block=4)
    assert [(r.r, r.c) for r in found.collect()] == [(2, 2)]
    peaks = [(0, 4, 4), (0, 5, 5), (0, 1, 1), (0, 2, 1), (0, 8, 1)]
    kept = pixels.suppress_adjacent(frame(spark, peaks, "fov int, r int, c int"))
    # (4, 4) has a peak at (r+1, c+1) and (2, 1) one at (r-1, c).
    assert {(r.r, r.c) for r in kept.collect()} == {(5, 5), (1, 1), (8, 1)}


@pytest.mark.parametrize("block", [8, 32])
def test_shift_is_found_over_blocks(spark, block):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 50, (20, 20)) + 500 * (rng.random((20, 20)) > 0.9)
    moved = np.zeros_like(a)
    moved[2:, :-3] = a[:-2, 3:]
    template = image(spark, [a[None]]).select("fov", "r", "c", F.col("k0").cast("double").alias("v"))
    other = image(spark, [moved[None]], ((0, 2),)).select("fov", "cycle", "r", "c", F.col("k0").cast("double").alias("v"))
    best = registration.estimate_shift(template, other, 4, block=block).first()
    assert (best.dr, best.dc) == (2, -3)


def test_expanded_label_prefers_near_then_low(spark):
    mask = frame(spark, [(0, 5, 2, 9), (0, 5, 6, 4)], "fov int, r int, c int, label bigint")
    got = {(r.r, r.c): r.label for r in pixels.expand_labels(mask, 10, 10, 3).collect()}
    assert got[(5, 3)] == 9 and got[(5, 5)] == 4 and got[(5, 4)] == 4
    assert (9, 2) not in got and got[(5, 2)] == 9


# ---- calls and decoding ---------------------------------------------------------------------


def test_too_few_good_pixels_are_no_calls(spark):
    px = frame(spark, [(0, t, 0, c, 100, 1) for t in (1, 2) for c in range(3)], "fov int, cycle int, r int, c int, a int, b int")
    mask = frame(spark, [(0, 0, 0, 1), (0, 0, 1, 1), (0, 0, 2, 2)], "fov int, r int, c int, label bigint")
    got = basecall.call_somata_good(mask, px, ["a", "b"], threshold=0.85, min_pixels=1).where("cycle = 1")
    assert {(r.label, r.base, r.a) for r in got.collect()} == {(1, 1, 100.0), (2, 5, 0.0)}


def test_no_threshold_is_null(spark):
    curve = frame(spark, [(0, 0.5, 0.9), (1, 0.6, 0.8)], "step int, threshold double, fdr double")
    assert basecall.pick_threshold(curve).first()["threshold"] is None
    better = frame(spark, [(0, 0.5, 0.9), (1, 0.6, 0.04), (2, 0.7, 0.01)], "step int, threshold double, fdr double")
    assert basecall.pick_threshold(better).first()["threshold"] == 0.6


def test_decode_finds_the_code(spark):
    book = frame(spark, [(0, "A", "GT"), (1, "B", "TC"), (2, "unused-1", "CC")], "gene_id int, gene string, sequence string")
    table = basecall.code_table(book, 2)
    signals = frame(
        spark, [(0, 0, 0, [9.0, 0.0, 0.0, 0.0, 0.0, 8.0, 0.0, 0.0]), (0, 0, 1, [0.0, 7.0, 0.0, 0.0, 0.0, 0.0, 0.0, 7.0])], "fov int, r int, c int, sig array<double>"
    )
    got = {r.c: (r.gene_id, r.control) for r in basecall.decode(signals, table, 0.001).collect()}
    assert got == {0: (0, False), 1: (1, False)}


def test_controls_are_new_and_stable(spark):
    book = frame(spark, [(0, "A", "GG"), (1, "B", "TC")], "gene_id int, gene string, sequence string")
    first = [tuple(r) for r in codebook.add_controls(book, 4, 2).orderBy("gene_id").collect()]
    again = [tuple(r) for r in codebook.add_controls(book, 4, 2).orderBy("gene_id").collect()]
    assert first == again and len({s for _, _, s in first}) == 6
    assert [g for _, g, _ in first[2:]] == [f"unused-{k}" for k in range(1, 5)]


# ---- layout ------------------------------------------------------------------------------------

# Stitched tile positions (y, x) of two published positions, to one decimal.
GOLDEN = {
    1: [(11.1, 2487.1), (0.0, 10.9), (2496.6, 2476.2), (2485.5, 0.0)],
    2: [(11.2, 2491.2), (0.0, 11.5), (2495.6, 2479.8), (2484.7, 0.0)],
}


def test_placement_gives_the_published_positions(spark):
    offsets = []
    for s, tiles in GOLDEN.items():
        for a, b in ((0, 1), (0, 2), (1, 3)):
            offsets.append((s, a, b, tiles[b][1] - tiles[a][1], tiles[b][0] - tiles[a][0]))
    placed = layout.place_tiles(frame(spark, offsets, "slice int, tile_a int, tile_b int, dx double, dy double"))
    scaled = layout.rescale_positions(placed).collect()
    for row in scaled:
        y, x = GOLDEN[row.slice][row.tile]
        assert (row.pos_y, row.pos_x) == pytest.approx((y, x))
        assert (row.ref_x, row.ref_y) == (row.pos_x * 0.5, row.pos_y * 0.5)


def test_lowest_neighbour_places_a_tile(spark):
    # Tile 3 can be reached from 1 and from 2 with different offsets; tile 1 decides.
    offsets = [(0, 0, 1, 10.0, 0.0), (0, 0, 2, 0.0, 10.0), (0, 1, 3, 0.0, 11.0), (0, 2, 3, 12.0, 0.0)]
    placed = layout.place_tiles(frame(spark, offsets, "slice int, tile_a int, tile_b int, dx double, dy double"))
    assert {r.tile: (r.pos_x, r.pos_y) for r in placed.collect()}[3] == (10.0, 11.0)


def test_snake(spark):
    grid = frame(spark, [(c, r) for r in range(3) for c in range(2)], "col int, row int")
    got = {(r.col, r.row): r.n for r in grid.select("*", layout.snake_number(F.col("col"), F.col("row"), 2, 3).alias("n")).collect()}
    assert got == {(1, 2): 1, (0, 2): 2, (0, 1): 3, (1, 1): 4, (1, 0): 5, (0, 0): 6}
    line = frame(spark, [(0, 0), (1, 0)], "col int, row int")
    assert [r.n for r in line.select(layout.snake_number(F.col("col"), F.col("row"), 2, 1).alias("n")).collect()] == [1, 2]


def test_transform_swaps_the_axes(spark):
    spots = frame(spark, [(0, 10.0, 20.0)], "fov int, lroi_x double, lroi_y double")
    tforms = frame(spark, [(0, 0.5, 100.0, 7.0)], "fov int, scale double, pos_x double, pos_y double")
    got = layout.to_global(spots, tforms).first()
    assert (got.pos10_x, got.pos10_y) == (110.0, 12.0)


# ---- files ---------------------------------------------------------------------------------------


def test_manifest_from_a_folder(spark, tmp_path):
    for path in (
        "geneseq01/MAX_Pos1_000_000.tif", "geneseq01/MAX_Pos12_000_001.tif", "geneseq02/MAX_Pos1_000_000.tif",
        "hyb01/MAX_Pos1_000_000.dn.tif", "hyb01/notes.txt", "other/MAX_Pos1_000_000.tif",
    ):
        (tmp_path / path).parent.mkdir(exist_ok=True)
        (tmp_path / path).write_text("x")
    listed = manifest.scan_manifest(manifest.list_files(spark, str(tmp_path)))
    assert {(r["mode"], r.cycle, r.position, r.col, r.row) for r in listed.collect()} == {
        ("geneseq", 0, "1", 0, 0), ("geneseq", 0, "12", 0, 1), ("geneseq", 1, "1", 0, 0), ("hyb", 0, "1", 0, 0),
    }
    missing = {(r["mode"], r.cycle, r.position) for r in manifest.missing_files(listed).collect()}
    assert missing == {("geneseq", 1, "12"), ("hyb", 0, "12")}


def test_files_without_groups_go_to_one_position(spark):
    paths = frame(spark, [("hyb1/b.tif",), ("hyb1/a.tif",), ("hyb2/c.tif",)], "path string")
    got = manifest.scan_manifest(paths, tiles=[r"[abc]"])
    assert {(r.cycle, r.position, r.col, r.row, r.path) for r in got.collect()} == {
        (0, "0", 0, 0, "hyb1/a.tif"), (0, "0", 1, 0, "hyb1/b.tif"), (1, "0", 0, 0, "hyb2/c.tif"),
    }


def test_tile_sets_pair_by_tile_not_by_order(spark):
    rows = [("geneseq", 0, "1", 0, 0, "g1/a"), ("geneseq", 0, "1", 0, 1, "g1/b"), ("hyb", 0, "1", 0, 1, "h1/b")]
    sets = manifest.file_sets(frame(spark, rows, "mode string, cycle int, position string, col int, row int, path string"), "tileset", ["geneseq", "hyb"])
    assert {(r.set_key, r.ordinal, r.path) for r in sets.collect()} == {("1/0/0", 0, "g1/a"), ("1/0/1", 0, "g1/b"), ("1/0/1", 1, "h1/b")}


def test_bucketed_tables_join_in_place(spark, tmp_path):
    from spotweave.sources.sinks import store_by_pixel

    px = image(spark, [np.arange(60).reshape(1, 6, 10)])
    mask = px.select("fov", "r", "c", (F.col("c") % 3 + 1).cast("long").alias("label"))
    store_by_pixel(px, "px_stored", 4, str(tmp_path / "px"))
    store_by_pixel(mask, "mask_stored", 4, str(tmp_path / "mask"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = pixels.label_signal(spark.table("mask_stored"), spark.table("px_stored"), ["k0"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        # Only the final sums move.
        assert plan.count("Exchange hashpartitioning") == 1
        want = pixels.label_signal(mask, px, ["k0"])
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_schemas(spark):
    from spotweave import schemas

    df = frame(spark, [(1, 2.0, 3.0, 4, 5.0, "x")], "fov bigint, lroi_x double, lroi_y double, gene_id bigint, signal double, extra string")
    assert schemas.conform(df, "spots").schema.simpleString() == "struct<fov:int,lroi_x:double,lroi_y:double,gene_id:int,signal:double>"
    with pytest.raises(ValueError, match="missing columns: label"):
        schemas.conform(df, "fov INT, label BIGINT")
    assert schemas.pixels(["a", "b"]).endswith("c INT, a INT, b INT")


def test_collapse_of_unequal_and_long_barcodes(spark):
    draw = random.Random(3)
    long = "".join(draw.choice("ACGT") for _ in range(300))
    near = long[:150] + ("A" if long[150] != "A" else "C") + long[151:]
    far = near[:20] + ("G" if near[20] != "G" else "T") * 3 + near[23:]
    rows = [(3, "ACGTACGT")] * 3 + [(3, "ACGT")] * 2 + [(4, long)] * 5 + [(4, near)] * 2 + [(4, far)] + [(5, "A")] * 2 + [(5, "C"), (5, "")]
    spots = spark.createDataFrame(rows, "cell_id long, seq string")
    apart = sum(x != y for x, y in zip(long, far)) > 2
    got = {tuple(r) for r in barcodes.collapse_barcodes(spots, 2).collect()}
    assert got == {(3, "ACGTACGT", 3), (3, "ACGT", 2), (4, long, 7 if apart else 8), (5, "A", 3), (5, "", 1)} | ({(4, far, 1)} if apart else set())


@pytest.mark.parametrize("reach, block", [(40, 16), (256, 256)])
def test_shifts_far_beyond_a_block(spark, reach, block):
    rng = np.random.default_rng(11)
    image = rng.integers(0, 50, (60, 50))
    down, right = -37, 29
    at = [(int(r), int(c)) for r in range(60) for c in range(50)]
    still = frame(spark, [(1, r + 300, c + 300, float(image[r, c])) for r, c in at], "fov int, r int, c int, v double")
    other = frame(spark, [(1, 2, r + 300 + down, c + 300 + right, float(image[r, c])) for r, c in at], "fov int, cycle int, r int, c int, v double")
    best = registration.estimate_shift(still, other, reach, block=block).first()
    assert (best.dr, best.dc, best.vote) == (down, right, float((image**2).sum()))


def test_votes_of_all_shifts_against_products():
    rng = np.random.default_rng(12)
    fixed, moving = (rng.integers(0, 9, (14, 14)).astype(float) for _ in range(2))
    votes = registration.correlated(fixed, moving, 3, 8)
    want = [[(fixed[3:11, 3:11] * moving[3 + dr : 11 + dr, 3 + dc : 11 + dc]).sum() for dc in range(-3, 4)] for dr in range(-3, 4)]
    assert (votes == np.array(want)).all() and registration.good_size(13) == 15


def test_median_of_mostly_equal_values(spark):
    from spotweave.operators.ranking import exact_median

    for values in ([5.0] * 90 + [1.0, 9.0, 7.5], [1.0, 2.0], [3.0], [1.0] * 4 + [2.0] * 4):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        assert exact_median(df, "v").first()["median"] == float(np.median(values))
    assert exact_median(spark.createDataFrame([], "v double"), "v").first()["median"] is None
