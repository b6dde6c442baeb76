"""Shifts in fractions of a pixel, shifts of spots, and outlines as runs."""

import random
from collections import Counter

import numpy as np
import pytest

from spotweave.operators import assign, pixels, registration


def blobs(spark, down=0.0, right=0.0, cycle=None):
    rng = np.random.default_rng(5)
    r, c = np.mgrid[0:60, 0:70]
    v = sum(np.exp(-((r - a - down) ** 2 + (c - b - right) ** 2) / 18) for a, b in rng.uniform(15, 45, (6, 2)))
    rows = [(0, int(i), int(j), float(v[i, j])) for i in range(60) for j in range(70)]
    df = spark.createDataFrame(rows, "fov int, r int, c int, v double")
    return df if cycle is None else df.selectExpr("fov", f"{cycle} AS cycle", "r", "c", "v")


def test_a_shift_in_fractions_is_found_and_undone(spark):
    template, moving = blobs(spark), blobs(spark, 1.5, -0.25, cycle=2)
    found = registration.estimate_fine_shift(template, moving, 4, block=32)
    row = found.first()
    assert (row.dr, row.dc) == pytest.approx((1.5, -0.25), abs=0.03)
    back = found.selectExpr("fov", "cycle", "-dr AS dr", "-dc AS dc")
    undone = pixels.apply_fine_shift(moving, back, ["v"], 60, 70, block=32)
    both = undone.join(template.withColumnRenamed("v", "want"), ["fov", "r", "c"])
    assert both.where("abs(v - want) > 0.04").count() == 0 and both.count() == 58 * 70
    raw = moving.join(template.withColumnRenamed("v", "want"), ["fov", "r", "c"])
    assert raw.where("abs(v - want) > 0.2").count() > 0


def test_shift_at_the_edge_of_the_reach_stays_whole(spark):
    row = registration.estimate_fine_shift(blobs(spark), blobs(spark, 3.0, 0.0, cycle=2), 2, block=32).first()
    assert row.dr == 2.0


def test_spot_votes_against_pairs(spark):
    rng = random.Random(6)
    a, b = ([(f, rng.randrange(-40, 60), rng.randrange(-9, 90)) for f in (0, 0, 1) for _ in range(120)] for _ in "ab")
    want = Counter()
    for f, r, c in a:
        want.update((f, y - r, x - c) for g, y, x in b if f == g and abs(y - r) <= 7 and abs(x - c) <= 7)
    frames = [spark.createDataFrame(s, "fov int, r int, c int") for s in (a, b)]
    votes = registration.spot_votes(*frames, 7, block=16)
    assert {(v.fov, v.dr, v.dc): v.vote for v in votes.collect()} == dict(want)


def test_far_and_crowded_spots(spark):
    a = spark.createDataFrame([(0, 10, 900), (0, 30, 950), (0, 800, 20)], "fov int, r int, c int")
    b = a.selectExpr("fov", "r + 481 AS r", "c - 377 AS c")
    assert tuple(registration.spot_shift(a, b, 500).first()) == (0, 481, -377, 3)
    assert registration.spot_shift(a, b, 100).count() == 0
    crowded = np.zeros((2, 5, 5))
    crowded[:, 2, 2] = 70_000_001.0, 60_000_003.0
    crowded[1, 2, 3] = 1.0
    votes = registration.correlated(crowded[0], crowded[1], 1, 3)
    assert (votes[1, 1], votes[1, 2], votes[0, 0]) == (70_000_001 * 60_000_003, 70_000_001, 0)


def inside(px, py, corners):
    odd = False
    for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1]):
        if (x2 - x1) * (py - y1) == (y2 - y1) * (px - x1) and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
            return True
        odd ^= (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1)
    return odd


def test_outline_runs_against_every_point(spark):
    rng = random.Random(7)
    shapes = []
    for k in range(1, 30):
        x, y, size = rng.randrange(-20, 90), rng.randrange(90), rng.choice([4, 12, 90])
        shapes.append((0, k, [(x + rng.randrange(4 * size) / 4, y + rng.randrange(4 * size) / 4) for _ in range(rng.randrange(1, 7))]))
    cells = spark.createDataFrame(
        [(f, k, [p[0] for p in s], [p[1] for p in s]) for f, k, s in shapes]
        + [(0, 50, None, None), (0, 51, [], []), (0, 52, [None, 1.0], [1.0, float("nan")]), (1, 53, [0.0, 9.0, 9.0], [0.0, 0.0, 9.0])],
        "fov int, cell_num bigint, xs array<double>, ys array<double>",
    )
    places = [(x, y) for x in range(-25, 190, 3) for y in range(0, 190, 3)] + [(int(p[0]), int(p[1])) for *_, s in shapes for p in s]
    spots = spark.createDataFrame([(0, float(x), float(y)) for x, y in places], "fov int, lroi_x double, lroi_y double")
    got = {(r.lroi_x, r.lroi_y): r.cell_num for r in assign.assign_by_outline(spots, cells).collect()}
    want = {(x, y): max([k for _, k, s in shapes if inside(x, y, s)], default=0) for x, y in places}
    assert got == want and sum(k > 0 for k in want.values()) > 200
