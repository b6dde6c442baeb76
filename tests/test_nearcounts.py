"""Counts of near cells against all pairs."""

import random

import numpy as np
import pytest

from spotweave.operators import nearcounts, overlaps

NEURON = "id bigint, slice int, fov int, x double, y double, total bigint"
SHAPES = [nearcounts.disc(20), nearcounts.open_box(16), nearcounts.disc(0.5)]


@pytest.mark.parametrize("shape", SHAPES, ids=["disc", "box", "small"])
@pytest.mark.parametrize("step", [0.5, 1e-3, 7.0])
def test_squares_against_every_point(shape, step):
    rng = np.random.default_rng(3)
    x, y = (rng.integers(0, 60 / step, 4_000) * step - 0.1 for _ in "xy")
    n = rng.integers(1, 4, 4_000)
    squares = nearcounts._Squares(x, y, n, (-0.1, -0.1), 61.0, shape.reach)
    got = squares.counts(x[:300], y[:300], shape)
    near = shape.inside(x[:300, None] - x[None], y[:300, None] - y[None])
    assert got.tolist() == (near * n).sum(axis=1).tolist()


def test_dense_cells_over_many_blocks(spark):
    rng = random.Random(8)
    cells = [(k, 0, rng.randrange(3), rng.randrange(-2000, 2000) / 8, rng.randrange(-300, 300) / 8, 1) for k in range(3_000)]
    got = {r.id: r.n_near for r in overlaps.radius_neighbours(spark.createDataFrame(cells, NEURON), 20).collect()}
    fov, x, y = (np.array([c[k] for c in cells]) for k in (2, 3, 4))
    near = (x[:, None] - x) ** 2 + (y[:, None] - y) ** 2 <= 400
    want = (near & (fov[:, None] != fov)).sum(axis=1)
    assert got == dict(enumerate(want.tolist()))


def test_cells_without_a_place_have_no_neighbours(spark):
    cells = [(1, 0, 0, None, 1.0, 1), (2, 0, 1, float("nan"), 1.0, 1), (3, 0, 0, 0.0, 1.0, 1), (4, 0, 1, 1.0, 2.0, 1), (5, None, 2, 1.0, 2.0, 1)]
    near = overlaps.radius_neighbours(spark.createDataFrame(cells, NEURON), 5)
    assert {r.id: r.n_near for r in near.collect()} == {1: 0, 2: 0, 3: 1, 4: 1, 5: 0}
    boxed = overlaps.overlap_counts(spark.createDataFrame([], NEURON), 5)
    assert boxed.count() == 0
