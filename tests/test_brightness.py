"""Matched brightness and difference of Gaussians against arrays."""

import math

import numpy as np
import pytest

from spotweave.operators import brightness


def table(spark, image, plane, schema):
    rows = [(*plane, r, c, None if np.isnan(v) else float(v)) for (r, c), v in np.ndenumerate(image)]
    return spark.createDataFrame(rows, f"{schema}, r int, c int, v double")


def back(df, shape):
    out = np.full(shape, np.nan)
    for x in df.collect():
        out[x.r, x.c] = x.v
    return out


def test_brightness_takes_the_template_of_the_same_rank(spark):
    rng = np.random.default_rng(1)
    moving, still = np.floor(rng.random((12, 15)) ** 3 * 50), np.floor(rng.random((9, 9)) * 200)
    got = brightness.match_brightness(table(spark, moving, (0, 2), "fov int, cycle int"), table(spark, still, (0,), "fov int"))
    (values, counts), (other, n) = (np.unique(x, return_counts=True) for x in (moving, still))
    want = np.interp(np.cumsum(counts) / moving.size, np.cumsum(n) / still.size, other)
    assert np.allclose(back(got, moving.shape), want[np.searchsorted(values, moving)], atol=1e-9)
    unknown = brightness.match_brightness(table(spark, moving, (5, 2), "fov int, cycle int"), table(spark, still, (0,), "fov int"))
    assert unknown.count() == 0


def test_levels_of_dark_and_null_images(spark):
    image = np.array([[0.0, 50.0], [np.nan, 100.0]])
    got = back(brightness.grey_levels(table(spark, image, (0, 1), "fov int, cycle int"), ["fov", "cycle"], 11), (2, 2))
    assert got[0].tolist() == [0.0, 5.0] and np.isnan(got[1, 0]) and got[1, 1] == 10.0
    dark = back(brightness.grey_levels(table(spark, image * 0, (0, 1), "fov int, cycle int"), ["fov", "cycle"]), (2, 2))
    assert dark[0].tolist() == [0.0, 0.0] and np.isnan(dark[1, 0])


@pytest.mark.parametrize("block", [4, 64])
def test_difference_of_gaussians_over_blocks(spark, block):
    rng = np.random.default_rng(2)
    image = rng.random((11, 9)) * 100
    image[4, 4] = np.nan
    got = back(brightness.difference_of_gaussians(table(spark, image, (0, 1), "fov int, cycle int"), 0.7, 1.2, block=block, reach=3), image.shape)
    want = np.full(image.shape, np.nan)
    for r, c in np.argwhere(~np.isnan(image)):
        blurred = []
        for sigma in (0.7, 1.2):
            near = [(p, q) for p in range(r - 3, r + 4) for q in range(c - 3, c + 4) if 0 <= p < 11 and 0 <= q < 9 and (p, q) != (4, 4)]
            w = [math.exp(-((p - r) ** 2 + (q - c) ** 2) / (2 * sigma**2)) for p, q in near]
            blurred.append(sum(x * image[at] for x, at in zip(w, near)) / sum(w))
        want[r, c] = blurred[0] - blurred[1]
    assert np.allclose(got, want, atol=1e-9, equal_nan=True)
