"""Prominent peaks against floods of every pixel."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotweave.operators import peaks
from spotweave.operators.links import components


def flood(image, start, floor):
    """Pixels reached from ``start`` through pixels above ``floor``."""
    seen, todo = {start}, [start]
    while todo:
        r, c = todo.pop()
        for q in ((r + dr, c + dc) for dr in (-1, 0, 1) for dc in (-1, 0, 1)):
            if q not in seen and 0 <= q[0] < image.shape[0] and 0 <= q[1] < image.shape[1] and image[q] > floor:
                seen.add(q)
                todo.append(q)
    return seen


def wanted(image, threshold, prominence):
    image = np.where(image > threshold, image, 0.0) if threshold is not None else image.astype(float)
    hit = np.zeros(image.shape, dtype=bool)
    for at in np.ndindex(image.shape):
        over = threshold is None or image[at] > threshold
        if over and image[at] - image.min() >= prominence:
            hit[at] = all(image[q] <= image[at] for q in flood(image, at, image[at] - prominence))
    found, left = set(), {tuple(map(int, p)) for p in np.argwhere(hit)}
    while left:
        group = flood(hit, min(left), 0)
        left -= group
        r, c = np.mean(sorted(group), axis=0)
        found.add((*min(group), round(float(r), 9), round(float(c), 9), len(group), float(image[min(group)])))
    return found


def table(spark, images):
    rows = [(f, 1, r, c, float(v)) for f, image in enumerate(images) for (r, c), v in np.ndenumerate(image)]
    return spark.createDataFrame(rows, "fov int, cycle int, r int, c int, ch double")


def found(df):
    out = {}
    for x in df.collect():
        out.setdefault(x.fov, set()).add((x.first_r, x.first_c, round(x.r, 9), round(x.c, 9), x.area, x.v))
    return out


@pytest.mark.parametrize("threshold, prominence, block", [(2.0, 2.0, 4), (None, 3.0, 5), (None, 1.0, 64)])
def test_peaks_against_floods(spark, threshold, prominence, block):
    rng = np.random.default_rng(3)
    noise = rng.integers(0, 7, (13, 17))
    winding = np.zeros((13, 17))  # one long ridge through many blocks, a little higher at one end
    for k, r in enumerate(range(0, 13, 2)):
        winding[r, :] = 5
        winding[min(r + 1, 12), 16 if k % 2 == 0 else 0] = 5
    winding[12, 16] = 6
    flat = np.full((13, 17), 4)
    images = [noise, winding, flat, rng.integers(0, 3, (13, 17)) * 3]
    got = found(peaks.prominent_peaks(table(spark, images), {"ch": (threshold, prominence)}, block=block))
    for f, image in enumerate(images):
        assert got.get(f, set()) == wanted(image, threshold, prominence), f


def test_null_and_absent_pixels_and_empty_images(spark):
    image = np.zeros((6, 6))
    image[1, 1], image[1, 4] = 9, 8
    image[:, 2] = 5
    df = table(spark, [image]).withColumn("ch", F.when(F.col("c") != 3, F.col("ch"))).where("c <> 5")
    got = found(peaks.prominent_peaks(df, {"ch": (None, 1.0)}, block=2))
    assert got == {0: {(1, 1, 1.0, 1.0, 1, 9.0), (1, 4, 1.0, 4.0, 1, 8.0)}}
    assert peaks.prominent_peaks(df.limit(0), {"ch": (1.0, 1.0)}).count() == 0
    with pytest.raises(ValueError):
        peaks.prominent_peaks(df, {"ch": (1.0, 0.0)})


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(900, 901), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {k: 0 for k in range(301)} | {900: 900, 901: 900}


def test_hyb_spots_blank_the_all_genes_channel(spark):
    from spotweave.workflow import call_hyb_spots

    image = np.zeros((4, 12, 12))
    image[0, 2, 2:5] = 90  # a plateau of three pixels in two blocks
    image[1, 8, 8], image[3, 8, 8] = 70, 80  # the stronger channel names both
    image[2, 5, 5] = 99  # all genes
    rows = [(0, 1, r, c, *map(int, image[:, r, c])) for r, c in np.ndindex(12, 12)]
    px = spark.createDataFrame(rows, "fov int, cycle int, r int, c int, g int, t int, a int, c4 int")
    spots, picture = call_hyb_spots(px, {k: (50.0, 10.0) for k in ("g", "t", "a", "c4")}, block=4)
    assert sorted(map(tuple, spots.collect())) == [(0, 2.0, 3.0, 0, 90.0), (0, 8.0, 8.0, 2, 70.0), (0, 8.0, 8.0, 2, 80.0)]
    assert sorted(map(tuple, picture.collect())) == [(0, 2, 3, 1), (0, 8, 8, 3)]
