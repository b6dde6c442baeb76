"""Number of cells around each cell, without a row per pair.

The plane is cut into blocks with a halo, and a block into small squares whose
points are counted once.  Per row of squares, those wholly inside the shape
around a cell are added as one difference of running sums; only points in
squares on its border are tested one by one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

TESTED = 1_000_000  # points tested at once
LEAST_BLOCK = 1024.0  # width of a block of cells
Widths = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Shape:
    """What counts as near: ``inside(dx, dy)`` decides.

    ``widths(near, far, own)`` are the half widths, in a row of squares at a
    distance from ``near`` to ``far``, of the part that may hold and of the part
    that only holds near points; negative where there is none.  ``own`` marks
    the cell's own row.
    """

    reach: float
    widths: Widths
    inside: Callable[[np.ndarray, np.ndarray], np.ndarray]


def disc(radius: float) -> Shape:
    """Points at most ``radius`` away."""
    r = float(radius)

    def widths(near, far, own):
        half = lambda d: np.where(d <= r, np.sqrt(np.maximum(r * r - d * d, 0.0)), -1.0)
        return half(near), half(far)

    return Shape(r, widths, lambda dx, dy: dx * dx + dy * dy <= r * r)


def open_box(reach: float) -> Shape:
    """Points nearer than ``reach`` on both axes and level on neither."""
    w = float(reach)

    def widths(near, far, own):
        return np.where(near < w, w, -1.0), np.where((far < w) & ~own, w, -1.0)

    def inside(dx, dy):
        dx, dy = np.abs(dx), np.abs(dy)
        return (dx > 0) & (dx < w) & (dy > 0) & (dy < w)

    return Shape(w, widths, inside)


class _Squares:
    """Weighted points sorted by square, with running sums."""

    def __init__(self, x: np.ndarray, y: np.ndarray, n: np.ndarray, corner: tuple[float, float], extent: float, reach: float):
        per_reach = int(np.clip(np.sqrt(len(x)) / 2 * reach / extent, 1, 128))  # a few points a square
        self.side = reach / per_reach
        self.many = int(extent / self.side) + 2
        self.corner = corner
        at = self.square(y, 1) * self.many + self.square(x, 0)
        order = np.argsort(at, kind="stable")
        self.x, self.y, self.n = x[order], y[order], n[order]
        self.first = np.searchsorted(at[order], np.arange(self.many * self.many + 1))
        self.upto = np.concatenate([[0], np.cumsum(self.n)])

    def square(self, v: np.ndarray, axis: int) -> np.ndarray:
        return np.clip(np.floor((v - self.corner[axis]) / self.side).astype(np.int64), 0, self.many - 1)

    def counts(self, qx: np.ndarray, qy: np.ndarray, shape: Shape) -> np.ndarray:
        total = np.zeros(len(qx), dtype=np.int64)
        column, row = self.square(qx, 0), self.square(qy, 1)
        lx, ly = qx - self.corner[0], qy - self.corner[1]
        slack = self.side * 1e-6  # squares are cut in floating point
        rows_away = int(shape.reach / self.side) + 1
        for step in range(-rows_away, rows_away + 1):
            who = np.flatnonzero((row + step >= 0) & (row + step < self.many))
            if not len(who):
                continue
            line, own, x = row[who] + step, column[who], lx[who]
            low = line * self.side - ly[who]
            high = low + self.side
            near = np.maximum(np.maximum(low, -high) - slack, 0.0)
            far = np.maximum(np.abs(low), np.abs(high)) + slack
            outer, inner = shape.widths(near, far, np.full(len(who), step == 0))
            left = np.clip(np.floor((x - outer - slack) / self.side).astype(np.int64), 0, self.many)
            right = np.clip(np.floor((x + outer + slack) / self.side).astype(np.int64) + 1, left, self.many)
            right = np.where(outer < 0, left, right)
            # Whole squares on both sides of the own one, which is tested: [from_, own) and [own + 1, to).
            from_ = np.clip(np.ceil((x - inner + slack) / self.side).astype(np.int64), left, np.maximum(own, left))
            to = np.clip(np.floor((x + inner - slack) / self.side).astype(np.int64), np.minimum(own + 1, right), right)
            none = inner < 0
            from_, to = np.where(none, np.maximum(own, left), from_), np.where(none, np.minimum(own + 1, right), to)
            at = lambda c: self.first[line * self.many + c]
            middle, after = np.clip(own, left, right), np.clip(own + 1, left, right)
            from_, to = np.minimum(from_, middle), np.maximum(to, after)
            total[who] += self.upto[at(middle)] - self.upto[at(from_)] + self.upto[at(to)] - self.upto[at(after)]
            for a, b in ((left, from_), (middle, after), (to, right)):
                self._test(qx, qy, who, at(a), at(b), shape, total)
        return total

    def _test(self, qx, qy, who, start, end, shape: Shape, total: np.ndarray) -> None:
        held = end > start
        who, start, many = who[held], start[held], (end - start)[held]
        upto = np.cumsum(many)
        begin = 0
        while begin < len(who):
            done = upto[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(upto, done + TESTED, side="right")))
            size = many[begin:stop]
            asked = np.repeat(np.arange(stop - begin), size)
            point = np.arange(len(asked)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start[begin:stop], size)
            q = who[begin:stop][asked]
            ok = shape.inside(qx[q] - self.x[point], qy[q] - self.y[point])
            np.add.at(total, q[ok], self.n[point[ok]])
            begin = stop


def other_tile_counts(sites: DataFrame, shape: Shape, name: str) -> DataFrame:
    """``slice, x, y, fov, name``: cells of other tiles that are near a site, all near ones less those of its own tile.

    ``sites(slice, x, y, fov, n)`` has one row per place and tile, with its
    number of cells.  A block is four reaches wide, ``LEAST_BLOCK`` at least, so
    that a short reach does not make a group of every few cells; with its halo
    it is all that a task holds.  Sites with a missing coordinate are left out.
    """
    reach = shape.reach
    block = max(4 * reach, LEAST_BLOCK)

    def homes(axis: str):
        return F.explode(F.sequence(F.floor((F.col(axis) - reach) / block), F.floor((F.col(axis) + reach) / block)))

    known = sites.select("slice", "x", "y", "fov", F.col("n").cast("long").alias("n"))
    known = known.where("NOT isnan(x) AND NOT isnan(y)")
    placed = known.withColumn("_bx", homes("x")).withColumn("_by", homes("y"))
    schema = known.withColumnRenamed("n", name).schema
    target = to_arrow_schema(schema)

    def count(key: tuple, rows: pa.Table) -> pa.Table:
        corner = tuple(k.as_py() * block - reach for k in key[1:])
        x, y = (rows[c].cast(pa.float64()).to_numpy() for c in ("x", "y"))
        n, fov = rows["n"].to_numpy(), rows["fov"].to_numpy()
        home = (np.floor(x / block) == key[1].as_py()) & (np.floor(y / block) == key[2].as_py())
        near = np.zeros(len(x), dtype=np.int64)
        extent = block + 2 * reach
        if home.any():
            near[home] = _Squares(x, y, n, corner, extent, reach).counts(x[home], y[home], shape)
        for tile in np.unique(fov[home]):
            own = fov == tile
            asked = own & home
            near[asked] -= _Squares(x[own], y[own], n[own], corner, extent, reach).counts(x[asked], y[asked], shape)
        kept = rows.filter(pa.array(home))
        columns = [kept[c].combine_chunks() for c in ("slice", "x", "y", "fov")] + [pa.array(near[home], pa.int64())]
        return pa.table([c.cast(kind) for c, kind in zip(columns, target.types)], schema=target)

    return placed.groupBy("slice", "_bx", "_by").applyInArrow(count, schema)
