"""Neighbourhood work on pixel tables, one shuffle and no hot tile.

A frame is cut into square blocks.  Pixels near a block edge are also sent to
the neighbouring blocks (the halo), so any chain of kernels that reaches no
further than the halo can run inside a block.  A tile of any size, or one that
holds a large part of all pixels, spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

HOME = "_home"
STACK_ROWS = 1 << 16  # rows of the blocks that are handed on together
STACK_CELLS = 1 << 18  # places of the arrays that are computed together


def cut_blocks(df: DataFrame, plane: Sequence[str], block: int, halo: int, signed: bool = False) -> DataFrame:
    """Add ``_br``, ``_bc`` and ``_home`` and place every pixel in its blocks; ``signed`` where pixels may lie before 0."""
    if halo > block:
        raise ValueError("the halo may not exceed the block")

    def homes(axis: str) -> Column:
        low = F.floor((F.col(axis) - halo) / block)
        low = low if signed else F.greatest(low, F.lit(0))
        high = F.floor((F.col(axis) + halo) / block)
        return F.sequence(low, high)

    spread = df.withColumn("_br", F.explode(homes("r"))).withColumn("_bc", F.explode(homes("c")))
    home = (F.floor(F.col("r") / block) == F.col("_br")) & (F.floor(F.col("c") / block) == F.col("_bc"))
    # This exchange serves all kernels of a block.
    return spread.withColumn(HOME, home).repartition(*plane, "_br", "_bc")


class Grid:
    """The pixels of one block with its halo, for kernels on arrays: squares, or as large as the pixels if ``tight``."""

    def __init__(self, rows: pa.Table, row: int, col: int, side: int, tight: bool = False):
        self.rows = rows
        places = rows["r"].to_numpy(), rows["c"].to_numpy()
        self.at = tuple(at - (at.min() if tight else start) for at, start in zip(places, (row, col)))
        self.present = np.zeros([at.max() + 1 if tight else side for at in self.at], dtype=bool)
        self.present[self.at] = True

    def array(self, name: str, outside: float) -> np.ndarray:
        """Values of a column as floats; ``outside`` where there is no pixel or its value is null."""
        values = self.rows[name].to_numpy().astype(float)
        out = np.full(self.present.shape, float(outside))
        out[self.at] = np.where(np.isnan(values), outside, values)
        return out

    def kept(self, columns: Mapping[str, np.ndarray], wanted: np.ndarray | None = None) -> pa.Table:
        """Home rows (of ``wanted`` pixels), with the given columns replaced by the arrays' values."""
        keep = self.rows[HOME].to_numpy()
        if wanted is not None:
            keep = keep & wanted[self.at]
        rows = self.rows.filter(pa.array(keep))
        at = tuple(a[keep] for a in self.at)
        for name, values in columns.items():
            rows = rows.set_column(rows.column_names.index(name), name, pa.array(values[at]))
        return rows


class Stack(Grid):
    """The pixels of several blocks as one stack of squares: the block of each row, and the corners of the blocks."""

    def __init__(self, rows: pa.Table, own: np.ndarray, row: np.ndarray, col: np.ndarray, side: int):
        self.rows = rows
        self.at = (own, *(rows[axis].to_numpy() - low[own] for axis, low in (("r", row), ("c", col))))
        self.present = np.zeros((len(row), side, side), dtype=bool)
        self.present[self.at] = True


def row_numbers(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """From 0 on, a number for each run of rows with the same keys."""
    new = np.zeros(rows.num_rows, dtype=bool)
    for name in keys:
        column = pa.chunked_array(rows[name].chunks, rows[name].type).combine_chunks()
        code = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= code[1:] != code[:-1]
    return np.cumsum(new)


def by_stacks(
    placed: DataFrame, keys: Sequence[str], kernel: Callable[[pa.Table, np.ndarray], pa.Table], schema: StructType | str
) -> DataFrame:
    """Run a kernel on whole blocks, many at a time, with the number of the block of each row.

    ``placed`` holds all rows of a block, which have the same ``keys``, in one
    partition.  A block is never cut: at most one and ``STACK_ROWS`` rows are held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, enough = [], 0, STACK_ROWS
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < enough:
                continue
            rows = pa.Table.from_batches(held)
            number = row_numbers(rows, keys)
            cut = int(np.searchsorted(number, number[-1]))  # the last block may go on
            if cut:
                yield from kernel(rows.slice(0, cut), number[:cut]).to_batches()
            held, size = rows.slice(cut).to_batches(), size - cut
            enough = max(STACK_ROWS, 2 * size)
        if size:
            rows = pa.Table.from_batches(held)
            yield from kernel(rows, row_numbers(rows, keys)).to_batches()

    return placed.sortWithinPartitions(*keys).mapInArrow(run, schema)


def over_blocks(
    df: DataFrame,
    plane: Sequence[str],
    block: int,
    halo: int,
    kernel: Callable[[Grid], pa.Table],
    schema: StructType,
    signed: bool = False,
    tight: bool = False,
    stacked: bool = False,
) -> DataFrame:
    """Run a kernel on every block with its halo; one exchange, and no more than a block in a task at a time.

    A kernel keeps home rows only, so a block that is all halo gives none.  ``tight`` is for kernels to which a place
    without a pixel is the same as one beyond the array: their arrays are no larger than the block's pixels.  ``stacked``
    is for kernels that work on a stack of arrays as on one: small blocks then cost no call each.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        if not pc.any(rows[HOME]).as_py():
            return target.empty_table()
        row, col = (k.as_py() * block - halo for k in key[-2:])
        found = kernel(Grid(rows, row, col, block + 2 * halo, tight))
        return typed(found)

    def typed(found: pa.Table) -> pa.Table:
        return pa.table([found[name].cast(kind) for name, kind in zip(target.names, target.types)], schema=target)

    def many(rows: pa.Table, number: np.ndarray) -> pa.Table:
        side, home = block + 2 * halo, rows[HOME].to_numpy()
        wanted = np.unique(number[home])  # others are all halo
        together = max(1, STACK_CELLS // side**2)
        parts = []
        for start in range(0, len(wanted), together):
            chosen = wanted[start : start + together]
            first, last = np.searchsorted(number, chosen), np.searchsorted(number, chosen, side="right")
            own = np.full(chosen[-1] - chosen[0] + 1, -1)
            own[chosen - chosen[0]] = np.arange(len(chosen))
            own = own[number[first[0] : last[-1]] - chosen[0]]
            ours = rows.slice(first[0], last[-1] - first[0]).filter(pa.array(own >= 0))
            corner = [rows[name].to_numpy()[first] * block - halo for name in ("_br", "_bc")]
            parts.append(typed(kernel(Stack(ours, own[own >= 0], *corner, side))))
        return pa.concat_tables(parts) if parts else target.empty_table()

    target = to_arrow_schema(schema)
    if stacked:
        return by_stacks(cut_blocks(df, plane, block, halo, signed), [*plane, "_br", "_bc"], many, schema)
    return cut_blocks(df, plane, block, halo, signed).groupBy(*plane, "_br", "_bc").applyInArrow(run, schema)


def moved(values: np.ndarray, down: int, right: int, outside: float) -> np.ndarray:
    """The value ``down`` rows and ``right`` columns on, ``outside`` beyond the array; of each array of a stack."""
    height, width = values.shape[-2:]
    out = np.full_like(values, outside)
    if abs(down) < height and abs(right) < width:
        out[..., max(0, -down) : height - max(0, down), max(0, -right) : width - max(0, right)] = values[
            ..., max(0, down) : height + min(0, down), max(0, right) : width + min(0, right)
        ]
    return out


def swept(values: np.ndarray, spans: Mapping[int, int], pick: np.ufunc, outside: float) -> np.ndarray:
    """Lowest or highest value under an element given as the half width of each of its lines."""
    wide, lines = values, {0: values}
    for w in range(1, max(spans.values()) + 1):
        wide = pick(wide, pick(moved(values, 0, w, outside), moved(values, 0, -w, outside)))
        lines[w] = wide
    out = np.full_like(values, outside)
    for down, w in spans.items():
        out = pick(out, moved(lines[w], down, 0, outside))
    return out


def is_first_highest(values: np.ndarray, reach: int) -> np.ndarray:
    """Whether a pixel is the highest of its (2*reach+1)-square, the first in (r, c) order on a tie."""
    own = np.arange(values.size).reshape(values.shape)
    top, who = values, own
    for axis in ((0, 1), (1, 0)):
        start, first = top, who
        for step in (d for k in range(1, reach + 1) for d in (-k, k)):
            other = moved(start, axis[0] * step, axis[1] * step, -np.inf)
            index = moved(first, axis[0] * step, axis[1] * step, values.size)
            better = (other > top) | ((other == top) & (index < who))
            top, who = np.where(better, other, top), np.where(better, index, who)
    return who == own
