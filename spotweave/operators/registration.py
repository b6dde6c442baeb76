"""Whole-pixel displacement between cycles, from pixels, label masks or spots."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.operators.blocks import HOME, STACK_CELLS, by_stacks, cut_blocks

VOTES = "fov int, cycle int, part int, votes array<double>"
EXACT = 2.0**42  # products of whole images up to this norm leave transforms exact
DIGIT = 2.0**12  # larger ones are cut into digits of this size
PER_SHIFT = 100  # cost of one shift of few pixels, in pixels
DIRECT = 5  # transforms cost as much as this many passes for each doubling of a block's pixels
SPOT_BLOCK = 1024  # spots are few, so their blocks are wide


def vote_arrays(template: DataFrame, moving: DataFrame, reach: int, block: int = 256) -> DataFrame:
    """``fov, cycle, votes``: the sum of products of template and moved image for every shift within ``reach``.

    ``template(fov, r, c, v)`` is compared with every cycle of
    ``moving(fov, cycle, r, c, v)``.  ``votes`` holds the shifts from
    (-reach, -reach) to (reach, reach), row by row.  Each block of pixels, with
    a halo, is correlated at all shifts at once; a block is one array, and
    arrays are added along rows of blocks and then over these, so no frame is
    ever whole in one task.  The template's block is held once for all cycles of
    its tile, and small blocks are handled many at a time.  Images of whole
    numbers give whole votes, which tie exactly while they fit 53 bits; others
    are exact to about 1e-12 of the largest.  Pixels may lie before 0.
    """
    block = max(block, reach)  # a halo reaches the next blocks only
    side, width = block + 2 * reach, 2 * reach + 1
    image = lambda df, cycle, still: df.select("fov", cycle.cast("int").alias("cycle"), F.lit(still).alias("_still"), "r", "c", F.col("v").cast("double").alias("v"))
    # A null tile meets no other null one.
    both = image(template.where("fov IS NOT NULL"), F.lit(None), True).unionByName(image(moving, F.col("cycle"), False))
    placed = cut_blocks(both, ["fov"], block, reach, signed=True).where(f"{HOME} OR NOT _still")  # no template in the halo
    by_shift = width * width <= DIRECT * np.log2(side * side) and width * width * PER_SHIFT > side * side

    def score(rows: pa.Table, number: np.ndarray) -> pa.Table:
        still = rows["_still"].to_numpy()
        v = rows["v"].to_numpy()
        r, c = (rows[axis].to_numpy() - rows[at].to_numpy() * block + reach for axis, at in (("r", "_br"), ("c", "_bc")))
        # An image is a block of a cycle.
        theirs = np.flatnonzero(~still)
        cycle = pa.chunked_array(rows["cycle"].chunks, pa.int32()).combine_chunks().take(pa.array(theirs))
        code = cycle.dictionary_encode(null_encoding="encode").indices.to_numpy()
        _, first, of = np.unique(number[theirs] * (code.max(initial=0) + 1) + code, return_index=True, return_inverse=True)
        owner = number[theirs[first]]
        ours = np.flatnonzero(still)
        bounds = [np.searchsorted(number[ours], owner, side) for side in ("left", "right")]
        theirs, of = theirs[np.argsort(of, kind="stable")], np.sort(of)
        limits = np.searchsorted(of, np.arange(len(owner) + 1))

        def voted_alone(k: int) -> np.ndarray:
            f, m = ours[bounds[0][k] : bounds[1][k]], theirs[limits[k] : limits[k + 1]]
            at = np.concatenate([f, m])
            fixed, moved = np.append(v[f], np.zeros(len(m))), np.append(np.zeros(len(f)), v[m])
            votes = paired(r[at], c[at], fixed, moved, reach, side)
            if votes is not None:
                return votes
            dense = lambda x: np.bincount(r[at] * side + c[at], weights=x, minlength=side * side).reshape(side, side)
            return correlated(dense(fixed), dense(moved), reach, block)

        def voted_together(chosen: np.ndarray) -> np.ndarray:
            def stack(parts: list[np.ndarray]) -> np.ndarray:
                own, at = np.repeat(np.arange(len(parts)), [len(p) for p in parts]), np.concatenate(parts)
                return np.bincount((own * side + r[at]) * side + c[at], weights=v[at], minlength=len(parts) * side * side).reshape(-1, side, side)

            fixed = stack([ours[bounds[0][k] : bounds[1][k]] for k in chosen])
            return shifted_products(fixed, stack([theirs[limits[k] : limits[k + 1]] for k in chosen]), reach, block)

        votes = np.empty((len(owner), width, width))
        alone = np.ones(len(owner), dtype=bool)
        if by_shift:  # a pixel without a number makes all votes of its block so
            odd = np.zeros(number[-1] + 1, dtype=bool)
            odd[number[~np.isfinite(v)]] = True
            alone = odd[owner]
            rest, together = np.flatnonzero(~alone), max(1, STACK_CELLS // side**2)
            for start in range(0, len(rest), together):
                chosen = rest[start : start + together]
                votes[chosen] = voted_together(chosen)
        for k in np.flatnonzero(alone):
            votes[k] = voted_alone(k)
        at = pa.array(theirs[limits[:-1]]) if len(owner) else pa.array([], pa.int64())
        names = {"fov": "fov", "cycle": "cycle", "part": "_br"}
        columns = [rows[name].take(at).cast(pa.int32()) for name in names.values()]
        listed = pa.FixedSizeListArray.from_arrays(pa.array(votes.ravel()), width * width).cast(pa.list_(pa.float64()))
        return pa.table([*columns, listed], [*names, "votes"])

    blocks = by_stacks(placed.select("fov", "_br", "_bc", "cycle", "_still", "r", "c", "v"), ["fov", "_br", "_bc"], score, VOTES)
    add = lambda x, y: F.zip_with(x, y, lambda u, v: u + v)
    for keys in (["fov", "cycle", "part"], ["fov", "cycle"]):  # one array for each block in a row, then for each row
        listed = blocks.groupBy(*keys).agg(F.collect_list("votes").alias("_all"))
        rest = F.expr("slice(_all, 2, size(_all) - 1)")
        blocks = listed.select(*keys, F.aggregate(rest, F.col("_all")[0], add).alias("votes"))
    return blocks.select("fov", "cycle", "votes")


def shifted_products(fixed: np.ndarray, moving: np.ndarray, reach: int, block: int) -> np.ndarray:
    """Votes of each block of a stack, shift by shift: few passes while the reach is short."""
    inner, width = fixed[:, reach : reach + block, reach : reach + block], 2 * reach + 1
    votes = np.empty((len(fixed), width, width))
    for down in range(width):
        for right in range(width):
            votes[:, down, right] = np.einsum("nij,nij->n", inner, moving[:, down : down + block, right : right + block])
    return votes


def paired(r: np.ndarray, c: np.ndarray, f: np.ndarray, m: np.ndarray, reach: int, side: int) -> np.ndarray | None:
    """The votes of few whole pixels in a wide block, shift by shift without an image; None where transforms cost less."""
    width = 2 * reach + 1
    held = [np.flatnonzero(v) for v in (f, m)]
    if width * width * (PER_SHIFT + len(held[0])) > side * side:
        return None
    if not all((v == np.rint(v)).all() and np.isfinite(v).all() for v in (f, m)) or np.abs(f).sum() * np.abs(m).sum() >= 2.0**53:
        return None
    line = side + 2 * reach  # wide enough that no shift leads to another row
    at = lambda k: (r[k] + reach) * line + c[k] + reach
    places, which = np.unique(at(held[1]), return_inverse=True)
    weight = np.append(np.bincount(which, weights=m[held[1]], minlength=len(places)), 0.0)
    places = np.append(places, -1)  # found by nothing
    start, own = at(held[0]), f[held[0]]
    votes = np.zeros((width, width))
    for down in range(width):
        for right in range(width):
            wanted = start + (down - reach) * line + (right - reach)
            found = np.searchsorted(places[:-1], wanted)
            votes[down, right] = (own * weight[found])[places[found] == wanted].sum()
    return votes


def correlated(fixed: np.ndarray, moving: np.ndarray, reach: int, block: int) -> np.ndarray:
    """Votes of all shifts within ``reach`` of the inner ``block`` of ``fixed`` over ``moving``; both have a halo of ``reach``."""
    inner = fixed[reach : reach + block, reach : reach + block]
    whole = all((v == np.rint(v)).all() for v in (inner, moving))
    held = [np.flatnonzero(inner.any(axis=a)) for a in (1, 0)]
    if not len(held[0]):
        return np.zeros((2 * reach + 1,) * 2)
    # Only the part that holds pixels counts; the halo keeps shifts within reach from wrapping around.
    (top, left), (low, right) = ([h[i] for h in held] for i in (0, -1))
    inner = inner[top : low + 1, left : right + 1]
    moving = moving[top : low + 1 + 2 * reach, left : right + 1 + 2 * reach]
    return _whole_votes(inner, moving, reach) if whole else _votes(inner, moving, reach)


def _whole_votes(inner: np.ndarray, moving: np.ndarray, reach: int) -> np.ndarray:
    """Exact votes of whole images: crowded pixels are cut into digits, so that each transform is exact after rounding."""
    if np.linalg.norm(inner) * np.linalg.norm(moving) <= EXACT:
        return np.rint(_votes(inner, moving, reach))
    larger = inner if np.abs(inner).max() >= np.abs(moving).max() else moving
    if np.abs(larger).max() < DIGIT:  # many pixels, none of them crowded
        return np.rint(_votes(inner, moving, reach))
    high = np.trunc(larger / DIGIT)
    parts = (high, DIGIT), (larger - high * DIGIT, 1.0)
    if larger is inner:
        return sum(scale * _whole_votes(part, moving, reach) for part, scale in parts)
    return sum(scale * _whole_votes(inner, part, reach) for part, scale in parts)


def _votes(inner: np.ndarray, moving: np.ndarray, reach: int) -> np.ndarray:
    shape = [good_size(n) for n in moving.shape]
    product = np.conj(np.fft.rfft2(inner, shape)) * np.fft.rfft2(moving, shape)
    return np.fft.irfft2(product, shape)[: 2 * reach + 1, : 2 * reach + 1]


def good_size(n: int) -> int:
    """The next size that has no prime factor over 5, for which transforms are fast."""
    while True:
        rest = n
        for factor in (2, 3, 5):
            while rest % factor == 0:
                rest //= factor
        if rest == 1:
            return n
        n += 1


def displacement_votes(template: DataFrame, moving: DataFrame, reach: int, block: int = 256) -> DataFrame:
    """The votes as rows ``fov, cycle, dr, dc, vote``."""
    width = 2 * reach + 1
    rows = vote_arrays(template, moving, reach, block).select("fov", "cycle", F.posexplode("votes").alias("at", "vote"))
    shift = lambda x: (F.floor(x) - reach).cast("int")
    return rows.select("fov", "cycle", shift(F.col("at") / width).alias("dr"), shift(F.col("at") % width).alias("dc"), "vote")


def best_shift(votes: DataFrame, keys: tuple[str, ...] = ("fov", "cycle")) -> DataFrame:
    """Shift with the most votes; the smallest (dr, dc) on a tie."""
    rank = F.struct(F.col("vote"), (-F.col("dr")).alias("dr"), (-F.col("dc")).alias("dc"))
    best = votes.groupBy(*keys).agg(F.max(rank).alias("_b"))
    return best.select(*keys, (-F.col("_b.dr")).alias("dr"), (-F.col("_b.dc")).alias("dc"), F.col("_b.vote").alias("vote"))


def estimate_shift(template: DataFrame, moving: DataFrame, reach: int, block: int = 256) -> DataFrame:
    """``fov, cycle, dr, dc, vote`` of the best shift; the smallest (dr, dc) on a tie."""
    width = 2 * reach + 1
    best = vote_arrays(template, moving, reach, block).withColumn("vote", F.array_max("votes"))
    best = best.withColumn("_at", F.array_position("votes", F.col("vote")) - 1)  # the first that has it
    shift = lambda x: (F.floor(x) - reach).cast("int")
    return best.select("fov", "cycle", shift(F.col("_at") / width).alias("dr"), shift(F.col("_at") % width).alias("dc"), "vote")


def mask_shift(template: DataFrame, moving: DataFrame, reach: int, block: int = 256) -> DataFrame:
    """The same on label masks: every labelled pixel counts 1."""
    ones = lambda m: m.withColumn("v", (F.col("label") > 0).cast("double"))
    return estimate_shift(ones(template), ones(moving), reach, block)


def estimate_fine_shift(template: DataFrame, moving: DataFrame, reach: int, block: int = 256) -> DataFrame:
    """``fov, cycle, dr, dc, vote`` with fractions: the best whole shift, moved to the top of the surface of second
    degree through its vote and the eight around it.

    Where that surface has no top within a pixel, each axis uses the parabola
    through its three votes, and an axis on which the best shift is at the edge
    of the reach, or beside equal votes, stays whole.
    """
    width = 2 * reach + 1
    best = vote_arrays(template, moving, reach, block).withColumn("vote", F.array_max("votes"))
    best = best.withColumn("_at", (F.array_position("votes", F.col("vote")) - 1).cast("int"))
    row, col = F.floor(F.col("_at") / width).cast("int"), F.col("_at") % width
    beside = lambda down, right: F.get("votes", F.col("_at") + down * width + right)
    inside = lambda place: (place > 0) & (place < width - 1)
    best = best.select(
        "fov",
        "cycle",
        "vote",
        (row - reach).alias("_dr"),
        (col - reach).alias("_dc"),
        F.when(inside(row), (beside(1, 0) - beside(-1, 0)) / 2).alias("_r"),
        F.when(inside(row), beside(1, 0) - 2 * F.col("vote") + beside(-1, 0)).alias("_rr"),
        F.when(inside(col), (beside(0, 1) - beside(0, -1)) / 2).alias("_c"),
        F.when(inside(col), beside(0, 1) - 2 * F.col("vote") + beside(0, -1)).alias("_cc"),
        F.when(
            inside(row) & inside(col), (beside(1, 1) - beside(1, -1) - beside(-1, 1) + beside(-1, -1)) / 4
        ).alias("_rc"),
    )
    r, rr, c, cc, rc = (F.col(n) for n in ("_r", "_rr", "_c", "_cc", "_rc"))
    bent = rr * cc - rc * rc
    best = best.withColumn("_down", F.when(bent > 0, (rc * c - cc * r) / bent))
    best = best.withColumn("_right", F.when(bent > 0, (rc * r - rr * c) / bent))
    joint = F.coalesce((rr < 0) & (F.abs("_down") <= 1) & (F.abs("_right") <= 1), F.lit(False))

    def top(whole: str, together: str, slope, bend):
        return F.col(whole) + F.when(joint, F.col(together)).when(bend < 0, -slope / bend).otherwise(0.0)

    return best.select("fov", "cycle", top("_dr", "_down", r, rr).alias("dr"), top("_dc", "_right", c, cc).alias("dc"), "vote")


def _spot_images(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spots counted per pixel, as template and moved image."""
    counted = lambda s: s.groupBy("fov", "r", "c").agg(F.count(F.lit(1)).cast("double").alias("v"))
    return counted(a), counted(b).withColumn("cycle", F.lit(0))


def spot_votes(a: DataFrame, b: DataFrame, reach: int, block: int = SPOT_BLOCK) -> DataFrame:
    """Votes of spot pairs for each offset (dr, dc) from ``a`` to ``b`` within ``reach``; offsets without a pair are left out.

    Spots are counted per pixel and the counts correlated as images, so no spot
    or pixel is repeated per offset and a reach of hundreds of pixels is served.
    """
    votes = displacement_votes(*_spot_images(a, b), reach, block).where("vote > 0")
    return votes.select("fov", "dr", "dc", F.col("vote").cast("long").alias("vote"))


def spot_shift(a: DataFrame, b: DataFrame, reach: int, block: int = SPOT_BLOCK) -> DataFrame:
    """``fov, dr, dc, vote`` of the offset with the most spot pairs; the smallest (dr, dc) on a tie, no row without pairs."""
    best = estimate_shift(*_spot_images(a, b), reach, block).where("vote > 0")
    return best.select("fov", "dr", "dc", F.col("vote").cast("long").alias("vote"))
