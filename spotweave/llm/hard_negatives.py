"""Hard negatives by a multiway hyperplane tree whose split points keep distance ranges.

The best partners of an anchor have the largest inner products.  Vectors get
one more component, so that all candidates have one length; then the inner
product with an anchor falls as the distance to it grows, and a window of
scores is an annulus around the anchor.

A node of the tree holds split points; each candidate belongs to the closest
one, and every split point keeps the least and the largest distance to the
candidates of each sibling.  A sibling is eliminated where these ranges, or
the hyperplane between two split points, show that none of its candidates lies
in the annulus.  Leaves are searched exactly, in integers.

The root is distributed: its split points come from a bounded sample, Spark
deals the candidates into the root's cells and aggregates the ranges, and a
large cell is read by many tasks, each of which grows the subtrees of its rows.
Anchors are broadcast in blocks of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotweave.llm.topk_search import _matrix, _values, quantised
from spotweave.session import discard, settle

ANCHORS = 16_384  # anchors broadcast at once; more take more passes over the candidates
SAMPLE = 2048  # candidates among which the root's split points are chosen
SPLITS = 32  # split points of the root
FANOUT = 8  # split points of a node below
LEAF = 128  # candidates of a leaf
_LOW, _HIGH = -(2**62), 2**62


class Space:
    """Distances after the added component; ``most`` is the largest squared length of a candidate."""

    def __init__(self, most: float):
        self.most = most
        self.slack = 1e-5 * np.sqrt(2 * most) + 1e-9  # far above the rounding of a distance

    def between(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Distances of candidates."""
        up = lambda v: np.sqrt(np.maximum(self.most - np.einsum("ij,ij->i", v, v), 0))
        return np.sqrt(np.maximum(2 * (self.most - x @ y.T - np.outer(up(x), up(y))), 0))

    def to(self, anchors: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Distances of anchors to candidates."""
        return np.sqrt(np.maximum(self.squares(anchors)[:, None] - 2 * (anchors @ x.T), 0))

    def squares(self, anchors: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", anchors, anchors) + self.most

    def radius(self, squares: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Distance at which a candidate has a score."""
        return np.sqrt(np.maximum(squares - 2.0 * scores, 0))


def spread(points: np.ndarray, count: int, space: Space) -> np.ndarray:
    """Places of ``count`` points, each the farthest from those before; fewer if points repeat."""
    chosen = [0]
    gap = space.between(points, points[:1])[:, 0]
    while len(chosen) < count and gap.max() > space.slack:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, space.between(points, points[chosen[-1:]])[:, 0])
    return np.array(chosen)


def survives(near, far, to_splits, low, high, apart, own: int, space: Space) -> np.ndarray:
    """Whether a sibling may hold candidates between ``near`` and ``far`` of each anchor.

    ``low`` and ``high`` are the distances of each split point to the sibling's
    candidates, ``apart`` those between the sibling's split point ``own`` and the others.
    """
    least = np.maximum(to_splits - high, low - to_splits).max(axis=1)
    most = (to_splits + high).min(axis=1)
    others = apart > space.slack
    if others.any():  # a candidate lies on its own split point's side of each hyperplane
        gaps = (to_splits[:, own, None] ** 2 - to_splits[:, others] ** 2) / (2 * apart[others])
        least = np.maximum(least, gaps.max(axis=1))
    return (least <= far + space.slack) & (most >= near - space.slack)


class Search:
    """Best ``k`` candidates of each window of each anchor, over the rows seen so far.

    Window w of anchor i takes scores from ``low[i, w]`` to ``high[i, w]`` of
    candidates with the anchor's label (``same``) or another.
    """

    def __init__(self, ids, labels, vectors, low, high, k: int, same: bool, space: Space):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.low, self.high, self.k, self.same, self.space = low.copy(), high, k, same, space
        self.squares = space.squares(vectors)
        self.inner = space.radius(self.squares, np.where(low <= high, high, _LOW).max(axis=1, initial=_LOW))
        self.found: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def outer(self, at: np.ndarray) -> np.ndarray:
        lows = np.where(self.low[at] <= self.high[at], self.low[at], _HIGH).min(axis=1, initial=_HIGH)
        return np.where(lows < _HIGH, self.space.radius(self.squares[at], lows), -1.0)

    def leaf(self, at: np.ndarray, ids, labels, vectors, keep: bool = True) -> None:
        """Score some anchors against some candidates, given in ascending order of id."""
        most = np.abs(self.vectors[at]).max(initial=0) * np.abs(vectors).max(initial=0) * max(vectors.shape[1], 1)
        exact = lambda v: _values(v, v.shape[1], most)
        scores = (exact(self.vectors[at]) @ exact(vectors).T).astype(np.int64)
        fits = ((labels == self.labels[at, None]) == self.same) & (ids != self.ids[at, None])
        for w in range(self.low.shape[1]):
            ok = fits & (scores >= self.low[at, w, None]) & (scores <= self.high[at, w, None])
            rows = np.flatnonzero(ok.any(axis=1))
            if not len(rows):
                continue
            own = np.where(ok[rows], scores[rows], _LOW - 1)
            order = np.argsort(-own, axis=1, kind="stable")[:, : self.k]  # ties stay in order of id
            best = np.take_along_axis(own, order, axis=1)
            if best.shape[1] == self.k:
                self.low[at[rows], w] = np.maximum(self.low[at[rows], w], best[:, -1])
            if keep:
                row, nth = np.nonzero(best >= _LOW)
                self.found.append((at[rows[row]], np.full(len(row), w), ids[order[row, nth]], best[row, nth]))
                self.held += len(row)
        if self.held > 2_000_000:
            self.best()

    def subtree(self, at: np.ndarray, ids, labels, vectors) -> None:
        """Grow the tree of some candidates as far as anchors reach into it, and search it."""
        order = np.argsort(ids, kind="stable")
        ids, labels, vectors = ids[order], labels[order], vectors[order]
        open_nodes = [(at, np.arange(len(ids)))]
        while open_nodes:
            at, rows = open_nodes.pop()
            points = vectors[rows]
            step = max(1, len(rows) // (4 * FANOUT))
            splits = spread(points[::step], FANOUT, self.space) * step if len(rows) > LEAF else np.zeros(1, np.int64)
            if len(splits) < 2:  # few candidates, or the same again and again
                for start in range(0, len(rows), LEAF):
                    part = rows[start : start + LEAF]
                    self.leaf(at, ids[part], labels[part], vectors[part])
                continue
            gaps = self.space.between(points, points[splits])
            nearest = gaps.argmin(axis=1)
            to_splits = self.space.to(self.vectors[at], points[splits])
            for j in range(len(splits)):
                mine = nearest == j
                if mine.any():
                    own = gaps[mine]
                    alive = survives(self.inner[at], self.outer(at), to_splits, own.min(axis=0), own.max(axis=0), gaps[splits[j]], j, self.space)
                    if alive.any():
                        open_nodes.append((at[alive], rows[mine]))

    def best(self) -> tuple[np.ndarray, ...]:
        """Anchor, window, id and score of the best so far."""
        if not self.found:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        at, window, ids, scores = (np.concatenate(c) for c in zip(*self.found))
        order = np.lexsort((ids, -scores, window, at))
        at, window, ids, scores = at[order], window[order], ids[order], scores[order]
        group = at * self.low.shape[1] + window
        first = np.searchsorted(group, group)
        keep = np.arange(len(group)) - first < self.k
        self.found, self.held = [(at[keep], window[keep], ids[keep], scores[keep])], int(keep.sum())
        return self.found[0]


def _fit(vectors: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    out[:, : vectors.shape[1]] = vectors[:, :width]
    return out


def _columns(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and vectors of the last three columns."""
    ids, labels, vectors = batch.columns[-3:]
    return ids.to_numpy(), labels.to_numpy(), _fit(_matrix(vectors), width)


class Root:
    """Split points of the root and, once counted, their distances to each cell."""

    def __init__(self, sample: pa.Table, width: int, most: float):
        self.space, self.width = Space(most), width
        ids, labels, vectors = _columns(sample.combine_chunks().to_batches()[0], width)
        order = np.argsort(ids, kind="stable")
        self.sample = ids[order], labels[order], vectors[order]
        self.points = vectors[spread(vectors, SPLITS, self.space)]
        self.apart = self.space.between(self.points, self.points)
        self.low = self.high = np.zeros((0, 0))

    def cells(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest = self.space.between(_columns(batch, self.width)[2], self.points).argmin(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(nearest), *batch.columns], ["cell", "id", "label", "vector"])

    def ranges(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column(0).to_numpy()
            gaps = self.space.between(_columns(batch, self.width)[2], self.points)
            for own in np.unique(cell):
                some = gaps[cell == own]
                nth = np.arange(len(self.points), dtype=np.int32)
                columns = [np.full(len(nth), own, np.int32), nth, some.min(axis=0), some.max(axis=0)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cell", "split", "low", "high"])


def _searched(sent, k: int, same: bool):
    """Task function: the task's best candidates for each window of the block's anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, ids, labels, vectors, low, high = sent.value
        search = Search(ids, labels, vectors, low, high, k, same, root.space)
        everyone = np.arange(len(ids))
        to_splits = root.space.to(vectors, root.points)
        begun = False
        for batch in batches:
            if not begun:  # the sample's scores are reached already, so only better ones are looked for
                for start in range(0, len(root.sample[0]), LEAF):
                    search.leaf(everyone, *(c[start : start + LEAF] for c in root.sample), keep=False)
                begun = True
            cell, (own_ids, own_labels, own_vectors) = batch.column(0).to_numpy(), _columns(batch, root.width)
            for own in np.unique(cell):
                alive = survives(search.inner, search.outer(everyone), to_splits, root.low[own], root.high[own], root.apart[own], own, root.space)
                if alive.any():
                    mine = cell == own
                    search.subtree(everyone[alive], own_ids[mine], own_labels[mine], own_vectors[mine])
        at, window, found, scores = search.best()
        columns = [pa.array(ids[at]), pa.array(window), pa.array(found), pa.array(scores)]
        yield pa.RecordBatch.from_arrays(columns, ["anchor_id", "window", "id", "score"])

    return run


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(
    anchors: DataFrame,
    candidates: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: str | Column = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Vectors are quantised to floor(scale * x); a score is the integer inner
    product with the anchor, and ties go to the smaller id.  An anchor's
    positives are its best ``positives`` rows with its label; for each, its
    negatives are the best ``negatives`` rows with another label whose score is
    ``low`` to ``high`` percent of the positive's.  All are returned if there
    are fewer, none where the positive's score is negative.

    Rows without id, label or vector, or with null or non-finite components,
    take no part; a shorter vector counts as padded with zeros.  Rows with the
    anchor's own id are not its partners.  An anchor id that repeats is answered
    once, for its smallest vector and label; repeated candidates each count.
    Scores must stay below 2**53.  Other columns are ignored.
    """
    spark = candidates.sparkSession
    label = F.col(label) if isinstance(label, str) else label

    def valid(df: DataFrame) -> DataFrame:
        vector = quantised(F.col(vector_col), scale)
        rows = df.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vector"))
        return rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")

    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = settle(valid(candidates), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    width, most = rows.agg(F.max(F.size("vector")), F.max(square)).first()
    asked = valid(anchors).groupBy("id").agg(F.min(F.struct("vector", "label")).alias("one"))
    asked = settle(asked.select("id", "one.label", "one.vector"), "anchors")
    blocks = -(-asked.count() // ANCHORS)
    if width is None or not blocks:
        return spark.createDataFrame([], schema)
    root = Root(rows.orderBy(F.xxhash64("id", "vector")).limit(SAMPLE).toArrow(), int(width), float(most))

    # Cells of the root: sorted, so that a task meets few of them, and large ones are cut by id.
    celled = rows.mapInArrow(root.cells, "cell int, id long, label long, vector array<double>")
    cells = settle(celled.repartitionByRange("cell", F.xxhash64("id")).sortWithinPartitions("cell"), "cells")
    ranges = cells.mapInArrow(root.ranges, "cell int, split int, low double, high double")
    ranges = ranges.groupBy("cell", "split").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow()  # SPLITS**2 rows
    own, split, lows, highs = (c.to_numpy() for c in ranges.columns)
    root.low, root.high = (np.zeros((len(root.points),) * 2) for _ in range(2))
    root.low[own, split], root.high[own, split] = lows, highs
    found_schema = "anchor_id long, window long, id long, score long"

    passes = []
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()
        if not part.num_rows:
            continue
        ids, labels, vectors = _columns(part.combine_chunks().to_batches()[0], int(width))
        order = np.argsort(ids)
        ids, labels, vectors = ids[order], labels[order], vectors[order]

        def sent(lowest, highest):
            return spark.sparkContext.broadcast((root, ids, labels, vectors, lowest, highest))  # noqa: B023

        whole = sent(np.full((len(ids), 1), _LOW), np.full((len(ids), 1), _HIGH))
        same = cells.mapInArrow(_searched(whole, positives, True), found_schema)
        near = settle(_ranked(same, ["anchor_id"], positives), "positives")

        # Windows of the block: at most ``positives`` an anchor.
        anchor, rank, score = (c.to_numpy() for c in near.select("anchor_id", "rank", "score").toArrow().columns)
        lowest, highest = np.full((len(ids), positives), 1), np.zeros((len(ids), positives), np.int64)
        at = np.searchsorted(ids, anchor), rank - 1
        lowest[at], highest[at] = -(-low * score // 100), high * score // 100
        other = cells.mapInArrow(_searched(sent(lowest, highest), negatives, False), found_schema)
        hard = _ranked(other, ["anchor_id", "window"], negatives).withColumnRenamed("score", "negative_score")
        near = near.select("anchor_id", (F.col("rank") - 1).cast("long").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        hard = hard.withColumnRenamed("id", "negative_id").join(near, ["anchor_id", "window"])
        passes.append(settle(hard.select(*[f.split()[0] for f in schema.split(", ")]), "negatives"))
    discard(rows)
    return reduce(DataFrame.union, passes) if passes else spark.createDataFrame([], schema)
