"""Exact top-k search over vectors by MaxScore, in blocks of queries and shards of candidates.

Every dimension is a term, and its postings are the values of all candidates.
In a shard, the score bound of a term for a query is the largest product its
values allow.  Terms whose bounds together cannot lift a candidate from the
floor to the query's threshold are non-essential: the essential terms are
traversed for the whole shard, and the others are probed only for candidates
that can still compete.  A task's thresholds rise from shard to shard; the
tasks' best are merged at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotweave.session import settle

QUERIES = 16_384  # queries broadcast at once; more take more passes over the candidates
SHARD = 4096  # candidates searched at once
PROBE = 8  # terms probed between two looks at who can still compete


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as double; null if the vector or a component is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(finite, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double")))


def _values(vectors: np.ndarray, width: int, most: float) -> np.ndarray:
    """Vectors cut or padded to ``width``; as floats where all sums stay exact, since floats multiply faster."""
    out = np.zeros((len(vectors), width), dtype=np.float64 if most < 2**53 else np.int64)
    out[:, : vectors.shape[1]] = vectors[:, :width]
    return out


def search(query_id: int, query: np.ndarray, ids: np.ndarray, terms: np.ndarray, high, low, k: int, threshold: float):
    """The best ``k`` (ids, scores) of a shard that reach the threshold, ties to the smaller id.

    ``terms`` holds one row of values per term, ``high`` and ``low`` its range.
    """
    top, bottom = np.maximum(query * high, query * low), np.minimum(query * high, query * low)
    order = np.argsort(bottom - top, kind="stable")
    # At position i: what the terms from i on add to a score at most, and by how much they can lift it over its floor.
    rest = np.append(np.cumsum(top[order][::-1])[::-1], 0)
    lift = np.append(np.cumsum((top - bottom)[order][::-1])[::-1], 0)
    hopeless = np.flatnonzero(lift + bottom.sum() < threshold)
    essential = int(hopeless[0]) if len(hopeless) else len(order)
    if len(order) and not essential:
        return ids[:0], ids[:0]
    scores = query[order[:essential]] @ terms[order[:essential]]
    alive = np.flatnonzero((scores + rest[essential] >= threshold) & (ids != query_id))
    for at in range(essential, len(order), PROBE):
        some = order[at : at + PROBE]
        scores[alive] += query[some] @ terms[np.ix_(some, alive)]
        alive = alive[scores[alive] + rest[min(at + PROBE, len(order))] >= threshold]
    found = scores[alive].astype(np.int64)
    if len(alive) > k:
        worst = np.partition(found, len(found) - k)[len(found) - k]
        alive, found = alive[found >= worst], found[found >= worst]
    best = np.lexsort((ids[alive], -found))[:k]
    return ids[alive][best], found[best]


def _matrix(vectors: pa.Array) -> np.ndarray:
    """One row per vector; shorter ones are padded with zeros."""
    flat, ends = vectors.flatten().to_numpy(), np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(ends), ends.max(initial=0)))
    out[np.arange(out.shape[1]) < ends[:, None]] = flat
    return out


def _searched(asked, k: int):
    """Task function: the task's best candidates for each query of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = asked.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(query_ids)
        for batch in batches:
            for start in range(0, batch.num_rows, SHARD):
                part = batch.slice(start, SHARD)
                ids, vectors = part.column(0).to_numpy(), _matrix(part.column(1))
                width = max(queries.shape[1], vectors.shape[1])
                most = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(width, 1)
                terms = np.ascontiguousarray(_values(vectors, width, most).T)
                high, low = terms.max(axis=1), terms.min(axis=1)
                for i, query in enumerate(_values(queries, width, most)):
                    own, scores = best[i]
                    threshold = scores[-1] if len(scores) == k else -np.inf
                    more, found = search(query_ids[i], query, ids, terms, high, low, k, threshold)
                    if len(more):
                        own, scores = np.append(own, more), np.append(scores, found)
                        keep = np.lexsort((own, -scores))[:k]
                        best[i] = own[keep], scores[keep]
        asked_by = np.repeat(query_ids, [len(own) for own, _ in best])
        own, scores = (np.concatenate(c) for c in zip(*best))
        yield pa.RecordBatch.from_arrays([pa.array(asked_by), pa.array(own), pa.array(scores)], ["query_id", "vec_id", "score"])

    return run


def top_k(
    queries: DataFrame, candidates: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256
) -> DataFrame:
    """The ``k`` best candidates of each query: ``query_id, rank, vec_id, score``; all if there are fewer.

    The score is the inner product of the vectors quantised to floor(scale * x);
    ties go to the smaller id, and candidates with the query's own id are left
    out.  Vectors that are null or hold null or non-finite components, and rows
    without an id, take no part; a shorter vector counts as padded with zeros.
    A query id that repeats is answered once, for its smallest vector; repeated
    candidates each count.  Components must stay below 2**53 and scores below
    2**63.  Other columns are ignored.

    The queries are cut by id hash into blocks of about ``QUERIES`` rows.  Each
    block is broadcast, its size being fixed, and meets all candidates once.
    """
    spark = candidates.sparkSession

    def valid(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("vector"))
        return rows.where("id IS NOT NULL AND vector IS NOT NULL")

    asked = settle(valid(queries).groupBy("id").agg(F.min("vector").alias("vector")), "asked")
    blocks = -(-asked.count() // QUERIES)
    passes = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()
        if rows.num_rows:
            ids, vectors = (c.combine_chunks() for c in rows.columns)
            sent = spark.sparkContext.broadcast((ids.to_numpy(), _matrix(vectors)))
            found = valid(candidates).mapInArrow(_searched(sent, k), "query_id long, vec_id long, score long")
            passes.append(settle(found, "found"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = reduce(DataFrame.union, passes) if passes else spark.createDataFrame([], "query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
