"""Mixing sources to target weights, with a splitting tree that deals blocks to output shards.

Documents of a source stand in the order of a hash, cut into blocks of about
``BLOCK`` documents.  A source is taken in whole passes and a last part, up to
the document at which its words come nearest to its target.  The blocks of all
passes are the source's quota; a tree over the shards splits the quotas of all
sources in two by multivariate hypergeometric draws, down to one shard, so
every shard holds an exact, disjoint and random share of the blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotweave.session import settle

WEIGHTS = (1, 2, 3)  # of the sources in code point order, repeating; no source (null) is last
MOST = 3  # a target stops at so many times its source's size
BLOCK = 256  # documents of a block, on average
SHARD_WORDS = 5_000_000  # words of an output shard, about
SEED = 11
_STEP = 10  # bits of the order settled in one round of the search for the last document
_ROUNDS = 3
_ORDER_BITS = 63


def words_in(text: Column) -> Column:
    """Number of words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def place(id_col: Column, text: Column, seed: int) -> Column:
    """Place of a document in the order of its source, 63 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col, text), 64 - _ORDER_BITS)


def targets(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Shares of the total size by weight; a share above ``most`` sizes stops there and the rest is shared again."""
    total, stopped = sum(sizes), set()
    while True:
        left = total - sum(most * sizes[i] for i in stopped)
        weight = sum(w for i, w in enumerate(weights) if i not in stopped)
        share = left / weight if weight else 0.0
        above = {i for i, w in enumerate(weights) if i not in stopped and share * w > most * sizes[i]}
        if not above:
            return [float(most * sizes[i]) if i in stopped else share * w for i, w in enumerate(weights)]
        stopped |= above


def _last_places(sized: DataFrame, needs: list[tuple[str | None, float]]) -> dict[str | None, int]:
    """Per source, the place of the last document of a part of so many words.

    Each round settles ten bits of the place from sums of at most 1,024 ranges
    per source; only documents of the range found go on.
    """
    spark = sized.sparkSession
    state = {source: (0, need) for source, need in needs}
    shift = _ORDER_BITS
    for _ in range(_ROUNDS):
        if not state:
            return {}
        shift -= _STEP
        known = spark.createDataFrame([(s, p, float(n)) for s, (p, n) in state.items()], "src string, prefix long, need double")
        held = _of_source(sized, known).where(F.shiftright("place", shift + _STEP) == F.col("prefix"))
        sums = held.groupBy("src", "need", F.shiftright("place", shift).alias("prefix")).agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("src").orderBy("prefix")
        sums = sums.withColumn("reach", F.sum("words").over(upto)).withColumn("end", F.max("prefix").over(Window.partitionBy("src")))
        first = sums.where("reach >= need OR prefix = end").groupBy("src").agg(
            F.min_by(F.struct("prefix", (F.col("need") - F.col("reach") + F.col("words")).alias("need")), "prefix").alias("at")
        )
        state = {r["src"]: (r["at"]["prefix"], r["at"]["need"]) for r in first.collect()}  # one row per source
    known = spark.createDataFrame([(s, p, float(n)) for s, (p, n) in state.items()], "src string, prefix long, need double")
    held = _of_source(sized, known).where(F.shiftright("place", shift) == F.col("prefix"))
    docs = held.groupBy("src", "need", "prefix", "place").agg(F.sum("size").alias("words"))
    reach = F.sum("words").over(Window.partitionBy("src").orderBy("place"))
    near = docs.withColumn("taken", reach - F.col("words") / 2 <= F.col("need"))
    before = F.shiftleft("prefix", shift) - 1  # the last place of the ranges before
    last = near.groupBy("src").agg(F.coalesce(F.max(F.when(F.col("taken"), F.col("place"))), F.max(before)).alias("last"))
    return {r["src"]: r["last"] for r in last.collect()}


def _of_source(df: DataFrame, plan: DataFrame) -> DataFrame:
    return df.join(plan, df["source"].eqNullSafe(plan["src"]))


def source_plan(df: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed: int = SEED) -> tuple[DataFrame, list[dict]]:
    """Sizes and places of all rows, and one entry per source: target, passes and the last place of the part after them.

    The entries, one per source, are the only data that reach the driver.
    """
    own = [F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), words_in(F.col(text_col)).alias("size")]
    sized = settle(df.select(*own, place(F.col(id_col), F.col(text_col), seed).alias("place")), "sized")
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs")).collect()
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))]
    plan = []
    for row, target in zip(rows, targets([r["size"] for r in rows], weights)):
        passes = min(MOST, int(target // row["size"])) if row["size"] else 0
        entry = {"source": row["source"], "source_size": row["size"], "target": target, "passes": passes}
        plan.append(entry | {"part": target - passes * row["size"], "last": -1, "blocks": max(1, -(-row["docs"] // BLOCK))})
    parts = [(p["source"], p["part"]) for p in plan if p["passes"] < MOST and p["part"] > 0]
    for source, last in _last_places(sized, parts).items():
        next(p for p in plan if p["source"] == source)["last"] = last
    return sized, plan


def _plan_table(df: DataFrame, plan: list[dict]) -> DataFrame:
    rows = [(p["source"], p["source_size"], p["target"], p["passes"], p["last"], p["blocks"], i) for i, p in enumerate(plan)]
    schema = "src string, source_size long, target double, passes int, last long, blocks long, nth int"
    return df.sparkSession.createDataFrame(rows, schema)


def _block(place_: Column, blocks: Column) -> Column:
    return F.shiftright(F.shiftright(place_, 32) * blocks, 31)


def split(counts: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of each source before ``shard`` and in it: the path of the splitting tree to one leaf.

    Every node draws from its own generator, so all leaves agree on it.
    """
    low, high, before = 0, shards, np.zeros_like(counts)
    while high - low > 1:
        middle = (low + high) // 2
        draw = np.random.default_rng([seed, low, high])
        left = draw.multivariate_hypergeometric(counts, int(counts.sum()) * (middle - low) // (high - low), method="marginals")
        if shard < middle:
            counts, high = left, middle
        else:
            counts, before, low = counts - left, before + left, middle
    return before, counts


def _dealt(plan: list[dict], shards: int, seed: int):
    """Task function: shard numbers to the blocks they hold: (nth source, pass, block, shard)."""
    parts = [(p["last"] >> 32) * p["blocks"] >> 31 if p["last"] >= 0 else -1 for p in plan]
    counts = np.array([p["passes"] * p["blocks"] + part + 1 for p, part in zip(plan, parts)], dtype=np.int64)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"].tolist():
                before, own = split(counts, shards, shard, seed)
                for nth in np.flatnonzero(own):
                    draws = np.arange(before[nth], before[nth] + own[nth])
                    passes, at = draws // plan[nth]["blocks"], draws % plan[nth]["blocks"]
                    block = at.copy()
                    for p in np.unique(passes):  # each pass has its own permutation of the blocks
                        n = plan[nth]["blocks"] if p < plan[nth]["passes"] else parts[nth] + 1
                        step, first = np.random.default_rng([seed, nth, p]).integers(1, n + 1, 2).tolist()
                        while math.gcd(step, n) > 1:
                            step += 1
                        block[passes == p] = (at[passes == p] * step + first) % n
                    yield pd.DataFrame({"nth": nth, "pass": passes, "block": block, "shard": shard})

    return run


def mix(
    df: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed: int = SEED, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """One row per row of ``df``: ``id_col, size, source_size, target, taken, copies, shards, place``.

    ``size`` is the number of words (null text: 0); ``taken`` counts the words
    the mix takes, ``copies`` times the size; ``shards`` lists the output shard
    of each copy.  Rows with one id and text go together; a source without
    words is not taken.  In a shard, copies stand in the order of
    ``xxhash64(shard, nth copy, place)``.  Reruns agree.  Other columns are
    ignored.
    """
    sized, plan = source_plan(df, id_col, text_col, source_col, seed)
    return _sharded(sized, F.col("source"), F.col("place"), plan, seed, shard_words).select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("shards")).alias("taken"),
        F.size("shards").alias("copies"),
        "shards",
        "place",
    )


def _sharded(df: DataFrame, source: Column, place_: Column, plan: list[dict], seed: int, shard_words: int) -> DataFrame:
    """``df`` with its source's entry and ``shards``, the output shard of each copy, from the blocks that the splitting tree deals."""
    if not plan:
        plan = [{"source": None, "source_size": 0, "target": 0.0, "passes": 0, "last": -1, "blocks": 1}]
    shards = max(1, round(sum(p["target"] for p in plan) / shard_words))
    blocks = df.sparkSession.range(shards).mapInPandas(_dealt(plan, shards, seed), "nth int, pass int, block long, shard int")
    entry = F.struct("pass", "shard")
    blocks = blocks.groupBy("nth", "block").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["shard"]).alias("all"))
    blocks = settle(blocks, "blocks")  # one row per block: its true size shows that the texts need not move for it
    table = _plan_table(df, plan)
    known = df.join(table, source.cast("string").eqNullSafe(table["src"])).withColumn("block", _block(place_, F.col("blocks")))
    upto = F.col("passes") + (place_ <= F.col("last")).cast("int")
    shards_of = F.slice(F.coalesce("all", F.array().cast("array<int>")), F.lit(1), upto)
    return known.join(blocks, ["nth", "block"], "left").withColumn("shards", shards_of)


def _in_shards(df: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, shard_words: int) -> DataFrame:
    """Struct ``row`` and ``shard``: a row per copy that the mix takes, a shard in one partition and shuffled on its own."""
    _, plan = source_plan(df, id_col, text_col, source_col, seed)
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), place(df[id_col], df[text_col], seed).alias("place"))
    dealt = _sharded(rows, F.col("row")[source_col], F.col("place"), plan, seed, shard_words)
    copies = dealt.select("row", "place", F.posexplode("shards").alias("copy", "shard"))
    key = F.xxhash64("shard", "copy", "place")
    return copies.repartition("shard").sortWithinPartitions("shard", key).select("row", "shard")


def mixed(
    df: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed: int = SEED, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """The rows the mix takes, each as often as it is taken, with the columns of ``df``, in the shards and order of ``mix``."""
    return _in_shards(df, id_col, text_col, source_col, seed, shard_words).select("row.*")


def write_shards(
    df: DataFrame, path: str, id_col="doc_id", text_col="text", source_col="source", seed: int = SEED, shard_words: int = SHARD_WORDS
) -> None:
    """Write the mix as Parquet folders ``shard=n``, each shuffled on its own."""
    placed = _in_shards(df, id_col, text_col, source_col, seed, shard_words)
    placed.select("row.*", "shard").write.partitionBy("shard").parquet(path)
