"""Near duplicates: a Jaccard self-join of shingle sets with rare-first prefix, length, positional and suffix filters.

Every distinct set is one class, so copies are never compared.  All sets are
sorted by one global order, rarest shingle first: shingles are counted over all
texts, and those that several texts hold go back to the slices that have them.  Two sets can only reach the
threshold if their prefixes share a shingle; such pairs go through the length,
positional and suffix filters, and what is left is verified once on the whole
sets.

A large group of near copies would still make all its pairs.  So sets are first
tried against hubs, the commonest set among those that agree in some minimum
hashes: a linear number of verified pairs that joins most of each group.  Pairs
inside a component add nothing to it and are not made.  Other sets with the
same hub h need no common prefix either: their overlap is at most the smaller
part they share with h, plus the shingles outside h that both have.  So they
can only be linked if both share enough with h (a join on hub and size) or have
a shingle outside h in common (a join on hub and shingle).  What is left for
the prefix join are pairs of sets with different hubs, and a shingle that only
sets of one hub have is dropped before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.llm import marks, textslices, wordbytes
from spotweave.llm.components import components
from spotweave.llm.textslices import paged, rows_of, values_of
from spotweave.session import discard, settle

WORDS = 5
PERCENT = 75
SLICE = 512 << 10  # bytes of text whose shingles are counted at once
PAGE = 8 << 20  # bytes of text whose shingles fill a page
PER_SLICE = 4  # shingles in a slice of the suffix filter, about
BANDS, ROWS = 8, 2  # hubs: sets that agree in a band of minimum hashes

_SALTS = np.random.default_rng(7).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_overlap(n_x: int, n_y: int, percent: int) -> int:
    """Smallest intersection i with 100 * i >= percent * (n_x + n_y - i)."""
    return -(-percent * (n_x + n_y) // (100 + percent))


def _least_overlap(n_x: str, n_y: str, percent: int) -> str:
    return f"(({percent} * ({n_x} + {n_y}) + {99 + percent}) div {100 + percent})"


def _entries(words: int, pages: int):
    """Task function: each slice's shingles, with how many of its texts hold them, one row per page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ends, data in zip(*(batch.column(c) for c in ("slice", "ends", "data"))):
                found = list(wordbytes.shingles_of(np.frombuffer(data.as_py(), np.uint8), ends.values.to_numpy(), words))
                key, counts = np.unique(paged(np.concatenate(found), pages)[1], return_counts=True)
                page = key >> 39
                at = np.flatnonzero(np.append(True, page[1:] != page[:-1])) if len(page) else page
                offsets = np.append(at, len(page))
                packed = [rows_of(c, offsets) for c in (key.astype("<u4"), (key >> 32 & 127).astype("u1"), counts.astype("<i4"))]
                yield pa.RecordBatch.from_arrays([pa.array(page[at]), pa.array(np.full(len(at), number.as_py())), *packed], ["page", "slice", "low", "high", "n"])
        pa.default_memory_pool().release_unused()

    return run


def _several(table: pa.Table) -> pa.Table:
    """The shingles of a page that more than one text holds, with their counts over all texts, by slice."""
    low, lengths = values_of(table["low"], "<u4")
    high, counts = values_of(table["high"], "u1")[0], values_of(table["n"], "<i4")[0]
    key = high.astype(np.int64) << 32 | low
    order = np.argsort(key, kind="stable")
    at = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    total = np.empty(len(key), dtype=np.int64)
    total[order] = np.repeat(np.add.reduceat(counts[order].astype(np.int64), at), np.diff(np.append(at, len(key))))
    key |= np.repeat(table["page"].to_numpy(), lengths) << 39
    keep = total > 1
    offsets = np.append(0, np.cumsum(keep))[np.append(np.cumsum(lengths) - lengths, len(keep))]
    packed = [rows_of(c[keep], offsets) for c in (key, total)]
    return pa.table([table["slice"].combine_chunks(), *packed], ["slice", "keys", "totals"]).filter(pa.array(np.diff(offsets) > 0))


def with_counts(slices: DataFrame, words: int, pages: int) -> DataFrame:
    """The slices with ``held``: the shingles of theirs that several texts hold, and how many texts; others have one.

    A shingle is one row per slice at most, however many texts hold it.
    """
    entries = slices.select("slice", "ends", "data").mapInArrow(_entries(words, pages), "page long, slice long, low binary, high binary, n binary")
    several = entries.groupBy("page").applyInArrow(_several, "slice long, keys binary, totals binary")
    several = settle(several, "several", textslices.SLICES)
    of_slice = several.groupBy("slice").agg(F.collect_list(F.struct("keys", "totals")).alias("held"))  # one slice's shingles at most
    return slices.join(of_slice, "slice", "left")


def _described(words: int, percent: int, pages: int):
    """Task function: one row per text with its class key, size, prefix, slice sizes and hub keys."""

    def rarity(found: np.ndarray, keys: np.ndarray, totals: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.ones(len(found), dtype=np.int64)
        own = paged(found, pages)[1]
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        return np.where(keys[at] == own, totals[at], 1)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, hashes, ends, data, held in zip(*(batch.column(c) for c in ("ids", "hashes", "ends", "data", "held"))):
                own_keys = own_totals = np.zeros(0, dtype=np.int64)
                if held.is_valid:
                    own_keys, own_totals = (values_of(held.values.field(c), "<i8")[0] for c in ("keys", "totals"))
                    order = np.argsort(own_keys)
                    own_keys, own_totals = own_keys[order], own_totals[order]
                keys, sizes, common, prefixes, pivots, hubs = [], [], [], [], [], []
                for found in wordbytes.shingles_of(np.frombuffer(data.as_py(), np.uint8), ends.values.to_numpy(), words):
                    n = len(found)
                    keys.append(class_key(found))
                    sizes.append(n)
                    keep = n - -(-percent * n // 100) + 1 if n else 0
                    seen = rarity(found, own_keys, own_totals)
                    common.append(int(seen.sum()) // n if n else 0)
                    prefixes.append(found[np.argsort(seen, kind="stable")[:keep]].view(np.int64))
                    pivots.append(_slices(found) if n else None)
                    hubs.append(_bands(found) if n else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values,
                        hashes.values,
                        pa.array(keys, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(common, pa.int64()),
                        pa.array(prefixes, pa.list_(pa.int64())),
                        pa.array(pivots, pa.list_(pa.int32())),
                        pa.array(hubs, pa.list_(pa.int64())),
                    ],
                    ["id", "text_hash", "c", "n", "common", "prefix", "pivots", "hubs"],
                )
        pa.default_memory_pool().release_unused()  # the worker may serve other stages next

    return describe


def class_key(found: np.ndarray) -> int | None:
    """64-bit key of a set; empty sets have none."""
    return int(np.int64(hash_of(found))) if len(found) else None


def hash_of(found: np.ndarray) -> np.int64:
    return np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), dtype=np.int64)[0]


def _slices(found: np.ndarray) -> np.ndarray:
    """Sizes of the slices of a set: a power of two of them, cut by the low bits of the shingles."""
    count = 1 << max(4, (len(found) // PER_SLICE).bit_length())
    return np.bincount((found & np.uint64(count - 1)).astype(np.int64), minlength=count)


def _slice_bound(p: str, q: str) -> str:
    """SQL for the largest overlap that the slices of two sets allow; sets of like size have as many slices or half."""
    fold = "zip_with(slice({0}, 1, size({0}) div 2), slice({0}, size({0}) div 2 + 1, size({0}) div 2), (u, v) -> u + v)"
    less = "zip_with({0}, {1}, (u, v) -> least(u, v))"
    cases = f"CASE WHEN size({p}) > size({q}) THEN {less.format(fold.format(p), q)} WHEN size({p}) < size({q}) THEN {less.format(p, fold.format(q))} ELSE {less.format(p, q)} END"
    return f"aggregate({cases}, 0, (s, v) -> s + v)"


def _bands(found: np.ndarray) -> np.ndarray:
    """One key per band of minimum hashes."""
    lows = (found[:, None] * _SALTS).min(axis=0).reshape(BANDS, ROWS)  # shingles are mixed already
    return wordbytes.mix(lows[:, 0] * _SALTS[0] + lows[:, 1] + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _sets(bitmap, words: int):
    """Task function: class key and whole set of the rows whose key is marked."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = marks.test(bitmap.value, batch.column(0).to_numpy())
            for _, data, ends in wordbytes.slices(batch.column(1).filter(pa.array(wanted))):
                found = list(wordbytes.shingles_of(data, ends, words))
                arrays = [pa.array([class_key(x) for x in found], pa.int64()), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["c", "set"])
        pa.default_memory_pool().release_unused()

    return read


def _shared(bitmap):
    """Task function: the prefix shingles that may occur in several sets, with their places."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column(2)
            tokens, ends = prefix.flatten().to_numpy(), prefix.offsets.to_numpy() - prefix.offsets[0].as_py()
            at = np.flatnonzero(marks.test(bitmap.value, tokens))
            row = np.searchsorted(ends, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[at]), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(at - ends[row])],
                ["token", "c", "n", "pos"],
            )
        pa.default_memory_pool().release_unused()

    return pick


def compared(df: DataFrame, pairs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """The pairs ``a, b`` of classes with ``n_a, n_b, overlap`` and ``extra``, the shingles of b that a lacks.

    Each pair is compared once, on the whole sets.  Only texts that stand for a
    class in a pair are read again: a bitmap of fixed size lets them through,
    and an exact join keeps the needed ones.  ``extra`` is kept where b shares
    at least half of its shingles.
    """
    spark = df.sparkSession
    ends = pairs.select(F.col("a").alias("c")).union(pairs.select(F.col("b").alias("c"))).distinct()
    needed = settle(classes.select("c", "rep").join(ends, "c", "left_semi"), "needed")
    bitmap = spark.sparkContext.broadcast(marks.to_array(marks.marked(needed, "rep")))
    read = df.select(F.xxhash64("_id").alias("rep"), "_text").mapInArrow(_sets(bitmap, words), "c long, set array<long>")
    sets = settle(read.join(needed.select("c"), "c", "left_semi").groupBy("c").agg(F.first("set").alias("set")), "sets", textslices.TEXTS)
    left = sets.select(F.col("c").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("c").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.select("a", "b", F.size("set_a").alias("n_a"), F.size("set_b").alias("n_b"), F.array_except("set_b", "set_a").alias("extra"))
    both = both.withColumn("overlap", F.col("n_b") - F.size("extra"))
    done = settle(both.withColumn("extra", F.when(F.expr("2 * overlap >= n_b"), F.col("extra"))), "compared")
    discard(sets)
    return done


def near_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``df``: ``id_col, n_shingles, component_id, text_hash``.

    Two texts are linked when the Jaccard similarity of their sets of distinct
    shingles of ``words`` words is at least ``percent`` / 100; A-Z are
    lower-cased, and a text with fewer words is one shingle.  Texts that are
    null, empty or without words are linked with nothing and are their own
    component.  ``component_id`` is the smallest id in the component; null ids
    do not count, so a component without any id has a null one.  Rows that
    repeat an id are rows of their own; ``text_hash`` (xxhash64) tells them
    apart.  Other columns are ignored.
    """
    spark = df.sparkSession
    texts = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    slices = textslices.sliced(texts, F.col("_text"), {"ids": F.col("_id"), "hashes": F.xxhash64("_text")}, SLICE)
    pages = textslices.pages_for(slices, PAGE)
    id_type = texts.schema["_id"].dataType.simpleString()
    schema = f"id {id_type}, text_hash long, c long, n long, common long, prefix array<long>, pivots array<int>, hubs array<long>"
    known = with_counts(slices, words, pages).select("ids", "hashes", "ends", "data", "held")
    described = settle(known.mapInArrow(_described(words, percent, pages), schema), "described", textslices.SLICES)
    discard(slices)
    members = settle(described.select("id", "text_hash", "c", "n"), "members")
    one_each = F.first(F.struct("n", "common", "prefix", "pivots", "hubs")).alias("one")
    classes = described.where("n > 0").groupBy("c").agg(F.min("id").alias("_rep"), one_each)
    classes = settle(classes.select("c", F.xxhash64("_rep").alias("rep"), "one.*"), "classes")
    discard(described)
    linked = f"{100 + percent} * overlap >= {percent} * (n_a + n_b)"

    # Hubs: a linear number of pairs joins most of each group.
    keyed = classes.select("c", "n", "common", F.posexplode("hubs").alias("band", "key"))
    hubs = keyed.groupBy("band", "key").agg(F.max(F.struct("common", "c", "n")).alias("hub"), F.count(F.lit(1)).alias("m"))
    hubs = settle(hubs.where("m > 1").select("band", "key", "hub"), "hubs")
    tried = keyed.join(hubs, ["band", "key"]).where("c <> hub.c")
    tried = tried.where(f"100 * least(n, hub.n) >= {percent} * greatest(n, hub.n)")
    tried = settle(tried.select(F.col("hub.c").alias("a"), F.col("c").alias("b")).distinct(), "tried")
    done = compared(texts, tried, classes, words)
    known = hubs.select(F.col("hub.c").alias("a"), F.col("hub.common").alias("known")).distinct()
    links = done.where(linked).select("a", "b")
    comps = components(links)

    # Each set tried keeps the commonest hub that has half of it, what both share and the shingles outside.
    best = F.max_by(F.struct(F.col("a").alias("hub"), F.col("n_b").alias("n"), F.col("overlap").alias("shared"), "extra"), F.struct("known", "a"))
    held = done.where("extra IS NOT NULL").join(known, "a").groupBy(F.col("b").alias("c")).agg(best.alias("h")).select("c", "h.*")
    held = settle(_with_comp(held, comps), "held")
    extra = settle(held.select("c", "n", "hub", "comp", F.explode("extra").alias("token")), "extra")

    # Prefix shingles that occur in more than one set, each with its set's component and anchor.
    counted = classes.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("m"))
    common = settle(counted.where("m > 1").select("token"), "common")
    bits = marks.MANY_BITS
    bitmap = spark.sparkContext.broadcast(marks.to_array(marks.marked(common, "token", bits), bits))
    picked = classes.select("c", "n", "prefix").mapInArrow(_shared(bitmap), "token long, c long, n long, pos long")
    picked = picked.join(common, "token", "left_semi")
    outside = extra.select("c", "token", F.lit(True).alias("_outside"))
    placed = picked.join(held.select("c", "hub"), "c", "left").join(outside, ["c", "token"], "left")
    anchor = F.when(F.col("_outside"), F.col("c")).otherwise(F.coalesce("hub", "c"))  # the hub where the shingle is the hub's
    places = settle(_with_comp(placed.withColumn("anchor", anchor).select("token", "c", "n", "pos", "anchor"), comps), "places", textslices.TEXTS)
    places = _spread(places, ["token"], ["anchor", "comp"])

    # Prefix join with length and positional filters: the longer set probes, the shorter one is indexed.
    x, y = _sides(places, ["token"], ["c", "n", "pos", "anchor", "comp"])
    y = y.where(f"y_pos <= y_n - {_least_overlap('y_n', 'y_n', percent)}")
    need = _least_overlap("x_n", "y_n", percent)
    joined = x.join(y, "token").where("x_comp <> y_comp AND x_anchor <> y_anchor AND (y_n < x_n OR (y_n = x_n AND y_c < x_c))")
    joined = joined.where(f"100 * y_n >= {percent} * x_n AND least(x_n - x_pos, y_n - y_pos) >= {need} - least(x_pos, y_pos)")
    pairs = joined.select(F.col("x_c").alias("a"), F.col("y_c").alias("b"))

    # Sets with one hub that have a shingle outside it in common.
    x, y = _sides(_spread(extra, ["hub", "token"], ["comp"]), ["hub", "token"], ["c", "n", "comp"])
    joined = x.join(y, ["hub", "token"]).where("x_comp <> y_comp AND (y_n < x_n OR (y_n = x_n AND y_c < x_c))")
    pairs = pairs.union(joined.where(f"100 * y_n >= {percent} * x_n").select(F.col("x_c").alias("a"), F.col("y_c").alias("b")))

    # Sets with one hub that both share enough with it: each names the sizes its partner may have.
    most = F.floor(F.lit(100 + percent) * F.col("shared") / percent).cast("long") - F.col("n")
    sized = held.withColumn("most", most).where(f"100 * most >= {percent} * n").drop("extra")
    sized = settle(_spread(sized, ["hub"], ["comp"]), "sized")
    x, y = _sides(sized, ["hub"], ["c", "n", "most", "comp"])
    x = x.withColumn("y_n", F.explode(F.sequence(F.ceil(F.col("x_n") * percent / 100), F.least("x_n", "x_most"))))
    joined = x.join(y, ["hub", "y_n"]).where("x_comp <> y_comp AND x_n <= y_most AND (y_n < x_n OR y_c < x_c)")
    pairs = pairs.union(joined.select(F.col("x_c").alias("a"), F.col("y_c").alias("b"))).distinct()
    again = tried.select("a", "b").union(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = pairs.join(again, ["a", "b"], "left_anti")

    # Suffix filter: pivots cut both sets into slices; the smaller slice bounds the overlap in each.
    side = classes.select("c", "n", "pivots")
    left = side.select(F.col("c").alias("a"), F.col("n").alias("n_a"), F.col("pivots").alias("p_a"))
    right = side.select(F.col("c").alias("b"), F.col("n").alias("n_b"), F.col("pivots").alias("p_b"))
    near = settle(pairs, "pairs").join(left, "a").join(right, "b")
    near = near.where(f"{_slice_bound('p_a', 'p_b')} >= {_least_overlap('n_a', 'n_b', percent)}")
    near = settle(near.select("a", "b"), "near")
    found = compared(texts, near, classes, words).where(linked)
    comps = components(links.union(found.select("a", "b")))

    placed = settle(_with_comp(members, comps), "placed")
    firsts = settle(placed.where("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("_first")), "firsts")
    return placed.join(firsts, "comp", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("_first")).alias("component_id"),
        "text_hash",
    )


def _with_comp(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows of classes ``c`` with their component; a class without links is its own."""
    found = rows.join(comps.select(F.col("node").alias("c"), "comp"), "c", "left")
    return found.select(*rows.columns, F.coalesce("comp", "c").alias("comp"))


def _spread(rows: DataFrame, keys: list[str], of: list[str]) -> DataFrame:
    """The rows whose key has more than one value in each column of ``of``."""
    ends = [f(c).alias(f"_{n}_{c}") for c in of for n, f in (("low", F.min), ("high", F.max))]
    mixed = rows.groupBy(*keys).agg(*ends).where(" AND ".join(f"_low_{c} < _high_{c}" for c in of))
    return settle(rows.join(settle(mixed.select(*keys), "mixed"), keys, "left_semi"), "spread")


def _sides(rows: DataFrame, keys: list[str], values: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of a self-join, with prefixes."""
    return tuple(rows.select(*keys, *[F.col(v).alias(f"{side}_{v}") for v in values]) for side in "xy")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose id is the smallest of their component, with all columns.

    A row without an id stays only if no linked row has one; rows that repeat
    both id and text stay or go together.
    """
    groups = near_components(df, id_col, text_col)
    gone = groups.where(~F.col(id_col).eqNullSafe(F.col("component_id")))
    gone = gone.select(F.col(id_col).alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    same = df[id_col].eqNullSafe(gone["gone_id"]) & (F.xxhash64(df[text_col]) == gone["gone_hash"])
    return df.join(gone, same, "left_anti")
