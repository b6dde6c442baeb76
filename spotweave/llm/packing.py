"""Packing documents into windows: full windows are cut off, what remains is packed by best-fit decreasing.

Remainders are dealt into groups of a fixed mean size.  In a group the longest
goes first, each into the open window with the least room that still holds it;
a tree over the possible remaining capacities finds that window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.llm import tokens
from spotweave.session import settle

WINDOW = 2048
END = 1  # id that ends a document
GROUP = 20_000  # documents packed together, on average


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree that finds the tightest one that fits."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.open = bytearray(2 * self.leaves)  # whether a node has an open window below it
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, window: int) -> None:
        if not self.windows[room]:
            node = room + self.leaves
            while node and not self.open[node]:
                self.open[node] = 1
                node >>= 1
        self.windows[room].append(window)

    def tightest(self, size: int) -> int:
        """Least remaining capacity of at least ``size`` with an open window; -1 without one."""
        node = size + self.leaves
        if self.open[node]:
            return size
        while node > 1:
            if not node & 1 and self.open[node + 1]:  # the right sibling holds the next larger capacities
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return -1

    def take(self, room: int) -> int:
        window = self.windows[room].pop()
        if not self.windows[room]:
            node = room + self.leaves
            while node and not (node < self.leaves and (self.open[2 * node] or self.open[2 * node + 1])):
                self.open[node] = 0
                node >>= 1
        return window


def best_fit(sizes: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window and offset of each piece, given in decreasing order of size (each 1 to ``window``)."""
    tree, used = OpenWindows(window), 0
    places, offsets = [], []
    for size in sizes:
        room = tree.tightest(size)
        if room < 0:
            own, room, used = used, window, used + 1
        else:
            own = tree.take(room)
        places.append(own)
        offsets.append(window - room)
        if room > size:
            tree.add(room - size, own)
    return places, offsets


def _cut(name: str, end: int, window: int):
    """Task function: each text's number of ids and the crc32 of each of its pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, stop = tokens.encoder(name), np.array([end], dtype="<u4").tobytes()
        for batch in batches:
            for row, ids, ends in encoder.encode(batch.column(1)):
                sizes, sums, begin = [], [], 0
                for until in ends.tolist():
                    data = ids[begin:until].tobytes() + stop
                    sizes.append(len(data) // 4)
                    sums.append([zlib.crc32(data[at : at + 4 * window]) for at in range(0, len(data), 4 * window)])
                    begin = until
                columns = [batch.column(0).slice(row, len(ends)), pa.array(sizes, pa.int64()), pa.array(sums, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "doc_tokens", "sums"])

    return run


def _packed(window: int):
    """Group function; ids stay in Arrow, which keeps null and large ones as they are."""

    def run(group: pa.Table) -> pa.Table:
        keys = [(c, "ascending") for c in ("doc_id", "doc_tokens", "salt")]
        group = group.take(pc.sort_indices(group, sort_keys=keys, null_placement="at_start")).combine_chunks()
        tokens_of = group["doc_tokens"].to_numpy()
        full, rest = tokens_of // window, tokens_of % window
        order = np.argsort(-rest, kind="stable")
        order = order[rest[order] > 0]
        places, offsets = best_fit(rest[order].tolist(), window)
        # Pieces: the full windows of each document, then its remainder.
        row = np.concatenate([np.repeat(np.arange(len(full)), full), order])
        nth = np.concatenate([np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full), full[order]])
        windows = np.concatenate([np.arange(full.sum()) + (max(places) + 1 if places else 0), places]).astype(np.int64)
        sums = group["sums"].combine_chunks()
        first = sums.offsets.to_numpy()[:-1] - sums.offsets[0].as_py()
        columns = {
            "doc_id": group["doc_id"].take(pa.array(row)),
            "start": nth * window,
            "length": np.concatenate([np.full(full.sum(), window), rest[order]]),
            "ids_crc32": sums.flatten().to_numpy()[first[row] + nth],
            "doc_tokens": tokens_of[row],
            "sequence_id": (group["pack"][0].as_py() << 40) + windows,
            "offset": np.concatenate([np.zeros(full.sum(), dtype=np.int64), offsets]).astype(np.int64),
        }
        return pa.table(columns)

    return run


def pack_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = tokens.TOKENIZER,
    end: int = END,
    window: int = WINDOW,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its text's ids and the end id; a null or empty text is the
    end id alone.  A document of at least ``window`` ids is cut into full
    windows, sequences of their own, and a remainder.  Rows with a null or
    repeated id are documents of their own.  Other columns are ignored.

    A task sees the sizes of one group of documents; ids never move.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    cut = rows.mapInArrow(_cut(tokenizer, end, window), "doc_id long, doc_tokens long, sums array<long>")
    cut = settle(cut.withColumn("salt", F.monotonically_increasing_id()), "cut")
    groups = max(1, -(-cut.count() // GROUP))
    dealt = cut.withColumn("pack", F.pmod(F.xxhash64("doc_id", "salt"), F.lit(groups)))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return dealt.groupBy("pack").applyInArrow(_packed(window), schema)


def sequences(df: DataFrame, pieces: DataFrame, id_col="doc_id", text_col="text", tokenizer=tokens.TOKENIZER, end=END) -> DataFrame:
    """The packed ids themselves: ``sequence_id, ids``, for documents whose ids are unique.

    ``ids`` ends where the last piece does; a loader pads it.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer)
        for batch in batches:
            for row, ids, ends in encoder.encode(batch.column(1)):
                lists = [np.append(part, end).astype(np.int64) for part in np.split(ids, ends[:-1])]
                columns = [batch.column(0).slice(row, len(ends)), pa.array(lists, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    held = rows.mapInArrow(read, "doc_id long, ids array<long>").join(pieces, "doc_id")
    part = F.struct("offset", F.expr("slice(ids, cast(start + 1 AS int), cast(length AS int))").alias("ids"))
    joined = F.array_sort(F.collect_list(part))  # at most one window of ids
    return held.groupBy("sequence_id").agg(F.flatten(F.transform(joined, lambda p: p["ids"])).alias("ids"))
