"""Token ids as fixed-width bit-packed blocks, written in id order and read back by position.

File format: Parquet shards, one row per block, in ascending (shard, block).

====================  =====================================================
``shard, block``      place of the block; shards follow the order of ids
``start``             ids of the shard before this block
``width``             bits of an id: the least that hold the vocabulary
``doc_ids``           documents of the block, in order
``lengths``           ids of each of them, end id included
``payload``           all their ids, ``width`` bits each, low bits first
====================  =====================================================

Id ``i`` of a block starts at bit ``i * width``, so any document is found from
the lengths alone, and a block is unpacked by NumPy in one go.  A block holds
whole documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotweave.llm import tokens
from spotweave.session import fresh_path

BLOCK = 1 << 18  # ids after which a block is closed
END = 2  # id that ends a document
SCHEMA = "shard int, block int, start long, width int, doc_ids array<long>, lengths array<long>, payload binary"
_PART = 1 << 16  # ids packed at once


def width_of(vocabulary: int) -> int:
    """Least number of bits for ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids at ``width`` bits each, low bits first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    parts = []
    for start in range(0, len(ids), _PART):  # _PART * width is a multiple of 8
        part = ids[start : start + _PART].astype("<u4")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
        parts.append(np.packbits(bits.reshape(-1), bitorder="little").tobytes())
    return b"".join(parts)


def unpack(payload: bytes, width: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from position ``start`` on, as unsigned 32-bit integers."""
    first, last = start * width // 8, -(-(start + count) * width // 8)
    data = np.frombuffer(payload, dtype=np.uint8)[first:last]
    if width in (8, 16, 32):
        return data.view(f"<u{width // 8}").astype("<u4")
    out = np.empty(count, dtype="<u4")
    places = (1 << np.arange(width, dtype=np.uint32)).astype(np.uint32)
    for done in range(0, count, _PART):
        n = min(_PART, count - done)
        bit = (start + done) * width - first * 8
        bits = np.unpackbits(data[bit // 8 : -(-(bit + n * width) // 8)], bitorder="little")[bit % 8 : bit % 8 + n * width]
        out[done : done + n] = bits.reshape(n, width) @ places
    return out


def _blocks(name: str, end: int, width: int):
    """Task function: sorted (id, text) rows to packed blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, block, start = tokens.encoder(name), TaskContext.get().partitionId(), 0, 0
        doc_ids, lengths, parts, held = [], [], [], 0

        def closed() -> pa.RecordBatch:
            data = pack(np.concatenate(parts), width)
            values = [[shard], [block], [start], [width], [doc_ids], [lengths], [data]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["shard", "block", "start", "width", "doc_ids", "lengths", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names)

        stop = np.array([end], dtype="<u4")
        for batch in batches:
            own = batch.column(0).to_pylist()
            for row, ids, ends in encoder.encode(batch.column(1)):
                begin = 0
                for i, until in enumerate(ends.tolist(), row):
                    doc_ids.append(own[i])
                    lengths.append(until - begin + 1)
                    parts += [ids[begin:until], stop]
                    held += until - begin + 1
                    begin = until
                    if held >= BLOCK:
                        yield closed()
                        block, start = block + 1, start + held
                        doc_ids, lengths, parts, held = [], [], [], 0
        if held:
            yield closed()

    return run


def write_tokens(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = tokens.TOKENIZER, end: int = END
) -> None:
    """Encode whole texts and write them in ascending order of ``id_col`` (null first, ties by text).

    A null or empty text is its end id alone.  Rows with one id stay rows of
    their own.  Texts are range-partitioned by id and text hash, so neither a
    frequent id nor a long table meets in one task.  Other columns are ignored.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = ["id", F.xxhash64("text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    width = width_of(max(tokens.vocabulary(tokenizer), end + 1))
    placed.mapInArrow(_blocks(tokenizer, end, width), SCHEMA).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``base``: ids of all blocks before, over all shards."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    sizes = blocks.select("shard", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    totals = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    bases = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return blocks.join(bases, "shard").withColumn("base", F.col("before") + F.col("start")).drop("before")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for base, width, doc_ids, lengths, payload in zip(*(c.to_pylist() for c in batch.columns)):
            data = unpack(payload, width, 0, sum(lengths)).tobytes()
            ends = np.cumsum(lengths)
            starts = ends - lengths
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            columns = [pa.array(doc_ids, pa.int64()), pa.array(base + starts), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, decoded from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    blocks = read_blocks(spark, path).select("base", "width", "doc_ids", "lengths", "payload")
    return blocks.mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Ids of some documents by random access: only their bits of a block are unpacked."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, own, lengths, payload in zip(*(c.to_pylist() for c in batch.columns)):
                starts = np.cumsum(lengths) - lengths
                found = [(d, unpack(payload, width, int(s), n).tolist()) for d, s, n in zip(own, starts, lengths) if d in wanted]
                columns = [pa.array([d for d, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])

    wanted = set(doc_ids)
    held = F.arrays_overlap("doc_ids", F.array(*[F.lit(d).cast("long") for d in doc_ids]))
    blocks = spark.read.schema(SCHEMA).parquet(path).where(held).select("width", "doc_ids", "lengths", "payload")
    return blocks.mapInArrow(fetch, "doc_id long, ids array<long>")


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = tokens.TOKENIZER, end: int = END) -> DataFrame:
    """Write the texts to a fresh folder of the shared one and read the documents back."""
    path = fresh_path(df.sparkSession, "tokens")
    write_tokens(df, path, id_col, text_col, tokenizer, end)
    return read_documents(df.sparkSession, path)
