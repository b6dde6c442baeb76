"""Whole texts as a table of slices: many texts, or one very long one, in a row.

Operators that look at a text several times, or that point into texts, work on
slices: a slice's number and the place in it name an occurrence, whether ids
are null or repeat, and joins by slice have one row for each on either side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.llm import wordbytes
from spotweave.session import settle

TEXTS = 1000  # texts that reach a task at once
SLICES = 16  # slices that reach a task at once


def sliced(df: DataFrame, text: Column, of: dict[str, Column], size: int) -> DataFrame:
    """``slice, n_bytes, ends, data`` and one array per column of ``of``, written to the shared folder.

    ``data`` holds the UTF-8 bytes of the slice's texts, about ``size`` of them,
    and ``ends`` where each ends; null counts as empty.
    """
    rows = df.select(text.alias("_text"), *[c.alias(name) for name, c in of.items()])
    names = ["slice", "n_bytes", "ends", "data", *of]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, data, ends in wordbytes.slices(batch.column(0), size):
                lists = [pa.ListArray.from_arrays([0, len(ends)], c.slice(first, len(ends))) for c in batch.columns[1:]]
                own = [pa.array([number]), pa.array([len(data)]), pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([data.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays([*own, *lists], names)
                number += 1

    kinds = "".join(f", {f.name} array<{f.dataType.simpleString()}>" for f in rows.schema.fields[1:])
    return settle(rows.mapInArrow(cut, f"slice long, n_bytes long, ends array<long>, data binary{kinds}"), "slices", TEXTS, "zstd")


def pages_for(slices: DataFrame, page_bytes: int) -> int:
    """Number of pages when the fingerprints of so many bytes of text go to one page."""
    return max(1, -(-(slices.agg(F.sum("n_bytes")).first()[0] or 0) // page_bytes))


def paged(marks: np.ndarray, pages: int) -> tuple[np.ndarray, np.ndarray]:
    """Page of each 64-bit fingerprint, and its key: the page and the low 39 bits."""
    page = ((marks >> np.uint64(40)) % np.uint64(pages)).astype(np.int64)
    return page, page << 39 | (marks & np.uint64(2**39 - 1)).astype(np.int64)


def rows_of(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary rows that hold the values between offsets; Spark moves them whole."""
    places = (offsets * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(values))])


def values_of(rows: pa.Array | pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of binary rows, and how many each row has."""
    kind, parts, lengths = np.dtype(kind), [], []
    for chunk in rows.chunks if isinstance(rows, pa.ChunkedArray) else [rows]:
        places = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1] if len(chunk) else np.zeros(1, int)
        parts.append(np.frombuffer((chunk.buffers()[2] or b"") if len(chunk) else b"", np.uint8)[places[0] : places[-1]])
        lengths.append(np.diff(places) // kind.itemsize)
    return np.concatenate([*parts, np.zeros(0, np.uint8)]).view(kind), np.concatenate([*lengths, np.zeros(0, int)]).astype(np.int64)
