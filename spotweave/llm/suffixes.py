"""Byte passages that an earlier document holds, by a merge sort of suffixes that knows common prefixes.

A document loses every byte of a passage of ``length`` bytes (a window) that a
document with a smaller id holds too.  Sorting every suffix would move each
byte ``length`` times, so suffixes are sorted at anchors only.  The anchor of a
window is the least-hashed gram of ``GRAM`` bytes in it, hence the same
wherever the window occurs, and one anchor serves a run of windows.

1. Grams that only one document has are found in pages of fingerprints and
   left out: their windows occur nowhere else.
2. Each slice of texts sorts its other anchors by what follows and then by what
   stands before, as far as windows reach, folds equal ones, and writes them as
   a front-coded run, cut into ranges of the order.
3. The runs of a range are merged by a loser tree that keeps, for every run,
   how many bytes it shares with the last suffix put out.  Only bytes beyond
   are compared.  The merged order brings equal grams together; there the
   windows of different contexts are compared as whole strings.
4. Verdicts go back to the slices, which cut the bytes out.

A gram with very many occurrences may have as many contexts.  Its windows are
sorted one by one instead: equal ones are one row per slice, and others may go
to different ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.llm import textslices, wordbytes
from spotweave.llm.textslices import paged, rows_of, values_of
from spotweave.session import discard, settle

LENGTH = 50
GRAM = 20
SLICE = 512 << 10  # bytes of text whose suffixes are sorted at once
PAGE = 16 << 20  # bytes of text whose grams fill a page
RANGE = 1 << 16  # suffixes merged by one task at a time, about
HOT = 1 << 16  # occurrences of a gram beyond which its windows are sorted one by one
SAMPLED = 256  # slices from which the ranges are taken, and strings of each
NO_ID = 2**63 - 1  # rows without an id come after all others

_rng = np.random.default_rng(20250321)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Anchors:
    """Anchors of a slice's windows: ``at``, their windows ``first`` to ``last``, the text ``row`` and the gram's ``mark``."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, length: int):
        grams = _gram_hashes(data)
        count = max(0, len(data) - length + 1)
        width = length - GRAM + 1
        least = grams & np.uint64(0xFFFFFFFF00000000) | np.arange(len(grams), dtype=np.uint64)
        done = 1
        while 2 * done <= width:
            least = np.minimum(least[: len(least) - done], least[done:])
            done *= 2
        least = np.minimum(least[:count], least[width - done :][:count]) if count else least[:0]
        anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.arange(count)
        row = np.searchsorted(ends, starts, side="right")
        whole = starts + length <= ends[row] if count else np.zeros(0, dtype=bool)
        starts, anchor, row = starts[whole], anchor[whole], row[whole]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(new)
        self.at, self.row, self.first = anchor[begin], row[begin], starts[begin]
        self.last = starts[np.append(begin[1:], len(starts)) - 1] if len(begin) else starts
        self.mark = grams[self.at]

    def take(self, keep: np.ndarray) -> None:
        for name in ("at", "row", "first", "last", "mark"):
            setattr(self, name, getattr(self, name)[keep])


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed polynomial of each run of ``GRAM`` bytes, from polynomials of half the length."""
    known = {1: _BYTE[data]}
    size = 1
    while 2 * size <= GRAM:
        known[2 * size] = _appended(known[size], known[size], size, size)
        size *= 2
    out, done = known[size], size
    for part in sorted(known, reverse=True):
        while done + part <= GRAM:
            out = _appended(out, known[part], done, part)
            done += part
    return wordbytes.mix(out)


def _appended(left: np.ndarray, right: np.ndarray, size: int, more: int) -> np.ndarray:
    n = max(0, len(right) - size)
    return left[:n] * np.uint64(pow(int(_BASE), more, 2**64)) + right[size : size + n]


def _slices_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Number, ids (null as ``NO_ID``), ends and bytes of the first four columns."""
    for number, ids, ends, data in zip(*(batch.column(c) for c in range(4))):
        yield number.as_py(), ids.values.fill_null(NO_ID).to_numpy(), ends.values.to_numpy(), np.frombuffer(data.as_py(), np.uint8)


def _grams(length: int, pages: int):
    """Task function: distinct grams of each slice with count, least and largest id, one row per page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ids, ends, data in _slices_of(batch):
                anchors = Anchors(data, ends, length)
                page, key = paged(anchors.mark, pages)
                order = np.argsort(key, kind="stable")  # by page, then by gram
                page, key, own = page[order], key[order], ids[anchors.row[order]]
                new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else order
                if not len(new):
                    continue
                low, high = np.minimum.reduceat(own, new), np.maximum.reduceat(own, new)
                counts = np.diff(np.append(new, len(key)))
                page, key = page[new], key[new] & (2**39 - 1)
                at = np.flatnonzero(np.append(True, page[1:] != page[:-1]))
                offsets = np.append(at, len(page))
                packed = [key.astype("<u4"), (key >> 32).astype("u1"), counts.astype("<i4"), low.astype("<i8"), (high - low).astype("<i8")]
                columns = [pa.array(page[at]), pa.array(np.full(len(at), number)), *[rows_of(c, offsets) for c in packed]]
                yield pa.RecordBatch.from_arrays(columns, ["page", "slice", "low", "high", "n", "least", "most"])
        pa.default_memory_pool().release_unused()

    return run


def _shared(hot: int):
    """Group function: the page's grams that documents of different ids have, by slice; negative (minus one) where hot."""

    def run(table: pa.Table) -> pa.Table:
        low, lengths = values_of(table["low"], "<u4")
        high, counts, least, most = (values_of(table[c], k)[0] for c, k in (("high", "u1"), ("n", "<i4"), ("least", "<i8"), ("most", "<i8")))
        key = high.astype(np.int64) << 32 | low
        order = np.argsort(key, kind="stable")
        at = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        size = np.diff(np.append(at, len(key)))
        several = np.minimum.reduceat(least[order], at) < np.maximum.reduceat((least + most)[order], at)
        many = np.add.reduceat(counts[order].astype(np.int64), at) > hot
        keep, often = (np.zeros(len(key), dtype=bool) for _ in range(2))
        keep[order], often[order] = np.repeat(several, size), np.repeat(many, size)
        key |= np.repeat(table["page"].to_numpy(), lengths) << 39
        key = np.where(often, -1 - key, key)
        held = np.diff(np.append(0, np.cumsum(keep))[np.append(np.cumsum(lengths) - lengths, len(keep))])
        columns = [table["slice"].combine_chunks(), rows_of(key[keep], np.append(0, np.cumsum(held))), pa.array(held)]
        return pa.table(columns, ["slice", "keys", "n"]).filter(pa.array(held > 0))

    return run


def _sample(length: int):
    """Task function: whole windows from all over a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, ends, data in _slices_of(batch):
                anchors = Anchors(data, ends, length)
                at = anchors.at[anchors.last == anchors.at]
                at = at[:: max(1, len(at) // SAMPLED)]
                yield pa.RecordBatch.from_arrays([pa.array([data[a : a + length].tobytes() for a in at], pa.binary())], ["start"])

    return run


class Contexts:
    """Sort keys: what follows the anchor, what stands before it backwards, both padded, and the size of each plus one."""

    def __init__(self, length: int):
        self.length, self.before = length, length - GRAM
        self.width = length + self.before + 2

    def keys(self, data: np.ndarray, at, first, last) -> np.ndarray:
        after, before = last + self.length - at, at - first
        out = np.zeros((len(at), self.width), dtype=np.uint8)
        place = np.arange(self.length)
        out[:, : self.length] = np.where(place < after[:, None], data[np.minimum(at[:, None] + place, max(len(data) - 1, 0))], 0)
        place = np.arange(self.before)
        out[:, self.length : -2] = np.where(place < before[:, None], data[np.maximum(at[:, None] - 1 - place, 0)], 0)
        out[:, -2], out[:, -1] = after + 1, before + 1
        return out

    def windows(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key number, place relative to the anchor, and bytes of all windows of some keys."""
        after, before = keys[:, -2].astype(np.int64) - 1, keys[:, -1].astype(np.int64) - 1
        count = after - self.length + before + 1
        own = np.repeat(np.arange(len(keys)), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) - before[own]
        text = np.concatenate([keys[:, self.length : -2][:, ::-1], keys[:, : self.length]], axis=1)
        whole = text[own[:, None], self.before + place[:, None] + np.arange(self.length)]
        return own, place, whole


def front_coded(keys: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes each sorted key shares with the one before, none where ``fresh``, and the bytes it does not share, joined."""
    shared = np.zeros(len(keys), dtype=np.uint8)
    if len(keys) > 1:
        differs = keys[1:] != keys[:-1]
        shared[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), keys.shape[1])
    shared[fresh] = 0
    return shared, keys[np.arange(keys.shape[1]) >= shared[:, None]]


def _runs(length: int, pages: int, starts: list[bytes]):
    """Task function: each slice's sorted run, one row per range, and where its suffixes stand (range -1)."""
    contexts = Contexts(length)
    names = ["range", "slice", "shared", "tails", "numbers", "least", "most", "places"]
    by_gram = np.array([s[:GRAM] for s in starts], dtype=f"S{GRAM}")
    by_window = np.array(starts, dtype=f"S{length}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (number, ids, ends, data), held in zip(_slices_of(batch), batch.column(4)):
                wanted = values_of(held.values, "<i8")[0]
                often = np.sort(-1 - wanted[wanted < 0])
                anchors = Anchors(data, ends, length)
                key = paged(anchors.mark, pages)[1]
                hot = np.isin(key, often)
                anchors.take(hot | np.isin(key, wanted))
                hot = hot[hot | np.isin(key, wanted)]
                # A hot anchor gives one entry for each of its windows.
                count = np.where(hot, anchors.last - anchors.first + 1, 1)
                own = np.repeat(np.arange(len(hot)), count)
                nth = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
                single = anchors.first[own] + nth
                at = np.where(hot[own], single, anchors.at[own])
                first = np.where(hot[own], single, anchors.first[own])
                last = np.where(hot[own], single, anchors.last[own])
                keys = contexts.keys(data, at, first, last)
                order = np.argsort(keys.view(f"S{contexts.width}")[:, 0], kind="stable")
                order = order[np.argsort(hot[own][order], kind="stable")]
                keys, at, of, hot = keys[order], at[order], ids[anchors.row[own[order]]], hot[own][order]
                if not len(keys):
                    continue
                new = np.append(True, (keys[1:] != keys[:-1]).any(axis=1) | (hot[1:] != hot[:-1]))
                fold = np.flatnonzero(new)
                numbers = np.cumsum(new) - 1
                lead = np.ascontiguousarray(keys[fold, :length]).view(f"S{length}")[:, 0]
                place = np.searchsorted(by_gram, lead.astype(f"S{GRAM}"), side="right")
                place = np.where(hot[fold], len(starts) + 1 + np.searchsorted(by_window, lead, side="right"), place)
                at_range = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                offsets = np.append(at_range, len(fold))
                shared, tails = front_coded(keys[fold], at_range)
                ends_of = np.append(0, np.cumsum(contexts.width - shared.astype(np.int64)))[offsets]
                packed = [rows_of(shared, offsets), rows_of(tails, ends_of), rows_of(at_range.astype("<i4"), np.arange(len(at_range) + 1))]
                least, most = (f.reduceat(of, fold).astype("<i8") for f in (np.minimum, np.maximum))
                packed += [rows_of(c, offsets) for c in (least, most - least)]
                empty = pa.nulls(len(at_range), pa.binary())
                columns = [pa.array(place[at_range].astype(np.int32)), pa.array(np.full(len(at_range), number)), *packed, empty]
                yield pa.RecordBatch.from_arrays(columns, names)
                none = pa.nulls(1, pa.binary())
                stand = [pa.array([c.astype("<i4").tobytes()], pa.binary()) for c in (numbers, at)]
                yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([number]), none, none, stand[0], none, none, stand[1]], names)
        pa.default_memory_pool().release_unused()

    return run


def merge(runs: list[tuple[list[bytes], list[int]]], width: int) -> tuple[list[int], list[int]]:
    """Merge sorted runs of keys, each with what it shares with the key before: run of each key in order, and what it shares.

    A loser tree; ``known[r]`` is what the next key of run r shares with the
    last key that won against it.  Of two contenders the one that shares more
    with the last winner is smaller; if both share as much, only bytes beyond
    are compared.
    """
    size = 1 << max(0, len(runs) - 1).bit_length()
    known = [0] * len(runs) + [-1] * (size - len(runs))  # -1: at its end
    heads = [keys[0] for keys, _ in runs] + [b""] * (size - len(runs))
    nexts = [1] * len(runs)

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser."""
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        at = known[a]
        if at < 0:
            return a, b
        x, y = int.from_bytes(heads[a][at:], "big"), int.from_bytes(heads[b][at:], "big")
        same = width - ((x ^ y).bit_length() + 7) // 8
        if x <= y:
            known[b] = same
            return a, b
        known[a] = same
        return b, a

    winners = [*([0] * size), *range(size)]
    losers = [0] * size
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if size > 1 else 0
    out, shared = [], []
    for _ in range(sum(len(keys) for keys, _ in runs)):
        out.append(best)
        shared.append(known[best])
        keys, lengths = runs[best]
        nth = nexts[best]
        if nth < len(keys):
            heads[best], known[best] = keys[nth], lengths[nth]
            nexts[best] = nth + 1
        else:
            known[best] = -1
        node = (best + size) >> 1
        while node:
            other = losers[node]
            if known[other] > known[best]:
                losers[node], best = best, other
            elif known[other] == known[best]:
                best, losers[node] = play(best, other)
            node >>= 1
    return out, shared


def decoded(shared: np.ndarray, tails: bytes, width: int) -> list[bytes]:
    """The keys of a front-coded run."""
    out, at, last = [], 0, b""
    for n in shared.tolist():
        last = last[:n] + tails[at : at + width - n]
        at += width - n
        out.append(last)
    return out


def _merged(length: int):
    """Group function: which windows of which suffixes a document with a smaller id has, by slice."""
    contexts = Contexts(length)

    def run(table: pa.Table) -> pa.Table:
        width, runs, numbers, least, most = contexts.width, [], [], [], []
        for shared, tails, *others in zip(*(table[c] for c in ("shared", "tails", "numbers", "least", "most"))):
            lengths = np.frombuffer(shared.as_py(), np.uint8)
            runs.append((decoded(lengths, tails.as_py(), width), lengths.tolist()))
            first, low, more = (np.frombuffer(value.as_py(), kind) for value, kind in zip(others, ("<i4", "<i8", "<i8")))
            numbers.append(first[0] + np.arange(len(lengths)))
            least.append(low)
            most.append(low + more)
        origin, common = (np.array(x, dtype=np.int64) for x in merge(runs, width))
        # The nth key of a run in merged order is its nth key.
        sizes = np.array([len(k) for k, _ in runs])
        flat = np.empty(len(origin), dtype=np.int64)
        by_run = np.argsort(origin, kind="stable")
        flat[by_run] = np.arange(len(origin))  # places in the runs, one after the other
        numbers, least, most = (np.concatenate(x)[flat] for x in (numbers, least, most))
        new = common < width
        new[0] = True
        kind = np.cumsum(new) - 1  # equal contexts
        firsts = np.flatnonzero(new)
        joined = np.frombuffer(b"".join(b"".join(k) for k, _ in runs), np.uint8).reshape(-1, width)
        distinct = joined[flat[firsts]]
        smallest = np.minimum.reduceat(least, firsts)
        # Contexts that share no gram with a neighbour, and all of whose copies agree, need no look at windows.
        near = np.append(common[firsts][1:] >= GRAM, False)
        near[1:] |= common[firsts][1:] >= GRAM
        own, place, low = [], [], []
        for part in np.array_split(np.flatnonzero(near), max(1, near.sum() // 20_000)) if near.any() else []:
            some, where, whole = contexts.windows(distinct[part])
            own.append(part[some])
            place.append(where)
            low.append(np.ascontiguousarray(whole).view(f"V{length}")[:, 0])
        if own:
            own, place, whole = np.concatenate(own), np.concatenate(place), np.concatenate(low)
            order = np.argsort(whole.view(f"S{length}"), kind="stable")  # no window ends before its length, so nulls inside count
            raw = whole.view(np.uint8).reshape(-1, length)[order]
            fresh = np.flatnonzero(np.append(True, (raw[1:] != raw[:-1]).any(axis=1)))
            low = np.empty(len(own), dtype=np.int64)
            low[order] = np.repeat(np.minimum.reduceat(smallest[own[order]], fresh), np.diff(np.append(fresh, len(order))))
        else:
            own, place, low = (np.zeros(0, dtype=np.int64) for _ in range(3))
        alone = np.flatnonzero(~near)
        after, before = distinct[alone, -2].astype(np.int64) - 1, distinct[alone, -1].astype(np.int64) - 1
        # Windows next to one another with one verdict become one.
        step = np.append(True, (own[1:] != own[:-1]) | (low[1:] != low[:-1]))[: len(own)]
        begin = np.flatnonzero(step)
        stop = np.append(begin[1:], len(own)) - 1 if len(begin) else begin
        own = np.concatenate([own[begin], alone])
        first = np.concatenate([place[begin], -before])
        last = np.concatenate([place[stop], after - length])
        low = np.concatenate([low[begin], smallest[alone]])
        # Back to each run's entry of that context.
        order = np.argsort(own, kind="stable")
        own, first, last, low = own[order], first[order], last[order], low[order]
        start, end = np.searchsorted(own, kind), np.searchsorted(own, kind, side="right")
        entry = np.repeat(np.arange(len(kind)), end - start)
        which = np.arange(len(entry)) - np.repeat(np.cumsum(end - start) - (end - start), end - start) + start[entry]
        needed = low[which] < most[entry]
        entry, which = entry[needed], which[needed]
        order = np.argsort(origin[entry], kind="stable")
        entry, which = entry[order], which[order]
        offsets = np.searchsorted(origin[entry], np.arange(len(sizes) + 1))
        packed = [numbers[entry].astype("<i4"), first[which].astype("i1"), last[which].astype("i1"), low[which].astype("<i8")]
        found = pa.table([table["slice"].combine_chunks(), *[rows_of(c, offsets) for c in packed]], ["slice", "numbers", "first", "last", "low"])
        return found.filter(pa.array(np.diff(offsets) > 0))

    return run


def removed(size: int, ids: np.ndarray, ends: np.ndarray, length: int, numbers, places, verdicts) -> np.ndarray:
    """Which bytes of a slice go."""
    cover = np.zeros(size + 1, dtype=np.int64)
    wanted, first, last, low = verdicts
    start, end = np.searchsorted(numbers, wanted), np.searchsorted(numbers, wanted, side="right")  # numbers ascend
    which = np.repeat(np.arange(len(wanted)), end - start)
    at = places[np.arange(len(which)) - np.repeat(np.cumsum(end - start) - (end - start), end - start) + start[which]]
    row = np.searchsorted(ends, at, side="right")
    gone = low[which] < ids[row]
    np.add.at(cover, (at + first[which])[gone], 1)
    np.add.at(cover, (at + last[which] + length)[gone], -1)
    return np.cumsum(cover)[:-1] > 0


def _cut(length: int, texts: bool):
    """Task function: what is left of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (_, ids, ends, data), own, numbers, places, held in zip(_slices_of(batch), batch.column(1), *(batch.column(c) for c in (4, 5, 6))):
                gone = np.zeros(len(data), dtype=bool)
                if held.is_valid:
                    parts = [values_of(held.values.field(c), kind)[0].astype(np.int64) for c, kind in (("numbers", "<i4"), ("first", "i1"), ("last", "i1"), ("low", "<i8"))]
                    numbers, places = (np.frombuffer(c.as_py(), "<i4") for c in (numbers, places))
                    gone = removed(len(data), ids, ends, length, numbers, places, parts)
                counts, spans, digests, kept = [], [], [], []
                start = 0
                for stop in ends.tolist():
                    part = gone[start:stop]
                    left = data[start:stop][~part].tobytes()
                    counts.append(int(part.sum()))
                    spans.append(int(part[:1].sum()) + int((part[1:] & ~part[:-1]).sum()))
                    digests.append(hashlib.sha256(left).hexdigest())
                    kept.append(left if texts else None)
                    start = stop
                columns = [own.values, pa.array(np.diff(ends, prepend=0)), pa.array(counts, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests)]
                columns += [pa.array(kept, pa.binary())] if texts else []
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: len(columns)])

    return run


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT, texts: bool = False) -> DataFrame:
    """One row per row of ``df``: ``id_col, n_bytes, n_removed, n_spans, kept_sha256``, and the ``kept`` bytes with ``texts``.

    Bytes of the UTF-8 text go where a string of ``length`` (25 to 100) bytes
    that also starts in a row with a smaller id covers them, as judged on the
    input.  Null texts are empty; shorter ones lose nothing.  Rows with one id
    take nothing from one another; rows without an id come after all others
    and take nothing from one another either.  Other columns are ignored.
    """
    if not GRAM + 5 <= length <= 100:
        raise ValueError(f"length must be {GRAM + 5} to 100")
    slices = textslices.sliced(df, F.col(text_col), {"ids": F.col(id_col).cast("long")}, SLICE)
    pages = textslices.pages_for(slices, PAGE)
    read = slices.select("slice", "ids", "ends", "data")
    grams = read.mapInArrow(_grams(length, pages), "page long, slice long, low binary, high binary, n binary, least binary, most binary")
    shared = settle(grams.groupBy("page").applyInArrow(_shared(hot), "slice long, keys binary, n long"), "shared", textslices.SLICES)
    n_slices, n_shared = slices.count(), shared.agg(F.sum("n")).first()[0] or 0

    # Range starts from a bounded sample; they only decide how even the ranges are.
    some = read.where(F.pmod(F.xxhash64("slice"), F.lit(-(-n_slices // SAMPLED) or 1)) == 0)
    sample = sorted(r["start"] for r in some.mapInArrow(_sample(length), "start binary").collect()) if n_shared else []
    ranges = max(1, -(-n_shared // RANGE))
    starts = sorted({bytes(sample[i * len(sample) // ranges]) for i in range(1, ranges)}) if sample else []

    of_slice = shared.groupBy("slice").agg(F.collect_list("keys").alias("keys"))  # one slice's grams at most
    looked = read.join(of_slice, "slice").select("slice", "ids", "ends", "data", "keys")
    schema = "range int, slice long, shared binary, tails binary, numbers binary, least binary, most binary, places binary"
    runs = settle(looked.mapInArrow(_runs(length, pages, starts), schema), "runs", textslices.SLICES, "zstd")
    discard(shared)
    merged = runs.where("range >= 0").groupBy("range").applyInArrow(_merged(length), "slice long, numbers binary, first binary, last binary, low binary")
    verdicts = settle(merged, "verdicts")
    judged = verdicts.groupBy("slice").agg(F.collect_list(F.struct("numbers", "first", "last", "low")).alias("held"))  # likewise
    stand = runs.where("range = -1").select("slice", "numbers", "places").join(judged, "slice")
    out = f"doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string{', kept binary' if texts else ''}"
    rows = read.join(stand, "slice", "left").select("slice", "ids", "ends", "data", "numbers", "places", "held")
    return settle(rows.mapInArrow(_cut(length, texts), out), "cut", textslices.SLICES).withColumnRenamed("doc_id", id_col)
