"""Phrase collocations from Rabin-Karp fingerprints of all word n-grams.

Texts are cut into slices.  In a slice, prefix polynomials give every word and
n-gram a fingerprint; equal ones are compared word by word and folded to one
entry: fingerprint, count and where the n-gram first occurs.  Entries meet in
pages, ranges of fingerprints; a page sums the counts and keeps the pointers of
fingerprints that are frequent.  Only these are looked up in the texts, and
counted by their text, so that no collision of fingerprints is left.  All later
steps are joins of frequent phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.llm import textslices, wordbytes
from spotweave.llm.textslices import rows_of, values_of
from spotweave.operators.ranking import number_within
from spotweave.session import discard, settle

SLICE = 256 << 10  # bytes of text in a slice, about; Spark moves slices as rows
FOLD = 2 << 20  # bytes of slices folded at once
PAGE = 4 << 20  # bytes of text whose n-grams fill a page, about: some millions of entries, however large the corpus
WORDS, LEAST, INSIDE, TOP, SCALE = 3, 10, 50, 2000, 1_000_000
_PIECE = np.zeros(256, dtype=bool)  # ends a piece, and a word
_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BREAK = _PIECE.copy()
_BREAK[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def same_runs(data: np.ndarray, begin: np.ndarray, end: np.ndarray, of: np.ndarray, step: int = 100_000) -> bool:
    """Whether each byte run equals the run with number ``of``."""
    length = end - begin
    if (length != length[of]).any():
        return False
    for first in range(0, len(begin), step):
        part = slice(first, first + step)
        sizes = length[part]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        if (data[np.repeat(begin[part], sizes) + within] != data[np.repeat(begin[of[part]], sizes) + within]).any():
            return False
    return True


def word_numbers(data: np.ndarray, begin: np.ndarray, end: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """A number for each word, the same for the same bytes only."""
    _, first, number = np.unique(hashed, return_index=True, return_inverse=True)
    if same_runs(data, begin, end, first[number]):
        return number
    seen: dict[bytes, int] = {}  # two words share a fingerprint
    whole = data.tobytes()
    return np.array([seen.setdefault(whole[b:e], len(seen)) for b, e in zip(begin.tolist(), end.tolist())])


def folded(data, ends, langs, lasts, words: int):
    """Fingerprint, count, slice and pointer (4 * first word + size) of all n-grams of some slices.

    ``ends`` and ``langs`` are those of the texts, ``lasts`` the bytes where slices end.
    """
    data = _LOWER[data]
    begin, end = wordbytes.bounds(data, ends, _BREAK)
    stops = np.searchsorted(begin, lasts)  # words up to the end of each slice
    hashed = wordbytes.hashes(data, begin, end)
    number = word_numbers(data, begin, end, hashed)
    row = np.searchsorted(np.searchsorted(begin, ends), np.arange(len(begin)), side="right")
    piece = np.searchsorted(np.flatnonzero(_PIECE[data]), begin) + row
    lang = langs.view(np.uint64)[row]
    out = []
    for size in range(1, words + 1):
        grams = wordbytes.sequences(hashed, size)
        start = np.flatnonzero(piece[: len(grams)] == piece[size - 1 :][: len(grams)])
        marks = wordbytes.mix(grams[start] ^ (lang[start] + np.uint64(size)))
        order = np.argsort(marks, kind="stable")
        marks, start = marks[order], start[order]
        new = np.ones(len(marks), dtype=bool)
        new[1:] = (marks[1:] != marks[:-1]) | (lang[start[1:]] != lang[start[:-1]])
        for k in range(size):
            new[1:] |= number[start[1:] + k] != number[start[:-1] + k]
        at = np.flatnonzero(new)
        first = start[at]
        own = np.searchsorted(stops, first, side="right")
        pointers = (first - np.append(0, stops)[own]) * 4 + size
        out.append((marks[at], np.diff(np.append(at, len(marks))), own, pointers))
    return tuple(np.concatenate(c) for c in zip(*out))


def _entries(words: int, pages: int):
    """Task function: the entries of slices folded together, one row per page and slice."""

    def fold(numbers: list[int], langs: list, ends: list, data: list) -> pa.RecordBatch:
        lasts = np.cumsum([len(d) for d in data])
        ends = np.concatenate([e + last - len(d) for e, last, d in zip(ends, lasts, data)])
        marks, counts, own, pointers = folded(np.concatenate(data), ends, np.concatenate(langs), lasts, words)
        page = ((marks >> np.uint64(32)) % np.uint64(pages)).astype(np.int64)
        order = np.lexsort((pointers, own, page))  # pointers ascend, so their steps are small
        marks, page, counts, own, pointers = marks[order], page[order], counts[order], own[order], pointers[order]
        new = np.ones(len(page), dtype=bool)
        new[1:] = (page[1:] != page[:-1]) | (own[1:] != own[:-1])
        at = np.flatnonzero(new)
        steps = np.diff(pointers, prepend=0)
        steps[at] = pointers[at]
        packed = [marks.astype("<u4"), (marks >> np.uint64(32)).astype(np.uint8), counts.astype("<i4"), steps.astype("<i4")]
        packed = [rows_of(c, np.append(at, len(page))) for c in packed]
        return pa.RecordBatch.from_arrays([pa.array(page[at]), pa.array(np.array(numbers)[own[at]]), *packed], ["page", "slice", "low", "high", "n", "step"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for number, langs, ends, data in zip(*(batch.column(c) for c in range(4))):
                held.append((number.as_py(), langs.values.to_numpy().copy(), ends.values.to_numpy().copy(), np.frombuffer(data.as_py(), np.uint8)))
                if sum(len(d) for *_, d in held) >= FOLD:
                    yield fold(*zip(*held))
                    held = []
        if held:
            yield fold(*zip(*held))
        pa.default_memory_pool().release_unused()  # the worker may serve other stages next

    return run


def _frequent(least: int):
    """Group function: the pointers of a page whose fingerprints are frequent, by slice."""

    def run(table: pa.Table) -> pa.Table:
        low, lengths = values_of(table["low"], "<u4")
        high, counts, steps = (values_of(table[c], kind)[0] for c, kind in (("high", "u1"), ("n", "<i4"), ("step", "<i4")))
        first = np.cumsum(lengths) - lengths
        reach = np.append(0, np.cumsum(steps, dtype=np.int64))
        pointers = (reach[1:] - np.repeat(reach[first], lengths)).astype("<i4")
        marks = high.astype(np.uint64) << np.uint64(32) | low
        order = np.argsort(marks, kind="stable")
        at = np.flatnonzero(np.append(True, marks[order][1:] != marks[order][:-1])) if len(marks) else order
        sums = np.add.reduceat(counts[order].astype(np.int64), at) if len(at) else at
        keep = np.zeros(len(marks), dtype=bool)
        keep[order] = np.repeat(sums >= least, np.diff(np.append(at, len(marks))))
        held = np.diff(np.append(0, np.cumsum(keep))[np.append(first, len(keep))])
        offsets = np.append(0, np.cumsum(held))
        columns = [table["slice"].combine_chunks(), rows_of(pointers[keep], offsets), rows_of(counts[keep], offsets)]
        return pa.table(columns, ["slice", "pointer", "n"]).filter(pa.array(held > 0))

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: the text of each pointer with its count, and the words of each language (size 0)."""
    for batch in batches:
        for langs, ends, data, pointers, counts in zip(*(batch.column(c) for c in range(5))):
            data, ends = _LOWER[np.frombuffer(data.as_buffer(), np.uint8)], ends.values.to_numpy()
            begin, end = wordbytes.bounds(data, ends, _BREAK)
            stops = np.searchsorted(begin, ends)
            words = pa.array(np.diff(stops, prepend=0))
            totals = pa.table([langs.values, words], ["lang", "n"]).group_by("lang").aggregate([("n", "sum")]).combine_chunks()
            for part in totals.to_batches():
                zero = pa.array(np.zeros(part.num_rows, np.int32))
                yield pa.RecordBatch.from_arrays([part.column("lang"), zero, pa.nulls(part.num_rows, pa.string()), part.column("n_sum")], _COUNTED)
            if not pointers.is_valid:
                continue
            (pointers, _), (counts, _) = values_of(pointers.values, "<i4"), values_of(counts.values, "<i4")
            for at in range(0, len(pointers), 50_000):
                part = pointers[at : at + 50_000]
                first, size = part >> 2, part & 3
                phrase = joined(data, begin, end, first, size)
                lang = langs.values.take(pa.array(np.searchsorted(stops, first, side="right")))
                columns = [lang, pa.array(size.astype(np.int32)), phrase, pa.array(counts[at : at + 50_000].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, _COUNTED)


_COUNTED = ["lang", "size", "phrase", "n"]


def joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray, size: np.ndarray) -> pa.Array:
    """The words from ``first`` on, ``size`` of them, joined by one space."""
    nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    word = np.repeat(first, size) + nth
    length = end[word] - begin[word] + 1  # with a space after each word
    reach = np.cumsum(length)
    within = np.arange(reach[-1] if len(reach) else 0) - np.repeat(reach - length, length)
    source = np.repeat(begin[word], length) + within
    space = within == np.repeat(length - 1, length)
    out = np.where(space, np.uint8(0x20), data[np.minimum(source, len(data) - 1)])
    stops = reach[np.cumsum(size) - 1]
    last = np.zeros(len(out), dtype=bool)
    last[stops - 1] = True  # the space after a phrase goes
    offsets = np.append(0, stops - np.arange(1, len(stops) + 1)).astype(np.int32)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(out[~last].tobytes()))


def frequent_phrases(df: DataFrame, text_col: str = "text", lang: str | Column = "lang", words: int = WORDS, least: int = LEAST) -> DataFrame:
    """``lang, size, phrase, n``: all phrases of 1 to ``words`` (at most 3) words that occur ``least`` times in a language.

    A text is lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into
    pieces, these at spaces and tabs into words.  Every contiguous occurrence
    inside a piece counts, overlapping ones too.  A row of ``size`` 0 without
    phrase holds a language's number of words.  Null and empty texts have no words.
    """
    if not 1 <= words <= 3:
        raise ValueError("pointers have room for phrases of 1 to 3 words")
    lang = F.col(lang) if isinstance(lang, str) else lang
    slices = textslices.sliced(df, F.col(text_col), {"lang": lang}, SLICE)
    pages = textslices.pages_for(slices, PAGE)
    keyed = slices.select("slice", F.transform("lang", lambda x: F.xxhash64(x)).alias("langs"), "ends", "data")
    entries = keyed.mapInArrow(_entries(words, pages), "page long, slice long, low binary, high binary, n binary, step binary")
    found = settle(entries.groupBy("page").applyInArrow(_frequent(least), "slice long, pointer binary, n binary"), "pointers", textslices.SLICES)
    of_slice = found.groupBy("slice").agg(F.collect_list(F.struct("pointer", "n")).alias("held"))  # one slice's n-grams at most
    looked = slices.join(of_slice, "slice", "left").select("lang", "ends", "data", F.col("held.pointer").alias("pointer"), F.col("held.n").alias("n"))
    texts = looked.mapInArrow(_texts, "lang string, size int, phrase string, n long")
    counted = texts.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).where((F.col("size") == 0) | (F.col("n") >= least))
    out = settle(counted, "phrases", textslices.SLICES)
    discard(slices)
    discard(found)
    return out


def collocations(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    words: int = WORDS,
    least: int = LEAST,
    inside: int = INSIDE,
    top: int = TOP,
    scale: int = SCALE,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` counts the phrase of 2 to ``words`` words, ``l`` and ``r`` the two
    parts of its lowest-scoring cut (ties: the first), ``n`` all words of the
    language (null: ``und``), and ``score`` is floor(scale * a * a / (l * r)).
    Phrases found inside a longer one that has at least ``inside`` percent of
    their count are left out.  The order is score, then ``a``, descending, then
    the phrase's bytes.  Null and empty texts, and empty tables, add nothing;
    repeated rows each count; other columns are ignored.  Counts may reach 10**16.
    """
    lang = F.coalesce(F.col(lang_col), F.lit("und"))
    counted = frequent_phrases(df, text_col, lang, words, least)
    totals = counted.where("size = 0").select("lang", F.col("n").alias("all_words"))
    parts = counted.where("size > 0").select("lang", "size", "phrase", F.col("n").alias("a"))
    split = parts.where("size > 1").withColumn("_words", F.split("phrase", " "))

    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("left", F.array_join(F.expr("slice(_words, 1, k)"), " ")).withColumn("right", F.array_join(F.expr("slice(_words, k + 1, size)"), " "))
    cuts = cuts.drop("_words")
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("a").alias(count)), ["lang", side])
    big = "cast({} AS decimal(20, 0))".format
    score = F.expr(f"({big('a')} * {big('a')} * cast({scale} AS decimal(38, 0))) div ({big('l')} * {big('r')})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(lowest).select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")

    longer = split.where("size > 2").withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    inner = F.array_join(F.expr("slice(_words, at, length)"), " ").alias("phrase")
    longer = longer.select("lang", inner, "a").groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(f"_longer IS NULL OR 100 * _longer < {inside} * a")

    kept = kept.select("lang", "phrase", "a", "l", "r", "score")
    ranked = number_within(kept, ["lang"], [F.col("score").desc(), F.col("a").desc(), "phrase"], "_place").where(F.col("_place") < top)
    found = ranked.join(totals, "lang")
    return found.select("lang", (F.col("_place") + 1).cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("all_words").alias("n"), "score")
