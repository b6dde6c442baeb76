"""Cell barcodes: complexity, error collapse, filters and library matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.functions.vectors import complexity_score, hamming, kth_lowest
from spotweave.session import discard, settle

# Fixed values of the default run.
COMPLEXITY_MIN, SCORE_MIN, SIGNAL_MIN = -0.9, 0.85, 150
COUNT_MIN, ERRORS_MAX = 3, 2


def unique_barcodes(spots: DataFrame) -> DataFrame:
    """Distinct barcodes of every cell with their number of spots."""
    return spots.groupBy("cell_id", "seq").agg(F.count(F.lit(1)).alias("n"))


def segments(seq: str | Column, errors: int) -> Column:
    """``errors`` + 1 parts of a sequence, of like size.

    Two sequences of one length that differ in at most ``errors`` positions
    have at least one part in common, since every difference lies in one part.
    """
    s = F.col(seq) if isinstance(seq, str) else seq
    cut = lambda i: F.floor(F.length(s) * F.lit(i) / F.lit(errors + 1)).cast("int")
    return F.array(*[F.substr(s, cut(i) + 1, cut(i + 1) - cut(i)) for i in range(errors + 1)])


def _close_pairs(uniq: DataFrame, errors: int) -> DataFrame:
    """Pairs of one cell within the distance, the earlier one (in collapse order) as ``parent``.

    Barcodes meet where a segment agrees; a pair is measured at its first such
    segment only, so it comes out once.
    """
    side = uniq.select("cell_id", "seq", "n", F.length("seq").alias("_len"), segments("seq", errors).alias("_parts"))
    side = side.select("*", F.posexplode("_parts").alias("_nth", "_key"))
    other = side.select("cell_id", "_len", "_nth", "_key", F.col("seq").alias("parent"), F.col("n").alias("pn"), F.col("_parts").alias("_theirs"))
    earlier = (F.col("pn") > F.col("n")) | ((F.col("pn") == F.col("n")) & (F.col("parent") < F.col("seq")))
    first = F.array_position(F.zip_with("_parts", "_theirs", lambda x, y: x == y), F.lit(True)) == F.col("_nth") + 1
    met = side.join(other, ["cell_id", "_len", "_nth", "_key"]).where(earlier & first)
    return met.select("cell_id", "seq", "parent", "pn", hamming("seq", "parent").alias("d")).where(F.col("d") <= errors)


def _decided(pairs: DataFrame, state: DataFrame) -> DataFrame:
    """States after one round; it decides at least the first open barcode of each cell."""
    waiting = state.where("state = 'open'").select("cell_id", "seq")
    seen = pairs.join(waiting, ["cell_id", "seq"], "left_semi").join(
        state.select("cell_id", F.col("seq").alias("parent"), F.col("state").alias("_ps")), ["cell_id", "parent"]
    ).groupBy("cell_id", "seq").agg(
        F.bool_or(F.col("_ps") == "kept").alias("_hit"), F.bool_or(F.col("_ps") == "open").alias("_wait")
    )
    decided = F.when(F.col("_hit"), "merged").when(F.col("_wait"), "open").otherwise("kept")
    return state.join(seen, ["cell_id", "seq"], "left").select(
        "cell_id", "seq", F.when(F.col("state") == "open", decided).otherwise(F.col("state")).alias("state")
    )


def _owners(uniq: DataFrame, errors: int) -> DataFrame:
    """Owner of every barcode, decided in rounds over all cells together.

    A barcode with an accepted earlier neighbour is merged; one whose earlier
    neighbours are all merged is accepted; the others wait.  The first
    undecided barcode of a cell can always be decided, so the rounds end.
    Barcodes without an earlier neighbour are accepted from the start, and a
    round only looks at pairs whose later barcode still waits.
    """
    pairs = settle(_close_pairs(uniq, errors), "pairs")
    waiting = pairs.select("cell_id", "seq").distinct().withColumn("state", F.lit("open"))
    first = pairs.select("cell_id", F.col("parent").alias("seq")).distinct().join(waiting, ["cell_id", "seq"], "left_anti")
    state = settle(waiting.unionByName(first.withColumn("state", F.lit("kept"))), "state")
    while not state.where("state = 'open'").isEmpty():
        before, state = state, settle(_decided(pairs, _decided(pairs, state)), "state")  # two rounds a table
        discard(before)
    kept = state.where("state = 'kept'").select("cell_id", F.col("seq").alias("parent"))
    # Nearest kept neighbour of a merged one; the one accepted first on a tie.
    merged = pairs.join(state.where("state = 'merged'").select("cell_id", "seq"), ["cell_id", "seq"], "left_semi")
    near = merged.join(kept, ["cell_id", "parent"]).groupBy("cell_id", "seq").agg(
        F.min(F.struct("d", (-F.col("pn")).alias("pn"), "parent")).alias("_p")
    )
    return uniq.join(near, ["cell_id", "seq"], "left").select(
        "cell_id", F.coalesce("_p.parent", "seq").alias("owner"), "n"
    )


def collapse_barcodes(spots: DataFrame, errors: int = ERRORS_MAX) -> DataFrame:
    """Collapsed barcodes ``(cell_id, seq, n)`` of a table of barcode spots."""
    return collapse_unique(settle(unique_barcodes(spots), "unique"), errors)


def collapse_unique(uniq: DataFrame, errors: int = ERRORS_MAX) -> DataFrame:
    """Collapse distinct barcodes ``(cell_id, seq, n)``, sequencing errors merged.

    In order of (count down, sequence up) a barcode joins the nearest accepted
    one within ``errors`` positions, the earliest accepted on a tie, or is
    accepted itself.  Barcodes of unequal length never join.  All cells go the
    same way: close pairs from an index of segments, then rounds.
    """
    if errors < 0:
        raise ValueError("errors may not be negative")
    return _owners(uniq, errors).groupBy("cell_id", F.col("owner").alias("seq")).agg(F.sum("n").alias("n"))


def attach_soma_barcodes(cells: DataFrame, soma: DataFrame, n_cycles: int) -> DataFrame:
    """Soma barcode of every cell: ``seq``, ``score`` and ``peak`` arrays, zeros where it has none."""
    zeros = F.array_repeat(F.lit(0.0), n_cycles)
    joined = cells.join(soma.select("cell_id", "seq", "score", "peak").withColumn("_has", F.lit(True)), "cell_id", "left")
    return joined.select(
        *[joined[c] for c in cells.columns],
        F.coalesce("seq", F.repeat(F.lit("0"), F.lit(n_cycles))).alias("seq"),
        F.coalesce("score", zeros).alias("score"),
        F.coalesce("peak", zeros).alias("peak"),
        F.col("_has").isNull().alias("missing"),
    )


def soma_table(cycles: DataFrame) -> DataFrame:
    """Soma calls per cycle to one row per cell, lists in cycle order and as long as the cycles."""
    listed = cycles.groupBy("cell_id").agg(F.array_sort(F.collect_list(F.struct("cycle", "base", "score", "peak"))).alias("_c"))
    return listed.select(
        "cell_id",
        F.array_join(F.transform("_c", lambda x: x["base"].cast("string")), "").alias("seq"),
        F.transform("_c", lambda x: x["score"]).alias("score"),
        F.transform("_c", lambda x: x["peak"]).alias("peak"),
    )


def is_barcoded(
    complexity_min: float = COMPLEXITY_MIN, score_min: float = SCORE_MIN, signal_min: float = SIGNAL_MIN, k: int = 3
) -> Column:
    """Complex enough, and the k-th lowest score and cycle signal high enough."""
    return (
        (complexity_score("seq") >= complexity_min)
        & (kth_lowest("score", k) >= score_min)
        & (kth_lowest("peak", k) >= signal_min)
    )


def dominant_barcode(spots: DataFrame, count_min: int = COUNT_MIN, errors: int = ERRORS_MAX) -> DataFrame:
    """Barcodes of the cells with one dominant barcode, long form.

    Cells with more than ``count_min`` spots are collapsed; a cell counts when
    its best merged barcode has more than ``count_min`` spots.  All barcodes of
    such a cell are kept, the dominant one flagged (the earliest accepted on a
    tie, which is the one with the larger own count, then the lower sequence).
    """
    uniq = settle(unique_barcodes(spots), "unique")
    enough = uniq.groupBy("cell_id").agg(F.sum("n").alias("_n")).where(F.col("_n") > count_min)
    eligible = settle(uniq.join(enough, "cell_id", "left_semi"), "eligible")
    merged = settle(collapse_unique(eligible, errors), "merged")
    merged = merged.join(eligible.withColumnRenamed("n", "own"), ["cell_id", "seq"])
    rank = F.struct((-F.col("n")).alias("n"), (-F.col("own")).alias("own"), "seq")
    top = merged.groupBy("cell_id").agg(F.min(rank).alias("_top")).where(-F.col("_top.n") > count_min)
    return merged.join(top, "cell_id").select(
        "cell_id", "seq", "n", (F.col("seq") == F.col("_top.seq")).alias("dominant")
    )


def dominant_soma_barcode(cells: DataFrame) -> DataFrame:
    """The soma barcode itself as the only, dominant barcode."""
    return cells.select("cell_id", "seq", F.lit(1).cast("long").alias("n"), F.lit(True).alias("dominant"))


def library_summary(counts: DataFrame, areas: Sequence[str], length: int = 15) -> DataFrame:
    """Per library barcode the areas it reaches, their numbers and counts as text lists.

    The lists are as long as the list of areas; barcodes found nowhere drop out.
    """
    names = F.array(*[F.lit(a) for a in areas])
    reached = counts.where("n > 0").groupBy("barcode_id", "sequence").agg(
        F.array_sort(F.collect_list(F.struct("area_id", "n"))).alias("_a")
    )

    def text(value) -> Column:
        return F.concat(F.lit("["), F.array_join(F.transform("_a", value), ", "), F.lit("]"))

    return reached.select(
        "barcode_id",
        F.substr("sequence", F.lit(1), F.lit(length)).alias("sequence"),
        text(lambda a: F.concat(F.lit("'"), F.get(names, a["area_id"]), F.lit("'"))).alias("target_areas"),
        text(lambda a: a["area_id"].cast("string")).alias("target_area_ids"),
        text(lambda a: a["n"].cast("string")).alias("target_counts"),
    )


def nearby(rows: DataFrame, seq: str, letters: Column, errors: int) -> DataFrame:
    """Rows once per text ``_text`` that differs from their sequence in at most ``errors`` positions (some texts twice).

    ``letters`` is an array of what may stand in a place, the same for all rows.
    """
    out = rows.withColumn("_text", F.col(seq))
    for _ in range(errors):
        spread = out.withColumn("_at", F.explode(F.sequence(F.lit(0), F.length("_text"))))
        own = F.substr("_text", F.col("_at"), F.lit(1))
        spread = spread.withColumn("_letter", F.explode(F.when(F.col("_at") == 0, F.array(F.lit(""))).otherwise(letters)))
        spread = spread.where((F.col("_at") == 0) | (F.col("_letter") != own))
        changed = F.concat(F.substr("_text", F.lit(1), F.col("_at") - 1), "_letter", F.substr("_text", F.col("_at") + 1))
        out = spread.withColumn("_text", F.when(F.col("_at") == 0, F.col("_text")).otherwise(changed)).drop("_at", "_letter")
    return out


def match_library(cells: DataFrame, library: DataFrame, length: int = 15, errors: int = 1) -> DataFrame:
    """Library row of each cell barcode within ``errors`` positions; the last row wins.

    Both sides meet on equal texts: the library, the smaller side, lists all
    texts within the larger half of the errors, with the letters the cells
    have, and the distinct barcodes those within the rest, which are
    themselves for one error.  So no pair is measured, and the work grows with
    the rows and not with the pairs that share a part.
    """
    long = cells.where(F.length("seq") == length)
    rows = library.where(F.length("sequence") == length).groupBy("sequence").agg(F.max("barcode_id").alias("barcode_id"))

    def letters(df: DataFrame, seq: str) -> Column:
        return df.select(F.explode(F.array_distinct(F.split(seq, ""))).alias("_l")).agg(F.collect_set("_l")).scalar()

    near = nearby(rows, "sequence", letters(long, "seq"), (errors + 1) // 2)
    best = near.groupBy("_text").agg(F.max("barcode_id").alias("barcode_id"))
    if errors > 1:
        texts = nearby(long.select("seq").distinct(), "seq", letters(rows, "sequence"), errors // 2)
        best = texts.join(best.hint("merge"), "_text").groupBy("seq").agg(F.max("barcode_id").alias("barcode_id"))
    else:
        best = best.withColumnRenamed("_text", "seq")
    # The texts are many times the rows the optimizer sees, so they are never broadcast.
    return long.join(best.hint("merge"), "seq").select(*cells.columns, "barcode_id")


def clean_list(text: str) -> Column:
    """Drop brackets, quotes and blanks of a printed list."""
    return F.translate(text, "[]' ", "")


def expand_matches(cells: DataFrame, matches: DataFrame, units: DataFrame) -> DataFrame:
    """Cells with their unit, structural unit and scan; one row per unit, nulls where there is none."""
    linked = matches.join(units, "sunit_id", "left").select("cell_id", "sunit_id", "unit_id", "scan_idx")
    return cells.join(linked, "cell_id", "left")


def matched_centroids(matches: DataFrame, one: DataFrame, two: DataFrame) -> DataFrame:
    """Both coordinate triples of every match of ``cell_id`` and ``sunit_id``."""
    a = one.select("cell_id", F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("z").alias("z1"))
    b = two.select("sunit_id", F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("z").alias("z2"))
    return matches.join(a, "cell_id").join(b, "sunit_id").select("cell_id", "x1", "y1", "z1", "sunit_id", "x2", "y2", "z2")
